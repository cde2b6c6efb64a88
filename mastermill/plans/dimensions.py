"""The dimensions of one run: given read-only frames, and stored ones that grow by registration."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import code_prefix
from ..operators.dedupe import dedupe_keys
from ..operators.lookups import code_counts, new_dimension_rows, split_codes, spread
from ..session import new_work_path
from ..sources.tables import SEGMENT, Commit, SnapshotStore
from ..spec import AUDIT_COLUMNS, EntitySpec, GateRule, LookupRule

DIMENSIONS, DIMENSION, EXTRA = "dimensions", "dimension", "extra"
ROW_OVERHEAD = 64  # bytes of a broadcast row besides its code
DIMENSION_SCHEMA = {"id": "bigint", "code": "string", "name": "string"} | AUDIT_COLUMNS
STORED_SCHEMA = ", ".join(f"`{c}` {t}" for c, t in DIMENSION_SCHEMA.items()) + f", {EXTRA} map<string,string>, {DIMENSION} string"


def by_file(rows: DataFrame) -> DataFrame:
    """Rows of dimensions placed so that a file holds a range of ids of one dimension."""
    return rows.repartition(F.col(DIMENSION), (F.col("id") / 1_000_000).cast("bigint"))


class Dimensions:
    """Stored dimensions share one table, partitioned by the dimension's name.

    Rows given for a registered dimension are taken into the store on every run, as far as it lacks their codes; a given
    id or code that contradicts a stored one raises an error. Columns beyond the common ones are kept as text in the map ``extra``.
    """

    def __init__(self, store: SnapshotStore, head: Commit | None, given: Mapping[str, DataFrame], options):
        self.store, self.given, self.options = store, given, options
        self.segments = store.live_segments(DIMENSIONS, head)
        self.counters = dict(head.counters) if head else {}
        self.grown: set[str] = set()
        self.code_counts: DataFrame | None = None
        self.stored_rows: DataFrame | None = None
        self.sizes: dict[str, tuple[int, int]] = {}

    def given_frame(self, name: str) -> DataFrame:
        if name not in self.given:
            raise ValueError(f"dimension {name} is not given")
        return self.given[name]

    def stored(self, name: str) -> DataFrame:
        """A registered dimension; the filter on the partition column prunes the other dimensions' files."""
        if self.stored_rows is None:
            self.stored_rows = self._read(self.segments)
        return self.stored_rows.filter(F.col(DIMENSION) == name).drop(DIMENSION, SEGMENT)

    def _read(self, segments: list[str]) -> DataFrame:
        if not segments:
            return self.store.spark.createDataFrame([], f"{STORED_SCHEMA}, {SEGMENT} string")
        return self.store.read_segments(DIMENSIONS, segments, STORED_SCHEMA)

    def fits(self, rule: LookupRule) -> bool:
        """Whether the rows of a dimension and the bytes of what a join takes of it, as counted, are within the limit for a broadcast."""
        name = rule.dimension
        if rule.missing == "register":
            rows, size = self.counters.get(name, 0), self.counters.get(f"{name}.bytes", 0)
        else:
            if name not in self.sizes:
                taken = dict.fromkeys(["code", *(value for value, _ in rule.outputs.values())])
                sizes = [F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in taken]
                size = F.coalesce(F.sum(functools.reduce(lambda a, b: a + b, sizes)), F.lit(0))
                self.sizes[name] = self.given_frame(name).agg(F.count("*"), size).first()
            rows, size = self.sizes[name]
        return rows * ROW_OVERHEAD + size <= self.options.broadcast_bytes

    def strategy(self, rule: LookupRule) -> dict:
        """How to join a dimension: broadcast where it fits; beyond it a shuffle join, whose frequent codes are divided by their counts
        if the rule asks for it."""
        if rule.missing != "register" and not rule.spread:
            return {}  # codes are unique in the rows: Catalyst's own choice is safe
        if self.fits(rule):
            return {"small": True}
        if not rule.spread:
            return {}
        counts = self.code_counts.filter(F.col(DIMENSION) == rule.dimension).select("code", "rows")
        return {"counts": counts, "target_rows": self.options.target_rows}

    def register_all(self, rows: DataFrame, spec: EntitySpec) -> None:
        """Store the codes of ``rows`` that the registered dimensions lack, for all rules at once.

        One scan counts the codes of every rule; the counts also tell which codes are frequent.
        """
        lookups = [r for r in spec.rules if isinstance(r, LookupRule)]
        names = [r.dimension for r in lookups if r.missing == "register"]
        if not names and not any(r.spread for r in lookups):
            return
        spark = self.store.spark
        staged = new_work_path(spark, f"{spec.name}-codes")
        self._used_codes(rows, spec).write.parquet(staged)
        self.code_counts = spark.read.parquet(staged)
        if not names:
            return
        seeds = [n for n in dict.fromkeys(names) if n in self.given]
        parts = [self._unstored(n) for n in seeds]

        known = [self._read(self.segments)] if self.segments else []
        known = [part.select(DIMENSION, "code") for part in [*known, *parts]]
        fresh = self.code_counts.filter(F.col(DIMENSION).isin(names)).select(DIMENSION, "code")
        if known:
            fresh = fresh.join(functools.reduce(DataFrame.unionByName, known), [DIMENSION, "code"], "left_anti")
        tops = dict(self.counters)
        for name in seeds:
            tops[name] = max(self.given[name].agg(F.max("id")).first()[0] or 0, tops.get(name, 0))
        start = F.coalesce(*[F.when(F.col(DIMENSION) == n, F.lit(tops.get(n, 0))) for n in dict.fromkeys(names)])
        options = self.options
        added = new_dimension_rows(fresh, None, options.run_ts, options.user, start, within=[DIMENSION])
        added = added.withColumn(EXTRA, F.lit(None).cast("map<string,string>"))

        written = self.store.write_segment(DIMENSIONS, *map(by_file, [added, *parts]), partition_by=[DIMENSION])
        new = self._read(written)
        size = F.sum(F.octet_length("code")).alias("bytes")
        tallies = new.groupBy(DIMENSION).agg(F.max("id").alias("top"), size).collect()
        if tallies:
            self.segments = [*self.segments, *written]
        for tally in tallies:
            name, before = tally[DIMENSION], self.counters.get(f"{tally[DIMENSION]}.bytes", 0)
            self.counters[name] = max(tally["top"] or 0, tops.get(name, 0))
            self.counters[f"{name}.bytes"] = before + (tally["bytes"] or 0)
            self.grown |= {name, f"{name}.bytes"}

    def _unstored(self, name: str) -> DataFrame:
        """The given rows of a dimension whose codes are not stored; an error if one contradicts a stored row."""
        seed = self._seed(name)
        if name not in self.counters:
            return seed
        stored = self.stored(name).select(F.col("id").alias("stored_id"), F.col("code").alias("stored_code"))
        by_code = seed.join(stored, F.col("code") == F.col("stored_code")).filter("id <> stored_id")
        by_id = seed.join(stored, F.col("id") == F.col("stored_id")).filter("code <> stored_code")
        wrong = by_code.unionByName(by_id).select("id", "code", "stored_id", "stored_code").first()
        if wrong:
            raise ValueError(f"dimension {name}: given {wrong.id} {wrong.code}, stored {wrong.stored_id} {wrong.stored_code}")
        return seed.join(stored, F.col("code") == F.col("stored_code"), "left_anti")

    def _seed(self, name: str) -> DataFrame:
        """A given dimension as rows of the store, the smallest id for each code."""
        seed = self.given[name].filter("code IS NOT NULL").withColumn("_order", -F.col("id"))
        seed = dedupe_keys(seed, ["code"], order_by=["_order"]).drop("_order")
        beyond = [c for c in seed.columns if c not in DIMENSION_SCHEMA]
        pairs = [x for c in beyond for x in (F.lit(c), F.col(c).cast("string"))]
        extra = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
        common = [(F.col(c) if c in seed.columns else F.lit(None)).cast(t).alias(c) for c, t in DIMENSION_SCHEMA.items()]
        return seed.select(F.lit(name).alias(DIMENSION), *common, extra.alias(EXTRA))

    def _used_codes(self, rows: DataFrame, spec: EntitySpec) -> DataFrame:
        """``dimension, code, rows`` over the rows that reach each rule that registers or spreads codes.

        A row reaches a rule when the preceding rules keep it: their sources are not null and, where a rule
        drops rows, the code is known. The counts are combined in the map tasks.
        """
        reached, entries = F.lit(True), []
        for n, rule in enumerate(spec.rules):
            if isinstance(rule, GateRule):
                continue
            code = code_prefix(rule.source, rule.prefix)
            if rule.require_source or rule.missing != "null":
                reached = reached & F.col(rule.source).isNotNull()
            if rule.missing == "register" or rule.spread:
                entry = F.struct(F.lit(rule.dimension).alias(DIMENSION), code.alias("code"))
                entries.append(F.when(reached & code.isNotNull(), entry))
            if rule.missing == "drop":
                known = self.given_frame(rule.dimension).select(F.col("code").cast("string").alias(f"_code{n}"))
                known = known.filter(F.col(f"_code{n}").isNotNull()).distinct().withColumn(f"_known{n}", F.lit(True))
                rows = rows.withColumn(f"_code{n}", code.cast("string"))
                if self.fits(rule):
                    rows = rows.join(F.broadcast(known), f"_code{n}", "left")
                else:
                    left, right = spread(rows, known, f"_code{n}", split_codes(code_counts(rows, code), self.options.target_rows))
                    rows = left.join(right, [f"_code{n}", "_lookup_salt"], "left").drop("_lookup_salt")
                reached = reached & F.col(f"_known{n}").isNotNull()
        used = rows.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        return used.groupBy(DIMENSION, "code").agg(F.count("*").alias("rows"))

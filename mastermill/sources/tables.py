"""Stored tables: plain reads and appends, and versioned snapshots with one atomic publish."""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import small_files as files

SEGMENT, SLICE = "segment", "slice"
FILE, ROW = "_stored_file", "_stored_row"  # where a stored row stands
LOG, MANIFESTS, DELETES, FILTERS = "commit_log", "manifests", "deletes", "filters"
CHECKPOINT_EVERY = 16  # commits between two checkpoints of the run ids, and the most sets of deleted rows that a table has
RECENT = 64  # the most changes that a commit lists beside its manifest
MANIFEST_SCHEMA = "place int, table string, unit string, rows bigint, slices int, words int, least string, greatest string, signature string"
DELETE_SCHEMA = f"{SEGMENT} string, {FILE} string, {ROW} bigint"
FILTER_SCHEMA = f"slices int, words int, {SLICE} int, word bigint, bits bigint"
COMPRESSION = "zstd"  # of stored tables; hash digits take half the bytes that they take with snappy
BROADCAST_ROWS = 1 << 20
SCANS, SCANNED_ROWS = 64, 1_000_000  # the most scans that one read of a segment is divided into; the rows for each task of a scan
STANDING_FILES = 16  # the most files that a slice may get from rows that are written without being moved
STANDING_ROWS = 62_500  # the rows that a file holds for that on average, where slices get several: each file costs its writing, listing and opening
FILTER_ROWS = 16_384  # segments of fewer rows have no key filter
PRUNED_UNITS, PRUNED_SHARE = 8, 20  # units are looked for when there are so many, and so many stored rows for each key


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", **options) -> DataFrame:
    """A whole table. For JDBC pass ``fmt="jdbc"`` with ``dbtable``, and ``partitionColumn``, ``lowerBound``,
    ``upperBound``, ``numPartitions`` to read it in parallel."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(url=location, **options).load()
    return spark.read.format(fmt).options(**options).load(location)


def append_table(df: DataFrame, location: str, fmt: str = "parquet", **options) -> None:
    """Append rows to a Parquet directory or, with ``fmt="jdbc"``, to a database table."""
    writer = df.write.format(fmt).mode("append")
    if fmt == "jdbc":
        writer.options(url=location, **options).save()
    else:
        writer.options(**options).save(location)


def replace_table(df: DataFrame, location: str) -> None:
    """Overwrite a staging copy; the counterpart of truncate-and-load."""
    df.write.mode("overwrite").parquet(location)


def one_row(spark: SparkSession, values: Mapping, schema: str) -> DataFrame:
    """A frame of one row and one partition, built without starting a Python worker."""
    parsed = F.from_json(F.lit(json.dumps(values)), schema)
    return spark.range(0, 1, 1, 1).select(parsed.alias("row")).select("row.*")


def path_exists(spark: SparkSession, location: str) -> bool:
    return files.exists(spark, location)


@dataclass(frozen=True)
class Unit:
    """What a commit knows of a slice: its rows, how many slices its segment has, the words of its key filter, its range of keys as text, and
    the name of the signature that its rows were hashed with."""

    rows: int = 0
    slices: int = 0
    words: int = 0
    least: str | None = None
    greatest: str | None = None
    signature: str | None = None


UNIT_FIELDS = tuple(Unit.__dataclass_fields__)


@dataclass(frozen=True)
class Commit:
    version: int
    run_id: str
    units: Mapping[str, Mapping[str, Unit]]
    counters: Mapping[str, int]
    deletes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    signatures: Mapping[str, Mapping] = field(default_factory=dict)
    manifest: str | None = field(default=None, compare=False)
    recent: Sequence[Mapping] = field(default=(), compare=False)

    @property
    def tables(self) -> dict[str, list[str]]:
        """The live slices, or whole segments, of every table in the order of their writing."""
        return {table: list(units) for table, units in self.units.items()}


class SnapshotStore:
    """Tables under one root whose visible content changes all at once.

    A table is a set of Parquet directories ``<root>/<table>/segment=<id>``. A commit is one small file, ``commit_log/v<number>.json``, that is
    created only if no other writer created it, so of two runs that start from one version the later one fails. It names a
    manifest, a Parquet table of all live units with their rows, key ranges and filters, and lists the few changes since that was written. Its
    size does not grow with the number of units. Every few commits a checkpoint gathers the ids of all runs; the newest commit
    is found from there. Readers take the newest commit, or any other whose files are not yet removed by :meth:`vacuum`.

    Tables that have bucket keys are cut further: a segment consists of slices by hash of these keys, about one for each
    ``unit_rows`` rows, and a slice of a segment is what a commit lists. A run that only adds rows writes new slices and keeps
    the others. Of rows that changed, the new ones are written to a new segment and the places of the old ones to a set of
    deleted rows that readers leave out; a slice of up to ``rewrite_rows`` rows, or one of which every tenth row
    changed, is written anew. Tables with the same keys and the same rows have the same slices.

    With ``buckets``, segments of tables that have bucket keys are clustered by these keys into that many
    buckets, and reads keep the clustering, so joins on the keys do not shuffle the stored side. Take the
    number of shuffle partitions: then the rows of an extract, shuffled once for their de-duplication, meet
    the stored rows without another exchange.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 0,
        bucket_keys: Mapping[str, Sequence[str]] | None = None,
        unit_rows: int = 1_000_000,
        rewrite_rows: int = 1024,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_keys = dict(bucket_keys or {})
        self.unit_rows = unit_rows
        self.rewrite_rows = rewrite_rows
        self.registered: set[str] = set()
        self._manifest: tuple[str | None, list] = (None, [])

    # -- commits ---------------------------------------------------------------------------------------

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/{LOG}/v{version:010d}.json"

    def _log(self) -> tuple[int, list[dict]]:
        """The version of the newest checkpoint, and that commit and those after it."""
        text = files.read_text(self.spark, f"{self.root}/{LOG}/_checkpoint")
        start = int(text) if text else 0
        found, version = [], max(start, 1)
        while (text := files.read_text(self.spark, self._commit_path(version))) is not None:
            found.append(json.loads(text))
            version += 1
        return start, found

    def head(self) -> Commit | None:
        """The newest commit."""
        found = self._log()[1]
        return self._commit(found[-1]) if found else None

    def at(self, version: int) -> Commit:
        """An earlier commit."""
        text = files.read_text(self.spark, self._commit_path(version))
        if text is None:
            raise ValueError(f"there is no version {version}")
        return self._commit(json.loads(text))

    def _commit(self, row: Mapping) -> Commit:
        units: dict[str, dict[str, Unit]] = {}
        for entry in [*self._manifest_rows(row["manifest"]), *row["recent"]]:
            table, unit = entry["table"], entry["unit"]
            if entry.get("gone"):
                units.get(table, {}).pop(unit, None)
            else:
                units.setdefault(table, {})[unit] = Unit(*(entry[c] for c in UNIT_FIELDS))
        for table in row["tables"]:
            units.setdefault(table, {})
        return Commit(row["version"], row["run_id"], units, row["counters"], row["deletes"], row["signatures"], row["manifest"], row["recent"])

    def _manifest_rows(self, name: str | None) -> list:
        if name is None:
            return []
        if self._manifest[0] != name:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/{MANIFESTS}/{name}").orderBy("place")
            self._manifest = (name, [r.asDict() for r in rows.toLocalIterator()])
        return self._manifest[1]

    def _write_manifest(self, units: Mapping[str, Mapping[str, Unit]]) -> str:
        name = uuid.uuid4().hex
        flat = [(table, unit, *asdict(facts).values()) for table, its in units.items() for unit, facts in its.items()]
        rows = self.spark.createDataFrame([(n, *entry) for n, entry in enumerate(flat)], MANIFEST_SCHEMA)
        rows.coalesce(1).write.parquet(f"{self.root}/{MANIFESTS}/{name}")
        return name

    def runs(self) -> DataFrame:
        """``version, run_id`` of all published runs."""
        start, found = self._log()
        rows = self.spark.createDataFrame([(r["version"], r["run_id"]) for r in found if r["version"] > start], "version bigint, run_id string")
        if not start:
            return rows
        return rows.unionByName(self.spark.read.parquet(f"{self.root}/{LOG}/runs-{start:010d}"))

    def has_run(self, run_id: str) -> bool:
        """Whether a run was published before; makes retried micro-batches harmless."""
        return bool(self.known_runs([run_id]))

    def known_runs(self, run_ids: Iterable[str]) -> set[str]:
        """Those of the given runs that were published before: from the commits since the checkpoint, then from the checkpoint."""
        start, found = self._log()
        wanted = set(run_ids)
        published = [r for row in found for r in row["runs"]]
        known = wanted & set(published)
        if start and wanted - known:
            older = self.spark.read.parquet(f"{self.root}/{LOG}/runs-{start:010d}")
            known |= {r.run_id for r in older.filter(F.col("run_id").isin(list(wanted - known))).select("run_id").distinct().collect()}
        return known

    def commit(
        self,
        run_id: str,
        tables: Mapping[str, Sequence[str]],
        previous: Commit | None,
        counters: Mapping[str, int] | None = None,
        facts: Mapping[str, Mapping[str, Unit]] | None = None,
        deletes: Mapping[str, Mapping[str, int]] | None = None,
        runs: Sequence[str] = (),
        signatures: Mapping[str, Mapping] | None = None,
    ) -> Commit:
        """Publish the live units and greatest ids of the named tables; other tables keep theirs.

        ``previous`` is the commit the run started from; when another run was published from it, this one fails. ``facts`` describes new units,
        ``deletes`` has the sets of deleted rows of the named tables with their sizes, and ``runs`` further run ids that this commit stands for,
        ``signatures`` what units name as theirs.
        """
        old = previous.units if previous else {}
        units, changes = dict(old), []
        for table, live in tables.items():
            known, described = old.get(table, {}), (facts or {}).get(table, {})
            units[table] = {unit: known.get(unit) or described.get(unit, Unit()) for unit in live}
            changes += [{"table": table, "unit": unit, "gone": True} for unit in known if unit not in units[table]]
            changes += [{"table": table, "unit": unit, **asdict(facts)} for unit, facts in units[table].items() if unit not in known]
        manifest, recent = (previous.manifest, [*previous.recent, *changes]) if previous else (None, changes)
        if len(recent) > RECENT:
            manifest, recent = self._write_manifest(units), []
        version, top = (previous.version if previous else 0) + 1, dict(previous.counters if previous else {}) | dict(counters or {})
        live_deletes = dict(previous.deletes if previous else {}) | {t: dict(d) for t, d in (deletes or {}).items()}
        known_signatures = dict(previous.signatures if previous else {}) | dict(signatures or {})
        row = {
            "version": version, "run_id": run_id, "runs": list(dict.fromkeys([run_id, *runs])), "committed_at": datetime.now(timezone.utc).isoformat(),
            "tables": sorted(units), "manifest": manifest, "recent": recent, "counters": top, "deletes": live_deletes,
            "signatures": known_signatures,
        }
        if not files.write_new(self.spark, self._commit_path(version), json.dumps(row)):
            raise RuntimeError(f"version {version} already exists: another run published it")
        if version % CHECKPOINT_EVERY == 0:
            self._checkpoint(version)
        return Commit(version, run_id, units, top, live_deletes, known_signatures, manifest, recent)

    def _checkpoint(self, version: int) -> None:
        """Gather the run ids up to a version; only the writer of that version does, and a missing checkpoint costs no more than reading on from the one before."""
        start, found = self._log()
        rows = [(r["version"], name) for r in found if start < r["version"] <= version for name in r["runs"]]
        runs = self.spark.createDataFrame(rows, "version bigint, run_id string")
        if start:
            runs = runs.unionByName(self.spark.read.parquet(f"{self.root}/{LOG}/runs-{start:010d}"))
        runs.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{LOG}/runs-{version:010d}")
        files.write_text(self.spark, f"{self.root}/{LOG}/_checkpoint", str(version))

    def vacuum(self, retain: timedelta = timedelta(days=7)) -> int:
        """Remove what no commit of the last ``retain`` refers to, nor the newest one; returns how many folders went.

        Files are listed and joined with the units of the commits in question; a folder written within ``retain`` stays, for it may belong to a run
        that is not yet published. Commits older than that, up to the checkpoint, go as well.
        """
        head, gone = self.head(), 0
        if head is None:
            return 0
        cutoff = datetime.now(timezone.utc) - retain
        start, tail = self._log()
        numbers = [int(n[1:11]) for n in files.names(self.spark, f"{self.root}/{LOG}") if n.startswith("v") and n.endswith(".json")]
        kept = {row["version"]: row for row in tail}
        for version in sorted(set(numbers) - set(kept), reverse=True):
            row = json.loads(files.read_text(self.spark, self._commit_path(version)))
            if datetime.fromisoformat(row["committed_at"]) < cutoff:
                continue
            kept[version] = row
        # A commit was the newest one until the next was written: it counts when that happened within the time.
        for version in sorted(kept):
            after = kept.get(version + 1)
            if after and datetime.fromisoformat(after["committed_at"]) < cutoff:
                del kept[version]
        live = {(table, unit) for row in kept.values() for table, its in self._commit(row).units.items() for unit in its}
        live |= {(DELETES, f"{table}/{name}") for row in kept.values() for table, its in row["deletes"].items() for name in its}
        live |= {(MANIFESTS, row["manifest"]) for row in kept.values()}
        for table in sorted({t for t, _ in live} | {MANIFESTS, DELETES, FILTERS}):
            found = self._folders(table, cutoff)
            if found is None:
                continue
            wanted = [(unit,) for t, unit in live if t == table]
            if table == FILTERS:
                wanted = [(unit.split("/")[0],) for t, unit in live if t in self.bucket_keys]
            dead = found.join(self.spark.createDataFrame(wanted, "unit string").distinct(), "unit", "left_anti")
            for row in dead.toLocalIterator():
                folder = row["unit"] if table in (MANIFESTS, DELETES) else f"{SEGMENT}={row['unit']}"
                files.delete(self.spark, f"{self.root}/{table}/{folder}")
                gone += 1
        for version in numbers:
            if version < start and version not in kept:
                files.delete(self.spark, self._commit_path(version))
        for name in files.names(self.spark, f"{self.root}/{LOG}"):
            if name.startswith("runs-") and int(name[5:]) < start:
                files.delete(self.spark, f"{self.root}/{LOG}/{name}")
        return gone

    def _folders(self, table: str, cutoff: datetime) -> DataFrame | None:
        """The folders of units under a table whose files were all written before a time."""
        location = f"{self.root}/{table}"
        if not files.exists(self.spark, location):
            return None
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location).select("path", "modificationTime")
        below = F.substring_index("path", f"/{table}/", -1)
        unit = F.regexp_replace(below, "/[^/]*$", "")
        if table not in (MANIFESTS, DELETES):
            sliced = table in self.bucket_keys
            unit = F.regexp_extract(below, f"^{SEGMENT}=([^/]*(?:/{SLICE}=[^/]*)?)" if sliced else f"^{SEGMENT}=([^/]*)", 1)
        times = listed.select(unit.alias("unit"), "modificationTime").groupBy("unit").agg(F.max("modificationTime").alias("latest"))
        return times.filter((F.col("unit") != "") & (F.col("latest") <= F.lit(cutoff))).select("unit")

    # -- segments --------------------------------------------------------------------------------------

    def live_segments(self, table: str, at: Commit | None) -> list[str]:
        return list(at.tables.get(table, ())) if at else []

    def slices(self, rows: int, least: int = 1) -> int:
        """The number of slices for a new segment of that many rows; a bucket is never cut."""
        wanted = max(least, -(-rows // self.unit_rows))
        return min(wanted, self.buckets) if self.buckets else wanted

    def dealt_slices(self, rows: int) -> int:
        """The number of slices for rows that stand as a shuffle by the key left them: a near divisor of the shuffle's partitions, where there is
        one, so that the rows of a partition belong to one slice."""
        wanted, partitions = self.slices(rows), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if wanted == 1 or self.buckets:
            return wanted
        near = [n for n in range(2, partitions + 1) if partitions % n == 0 and 0.6 * n * self.unit_rows <= rows <= 1.25 * n * self.unit_rows]
        return min(near, key=lambda n: abs(n - wanted), default=wanted)

    def stand(self, table: str, stored: DataFrame, slices: int, rows: int) -> bool:
        """Whether ``rows`` rows read from files need not be moved to be written by :meth:`write_segment`: each file holds few slices (or buckets),
        so the slices get few files, and none that are small."""
        place, least = self._place(self.bucket_keys[table], slices), self.buckets or slices
        pairs = stored.select(F.col("_metadata.file_path").alias(FILE), place.alias(SLICE)).distinct().count()
        return pairs <= min(STANDING_FILES * least, max(least, rows // STANDING_ROWS))

    def scans(self, location: str, stored: DataFrame, rows: int) -> list[DataFrame]:
        """The files of a folder in order of their names, as scans of a few files each: files hold few bytes a row, and one scan of them all would
        give a task more rows than it can sort. ``stored`` is the whole table and ``rows`` the number of rows in the folder."""
        base = location.rsplit("/", 1)[0]
        names = [f"{location}/{n}" for n in files.names(self.spark, location) if n[0] not in "_."]
        each = max(1, SCANNED_ROWS * len(names) // max(1, rows) // (4 if self.buckets else 1))  # a bucketed write sorts whole rows
        size = max(self.spark.sparkContext.defaultParallelism * each, -(-len(names) // SCANS))
        reader = self.spark.read.option("basePath", base).schema(stored.schema)
        return [reader.parquet(*names[n : n + size]) for n in range(0, len(names), size)]

    def small_units(self, table: str, units: Sequence[str], most: int, schema: str | None = None) -> list[tuple[str, int]]:
        """At most ``most`` of the given units that hold less than half of ``unit_rows``, smallest first, with their rows."""
        if not units:
            return []
        counts = self.read_segments(table, units, schema).groupBy(SEGMENT).agg(F.count("*").alias("rows"))
        small = counts.filter(F.col("rows") < self.unit_rows / 2).orderBy("rows", SEGMENT).limit(most)
        return [(r[SEGMENT], r["rows"]) for r in small.collect()]

    def write_segment(
        self,
        table: str,
        *parts: DataFrame | tuple[DataFrame, Callable[[DataFrame], DataFrame]],
        segment: str | None = None,
        partition_by: Sequence[str] = (),
        slices: int = 1,
        placed: Sequence[DataFrame | tuple[DataFrame, Callable[[DataFrame], DataFrame]]] = (),
        standing: Sequence[DataFrame | tuple[DataFrame, Callable[[DataFrame], DataFrame]]] = (),
    ) -> list[str]:
        """Write the union of ``parts`` as a new, still invisible segment and return what a commit lists of it.

        A part may come with a projection that makes the stored rows of it. It is applied after the rows were moved, so that what can be
        computed from a row, such as absent columns and hashes, is not shuffled or sorted. Each part of a bucketed table is clustered on its own: Spark leaves the shuffle out for a part that
        comes from a join on the bucket keys, so only the new rows move. ``placed`` are further parts, read by :meth:`placed_rows` from a
        segment of as many slices: their rows stand together already and are not shuffled. Neither are those of ``standing``, of which
        :meth:`stand` says so; they may come with a projection as well.
        """
        placed = [*standing, *placed]
        segment = segment or f"s{uuid.uuid4().hex}"
        location = f"{self.root}/{table}/{SEGMENT}={segment}"
        keys = self.bucket_keys.get(table)
        if not keys:
            rows = self._union([_finished(p) for p in parts])
            rows.write.mode("error").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(location)
            return [segment]
        # Spark's own placement by hash: a task holds the rows of one slice, or of one bucket of it.
        place = self._slice(keys, slices)
        if self.buckets:
            rows = self._union([_finished(p, lambda df: df.repartition(self.buckets, *keys)) for p in parts] + [_finished(p) for p in placed]).withColumn(SLICE, place)
            name = f"mastermill_{uuid.uuid4().hex}"
            writer = rows.write.format("parquet").partitionBy(SLICE).bucketBy(self.buckets, *keys).sortBy(*keys)
            writer.option("path", location).option("compression", COMPRESSION).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
        else:
            def ordered(df: DataFrame) -> DataFrame:
                return df.sortWithinPartitions(place, *keys) if slices > 1 else df

            def moved(df: DataFrame) -> DataFrame:
                return ordered(df.repartition(slices, *keys)) if slices > 1 else df

            # The writer finds the rows of a part in order of their slice, so it sorts no wide rows; a union would lose that order. Rows in
            # order of their keys take fewer bytes.
            finished = [_finished(part, moved) for part in parts] + [_finished(part, ordered) for part in placed]
            for n, part in enumerate(finished):
                rows = self._union([part]).withColumn(SLICE, place)
                rows.write.mode("append" if n else "error").option("compression", COMPRESSION).partitionBy(SLICE).parquet(location)
        found = [0]
        if slices > 1:
            folders = (n for n in files.names(self.spark, location) if n.startswith(f"{SLICE}="))
            found = sorted(int(n.removeprefix(f"{SLICE}=")) for n in folders)
        return [f"{segment}/{SLICE}={k}" for k in found]

    @staticmethod
    def _union(parts: Sequence[DataFrame]) -> DataFrame:
        first, *rest = [p.drop(SEGMENT, FILE, ROW) for p in parts]
        for part in rest:
            first = first.unionByName(part)
        return first

    def read_segments(self, table: str, segments: Iterable[str], schema: str | None = None, places: bool = False) -> DataFrame | None:
        """The rows of the given segments, or slices of segments, with the name a commit lists them under as ``segment``.

        A partitioned table needs its ``schema``: a segment without rows has no file to take it from. ``places`` adds the file and the position in
        it that each row stands at. Deleted rows are among them: :meth:`rows` leaves those out.
        """
        segments = list(segments)
        if not segments:
            return None
        base = f"{self.root}/{table}"
        paths = [f"{base}/{SEGMENT}={s}" for s in segments]
        keys = self.bucket_keys.get(table)
        unit = F.concat_ws(f"/{SLICE}=", F.col(SEGMENT), F.col(SLICE).cast("string"))
        if not keys:
            reader = self.spark.read.option("basePath", base)
            found = (reader.schema(f"{schema}, {SEGMENT} string") if schema else reader).parquet(*paths)
            return self._placed(found) if places else found
        if not self.buckets:
            found = self.spark.read.option("basePath", base).parquet(*paths)
            return (self._placed(found) if places else found).withColumn(SEGMENT, unit).drop(SLICE)
        schema = self.spark.read.parquet(paths[0]).schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        names = ", ".join(f"`{k}`" for k in keys)
        identity = hashlib.sha1("|".join([base, str(self.buckets), *segments]).encode()).hexdigest()
        name = f"mastermill_{identity}"
        self.registered.add(name)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {SEGMENT} string, {SLICE} int) USING parquet "
            f"PARTITIONED BY ({SEGMENT}, {SLICE}) "
            f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {self.buckets} BUCKETS LOCATION '{base}'"
        )
        parts = [(*s.split(f"/{SLICE}="), p) for s, p in zip(segments, paths)]
        adds = " ".join(f"PARTITION ({SEGMENT}='{s}', {SLICE}={k}) LOCATION '{p}'" for s, k, p in parts)
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {adds}")
        found = self.spark.table(name)
        return (self._placed(found) if places else found).withColumn(SEGMENT, unit).drop(SLICE)

    def placed_rows(self, table: str, units: Sequence[str]) -> DataFrame:
        """The rows of the slices of one segment, for another table with the same slices.

        A bucketed table is read by buckets. Of others, a few slices at a time are read, as parts of one union: files
        hold few bytes a row, and a scan of all of them at once would give a task the rows of many slices to sort.
        """
        if self.buckets:
            return self.read_segments(table, units).drop(SEGMENT)
        each = max(1, SCANNED_ROWS // self.unit_rows)  # slices for a task
        size = max(self.spark.sparkContext.defaultParallelism * each, -(-len(units) // SCANS))
        groups = [units[n : n + size] for n in range(0, len(units), size)]
        return functools.reduce(DataFrame.unionByName, [self.read_segments(table, group) for group in groups]).drop(SEGMENT)

    @staticmethod
    def _placed(df: DataFrame) -> DataFrame:
        return df.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(ROW))

    def rows(self, table: str, at: Commit | None, units: Iterable[str] | None = None, places: bool = False) -> DataFrame | None:
        """The published rows of a table, or of some of its units, without the deleted ones; columns as in :meth:`read_segments`."""
        units = self.live_segments(table, at) if units is None else list(units)
        sets = at.deletes.get(table, {}) if at else {}
        found = self.read_segments(table, units, places=places or bool(sets))
        if found is None or not sets:
            return found
        # A task that writes several slices gives their files one name, so a place is not known without its unit.
        kept = found.join(self._deleted(table, sets), [SEGMENT, FILE, ROW], "left_anti")
        return kept if places else kept.drop(FILE, ROW)

    def _deleted(self, table: str, sets: Mapping[str, int]) -> DataFrame:
        """The places of deleted rows; broadcast while their counted number is small."""
        dead = self.spark.read.schema(DELETE_SCHEMA).parquet(*[f"{self.root}/{DELETES}/{table}/{name}" for name in sets])
        return F.broadcast(dead) if sum(sets.values()) <= BROADCAST_ROWS else dead

    def deleted_counts(self, table: str, at: Commit) -> dict[str, int]:
        """The number of deleted rows by unit."""
        sets = at.deletes.get(table, {})
        if not sets:
            return {}
        rows = self.spark.read.schema(DELETE_SCHEMA).parquet(*[f"{self.root}/{DELETES}/{table}/{name}" for name in sets])
        return {r[SEGMENT]: r["count"] for r in rows.groupBy(SEGMENT).count().toLocalIterator()}

    def write_deletes(self, table: str, places: DataFrame, count: int, at: Commit | None, live: Iterable[str]) -> dict[str, int]:
        """Store the places of ``count`` deleted rows (unit, file, position); returns the table's sets for the next commit.

        When a table has many sets they become one, without the places in units that are no longer live.
        """
        sets = dict(at.deletes.get(table, {})) if at else {}
        name = uuid.uuid4().hex
        if len(sets) >= CHECKPOINT_EVERY:
            older = self.spark.read.schema(DELETE_SCHEMA).parquet(*[f"{self.root}/{DELETES}/{table}/{n}" for n in sets])
            units = self.spark.createDataFrame([(u,) for u in live], f"{SEGMENT} string")
            places = places.select(SEGMENT, FILE, ROW).unionByName(older.join(units, SEGMENT, "left_semi"))
            count, sets = count + sum(sets.values()), {}
        places.select(SEGMENT, FILE, ROW).write.option("compression", COMPRESSION).parquet(f"{self.root}/{DELETES}/{table}/{name}")
        return sets | {name: count}

    # -- which units hold a key ------------------------------------------------------------------------

    def _place(self, keys: Sequence[str], slices: int):
        """The slice of a row in a segment of so many slices, or its bucket."""
        return F.pmod(F.hash(*keys), F.lit(self.buckets or slices))

    def _slice(self, keys: Sequence[str], slices: int):
        """The slice of a row in a segment of so many slices, as :meth:`write_segment` places it."""
        place = self._place(keys, slices)
        return (place.cast("bigint") * slices / self.buckets).cast("int") if self.buckets else place

    def describe(self, table: str, units: Sequence[str], keys: Sequence[str], slices: int, signature: str | None = None) -> dict[str, Unit]:
        """Rows, key ranges and a key filter of the units of one new segment.

        The filter is a Bloom filter in words of 64 bits, four bits a key and about 16 for each: a key looks at one word. It is a table by word, made
        with partial aggregates, so no unit's filter is built in one place. Small segments have none: their rows are as quickly read.
        """
        found = self.read_segments(table, units)
        text = F.col(f"`{keys[0]}`").cast("string")
        tallies = found.groupBy(SEGMENT).agg(F.count("*").alias("rows"), F.min(text).alias("least"), F.max(text).alias("greatest")).collect()
        most, words = max((t["rows"] for t in tallies), default=0), 0
        if sum(t["rows"] for t in tallies) >= FILTER_ROWS:
            words = 1 << max(0, (most // 4).bit_length())
            key = F.xxhash64(*keys)
            columns = [F.element_at(F.split(SEGMENT, f"/{SLICE}="), -1).cast("int").alias(SLICE), _word(key, words), _bits(key)]
            bits = found.select(*columns).groupBy(SLICE, "word").agg(F.bit_or("bits").alias("bits"))
            bits = bits.select(F.lit(slices).alias("slices"), F.lit(words).alias("words"), SLICE, "word", "bits")
            bits.write.option("compression", COMPRESSION).parquet(f"{self.root}/{FILTERS}/{SEGMENT}={units[0].split('/')[0]}")
        return {t[SEGMENT]: Unit(t["rows"], slices, words, t["least"], t["greatest"], signature) for t in tallies}

    def prunable(self, table: str, at: Commit | None, count: int) -> bool:
        """Whether ``count`` keys are few enough, against the stored rows, to look for the units that may hold them."""
        units = at.units.get(table, {}) if at else {}
        return len(units) >= PRUNED_UNITS and count * PRUNED_SHARE <= sum(u.rows for u in units.values())

    def units_with(self, table: str, at: Commit | None, incoming: DataFrame, keys: Sequence[str], count: int) -> list[str]:
        """The units that may hold a row with one of the ``count`` keys of ``incoming``: by key range, by slice, then by filter.

        All units when there are few of them or the keys are many against the stored rows.
        """
        units = dict(at.units.get(table, {})) if at else {}
        if not self.prunable(table, at, count):
            return list(units)
        cluster, text = self.bucket_keys[table], F.col(f"`{keys[0]}`").cast("string")
        sizes = sorted({u.slices for u in units.values() if u.slices > 1})
        places = [F.struct(F.lit(n).alias("slices"), self._slice(cluster, n).alias(SLICE)) for n in sizes]
        low, high = incoming.agg(F.min(text), F.max(text)).first()
        hit = set()
        if places:
            hit = {tuple(r) for r in incoming.select(F.explode(F.array(*places)).alias("p")).select("p.*").distinct().toLocalIterator()}

        def possible(name: str, unit: Unit) -> bool:
            if unit.least is not None and low is not None and (unit.greatest < low or unit.least > high):
                return False
            return unit.slices < 2 or (unit.slices, int(name.rsplit("=", 1)[1])) in hit

        units = {name: unit for name, unit in units.items() if possible(name, unit)}
        kinds = sorted({(u.slices, u.words) for u in units.values() if u.words})
        if not kinds or count * len(kinds) > BROADCAST_ROWS:
            return list(units)
        key = F.xxhash64(*keys)
        probes = [F.struct(F.lit(n).alias("slices"), F.lit(w).alias("words"), self._slice(cluster, n).alias(SLICE), _word(key, w), _bits(key, "mask")) for n, w in kinds]
        probes = incoming.select(F.explode(F.array(*probes)).alias("p")).select("p.*").distinct()
        base = f"{self.root}/{FILTERS}"
        segments = sorted({name.split("/")[0] for name, unit in units.items() if unit.words})
        stored = self.spark.read.option("basePath", base).schema(f"{FILTER_SCHEMA}, {SEGMENT} string").parquet(*[f"{base}/{SEGMENT}={s}" for s in segments])
        met = stored.join(F.broadcast(probes), ["slices", "words", SLICE, "word"]).filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        found = {f"{r[SEGMENT]}/{SLICE}={r[SLICE]}" for r in met.select(SEGMENT, SLICE).distinct().toLocalIterator()}
        return [name for name, unit in units.items() if not unit.words or name in found]

    def release(self, keep: Iterable[str] = ()) -> None:
        """Drop the catalog entries made for bucketed reads; the files stay. Frames read before are then void."""
        for name in self.registered - set(keep):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.registered &= set(keep)

    def read(self, table: str, at: Commit | None = None) -> DataFrame | None:
        """The published rows of a table, without the segment id; ``None`` before the first commit."""
        rows = self.rows(table, at or self.head())
        return None if rows is None else rows.drop(SEGMENT)


def _finished(part, moved: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The stored rows of a part of a segment: moved, then projected."""
    df, finish = part if isinstance(part, tuple) else (part, lambda rows: rows)
    return finish(moved(df))


def _word(key, words: int):
    return key.bitwiseAND(F.lit(words - 1)).cast("bigint").alias("word")


def _bits(key, name: str = "bits"):
    """The four bits of a key's hash in its word."""
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(key, at).bitwiseAND(F.lit(63)).cast("int")) for at in (32, 38, 44, 50)]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name)

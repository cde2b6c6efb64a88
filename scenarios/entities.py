"""Complete runs of the entities: two daily extracts as CSV, loaded into a store, target table returned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastermill import ENTITIES, EntitySpec, RunOptions, open_store, run_day, run_entity
from mastermill.operators import conform, region_code
from mastermill.plans.entity import AUDIT
from mastermill.session import new_work_path
from mastermill.sources import SnapshotStore, append_table, read_extract, read_table, replace_table
from mastermill.spec import AUDIT_COLUMNS, GateRule, LookupRule
from mastermill.streaming import ingest_stream, stream_rows

from .base import (
    LATER_TEXT,
    LATER_TS,
    ORACLES,
    QUERIES,
    RUN_TEXT,
    RUN_TS,
    picked,
    scenario,
    sql_id_order,
    sql_rank,
    sql_text,
    stamp_text,
    table,
)

FILE_RECORDS = 2_000_000
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "timestamp": "TIMESTAMP", "double": "DOUBLE"}


@dataclass(frozen=True)
class Feed:
    """An entity's extract as expressions over a sample table; they read the same in Spark and in SQL.

    The first day brings the rows of ``first_day``, the second day all rows with the ``changes`` applied.
    """

    entity: str
    source: str
    columns: Mapping[str, str]
    first_day: str
    changes: Mapping[str, str]
    region: str = "AUS"
    junk: Mapping[str, str] = field(default_factory=dict)

    @property
    def spec(self) -> EntitySpec:
        return ENTITIES[self.entity]

    def day(self, second: bool) -> dict[str, str]:
        return dict(self.columns) | dict(self.junk) | (dict(self.changes) if second else {})

    def write(self, spark: SparkSession, sf: str, second: bool, path: str, upper: bool = True) -> str:
        """Write one day's extract as headered gzip CSV with upper-case names; a file cannot be split, so none has too many rows for a task."""
        rows = table(spark, sf, self.source)
        if not second:
            rows = rows.filter(self.first_day)
        names = {(c.upper() if upper else c): e for c, e in self.day(second).items()}
        writer = rows.selectExpr(*[f"{e} AS {c}" for c, e in names.items()]).write
        writer.option("maxRecordsPerFile", FILE_RECORDS).csv(path, header=True, compression="gzip")
        return path


FEEDS = [
    Feed(
        "alternate_parts",
        "lineitem",
        {
            "root_part": "CAST(l_partkey AS STRING)",
            "xref_part": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE concat('X', l_suppkey) END",
            "diff_flg": "l_returnflag",
            "diff_str": "l_linestatus",
            "brandsort": "CAST(l_linenumber AS STRING)",
            "rgcd": "'AUS'",
            "name": "NULLIF(l_returnflag, 'N')",
        },
        first_day="l_linenumber < 6",
        changes={"diff_str": "CASE WHEN l_suppkey < 20 THEN NULL ELSE l_linestatus END"},
    ),
    Feed(
        "bill_of_materials",
        "lineitem",
        {
            "assemb": "CAST(l_orderkey AS STRING)",
            "compnt": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE CAST(l_partkey AS STRING) END",
            "lineno": "CAST(l_linenumber AS STRING)",
            "comqty": "CASE WHEN l_linestatus = 'F' THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS STRING) END",
            "crtdat": "CAST(l_shipdate AS STRING)",
            "revnum": "l_returnflag",
        },
        first_day="l_returnflag <> 'N'",
        changes={"comqty": "CAST(CAST(l_quantity AS INTEGER) AS STRING)"},
    ),
    Feed(
        "customer_part_numbers",
        "orders",
        {
            "xrfptno": "CAST(o_custkey AS STRING)",
            "xricno": "NULLIF(o_orderpriority, '5-LOW')",
            "xdesc": "o_orderstatus",
            "cpalqt": "CAST(o_custkey AS STRING)",
            "xdate": "CAST(o_orderdate AS STRING)",
            "rgcd": "'XX'",
        },
        first_day="o_orderstatus <> 'P'",
        changes={"cpalqt": "CASE WHEN o_orderstatus = 'P' THEN '0' ELSE CAST(o_custkey AS STRING) END"},
        junk={"pkgspc": "'7'", "record_action": "o_orderstatus"},
    ),
    Feed(
        "franchise",
        "supplier",
        {
            "francdn": "CASE WHEN s_nationkey = 4 THEN 'x' ELSE CAST(s_suppkey AS STRING) END",
            "frands": "s_name",
            "paexcept": "CAST(s_nationkey AS STRING)",
        },
        first_day="s_nationkey > 6",
        changes={"frands": "CASE WHEN s_nationkey = 10 THEN 'renamed' ELSE s_name END"},
    ),
    Feed(
        "franchise_code_map",
        "customer",
        {
            "fsoldt": "c_name",
            "frchdisp": "CAST(c_nationkey AS STRING)",
            "fdscd": "NULLIF(c_mktsegment, 'BUILDING')",
            "fshipt": "c_mktsegment",
        },
        first_day="c_acctbal > 0",
        changes={"fshipt": "CASE WHEN c_acctbal > 5000 THEN 'rich' ELSE c_mktsegment END"},
    ),
    Feed(
        "coninv",
        "lineitem",
        {
            "cordno": "CAST(l_orderkey AS STRING)",
            "cinvno": "CAST(l_linenumber AS STRING)",
            "cpartno": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE CAST(l_partkey AS STRING) END",
            "cqtshp": "CAST(CAST(l_quantity AS DECIMAL(16,2)) AS STRING)",
            "cuntpr": "CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS STRING)",
            "cinvdt": "CAST(l_shipdate AS STRING)",
            "cfill1": "l_linestatus",
        },
        first_day="l_linenumber < 5",
        changes={"cqtshp": "CASE WHEN l_suppkey < 30 THEN '1.5' ELSE CAST(CAST(l_quantity AS DECIMAL(16,2)) AS STRING) END"},
        region="OCA",
    ),
    Feed(
        "supplier",
        "supplier",
        {
            "vacode": "CAST(s_suppkey AS STRING)",
            "vaname": "s_name",
            "inter": "CAST(s_nationkey AS STRING)",
            "vastat": "CASE WHEN s_acctbal < 0 THEN 'hold' END",
        },
        first_day="s_nationkey > 3",
        changes={"inter": "'99'", "vastat": "CASE WHEN s_acctbal < 5000 THEN 'hold' END"},
        region="OCA",
        junk={"record_action": "s_name"},
    ),
    Feed(
        "technical_part_details",
        "part",
        {
            "part_num": "CAST(p_partkey AS STRING)",
            "rgcd": "'AUS'",
            "model": "p_name",
            "brand": "p_brand",
            "style": "NULLIF(p_type, 'PROMO')",
            "series": "CAST(p_size AS STRING)",
        },
        first_day="p_size > 10",
        changes={"series": "CASE WHEN p_brand = 'Brand#1' THEN '0' ELSE CAST(p_size AS STRING) END"},
        junk={"tubtyoe": "p_brand", "action": "'U'"},
    ),
]


# -- expected results ----------------------------------------------------------------------------------------


def _cast(spec: EntitySpec, column: str, expr: str) -> str:
    dtype = spec.schema[column]
    sql_type = SQL_TYPES.get(dtype, dtype.upper())
    return f"TRY_CAST(({expr}) AS {sql_type}) AS {column}"


def conformed_sql(feed: Feed, second: bool) -> tuple[str, list[str]]:
    """The valid rows of one day: typed, complete keys, one per key."""
    spec = feed.spec
    exprs = {c: e for c, e in feed.day(second).items() if c in spec.schema and c not in spec.drop}
    exprs |= {c: f"'{v}'" if isinstance(v, str) else str(v) for c, v in spec.constants.items()}
    if spec.region_default and "rgcd" not in exprs:
        exprs["rgcd"] = f"'{region_code(feed.region)}'"
    if spec.category_ladder:
        exprs |= {f"cc{n}": f"substr({exprs['cat_cd']}, 1, {n})" for n in range(1, 6)}
    typed = ", ".join(_cast(spec, c, e) for c, e in exprs.items())
    where = "" if second else f"WHERE {feed.first_day}"
    keys = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    sql = f"""
        SELECT {", ".join(exprs)} FROM (
            SELECT *, {sql_rank(spec.keys, list(exprs))} AS rk
            FROM (SELECT {typed} FROM {feed.source} {where}) WHERE {keys}
        ) WHERE rk = 1
    """
    return sql, list(exprs)


def _full(feed: Feed, second: bool) -> str:
    """All target columns of one day's valid rows, without the audit columns."""
    return full_sql(feed.spec, *conformed_sql(feed, second))


def full_sql(spec: EntitySpec, rows: str, have: list[str]) -> str:
    columns = []
    for c, t in spec.target_columns.items():
        if c in AUDIT_COLUMNS:
            continue
        if c == "code":
            columns.append(f"concat_ws('', {', '.join(f'CAST({k} AS VARCHAR)' for k in spec.code_columns)}) AS code")
        else:
            columns.append(c if c in have else f"CAST(NULL AS {SQL_TYPES.get(t, t.upper())}) AS {c}")
    return f"SELECT {', '.join(columns)} FROM ({rows})"


def merged_sql(spec: EntitySpec, day1: str, day2: str, before: str = "") -> str:
    """The target after both days, with texts for timestamps and the date of the last change."""
    body = [c for c in spec.target_columns if c not in AUDIT_COLUMNS]
    keys = list(spec.delta_keys)
    on = " AND ".join(f"d2.{k} = t1.{k}" for k in keys)
    hit = f"d2.{keys[0]} IS NOT NULL"
    differs = " OR ".join(f"t1.{c} IS DISTINCT FROM d2.{c}" for c in body)
    updated = set(spec.update_columns)
    merged = ", ".join(f"CASE WHEN {hit} THEN d2.{c} ELSE t1.{c} END AS {c}" if c in updated else f"t1.{c}" for c in body)
    shown = ", ".join(
        f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if spec.target_columns[c] == "timestamp" else f'"{c}"' for c in body
    )
    return f"""
        WITH {before} d1 AS ({day1}), d2 AS ({day2}),
        merged AS (
            SELECT {merged}, CASE WHEN {hit} AND ({differs}) THEN '{LATER_TEXT}' ELSE '{RUN_TEXT}' END AS updated_date
            FROM d1 AS t1 LEFT JOIN d2 ON {on}
            UNION ALL
            SELECT {", ".join(body)}, '{LATER_TEXT}' AS updated_date FROM d2 ANTI JOIN d1 USING ({", ".join(keys)})
        )
        SELECT {shown}, updated_date, updated_date AS created_date, 'system' AS updated_by,
               'system' AS created_by, '{spec.validation_status}' AS validationstatus, false AS is_valid, ' ' AS "comment"
        FROM merged
    """


def _code_sql(rule: LookupRule) -> str:
    text = f"CAST({rule.source} AS VARCHAR)"
    return f"substr({text}, 1, {rule.prefix})" if rule.prefix else text


def resolved_sql(feed: Feed, day: int, gate: str = "") -> tuple[str, str, list[str]]:
    """Common table expressions that apply the entity's rules to one day: ``(ctes, last name, columns)``.

    ``dim_<day>_<rule>`` holds a registered dimension after the day; given dimensions are CTEs of their name.
    """
    rows, have = conformed_sql(feed, day == 2)
    name = f"rows_{day}"
    ctes = [f"{name} AS ({rows})"]
    for k, rule in enumerate(feed.spec.rules):
        after = f"rows_{day}_{k}"
        if isinstance(rule, GateRule):
            gated = ", ".join(f"CASE WHEN {rule.source} IN (SELECT code FROM {gate}) THEN {c} END AS {c}" for c in rule.columns)
            ctes.append(f"{after} AS (SELECT * REPLACE ({gated}) FROM {name})")
            name = after
            continue
        dim, code = f"dim_{day}_{k}", _code_sql(rule)
        if rule.missing == "register":
            codes = f"SELECT DISTINCT {code} AS code FROM {name} WHERE {rule.source} IS NOT NULL"
            number = f"row_number() OVER (ORDER BY {sql_id_order(['code'])})"
            if day == 1:
                ctes.append(f"{dim} AS (SELECT code, {number} AS id FROM ({codes}))")
            else:
                old = f"dim_1_{k}"
                ctes.append(
                    f"{dim} AS (SELECT code, id FROM {old} UNION ALL SELECT code, (SELECT count(*) FROM {old}) + {number} "
                    f"AS id FROM (SELECT * FROM ({codes}) ANTI JOIN {old} USING (code)))"
                )
        else:
            dim = rule.dimension
        join = "LEFT JOIN" if rule.missing == "null" else "JOIN"
        where = f"WHERE {rule.source} IS NOT NULL" if rule.require_source else ""
        kept = [c for c in have if c not in rule.outputs]
        types = {out: SQL_TYPES.get(t, t.upper()) for out, (_, t) in rule.outputs.items()}
        added = [f"TRY_CAST(dim.{value} AS {types[out]}) AS {out}" for out, (value, _) in rule.outputs.items()]
        inner = f"(SELECT *, {code} AS lookup_code FROM {name} {where}) r"
        columns = ", ".join([f"r.{c}" for c in kept] + added)
        ctes.append(f"{after} AS (SELECT {columns} FROM {inner} {join} {dim} dim ON dim.code = r.lookup_code)")
        have = [*kept, *rule.outputs]
        name = after
    return ", ".join(ctes), name, have


def ruled_sql(feed: Feed, given: str = "", gate: str = "") -> str:
    """The target after both days of an entity with lookup rules."""
    parts, days = [given] if given else [], []
    for day in (1, 2):
        ctes, name, have = resolved_sql(feed, day, gate)
        parts.append(ctes)
        days.append(full_sql(feed.spec, f"SELECT * FROM {name}", have))
    return merged_sql(feed.spec, *days, before=", ".join(parts) + ",")


def load_two_days(
    spark: SparkSession, sf: str, feed: Feed, dimensions=None, buckets: int = 0, spec: EntitySpec | None = None, **options
) -> SnapshotStore:
    """Write both extracts, load them in order and return the store."""
    base, spec = new_work_path(spark, f"feed-{feed.entity}"), spec or feed.spec
    store = open_store(spark, f"{base}/store", spec, buckets)
    for second, stamp in ((False, RUN_TS), (True, LATER_TS)):
        path = feed.write(spark, sf, second, f"{base}/day{int(second) + 1}")
        run = RunOptions(run_ts=stamp, region=feed.region, file_name=f"{feed.entity}_{int(second) + 1}.csv", **options)
        run_entity(store, spec, read_extract(spark, path), run, dimensions)
    return store


def shown_target(store: SnapshotStore) -> DataFrame:
    target = store.read("target").drop("id")
    return stamp_text(target, *[f.name for f in target.schema.fields if f.dataType.typeName() == "timestamp"])


def _add_simple(feed: Feed) -> None:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return shown_target(load_two_days(spark, sf, feed))

    name = f"entity_{feed.entity}"
    QUERIES[name] = query
    ORACLES[name] = merged_sql(feed.spec, _full(feed, False), _full(feed, True))


for _feed in FEEDS:
    _add_simple(_feed)

BY_NAME = {feed.entity: feed for feed in FEEDS}


def entity_coninv_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shown_target(load_two_days(spark, sf, BY_NAME["coninv"], buckets=buckets))


scenario(ORACLES["entity_coninv"])(entity_coninv_bucketed)


# -- entities with lookup rules ------------------------------------------------------------------------------

CUSTOMER = Feed(
    "customer",
    "customer",
    {
        "custid": "CAST(c_custkey AS STRING)",
        "name": "c_name",
        "chainc": "c_mktsegment",
        "chnl": "CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_nationkey AS STRING) END",
        "shpto": "substr(c_name, 10)",
        "sldto": "c_name",
        "sldto_d": "c_mktsegment",
        "cdisccd": "CAST(c_nationkey AS STRING)",
        "cdiscp": "CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS STRING)",
    },
    first_day="c_acctbal > 1000",
    changes={
        "chainc": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSES' ELSE c_mktsegment END",
        "sldto_d": "CASE WHEN c_nationkey > 20 THEN c_name ELSE c_mktsegment END",
        "cdisccd": "CASE WHEN c_nationkey < 5 THEN '-1' ELSE CAST(c_nationkey AS STRING) END",
    },
    junk={"mmexcll": "'x'"},
)


@scenario(ruled_sql(CUSTOMER))
def entity_customer(spark: SparkSession, sf: str) -> DataFrame:
    """All customers share one sold-to code, the most skewed lookup there can be."""
    return shown_target(load_two_days(spark, sf, CUSTOMER))


PART = Feed(
    "part_regional",
    "part",
    {
        "part_num": "CAST(p_partkey AS STRING)",
        "name": "p_name",
        "rgcd": "CASE WHEN p_size < 20 THEN 'ASIA' WHEN p_size < 40 THEN 'EUROPE' ELSE 'NOWHERE' END",
        "prod_cd5": "NULLIF(p_type, 'SMALL')",
        "mktcd": "NULLIF(p_brand, 'Brand#13')",
        "cat_cd": "p_brand",
        "fran_code": "p_type",
        "lprc": "CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS STRING)",
        "pllqty": "CAST(p_size AS STRING)",
    },
    first_day="p_size > 5",
    changes={
        "lprc": "CAST(CAST(CASE WHEN p_brand = 'Brand#1' THEN 7.25 ELSE p_retailprice END AS DECIMAL(16,2)) AS STRING)",
        "rgcd": "CASE WHEN p_size < 18 THEN 'ASIA' WHEN p_size < 40 THEN 'EUROPE' ELSE 'NOWHERE' END",
    },
    junk={"lpp_part": "'x'", "franc_code": "p_type", "brand_code": "p_brand", "prod_code": "p_type"},
)
PART_DIMENSIONS = {
    "x_market_code": (
        "part",
        "SELECT p_brand AS code, CAST(min(p_size) AS STRING) AS level1, 'x' AS level2, CAST(max(p_size) AS STRING) AS level3, "
        "CAST(count(*) AS STRING) AS level4, CAST(NULL AS STRING) AS level5 FROM part WHERE p_brand <> 'Brand#7' GROUP BY p_brand",
    ),
    "p_lifecycle_stage": ("part", "SELECT CAST(p_partkey AS STRING) AS code, p_partkey + 5 AS id FROM part WHERE p_size >= 25"),
    "p_pricing_region": ("region", "SELECT r_name AS code, r_regionkey + 1 AS id FROM region"),
    "p_pricing_action_detail": (
        "lineitem",
        "SELECT CAST(l_partkey AS STRING) AS code, l_returnflag AS attr, "
        "CASE WHEN l_linestatus = 'F' THEN 'yes' ELSE 'no' END AS app, date_trunc('month', l_shipdate) AS effdt FROM lineitem",
    ),
    "view_x_yes_no_flag": (
        "lineitem",
        "SELECT DISTINCT l_returnflag AS id, CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS code FROM lineitem",
    ),
}
PART_GIVEN = ", ".join(f"{name} AS ({sql})" for name, (_, sql) in PART_DIMENSIONS.items()) + """,
    hits AS (SELECT DISTINCT a.code FROM p_pricing_action_detail a JOIN view_x_yes_no_flag f ON f.id = a.attr
             WHERE f.code = 'True' AND a.app = 'yes' AND CAST(a.effdt AS DATE) = DATE '1998-03-01')
"""


def part_dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        name: spark.sql(sql.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf, source))
        for name, (source, sql) in PART_DIMENSIONS.items()
    }


@scenario(ruled_sql(PART, PART_GIVEN, "hits"))
def entity_part_regional(spark: SparkSession, sf: str) -> DataFrame:
    return shown_target(load_two_days(spark, sf, PART, part_dimensions(spark, sf), file_date=date(1998, 3, 1)))


# -- audit, files and streams --------------------------------------------------------------------------------

LINES = BY_NAME["coninv"]
_KEYS = ", ".join(LINES.spec.keys)
_COUNT_DAY = f"""
    SELECT 1 AS day, (SELECT count(*) FROM lineitem WHERE {LINES.first_day}) AS csv_count, count(*) AS inserts, 0 AS updates FROM d1
    UNION ALL
    SELECT 2, (SELECT count(*) FROM lineitem), count(*) FILTER (d1.cordno IS NULL),
           count(*) FILTER (d1.cordno IS NOT NULL AND d1 IS DISTINCT FROM d2)
    FROM d2 LEFT JOIN d1 USING ({_KEYS})
"""


@scenario(
    f"""
    WITH d1 AS ({_full(LINES, False)}), d2 AS ({_full(LINES, True)}), counts AS ({_COUNT_DAY})
    SELECT 'coninv' AS table_name, concat('coninv_', day, '.csv') AS file_name, 'OCA' AS region,
           CAST(csv_count AS BIGINT) AS csv_count, CAST(inserts AS BIGINT) AS data_insert_count,
           CAST(updates AS BIGINT) AS data_update_count, 'Success' AS status, 'extract loaded' AS success_message,
           '' AS error_message, sha256(concat('coninv_', day, '.csv')) AS file_code
    FROM counts
    """
)
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    store = load_two_days(spark, sf, LINES)
    audit = spark.read.parquet(f"{store.root}/{AUDIT}")
    return audit.drop("created_date", "start_time", "end_time", "duration")


@scenario(
    f"""
    WITH d1 AS ({_full(LINES, False)}), d2 AS ({_full(LINES, True)}),
    n AS (SELECT (SELECT count(*) FROM d1) AS n1, (SELECT count(*) FROM d2 ANTI JOIN d1 USING ({_KEYS})) AS n2)
    SELECT '{RUN_TEXT}' AS created_date, 1::BIGINT AS first_id, n1 AS last_id, n1 AS rows, n1 AS ids FROM n
    UNION ALL
    SELECT '{LATER_TEXT}', n1 + 1, n1 + n2, n2, n2 FROM n
    """
)
def dense_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids are dense in each load and survive updates."""
    target = load_two_days(spark, sf, LINES, preserve_created=True).read("target")
    ids = [F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("rows")]
    ids.append(F.countDistinct("id").alias("ids"))
    return stamp_text(target, "created_date").groupBy("created_date").agg(*ids)


def _hash_sql(spec: EntitySpec) -> str:
    casts = {c: f"epoch_us({c})" for c, t in spec.target_columns.items() if t == "timestamp"}
    return f"sha1({sql_text([c for c in spec.target_columns if c not in AUDIT_COLUMNS], casts)})"


@scenario(
    f"""
    WITH d1 AS ({_full(LINES, False)}), d2 AS ({_full(LINES, True)}),
    latest AS (SELECT * FROM d2 UNION ALL SELECT * FROM d1 ANTI JOIN d2 USING ({_KEYS}))
    SELECT {_KEYS}, concat(CAST(cordno AS VARCHAR), CAST(cinvno AS VARCHAR), cpartno) AS code,
           {_hash_sql(LINES.spec)} AS hash_value
    FROM latest
    """
)
def stored_state(spark: SparkSession, sf: str) -> DataFrame:
    """After both days the state holds the fingerprint of every current row."""
    return load_two_days(spark, sf, LINES).read("state").drop("check_sum")


@scenario(
    """
    SELECT 'appended' AS step, c_custkey, c_name, c_mktsegment FROM customer
    UNION ALL
    SELECT 'replaced', c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    """
)
def appended_and_replaced(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    others = customers.filter("c_mktsegment <> 'BUILDING'")
    grown, staged = new_work_path(spark, "grown"), new_work_path(spark, "staged")
    append_table(customers.filter("c_mktsegment = 'BUILDING'"), grown)
    append_table(others, grown)
    replace_table(customers, staged)
    replace_table(others, staged)
    frames = [read_table(spark, path).withColumn("step", F.lit(step)) for path, step in ((grown, "appended"), (staged, "replaced"))]
    return frames[0].unionByName(frames[1])


EVENT_SQL = """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, CAST(value AS DECIMAL(16,6)) AS value, props
    FROM events
"""
EVENT_SCHEMA = {"event_id": "bigint", "user_id": "bigint", "value": "decimal(16,6)"}


def _event_files(spark: SparkSession, sf: str) -> str:
    path = new_work_path(spark, "events")
    events = table(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    events.repartition(4, "user_id").write.csv(path, header=True)
    return path


@scenario(EVENT_SQL)
def extract_rows(spark: SparkSession, sf: str) -> DataFrame:
    return conform(read_extract(spark, _event_files(spark, sf)), EVENT_SCHEMA)


@scenario(EVENT_SQL)
def stream_extract_rows(spark: SparkSession, sf: str) -> DataFrame:
    path, out = _event_files(spark, sf), new_work_path(spark, "streamed")
    stream = stream_rows(spark, path, table(spark, sf, "events").columns)
    writer = stream.writeStream.foreachBatch(lambda batch, _: append_table(conform(batch, EVENT_SCHEMA), out))
    writer = writer.option("checkpointLocation", new_work_path(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return read_table(spark, out)


@scenario(
    f"""
    WITH d AS ({_full(BY_NAME["franchise"], True)})
    SELECT francdn, frands, paexcept, CAST(francdn AS VARCHAR) AS code FROM d
    """
)
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Every file of a directory loaded by the file stream, each as its own commit."""
    feed = BY_NAME["franchise"]
    spec = replace(feed.spec, files={"AUS": "part-"})
    base = new_work_path(spark, "franchise-stream")
    feed.write(spark, sf, True, f"{base}/AUS")
    store = open_store(spark, f"{base}/store", spec)
    for _ in range(2):  # the second start finds nothing new
        ingest_stream(store, spec, f"{base}/AUS", f"{base}/checkpoint", "AUS", RunOptions(run_ts=RUN_TS)).awaitTermination()
    target = store.read("target").select("francdn", "frands", "paexcept")
    return target.join(store.read("state").select("francdn", "code"), "francdn")

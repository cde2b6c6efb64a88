"""Runs with options, late seeds, empty extracts, the ledger of runs and a day of several files."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, compact, open_store, run_day, run_entity
from mastermill.plans.entity import AUDIT
from mastermill.session import new_work_path
from mastermill.sources import SnapshotStore, read_extract
from mastermill.sources import small_files as files
from mastermill.spec import AUDIT_COLUMNS

from .base import LATER_TEXT, LATER_TS, ORACLES, RUN_TEXT, RUN_TS, scenario, sql_id_order, table
from .entities import (
    BY_NAME,
    CUSTOMER,
    LINES,
    PART,
    PART_GIVEN,
    _full,
    conformed_sql,
    full_sql,
    load_two_days,
    part_dimensions,
    resolved_sql,
    shown_target,
)

KEYS = ", ".join(LINES.spec.keys)
FILE_DATE = date(1998, 3, 1)


# -- fingerprints ------------------------------------------------------------------------------------------------

MURMUR_SQL = f"SELECT *, true AS is_checksum FROM ({ORACLES['entity_part_regional']})"


@scenario(MURMUR_SQL)
def murmur_run(spark: SparkSession, sf: str) -> DataFrame:
    """Parts compared by the 32-bit checksum alone, which the state holds in both columns."""
    spec = replace(PART.spec, fingerprint="murmur")
    store = load_two_days(spark, sf, PART, part_dimensions(spark, sf), spec=spec, file_date=FILE_DATE)
    keys = list(spec.delta_keys)
    same = (F.col("hash_value") == F.col("check_sum").cast("string")).alias("is_checksum")
    return shown_target(store).join(store.read("state").select(*keys, same), keys)


def _legacy_sql() -> str:
    """The plain concatenation: the extract's columns in order, the code, and the audit columns but dates."""
    days = []
    for second in (False, True):
        rows, have = conformed_sql(LINES, second)
        code = f"concat_ws('', {', '.join(f'CAST({k} AS VARCHAR)' for k in LINES.spec.code_columns)})"
        audit = ["'system'", "'true'", "'false'", "'system'", "' '"]
        text = ", ".join([*[f"CAST({c} AS VARCHAR)" for c in have], code, *audit])
        days.append(f"SELECT {KEYS}, sha1(concat_ws('', {text})) AS hash_value FROM ({rows})")
    return f"WITH d1 AS ({days[0]}), d2 AS ({days[1]}) SELECT * FROM d2 UNION ALL SELECT * FROM d1 ANTI JOIN d2 USING ({KEYS})"


@scenario(_legacy_sql())
def legacy_run(spark: SparkSession, sf: str) -> DataFrame:
    """The state of a run that keeps the plain concatenation in file order."""
    return load_two_days(spark, sf, LINES, legacy_fingerprint=True).read("state").select(*LINES.spec.keys, "hash_value")


@scenario(
    f"""
    WITH d1 AS ({_full(LINES, False)}), d2 AS ({_full(LINES, True)})
    SELECT 'sha1 to murmur' AS change, count(*) FILTER (d1.cordno IS NULL) AS inserts,
           count(*) FILTER (d1.cordno IS NOT NULL AND d1 IS DISTINCT FROM d2) AS updates, 0::BIGINT AS updates_again
    FROM d2 LEFT JOIN d1 USING ({KEYS})
    """
)
def changed_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Another method on the second day: stored rows are compared by the method they were hashed with, so only real changes are updates."""
    base, spec = new_work_path(spark, "changed-fingerprint"), LINES.spec
    store = open_store(spark, f"{base}/store", spec)
    paths = [LINES.write(spark, sf, second, f"{base}/day{int(second) + 1}") for second in (False, True)]
    murmur = replace(spec, fingerprint="murmur")
    runs = [(spec, paths[0], RUN_TS), (murmur, paths[1], LATER_TS), (murmur, paths[1], LATER_TS)]
    records = [run_entity(store, s, read_extract(spark, p), RunOptions(run_ts=t, region=LINES.region)) for s, p, t in runs]
    second, third = records[1:]
    row = ("sha1 to murmur", second.data_insert_count, second.data_update_count, third.data_insert_count + third.data_update_count)
    return spark.createDataFrame([row], "change string, inserts bigint, updates bigint, updates_again bigint")


# -- truncated decimals at insert --------------------------------------------------------------------------------


def _narrow_sql() -> str:
    parts, days = [PART_GIVEN], []
    for day in (1, 2):
        ctes, name, have = resolved_sql(PART, day, "hits")
        parts.append(ctes)
        days.append(full_sql(PART.spec, f"SELECT * FROM {name}", have))
    spec = PART.spec
    body = [c for c in spec.target_columns if c not in AUDIT_COLUMNS]
    on = " AND ".join(f"d2.{k} = t1.{k}" for k in spec.delta_keys)
    differs = " OR ".join(f"t1.{c} IS DISTINCT FROM d2.{c}" for c in body)
    changed = f"d2.{spec.delta_keys[0]} IS NOT NULL AND ({differs})"

    def cut(name: str, of: str) -> str:
        return f"CAST(trunc({of}.{name}) AS DECIMAL(16,6))" if name in spec.narrow else f"{of}.{name}"

    updated = set(spec.update_columns)
    shown = ["part_num", "rgcd", *spec.narrow]
    merged = ", ".join(f"CASE WHEN {changed} THEN d2.{c} ELSE {cut(c, 't1')} END AS {c}" if c in updated else f"{cut(c, 't1')} AS {c}" for c in shown)
    new = ", ".join(f"{cut(c, 'd2')} AS {c}" for c in shown)
    return f"""
        WITH {", ".join(parts)}, d1 AS ({days[0]}), d2 AS ({days[1]})
        SELECT {merged}, CASE WHEN {changed} THEN '{LATER_TEXT}' ELSE '{RUN_TEXT}' END AS updated_date FROM d1 AS t1 LEFT JOIN d2 ON {on}
        UNION ALL
        SELECT {new}, '{LATER_TEXT}' FROM d2 ANTI JOIN d1 USING ({", ".join(spec.delta_keys)})
    """


@scenario(_narrow_sql())
def narrow_inserts_run(spark: SparkSession, sf: str) -> DataFrame:
    """Decimals of parts lose their fraction when a row is inserted, and keep it when it is updated."""
    store = load_two_days(spark, sf, PART, part_dimensions(spark, sf), file_date=FILE_DATE, narrow_inserts=True)
    return shown_target(store).select("part_num", "rgcd", *PART.spec.narrow, "updated_date")


# -- dimensions over several runs --------------------------------------------------------------------------------

_CHAINS = "SELECT DISTINCT c_mktsegment AS code FROM customer WHERE c_nationkey <> 3 AND"
_NUMBER = f"row_number() OVER (ORDER BY {sql_id_order(['code'])})"


@scenario(
    f"""
    WITH d1 AS (SELECT code, {_NUMBER} AS id FROM ({_CHAINS} c_custkey % 2 = 0 AND c_mktsegment <> 'MACHINERY')),
    seed AS (SELECT r_name AS code, r_regionkey + 1000 AS id, concat('given ', r_name) AS name FROM region),
    d2 AS (SELECT code, (SELECT max(id) FROM seed) + {_NUMBER} AS id
           FROM (SELECT * FROM ({_CHAINS} true) ANTI JOIN d1 USING (code)))
    SELECT code, CAST(id AS BIGINT) AS id, 'to be filled' AS name FROM d1
    UNION ALL SELECT code, id, name FROM seed
    UNION ALL SELECT code, id, 'to be filled' FROM d2
    """
)
def seed_on_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension given only on the second day keeps its ids; codes registered after it continue behind them."""
    base, spec = new_work_path(spark, "late-seed"), CUSTOMER.spec
    store = open_store(spark, f"{base}/store", spec)
    customers = table(spark, sf, "customer").filter("c_nationkey <> 3")
    columns = [f"{e} AS {c}" for c, e in CUSTOMER.columns.items()]
    seed = table(spark, sf, "region").selectExpr("r_regionkey + 1000 AS id", "r_name AS code", "concat('given ', r_name) AS name")
    first = customers.filter("c_custkey % 2 = 0 AND c_mktsegment <> 'MACHINERY'").selectExpr(*columns)
    run_entity(store, spec, first, RunOptions(run_ts=RUN_TS, run_id="first"))
    run_entity(store, spec, customers.selectExpr(*columns), RunOptions(run_ts=LATER_TS, run_id="second"), {"x_chain": seed})
    return store.read("dimensions").filter("dimension = 'x_chain'").select("code", "id", "name")


@scenario(
    """
    SELECT 1::BIGINT AS run, count(*) AS csv_count, 0::BIGINT AS inserts, 'Success' AS status FROM customer
    UNION ALL
    SELECT 2, count(*), count(*) FILTER (c_nationkey <> 3), 'Success' FROM customer
    """
)
def first_load_without_codes(spark: SparkSession, sf: str) -> DataFrame:
    """A first extract whose rows all lack a code registers nothing and keeps no row; the next one loads as if it were the first."""
    base, spec = new_work_path(spark, "no-codes"), CUSTOMER.spec
    store, customers = open_store(spark, f"{base}/store", spec), table(spark, sf, "customer")
    without = dict(CUSTOMER.columns) | {"chainc": "CAST(NULL AS STRING)"}
    records = [
        run_entity(store, spec, customers.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]), RunOptions(run_ts=RUN_TS))
        for columns in (without, CUSTOMER.columns)
    ]
    rows = [(n, r.csv_count, r.data_insert_count, r.status) for n, r in enumerate(records, 1)]
    return spark.createDataFrame(rows, "run bigint, csv_count bigint, inserts bigint, status string")


# -- the ledger of runs ------------------------------------------------------------------------------------------


@scenario(
    f"""
    WITH d1 AS ({_full(BY_NAME["franchise"], False)})
    SELECT n.run, n.status, CASE WHEN n.run = 1 THEN (SELECT count(*) FROM supplier WHERE {BY_NAME["franchise"].first_day}) WHEN n.run = 2
           THEN (SELECT count(*) FROM supplier WHERE {BY_NAME["franchise"].first_day}) ELSE 0 END AS csv_count,
           CASE WHEN n.run = 1 THEN (SELECT count(*) FROM d1) ELSE 0 END AS inserts
    FROM (VALUES (1::BIGINT, 'Success'), (2, 'Success'), (3, 'Skipped'), (4, 'Empty')) n(run, status)
    """
)
def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """A run, one that changes nothing, the same again, and an extract with a header and no rows."""
    feed, base = BY_NAME["franchise"], new_work_path(spark, "ledger")
    store = open_store(spark, f"{base}/store", feed.spec)
    path = feed.write(spark, sf, False, f"{base}/day")
    some = read_extract(spark, path)
    extracts = [("a", some), ("b", some), ("b", some), ("c", some.limit(0))]
    records = [run_entity(store, feed.spec, extract, RunOptions(run_ts=RUN_TS, region=feed.region, run_id=name)) for name, extract in extracts]
    rows = [(n, r.status, r.csv_count, r.data_insert_count) for n, r in enumerate(records, 1)]
    return spark.createDataFrame(rows, "run bigint, status string, csv_count bigint, inserts bigint")


# -- a day of several files --------------------------------------------------------------------------------------

DAY = date(2024, 5, 8)
# Three headers: with a region, without one and in another order, with further columns. The last by name wins.
DAY_FILES = {
    "a": ("true", {"VACODE": "CAST(s_suppkey AS STRING)", "VANAME": "s_name", "RGCD": "'AUS'"}),
    "b": ("s_nationkey < 12", {"vaname": "concat('b ', s_name)", "vacode": "CAST(s_suppkey AS STRING)"}),
    "c": ("s_nationkey > 8", {"vastat": "'hold'", "VACODE": "CAST(s_suppkey AS STRING)", "Inter": "CAST(s_nationkey AS STRING)"}),
    "d": ("true", {"OTHER": "s_name"}),
}


def write_day(spark: SparkSession, sf: str, root: str) -> None:
    """The files of the day as one region's folder holds them; a written part is a file."""
    suppliers = table(spark, sf, "supplier")
    for tag, (where, columns) in DAY_FILES.items():
        path = f"{root}/written-{tag}"
        suppliers.filter(where).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]).write.csv(path, header=True)
        for n, name in enumerate(name for name in files.names(spark, path) if name.startswith("part-")):
            files.move(spark, f"{path}/{name}", f"{root}/landing/AUS/AUSSUPPLR_2024_{tag}{n}_20240508.csv")
    files.write_text(spark, f"{root}/landing/AUS/AUSSUPPLR_2024_e_20240508.csv.pgp", "secret")


@scenario(
    """
    WITH files AS (
      SELECT 'a' AS tag, s_suppkey, s_name AS vaname, NULL AS vastat, CAST(NULL AS INTEGER) AS inter FROM supplier
      UNION ALL SELECT 'b', s_suppkey, concat('b ', s_name), NULL, NULL FROM supplier WHERE s_nationkey < 12
      UNION ALL SELECT 'c', s_suppkey, NULL, 'hold', CAST(s_nationkey AS INTEGER) FROM supplier WHERE s_nationkey > 8
    ), last AS (
      SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY tag DESC) = 1
    ), counts AS (
      SELECT tag, count(*) AS inserts FROM last GROUP BY tag
    ), reads AS (SELECT tag, count(*) AS rows FROM files GROUP BY tag)
    SELECT CAST(s_suppkey AS VARCHAR) AS vacode, 'AUS' AS rgcd, vaname, vastat, inter, 1::BIGINT AS version,
           CAST(r.rows AS BIGINT) AS csv_count, CAST(c.inserts AS BIGINT) AS data_insert_count
    FROM last JOIN counts c USING (tag) JOIN reads r USING (tag)
    """
)
def day_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files with different headers and overlapping keys, one without its key and one refused: one commit, counts by file."""
    root, spec = new_work_path(spark, "day"), ENTITIES["supplier"]
    write_day(spark, sf, root)
    store = open_store(spark, f"{root}/store", spec)
    run_day(store, spec, f"{root}/landing", DAY, RunOptions(run_ts=RUN_TS))
    audit = spark.read.parquet(f"{store.root}/{AUDIT}").filter("status = 'Success'")
    tag = F.regexp_extract("file_name", "_([a-d])[0-9]+_", 1)
    counts = audit.groupBy(tag.alias("tag")).agg(F.sum("csv_count").alias("csv_count"), F.sum("data_insert_count").alias("data_insert_count"))
    shown = store.read("target").select("vacode", "rgcd", "vaname", "vastat", "inter", F.lit(store.head().version).cast("bigint").alias("version"))
    own = F.when(F.col("vastat").isNotNull(), "c").when(F.col("vaname").startswith("b "), "b").otherwise("a")
    return shown.withColumn("tag", own).join(counts, "tag").drop("tag")


# -- updates and removal -----------------------------------------------------------------------------------------


def marked_store(spark: SparkSession, sf: str) -> SnapshotStore:
    """Both days of the invoice lines in a store that rewrites no slice for an update if it can be helped."""
    base, spec = new_work_path(spark, "marked"), LINES.spec
    store = open_store(spark, f"{base}/store", spec, unit_rows=5_000, rewrite_rows=0)
    for second, stamp in ((False, RUN_TS), (True, LATER_TS)):
        extract = read_extract(spark, LINES.write(spark, sf, second, f"{base}/day{int(second) + 1}"))
        run_entity(store, spec, extract, RunOptions(run_ts=stamp, region=LINES.region))
    return store


@scenario(ORACLES["entity_coninv"])
def merge_on_read(spark: SparkSession, sf: str) -> DataFrame:
    """The target as readers see it through the sets of deleted rows."""
    return shown_target(marked_store(spark, sf))


@scenario(ORACLES["entity_coninv"])
def compacted_and_cleared(spark: SparkSession, sf: str) -> DataFrame:
    """The same after compaction and the removal of everything that the newest commit does not use."""
    store = marked_store(spark, sf)
    while compact(store, deleted_share=0.01):
        pass
    store.vacuum(timedelta(0))
    return shown_target(store)

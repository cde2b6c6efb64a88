"""One query per operator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mastermill.functions import (
    business_key,
    category_ladder,
    checksum,
    code_prefix,
    file_date,
    row_fingerprint,
    with_fingerprint,
)
from mastermill.operators import (
    action_gate,
    advance_state,
    assert_overridden,
    assign_ids,
    classify_delta,
    conform,
    dedupe_codes,
    dedupe_keys,
    default_region,
    delta_changed,
    delta_existing,
    delta_new,
    distinct_rows,
    drop_columns,
    force_constants,
    lookup_optional,
    lookup_or_drop,
    lookup_required,
    lower_names,
    merge,
    narrow_decimals,
    new_dimension_rows,
    override_columns,
    project_state,
    qualifying_codes,
    register_and_lookup,
    require_code,
    require_keys,
    require_source,
    select_except,
    stamp_audit,
    unregistered_codes,
    union_branches,
)
from mastermill.sources import select_files

from .base import (
    KNOWN_ORDERS,
    ORDER_COLUMNS,
    RUN_TEXT,
    RUN_TS,
    TODAY_COLUMNS,
    known_orders,
    picked,
    scenario,
    sql_id_order,
    sql_rank,
    sql_text,
    stamp_text,
    table,
    todays_orders,
)

ORDER_FIELDS = list(ORDER_COLUMNS)
KNOWN = f"known AS (SELECT {picked(ORDER_COLUMNS)} FROM orders WHERE {KNOWN_ORDERS})"
TODAY = f"today AS (SELECT {picked(TODAY_COLUMNS)} FROM orders)"
HASH = f"sha1({sql_text(ORDER_FIELDS)})"
LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


# -- schema and rows ---------------------------------------------------------------------------------------

RAW_ORDERS = {
    "O_ORDERKEY": "CAST(o_orderkey AS VARCHAR(40))",
    "O_TOTALPRICE": "CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR(40)) END",
    "O_CUSTKEY": "CASE WHEN o_orderpriority = '5-LOW' THEN '12x' ELSE CAST(o_custkey AS VARCHAR(40)) END",
    "QUANTITY": "CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR(40))",
    "EXTRA": "o_orderpriority",
}


@scenario(
    f"""
    WITH raw AS (SELECT {picked(RAW_ORDERS)} FROM orders)
    SELECT TRY_CAST(O_ORDERKEY AS BIGINT) AS o_orderkey, TRY_CAST(O_TOTALPRICE AS DECIMAL(16,6)) AS o_totalprice,
           TRY_CAST(O_CUSTKEY AS INTEGER) AS o_custkey, trunc(CAST(QUANTITY AS DECIMAL(16,2)))::INTEGER AS quantity,
           EXTRA AS extra
    FROM raw
    """
)
def conform_types(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in RAW_ORDERS.items()])
    schema = {"o_orderkey": "bigint", "o_totalprice": "decimal(16,6)", "o_custkey": "int", "quantity": "int", "absent": "int"}
    return conform(lower_names(raw), schema)


LINE_KEYS = ["l_orderkey", "l_linenumber"]
NULL_KEY = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE l_orderkey END"
LINES_WITH_NULLS = f"SELECT {NULL_KEY} AS l_orderkey, {', '.join(LINE_COLUMNS[1:])} FROM lineitem"


@scenario(
    f"""
    SELECT * EXCLUDE (rk) FROM (
        SELECT *, {sql_rank(LINE_KEYS, LINE_COLUMNS, ["l_shipdate"])} AS rk
        FROM ({LINES_WITH_NULLS}) WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    ) WHERE rk = 1
    """
)
def require_and_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("l_orderkey", F.expr(NULL_KEY))
    return dedupe_keys(require_keys(lines, LINE_KEYS), LINE_KEYS, order_by=["l_shipdate"])


@scenario(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag,
           concat_ws('', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), NULLIF(l_returnflag, 'R')) AS code
    FROM lineitem
    """
)
def business_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("flag", F.expr("NULLIF(l_returnflag, 'R')"))
    return lines.select(*LINE_KEYS, "l_returnflag", business_key(["l_orderkey", "l_linenumber", "flag"]).alias("code"))


DECIMALS = {c: f"CAST({c} AS DECIMAL(16,6))" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
LINE_TEXT = sql_text(LINE_COLUMNS, DECIMALS | {"l_returnflag": "NULLIF(l_returnflag, 'R')"})


def _decimal_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumns({c: F.expr(e) for c, e in DECIMALS.items()})
    return lines.withColumn("l_returnflag", F.expr("NULLIF(l_returnflag, 'R')"))


@scenario(f"SELECT l_orderkey, l_linenumber, sha1({LINE_TEXT}) AS hash_value FROM lineitem")
def row_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    lines = _decimal_lines(spark, sf)
    return lines.select(*LINE_KEYS, row_fingerprint(lines).alias("hash_value"))


@scenario(
    f"""
    WITH {TODAY}
    SELECT o_orderkey, sha1(concat_ws('', {", ".join(f"CAST({c} AS VARCHAR)" for c in ORDER_FIELDS)})) AS hash_value
    FROM today
    """
)
def fingerprint_legacy(spark: SparkSession, sf: str) -> DataFrame:
    orders = todays_orders(spark, sf)
    return orders.select("o_orderkey", row_fingerprint(orders, legacy=True).alias("hash_value"))


# Murmur3 (32 bit, seed 42) over the bytes of an ASCII text: whole little-endian words, then single bytes.
_MASK = "4294967295"
_BYTE = "(CASE WHEN substr(txt, {0}, 1) = chr(0) THEN 0 ELSE ascii(substr(txt, {0}, 1)) END)::UBIGINT"
_WORD = " + ".join(f"{_BYTE.format(f'4 * i + {n + 1}')} * {256**n}" for n in range(4))


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) & {_MASK}) | (({x}) >> {32 - r})"


def _times(x: str, factor: int) -> str:
    return f"((({x})::HUGEINT * {factor}) % 4294967296)::UBIGINT"


_MIX_K = _times(_rotl(_times("k", 0xCC9E2D51), 15), 0x1B873593)
_MIX_H = f"((({_times(_rotl('xor(h, k)', 13), 5)}) + 3864292196::UBIGINT) & {_MASK})::UBIGINT"


@scenario(
    f"""
    WITH {TODAY},
    texts AS (SELECT o_orderkey, {sql_text(ORDER_FIELDS)} AS txt FROM today),
    words AS (
        SELECT o_orderkey, length(txt) AS n,
               list_concat(
                   [42::UBIGINT],
                   list_transform(
                       list_concat(
                           list_transform(range(0, length(txt) // 4), lambda i: ({_WORD})::UBIGINT),
                           list_transform(range(4 * (length(txt) // 4), length(txt)), lambda i: {_BYTE.format("i + 1")})
                       ),
                       lambda k: {_MIX_K}
                   )
               ) AS ks
        FROM texts
    ),
    mixed AS (SELECT o_orderkey, xor(list_reduce(ks, lambda h, k: {_MIX_H}), n::UBIGINT) AS f0 FROM words),
    f1 AS (SELECT o_orderkey, {_times("xor(f0, f0 >> 16)", 0x85EBCA6B)} AS f FROM mixed),
    f2 AS (SELECT o_orderkey, {_times("xor(f, f >> 13)", 0xC2B2AE35)} AS f FROM f1),
    f3 AS (SELECT o_orderkey, xor(f, f >> 16)::BIGINT AS f FROM f2)
    SELECT o_orderkey, (CASE WHEN f > 2147483647 THEN f - 4294967296 ELSE f END)::INTEGER AS check_sum FROM f3
    """
)
def checksums(spark: SparkSession, sf: str) -> DataFrame:
    orders = todays_orders(spark, sf)
    return orders.select("o_orderkey", checksum(orders).alias("check_sum"))


@scenario(
    """
    SELECT p_partkey, NULLIF(p_brand, 'Brand#13') AS cat_cd,
           substr(NULLIF(p_brand, 'Brand#13'), 1, 1) AS cc1, substr(NULLIF(p_brand, 'Brand#13'), 1, 2) AS cc2,
           substr(NULLIF(p_brand, 'Brand#13'), 1, 3) AS cc3, substr(NULLIF(p_brand, 'Brand#13'), 1, 4) AS cc4,
           substr(NULLIF(p_brand, 'Brand#13'), 1, 5) AS cc5
    FROM part
    """
)
def category_ladders(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").selectExpr("p_partkey", "NULLIF(p_brand, 'Brand#13') AS cat_cd")
    return parts.withColumns(category_ladder())


@scenario(
    """
    SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN 'AUS' ELSE 'CA' END AS rgcd FROM supplier
    UNION ALL
    SELECT s_suppkey, s_name AS rgcd FROM supplier
    """
)
def region_default(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier")
    first = default_region(suppliers.filter("s_nationkey < 10"), "AUS")
    second = default_region(suppliers.filter("s_nationkey >= 10"), "OCA")
    own = default_region(lower_names(suppliers.select("s_suppkey", F.col("s_name").alias("RGCD"))), "AUS")
    return union_branches(*[df.select("s_suppkey", "rgcd") for df in (first, second, own)])


@scenario("SELECT s_suppkey, s_name, '' AS grp, 1 AS prdmgr FROM supplier")
def constants_and_drops(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = force_constants(table(spark, sf, "supplier"), {"grp": "", "prdmgr": 1})
    return drop_columns(suppliers, ["S_NATIONKEY", "s_acctbal", "absent"])


@scenario(
    f"""
    SELECT c_custkey, c_name, 'system' AS updated_by, '{RUN_TEXT}' AS updated_date, 'true' AS validationstatus,
           false AS is_valid, '{RUN_TEXT}' AS created_date, 'system' AS created_by, ' ' AS "comment"
    FROM customer
    """
)
def audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = stamp_audit(table(spark, sf, "customer").select("c_custkey", "c_name"), RUN_TS)
    return stamp_text(stamped, "updated_date", "created_date")


@scenario("SELECT p_partkey, trunc(-p_retailprice * 1.5)::INTEGER AS lprc, CAST(NULL AS INTEGER) AS crprc FROM part")
def narrowed_decimals(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "CAST(-p_retailprice * 1.5 AS DECIMAL(16,6)) AS lprc",
        "CAST(9999999999 AS DECIMAL(16,6)) AS crprc",
    )
    return narrow_decimals(parts, ["lprc", "crprc", "absent"])


@scenario("SELECT c_custkey, 'hidden' AS c_name, c_nationkey, 0.0::DOUBLE AS c_acctbal, c_mktsegment FROM customer")
def overridden_columns(spark: SparkSession, sf: str) -> DataFrame:
    values = {"c_name": "hidden", "c_acctbal": 0.0}
    replaced = override_columns(table(spark, sf, "customer"), values)
    assert_overridden(replaced, values)
    return replaced


@scenario(
    """
    SELECT p_brand, p_type, p_size, NULL::DOUBLE AS price FROM part WHERE p_size < 20
    UNION
    SELECT p_brand, p_type, NULL::INTEGER AS p_size, NULL::DOUBLE AS price FROM part WHERE p_size >= 20
    UNION
    SELECT p_brand, p_type, p_size, p_retailprice AS price FROM part
    """
)
def unions_and_distinct(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    small = parts.filter("p_size < 20").select("p_brand", "p_type", "p_size")
    large = parts.filter("p_size >= 20").select("p_type", "p_brand")
    priced = parts.select("p_brand", "p_type", "p_size", F.col("p_retailprice").alias("price"))
    return distinct_rows(union_branches(small, large, priced))


@scenario("SELECT DISTINCT substr(l_returnflag, 1, 1) || l_linestatus || CAST(l_suppkey AS VARCHAR) AS code FROM lineitem")
def distinct_codes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    code = business_key(["l_returnflag", "l_linestatus", "l_suppkey"])
    return dedupe_codes(require_code(lines.withColumn("code", code)))


# -- lookups -----------------------------------------------------------------------------------------------

# The customer-number prefix as code; the stored dimension knows the codes of some customers.
PREFIX = "substr(c_name, 1, 16)"
PREFIX_DIM = f"""
    dim AS (SELECT {PREFIX} AS code, CAST(min(c_custkey) + 1 AS BIGINT) AS id FROM customer
            WHERE c_acctbal > 9900 GROUP BY 1),
    fresh AS (SELECT DISTINCT code FROM (SELECT {PREFIX} AS code FROM customer WHERE c_mktsegment <> 'BUILDING')
              WHERE code NOT IN (SELECT code FROM dim)),
    numbered AS (SELECT code, (SELECT COALESCE(max(id), 0) FROM dim)
                 + row_number() OVER (ORDER BY {sql_id_order(["code"])}) AS id FROM fresh)
"""


def _prefix_dim(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").filter("c_acctbal > 9900")
    return customers.groupBy(F.expr(PREFIX).alias("code")).agg((F.min("c_custkey") + 1).alias("id"))


def _segment_source(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS shpto"
    )


@scenario(
    f"""
    WITH {PREFIX_DIM}, full_dim AS (SELECT code, id FROM dim UNION ALL SELECT code, id FROM numbered)
    SELECT c_custkey, CAST(full_dim.id AS BIGINT) AS shpto FROM customer
    JOIN full_dim ON full_dim.code = {PREFIX} WHERE c_mktsegment <> 'BUILDING'
    """
)
def prefix_lookup_register(spark: SparkSession, sf: str) -> DataFrame:
    rows = require_source(_segment_source(spark, sf), "shpto")
    found, _ = register_and_lookup(rows, _prefix_dim(spark, sf), code_prefix("shpto", 16), "shpto", RUN_TS, salt=4)
    return found


@scenario(
    f"""
    WITH {PREFIX_DIM}
    SELECT CAST(id AS BIGINT) AS id, code, 'to be filled' AS name, 'system' AS updated_by,
           'true' AS validationstatus, false AS is_valid, ' ' AS "comment" FROM numbered
    """
)
def new_dimension_codes(spark: SparkSession, sf: str) -> DataFrame:
    dim = _prefix_dim(spark, sf)
    codes = unregistered_codes(_segment_source(spark, sf), dim, code_prefix("shpto", 16))
    rows = new_dimension_rows(codes, dim, RUN_TS)
    return rows.drop("updated_date", "created_date", "created_by")


@scenario(
    """
    SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS code FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)
    """
)
def unregistered_part_codes(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "part").filter("p_size < 25").selectExpr("CAST(p_partkey AS STRING) AS code")
    return unregistered_codes(table(spark, sf, "lineitem"), dim, F.col("l_partkey"))


@scenario(
    f"""
    WITH codes AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
    SELECT 1000 + row_number() OVER (ORDER BY {sql_id_order(["l_partkey", "l_suppkey"])}) AS id, l_partkey, l_suppkey
    FROM codes
    """
)
def assigned_ids(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return assign_ids(pairs, ["l_partkey", "l_suppkey"], start=1000)


@scenario(
    """
    SELECT o_orderkey, o_custkey, c_custkey * 10 AS cust_id FROM orders
    JOIN customer ON c_custkey = o_custkey AND c_mktsegment IN ('BUILDING', 'MACHINERY')
    """
)
def lookup_inner(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "customer").filter("c_mktsegment IN ('BUILDING', 'MACHINERY')")
    dim = dim.selectExpr("c_custkey AS code", "c_custkey * 10 AS id")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lookup_required(orders, dim, F.col("o_custkey"), {"cust_id": ("id", "bigint")})


@scenario(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag, CAST(s_suppkey + 1 AS BIGINT) AS supp_id
    FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey END AS sk
          FROM lineitem)
    LEFT JOIN supplier ON s_suppkey = sk
    """
)
def lookup_salted_skew(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows has one code and a third has none."""
    dim = table(spark, sf, "supplier").selectExpr("s_suppkey AS code", "s_suppkey + 1 AS id")
    sk = "CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN NULL ELSE l_suppkey END"
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_extendedprice", "l_returnflag", F.expr(sk).alias("sk"))
    return lookup_optional(lines, dim, F.col("sk"), {"supp_id": ("id", "bigint")}, salt=8).drop("sk")


LEVELS = {
    "code": "CAST(n_nationkey AS VARCHAR(10))",
    "level1": "CAST(n_regionkey AS VARCHAR(10))",
    "level2": "CASE WHEN n_regionkey = 1 THEN 'none' ELSE CAST(n_nationkey AS VARCHAR(10)) END",
}


@scenario(
    f"""
    WITH dim AS (SELECT {picked(LEVELS)} FROM nation WHERE n_regionkey < 3)
    SELECT c_custkey, c_nationkey, TRY_CAST(level1 AS INTEGER) AS mktcdl1, TRY_CAST(level2 AS INTEGER) AS mktcdl2
    FROM customer LEFT JOIN dim ON dim.code = CAST(c_nationkey AS VARCHAR)
    """
)
def lookup_levels_optional(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "nation").filter("n_regionkey < 3").selectExpr(*[f"{e} AS {n}" for n, e in LEVELS.items()])
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    outputs = {"mktcdl1": ("level1", "int"), "mktcdl2": ("level2", "int")}
    return lookup_optional(customers, dim, F.col("c_nationkey"), outputs)


@scenario(
    """
    SELECT s_suppkey, s_name, CAST(n_nationkey + 100 AS BIGINT) AS s_nationkey FROM supplier
    JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey IN (0, 2)
    """
)
def lookup_region_or_drop(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "nation").filter("n_regionkey IN (0, 2)")
    dim = dim.selectExpr("n_nationkey AS code", "n_nationkey + 100 AS id")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return lookup_or_drop(suppliers, dim, F.col("s_nationkey"), {"s_nationkey": ("id", "bigint")})


# Actions are orders that take effect on the first of their month; a flag row exists per order status.
ACTIONS = {
    "code": "CAST(o_custkey AS VARCHAR(20))",
    "attr": "o_orderstatus",
    "app": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' ELSE 'no' END",
    "effdt": "date_trunc('month', o_orderdate)",
}
FLAGS = {"id": "o_orderstatus", "code": "CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END"}


@scenario(
    f"""
    WITH actions AS (SELECT {picked(ACTIONS)} FROM orders),
    flags AS (SELECT DISTINCT {picked(FLAGS)} FROM orders),
    hits AS (SELECT DISTINCT actions.code FROM actions JOIN flags ON flags.id = attr AND flags.code = 'True'
             WHERE app = 'yes' AND CAST(effdt AS DATE) = DATE '1998-03-01')
    SELECT c_custkey, c_nationkey,
           CASE WHEN CAST(c_custkey AS VARCHAR) IN (SELECT code FROM hits) THEN c_mktsegment END AS fran_code,
           CASE WHEN CAST(c_custkey AS VARCHAR) IN (SELECT code FROM hits) THEN c_name END AS prod_cd5
    FROM customer
    """
)
def action_gates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    actions = orders.selectExpr(*[f"{e} AS {n}" for n, e in ACTIONS.items()])
    flags = orders.selectExpr(*[f"{e} AS {n}" for n, e in FLAGS.items()]).distinct()
    codes = qualifying_codes(actions, flags, date(1998, 3, 1))
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_nationkey", "c_mktsegment AS fran_code", "c_name AS prod_cd5"
    )
    return action_gate(customers, codes, F.col("c_custkey"), ["fran_code", "prod_cd5"])


# -- delta and merge ---------------------------------------------------------------------------------------

HASHED = f"""
    {KNOWN}, {TODAY},
    state AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS code, {HASH} AS hash_value FROM known),
    incoming AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS code, {HASH} AS hash_value FROM today),
    classified AS (
        SELECT incoming.*, CASE WHEN state.o_orderkey IS NULL THEN 'insert'
               WHEN state.hash_value = incoming.hash_value THEN 'unchanged' ELSE 'update' END AS change
        FROM incoming LEFT JOIN state ON state.o_orderkey = incoming.o_orderkey)
"""
KEY = ["o_orderkey"]


def _hashed(orders: DataFrame) -> DataFrame:
    return with_fingerprint(orders).withColumn("code", business_key(KEY))


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return project_state(_hashed(known_orders(spark, sf)), KEY)


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    return _hashed(todays_orders(spark, sf))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify_delta(_incoming(spark, sf), _state(spark, sf), KEY)


@scenario(f"WITH {HASHED} SELECT o_orderkey, hash_value, change FROM classified")
def delta_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select("o_orderkey", "hash_value", F.col("_change").alias("change"))


@scenario(f"WITH {HASHED} SELECT {', '.join(ORDER_FIELDS)} FROM classified WHERE change = 'insert'")
def delta_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return delta_new(_incoming(spark, sf), _state(spark, sf), KEY).select(*ORDER_FIELDS)


@scenario(f"WITH {HASHED} SELECT {', '.join(ORDER_FIELDS)} FROM classified WHERE change <> 'insert'")
def delta_existing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return delta_existing(_incoming(spark, sf), _state(spark, sf), KEY).select(*ORDER_FIELDS)


@scenario(f"WITH {HASHED} SELECT {', '.join(ORDER_FIELDS)} FROM classified WHERE change = 'update'")
def delta_changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return delta_changed(_incoming(spark, sf), _state(spark, sf), KEY).select(*ORDER_FIELDS)


@scenario(
    """
    SELECT mine.o_orderkey,
           CASE WHEN mine.o_custkey = other.o_custkey AND mine.o_orderstatus = other.o_orderstatus
                THEN 'unchanged' ELSE 'update' END AS change
    FROM orders mine JOIN orders other ON other.o_orderkey = xor(mine.o_orderkey, 1)
    """
)
def delta_hash_swap(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring orders swap their contents: every content hash was seen before, under another key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    swapped = orders.withColumn("o_orderkey", F.expr("o_orderkey ^ 1"))
    content = ["o_custkey", "o_orderstatus"]
    state = with_fingerprint(orders, exclude=KEY).withColumn("code", business_key(KEY))
    incoming = with_fingerprint(swapped, exclude=KEY).drop(*content)
    classified = classify_delta(incoming, project_state(state, KEY), KEY)
    return classified.filter("_change <> 'insert'").select("o_orderkey", F.col("_change").alias("change"))


@scenario(
    f"""
    WITH {HASHED}
    SELECT known.o_orderkey, known.o_custkey,
           CASE WHEN change = 'update' THEN u.o_orderstatus ELSE known.o_orderstatus END AS o_orderstatus,
           CASE WHEN change = 'update' THEN u.price ELSE known.price END AS price,
           CASE WHEN change = 'update' THEN u.priority ELSE known.priority END AS priority
    FROM known LEFT JOIN classified u ON u.o_orderkey = known.o_orderkey
    UNION ALL
    SELECT {", ".join(ORDER_FIELDS)} FROM classified WHERE change = 'insert'
    """
)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    changes = select_except(_classified(spark, sf), ["code", "hash_value", "check_sum"])
    return merge(known_orders(spark, sf), changes, KEY, ["o_orderstatus", "price", "priority"])


@scenario(
    f"""
    WITH {HASHED}
    SELECT o_orderkey, code, hash_value FROM state
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM classified WHERE change = 'update')
    UNION ALL
    SELECT o_orderkey, code, hash_value FROM classified WHERE change <> 'unchanged'
    """
)
def state_advance(spark: SparkSession, sf: str) -> DataFrame:
    return advance_state(_state(spark, sf), _classified(spark, sf), KEY).drop("check_sum")


# -- files -------------------------------------------------------------------------------------------------

FILE_DAY = date(1998, 3, 2)
FILE_PREFIX = "CASE WHEN o_orderstatus = 'F' THEN 'AUSFRAN_2024' ELSE 'AUSINVDTL_2024' END"
FILE_ENDING = "CASE o_orderpriority WHEN '1-URGENT' THEN '.csv' WHEN '2-HIGH' THEN '.csv.gz' WHEN '5-LOW' THEN '.csv.pgp' ELSE '.txt' END"


def _file_names(day_text: str, key: str) -> str:
    return f"concat({FILE_PREFIX}, '_', {key}, '_', {day_text}, {FILE_ENDING})"


@scenario(
    f"""
    WITH names AS (SELECT {_file_names("strftime(o_orderdate, '%Y%m%d')", "CAST(o_orderkey AS VARCHAR)")} AS file_name FROM orders)
    SELECT file_name, sha256(file_name) AS file_code, CAST(DATE '1998-03-02' AS VARCHAR) AS file_date,
           file_name LIKE '%.csv' OR file_name LIKE '%.csv.gz' AS accepted
    FROM names WHERE starts_with(file_name, 'AUSINVDTL_2024') AND contains(file_name, '19980302')
    """
)
def file_selection(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").selectExpr(
        _file_names("date_format(o_orderdate, 'yyyyMMdd')", "CAST(o_orderkey AS STRING)") + " AS file_name"
    )
    chosen = select_files(names, "AUSINVDTL_2024", FILE_DAY)
    return chosen.withColumn("file_date", F.col("file_date").cast("string"))


@scenario(
    f"""
    WITH names AS (SELECT o_orderkey, {_file_names("strftime(o_orderdate, '%Y%m%d')", "CAST(o_orderkey AS VARCHAR)")} AS file_name,
                          o_orderdate FROM orders)
    SELECT o_orderkey, file_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS file_date FROM names
    """
)
def file_dates(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        _file_names("date_format(o_orderdate, 'yyyyMMdd')", "CAST(o_orderkey AS STRING)") + " AS file_name",
    )
    return names.withColumn("file_date", file_date(F.col("file_name")).cast("string"))

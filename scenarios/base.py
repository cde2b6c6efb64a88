"""Registry of scenarios and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2024, 5, 8, 6, 30, tzinfo=timezone.utc)
LATER_TS = datetime(2024, 5, 9, 6, 30, tzinfo=timezone.utc)
RUN_TEXT, LATER_TEXT = "2024-05-08 06:30:00", "2024-05-09 06:30:00"


def scenario(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""

    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The same expressions in Spark SQL and in the oracle. Orders placed before 2000 are known; today's extract
# has all orders, open ones with a higher price and urgent finished ones without a priority.
KNOWN_ORDERS = "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
ORDER_COLUMNS = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_orderstatus": "o_orderstatus",
    "price": "CAST(o_totalprice AS DECIMAL(16,6))",
    "priority": "NULLIF(o_orderpriority, '4-NOT SPECIFIED')",
}
TODAY_COLUMNS = ORDER_COLUMNS | {
    "price": "CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 10 ELSE o_totalprice END AS DECIMAL(16,6))",
    "priority": "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL "
    "ELSE NULLIF(o_orderpriority, '4-NOT SPECIFIED') END",
}


def pick(columns: Mapping[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def picked(columns: Mapping[str, str]) -> str:
    return ", ".join(pick(columns))


def known_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(KNOWN_ORDERS).selectExpr(*pick(ORDER_COLUMNS))


def todays_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*pick(TODAY_COLUMNS))


def sql_text(columns: Sequence[str], casts: Mapping[str, str] | None = None) -> str:
    """The separated, null-marked row text of :func:`mastermill.functions.row_text` in SQL."""
    casts = casts or {}
    parts = [f"COALESCE(CAST({casts.get(c, c)} AS VARCHAR), chr(0))" for c in sorted(columns)]
    return f"concat_ws(chr(31), {', '.join(parts)})"


def sql_key_text(columns: Sequence[str]) -> str:
    return f"concat_ws(chr(31), {', '.join(f'COALESCE(CAST({c} AS VARCHAR), chr(0))' for c in columns)})"


def sql_id_order(columns: Sequence[str]) -> str:
    text = sql_key_text(columns)
    return f"substr(sha1({text}), 1, 3), {text}"


def sql_rank(keys: Sequence[str], columns: Sequence[str], first: Sequence[str] = ()) -> str:
    """The rank of :func:`mastermill.operators.dedupe_keys` in SQL."""
    rest = [*first, *sorted(c for c in columns if c not in keys and c not in first)]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order})"


def stamp_text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that no client converts them."""
    return df.withColumns({c: F.date_format(F.to_timestamp(c), "yyyy-MM-dd HH:mm:ss") for c in columns})

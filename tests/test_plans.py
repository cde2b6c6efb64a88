"""Physical plans: one shuffle per side, partial limits, pruning."""

import re

import pytest
from pyspark.sql import functions as F

from mastermill import ENTITIES, RunOptions, open_store, run_entity
from mastermill.functions import with_fingerprint
from mastermill.operators import assign_ids, classify_delta, dedupe_keys, lookup_required, number_by_position
from mastermill.plans.entity import conform_extract, finish_rows, valid_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(1000).selectExpr("id % 300 AS k", "id AS v", "id * 2 AS unused").write.parquet(path)
    return spark.read.parquet(path)


def test_dedupe_limits_groups_before_the_shuffle(lines):
    text = plan(dedupe_keys(lines, ["k"]))
    assert text.count("WindowGroupLimit") == 2 and exchanges(dedupe_keys(lines, ["k"])) == 1


def test_dedupe_and_delta_share_one_shuffle(spark, lines):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = with_fingerprint(dedupe_keys(lines, ["k"]))
        state = lines.selectExpr("k", "CAST(v AS STRING) AS hash_value").groupBy("k").agg(F.min("hash_value").alias("hash_value"))
        assert exchanges(classify_delta(rows, state, ["k"])) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_needed_columns(lines):
    text = plan(dedupe_keys(lines.select("k", "v"), ["k"]))
    assert "unused" not in re.search(r"ReadSchema: struct<([^>]*)", text).group(1)


def test_large_lookup_does_not_broadcast(spark, lines):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = lines.selectExpr("CAST(k AS STRING) AS code", "v AS id")
        found = lookup_required(lines, dim, F.col("k"), {"id": ("id", "bigint")}, salt=4, hot=["1"])
        assert "BroadcastHashJoin" not in plan(found) and "_lookup_salt" in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_by_position_does_not_shuffle_rows(lines):
    assert sorted(r.id for r in number_by_position(lines, 10).collect()) == list(range(11, 1011))
    numbered = number_by_position(lines, 10)
    # The only exchanges belong to the counts per file.
    assert exchanges(numbered) == 1 and "Exchange hashpartitioning(_file" in plan(numbered)


def test_id_windows_are_partitioned(lines):
    text = plan(assign_ids(lines.select("k").distinct(), ["k"]))
    assert "row_number() windowspecdefinition(_bucket" in text


BUCKETED = {
    "bill_of_materials": ("CAST(id AS STRING) AS assemb", "CAST(id % 7 AS STRING) AS compnt"),
    "customer_part_numbers": ("CAST(id AS STRING) AS xrfptno", "CAST(id % 7 AS STRING) AS xricno"),
    "supplier": ("CAST(id AS STRING) AS vacode", "'x' AS vaname"),
}


@pytest.mark.parametrize("entity", BUCKETED)
def test_bucketed_state_is_not_shuffled(spark, tmp_path, run_ts, entity):
    spec = ENTITIES[entity]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = open_store(spark, str(tmp_path / "s"), spec, buckets)
    extract = spark.range(500).selectExpr(*BUCKETED[entity])
    run_entity(store, spec, extract, RunOptions(run_ts=run_ts))
    more = extract.withColumn(extract.columns[0], F.concat(extract.columns[0], F.lit("x")))
    run_entity(store, spec, more, RunOptions(run_ts=run_ts))
    head = store.head()
    assert len(head.tables["state"]) == 2 and store.read("target").count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = finish_rows(valid_rows(conform_extract(extract, spec), spec), spec, RunOptions(run_ts=run_ts))
        delta = classify_delta(rows, store.read_segments("state", head.tables["state"]), spec.delta_keys)
        # One exchange: the extract's own, for its de-duplication.
        assert exchanges(delta) == 1 and "Bucketed: true" in plan(delta)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

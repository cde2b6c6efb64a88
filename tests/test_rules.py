"""Entities with lookup rules."""

from datetime import date, datetime, timezone

import pytest

from mastermill import ENTITIES, EntitySpec, RunOptions, open_store, run_entity
from mastermill.plans.dimensions import DIMENSIONS
from mastermill.spec import columns, register
from tests.conftest import rows

CUSTOMER, PART = ENTITIES["customer"], ENTITIES["part_regional"]
LATER = datetime(2025, 1, 1, tzinfo=timezone.utc)


def customers(spark, data):
    return spark.createDataFrame(data, "CUSTID string, NAME string, CHAINC string, CHNL string, SHPTO string, SLDTO string")


DAY_ONE = [
    ("1", "n1", "A", "x", "1234567", "9999991"),
    ("2", "n2", "A", "y", "1234568", "9999992"),
    ("3", "n3", None, "only-here", "123", "9"),
    ("4", "n4", "B", "x", None, "9"),
]


def dimension(store, name):
    dim = store.read(DIMENSIONS).filter(f"dimension = '{name}'")
    return {r.code: r.id for r in dim.collect()}


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0], ids=["broadcast", "salted"])
def test_customer_rules(spark, tmp_path, run_ts, broadcast_bytes):
    store = open_store(spark, str(tmp_path / "s"), CUSTOMER)
    seed = spark.createDataFrame([(7, "A", "seeded", "z"), (9, "A", "double", "z")], "id bigint, code string, name string, rgcd string")
    record = run_entity(store, CUSTOMER, customers(spark, DAY_ONE), RunOptions(run_ts=run_ts, broadcast_bytes=broadcast_bytes), {"x_chain": seed})
    assert (record.csv_count, record.data_insert_count) == (4, 2)
    # Codes come from rows that the preceding rules keep: customer 3 has no chain, customer 4 no ship-to.
    assert dimension(store, "x_chain") == {"A": 7, "B": 10}
    assert set(dimension(store, "x_channel")) == {"x", "y"}
    assert dimension(store, "x_customer_group") == {"": 1}
    assert dimension(store, "x_ship_to") == {"123456": 1}
    assert set(dimension(store, "x_sold_to")) == {"999999"}
    seeded = store.read(DIMENSIONS).filter("code = 'A'").first()
    assert (seeded.name, seeded.extra) == ("seeded", {"rgcd": "z"})
    target = store.read("target")
    assert rows(target, "custid", "name", "chainc", "shpto") == [("1", "n1", 7, 1), ("2", "n2", 7, 1)]

    options = RunOptions(run_ts=LATER, broadcast_bytes=broadcast_bytes)
    again = run_entity(store, CUSTOMER, customers(spark, DAY_ONE), options, {"x_chain": seed})
    assert (again.data_insert_count, again.data_update_count) == (0, 0)
    moved = run_entity(store, CUSTOMER, customers(spark, [("1", "n1", "C", "x", "1234567", "9999991")]), options)
    assert (moved.data_insert_count, moved.data_update_count) == (0, 1)
    assert dimension(store, "x_chain") == {"A": 7, "B": 10, "C": 11}
    assert rows(store.read("target"), "custid", "chainc") == [("1", 11), ("2", 7)]


def part_dimensions(spark):
    return {
        "x_market_code": spark.createDataFrame([("M", "1", "2", "x", None, "5")], "code string, level1 string, level2 string, level3 string, level4 string, level5 string"),
        "p_lifecycle_stage": spark.createDataFrame([(3, "P1"), (4, "P1")], "id int, code string"),
        "p_pricing_region": spark.createDataFrame([(21, "AUS", "AUD")], "id int, code string, curr string"),
        "p_pricing_action_detail": spark.createDataFrame([("P1", "1", "yes", datetime(2024, 5, 8, 12))], "code string, attr string, app string, effdt timestamp"),
        "view_x_yes_no_flag": spark.createDataFrame([("True", "1")], "code string, id string"),
    }


PART_ROWS = [
    ("P1", "AUS", "ABCDE", "M", "F", "9.75"),
    ("P2", "AUS", "XYZ", "other", "F", "1"),
    ("P3", "NZ", "QRS", "M", "F", "1"),
    ("P4", "AUS", None, "M", "F", "1"),
    ("P5", "AUS", "ABC", None, "F", "1"),
]


def parts(spark, guard=True):
    df = spark.createDataFrame(PART_ROWS, "Part_Num string, RGCD string, PROD_CD5 string, MKTCD string, FRAN_CODE string, LPRC string")
    return df.selectExpr("*", "'a' AS Franc_code", "'b' AS brand_code", "'c' AS prod_code") if guard else df


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0], ids=["broadcast", "salted"])
def test_part_rules(spark, tmp_path, run_ts, broadcast_bytes):
    store = open_store(spark, str(tmp_path / "s"), PART)
    options = RunOptions(run_ts=run_ts, file_date=date(2024, 5, 8), narrow_inserts=True, broadcast_bytes=broadcast_bytes)
    record = run_entity(store, PART, parts(spark), options, part_dimensions(spark))
    assert (record.csv_count, record.data_insert_count) == (5, 2)
    target = store.read("target")
    assert target.columns == ["id", *PART.target_columns] and len(PART.target_columns) == 108
    shown = target.select("part_num", "rgcd", "lfcycle", "mktcdl1", "mktcdl2", "mktcdl3", "fran_code", "prod_cd5", "brnd_cd", "prdmgr")
    assert rows(shown) == [
        ("P1", 21, 3, 1, 2, None, "F", "ABCDE", 1, 1),
        ("P2", 21, None, None, None, None, None, None, None, 1),
    ]
    assert [float(r.lprc) for r in target.orderBy("part_num").collect()] == [9.0, 1.0]
    # Codes are registered before the rules that drop a row: P3 and P5 reach the first two rules.
    assert set(dimension(store, "x_product_code_1_digit")) == {"A", "X", "Q"}
    assert set(dimension(store, "x_sub_brand")) == {"P1", "P2"}
    assert {r.code for r in store.read("state").collect()} == {"P121", "P221"}


def test_gate_needs_its_columns(spark, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "s"), PART)
    run_entity(store, PART, parts(spark, guard=False), RunOptions(run_ts=run_ts), part_dimensions(spark))
    assert rows(store.read("target"), "part_num", "fran_code") == [("P1", "F"), ("P2", "F")]


def test_missing_dimension_fails_and_publishes_nothing(spark, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "s"), PART)
    with pytest.raises(ValueError, match="not given"):
        run_entity(store, PART, parts(spark), RunOptions(run_ts=run_ts), {})
    assert store.head() is None


def test_rules_may_not_read_replaced_columns():
    with pytest.raises(ValueError, match="replaced"):
        EntitySpec("e", {}, columns("a string"), ("a",), rules=(register("a", "d1"), register("a", "d2")))


def test_readers_keep_an_older_version(spark, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "s"), CUSTOMER)
    run_entity(store, CUSTOMER, customers(spark, DAY_ONE), RunOptions(run_ts=run_ts))
    first = store.head()
    run_entity(store, CUSTOMER, customers(spark, [("1", "renamed", "A", "x", "1234567", "9999991")]), RunOptions(run_ts=LATER))
    assert rows(store.read("target", first), "custid", "name") == [("1", "n1"), ("2", "n2")]
    assert rows(store.read("target"), "custid", "name") == [("1", "renamed"), ("2", "n2")]


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path, run_ts):
    store = open_store(spark, str(tmp_path / "s"), CUSTOMER)
    store.commit("one", {"target": []}, None)
    with pytest.raises(Exception, match="already exists"):
        store.commit("two", {"target": []}, None)

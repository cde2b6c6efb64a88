"""Row-level behaviour of the operators, with hand-written rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mastermill.functions import (
    business_key,
    category_ladder,
    checksum,
    code_prefix,
    file_code,
    file_date,
    row_fingerprint,
    with_fingerprint,
)
from mastermill.operators import (
    action_gate,
    align,
    apply_updates,
    assert_overridden,
    assign_ids,
    classify_delta,
    conform,
    dedupe_keys,
    default_region,
    delta_changed,
    delta_existing,
    delta_new,
    drop_columns,
    has_columns,
    lookup_optional,
    lookup_required,
    lower_names,
    merge,
    narrow_decimals,
    one_per_code,
    override_columns,
    qualifying_codes,
    register_and_lookup,
    require_keys,
    unregistered_codes,
)
from tests.conftest import rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# -- schema ------------------------------------------------------------------------------------------------


def test_lower_names_refuses_names_equal_but_for_case(spark):
    assert lower_names(frame(spark, [("a", "b")], "A string, bC string")).columns == ["a", "bc"]
    with pytest.raises(ValueError, match="rgcd"):
        lower_names(spark.sql("SELECT 1 AS RGCD, 2 AS rgcd"))


def test_conform_gives_null_for_unreadable_values(spark):
    data = [("1", "2.5", "2024-01-02", "true", "k"), ("x", "n/a", "2024-13-01", "maybe", "k"), (None,) * 4 + ("k",)]
    raw = frame(spark, data, "i string, d string, t string, b string, other string")
    schema = {"i": "int", "d": "decimal(16,6)", "t": "timestamp", "b": "boolean", "absent": "int"}
    out = conform(raw, schema)
    assert out.columns == raw.columns and out.schema["other"].dataType.simpleString() == "string"
    got = out.collect()
    assert got[0][:4] == (1, Decimal("2.500000"), datetime(2024, 1, 2), True)
    assert got[1][:4] == (None,) * 4 and got[2][:4] == (None,) * 4


@pytest.mark.parametrize(
    "text, value",
    [("7", 7), ("7.99", 7), ("-7.5", -7), (" 8. ", 8), ("1e3", None), ("7.x", None), ("99999999999", None), ("", None)],
)
def test_integers_with_fractions_are_cut(spark, text, value):
    assert conform(frame(spark, [(text,)], "i string"), {"i": "int"}).first().i == value


def test_over_wide_decimal_is_null(spark):
    raw = frame(spark, [("12345678901234",), ("1.2345678",)], "d string")
    assert [r.d for r in conform(raw, {"d": "decimal(16,6)"}).collect()] == [None, Decimal("1.234568")]


def test_drop_columns_ignores_case_and_absent_names(spark):
    assert drop_columns(frame(spark, [(1, 2)], "sldtoD int, b int"), ["SLDTOD", "zz"]).columns == ["b"]


def test_default_region_keeps_an_existing_column(spark):
    plain = frame(spark, [(1,)], "a int")
    assert default_region(plain, "AUS").first().rgcd == "AUS"
    assert default_region(plain, "OCA").first().rgcd == "CA"
    own = lower_names(frame(spark, [("US",)], "RGCD string"))
    assert default_region(own, "AUS").first().rgcd == "US"


def test_narrow_decimals_truncates(spark):
    df = frame(spark, [(Decimal("2.9"), Decimal("-2.9"))], "a decimal(16,6), b decimal(16,6)")
    assert rows(narrow_decimals(df, ["a", "b"])) == [(2, -2)]


def test_override_columns_is_checked(spark):
    df = frame(spark, [("x", 1), (None, 2)], "c string, n int")
    assert_overridden(override_columns(df, {"c": "z"}), {"c": "z"})
    with pytest.raises(AssertionError, match="'c': 2"):
        assert_overridden(df, {"c": "z"})
    with pytest.raises(ValueError, match="missing"):
        override_columns(df, {"zz": 1})


# -- keys and fingerprints ---------------------------------------------------------------------------------


def test_business_key_of_decimals(spark):
    df = frame(spark, [(Decimal(123), Decimal(45), "P")], "a decimal(16,6), b decimal(16,6), c string")
    assert df.select(business_key(["a", "b", "c"])).first()[0] == "123.00000045.000000P"


def test_fingerprint_depends_on_values_not_on_column_order(spark):
    df = frame(spark, [("a", "b")], "x string, y string")
    assert df.select(row_fingerprint(df)).first() == df.select("y", "x").select(row_fingerprint(df.select("y", "x"))).first()


@pytest.mark.parametrize("one, two", [(("ab", "c"), ("a", "bc")), ((None, "a"), ("", "a")), ((None, "a"), ("a", None))])
def test_fingerprint_tells_rows_apart_that_the_legacy_one_confuses(spark, one, two):
    a, b = frame(spark, [one], "x string, y string"), frame(spark, [two], "x string, y string")
    assert a.select(row_fingerprint(a)).first() != b.select(row_fingerprint(b)).first()
    assert a.select(row_fingerprint(a, legacy=True)).first() == b.select(row_fingerprint(b, legacy=True)).first()


def test_fingerprint_ignores_the_audit_dates_and_the_time_zone(spark):
    df = frame(spark, [(1, datetime(2024, 1, 1))], "a int, updated_date timestamp")
    later = frame(spark, [(1, datetime(2025, 1, 1))], "a int, updated_date timestamp")
    assert df.select(row_fingerprint(df)).first() == later.select(row_fingerprint(later)).first()
    stamped = spark.sql("SELECT timestamp_micros(1700000000000000) AS t")
    one = stamped.select(row_fingerprint(stamped)).first()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert stamped.select(row_fingerprint(stamped)).first() == one
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_murmur_fingerprint_fills_both_columns(spark):
    df = frame(spark, [("a",)], "x string")
    row = with_fingerprint(df, method="murmur").first()
    assert row.hash_value == str(row.check_sum) == str(df.select(checksum(df)).first()[0])


def test_ladder_and_prefix(spark):
    df = frame(spark, [("ABCDEFG",), ("AB",), (None,)], "cat_cd string").withColumns(category_ladder())
    assert rows(df, "cc1", "cc3", "cc5") == rows(frame(spark, [("A", "ABC", "ABCDE"), ("A", "AB", "AB"), (None,) * 3], "a string, b string, c string"))
    assert [r[0] for r in df.select(code_prefix("cat_cd", 3)).collect()] == ["ABC", "AB", None]


def test_file_names(spark):
    names = ["AUSBOM_2024_20240321.csv", "X_20240321.csv.gz", "X_1240508_150657_55335.csv", "X_20241340.csv"]
    df = frame(spark, [(n,) for n in names], "n string")
    assert [r[0] for r in df.select(file_date(F.col("n"))).collect()] == [date(2024, 3, 21), date(2024, 3, 21), None, None]
    assert len(df.select(file_code(F.col("n"))).first()[0]) == 64


# -- rows --------------------------------------------------------------------------------------------------


def test_require_keys_and_dedupe(spark):
    data = [("a", 1, "old", 1), ("a", 1, "new", 2), ("a", 1, None, 2), ("b", None, "x", 1), (None, 1, "x", 1), ("b", 2, None, None)]
    df = frame(spark, data, "k string, l int, v string, seq int")
    valid = require_keys(df, ["k", "l"])
    assert rows(dedupe_keys(valid, ["k", "l"], order_by=["seq"]), "k", "l", "v") == [("a", 1, "new"), ("b", 2, None)]


def test_dedupe_does_not_depend_on_row_order_or_partitioning(spark):
    df = spark.range(200).selectExpr("id % 7 AS k", "CAST(hash(id) % 5 AS STRING) AS a", "id % 3 AS b")
    expected = rows(dedupe_keys(df, ["k"]))
    for n in (1, 3, 8):
        assert rows(dedupe_keys(df.repartition(n, "b"), ["k"])) == expected
    assert rows(dedupe_keys(df.select("b", "k", "a"), ["k"]), "k", "a", "b") == expected


# -- lookups -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{}, {"small": True}, {"salt": 4}])
def test_lookups_keep_other_columns_of_the_same_name(spark, how):
    dim = frame(spark, [(1, "x", "dim name", "r"), (2, "y", "dim name", "r")], "id int, code string, name string, rgcd string")
    df = frame(spark, [("x", "own", "A"), ("q", "own", "B"), (None, "own", "C")], "chainc string, name string, rgcd string")
    found = lookup_required(df, dim, F.col("chainc"), {"chainc": ("id", "bigint")}, **how)
    assert found.columns == df.columns and rows(found) == [(1, "own", "A")]
    kept = lookup_optional(df, dim, F.col("chainc"), {"level": ("id", "int")}, **how)
    assert rows(kept, "rgcd", "level") == [("A", 1), ("B", None), ("C", None)]


def test_one_per_code(spark):
    dim = frame(spark, [(3, "x"), (1, "x"), (2, None)], "id int, code string")
    assert rows(one_per_code(dim)) == [("x", 1)]


def test_register_and_lookup(spark, run_ts):
    dim = frame(spark, [(10, "AB")], "id bigint, code string")
    df = frame(spark, [("ABx", 1), ("ABy", 2), ("CDz", 3), (None, 4), ("", 5), ("E", 6)], "c string, n int")
    found, fresh = register_and_lookup(df, dim, code_prefix("c", 2), "c", run_ts)
    assert {r.code for r in fresh.collect()} == {"CD", "", "E"}
    assert sorted(r.id for r in fresh.collect()) == [11, 12, 13]
    assert {r.name for r in fresh.collect()} == {"to be filled"}
    assert rows(found, "n") == [(1,), (2,), (3,), (5,), (6,)]
    assert unregistered_codes(df, dim.unionByName(fresh.select("id", "code")), code_prefix("c", 2)).isEmpty()


def test_assign_ids_are_dense_within_groups(spark):
    df = spark.range(500).selectExpr("id % 3 AS g", "CAST(id AS STRING) AS code")
    out = assign_ids(df, ["code"], start=F.col("g") * 1000, within=["g"])
    for g, n in ((0, 167), (1, 167), (2, 166)):
        assert sorted(r.id for r in out.filter(F.col("g") == g).collect()) == list(range(g * 1000 + 1, g * 1000 + n + 1))
    again = assign_ids(df.repartition(5), ["code"], start=F.col("g") * 1000, within=["g"])
    assert rows(out.select("id", "g", "code")) == rows(again.select("id", "g", "code"))


def test_action_gate(spark):
    day = date(2024, 3, 21)
    actions = frame(
        spark,
        [
            ("P1", "1", "yes", datetime(2024, 3, 21, 5)),
            ("P1", "1", "yes", datetime(2024, 3, 21, 9)),
            ("P1", "2", "no", datetime(2024, 3, 22)),
            ("P2", "2", "yes", datetime(2024, 3, 21)),
            ("P3", "1", "no", datetime(2024, 3, 21)),
            ("P4", "1", "yes", datetime(2024, 3, 22)),
            ("P5", None, "yes", None),
        ],
        "code string, attr string, app string, effdt timestamp",
    )
    flags = frame(spark, [("True", "1"), ("False", "2")], "code string, id string")
    df = frame(spark, [(f"P{n}", "f", 1) for n in range(1, 7)], "part_num string, fran_code string, brnd_cd int")
    gated = action_gate(df, qualifying_codes(actions, flags, day), F.col("part_num"), ["fran_code", "brnd_cd"])
    assert rows(gated) == rows(frame(spark, [("P1", "f", 1)] + [(f"P{n}", None, None) for n in range(2, 7)], df.schema))
    assert has_columns(df, ["PART_NUM", "fran_code"]) and not has_columns(df, ["franc_code"])


# -- delta and merge ---------------------------------------------------------------------------------------


def test_delta_operators_agree(spark):
    state = frame(spark, [(1, "h1"), (2, "h2"), (3, "h3")], "k int, hash_value string")
    incoming = frame(spark, [(1, "h1"), (2, "h3"), (4, "h1")], "k int, hash_value string")
    assert rows(classify_delta(incoming, state, ["k"]), "k", "_change") == [(1, "unchanged"), (2, "update"), (4, "insert")]
    assert rows(delta_new(incoming, state, ["k"]), "k") == [(4,)]
    assert rows(delta_existing(incoming, state, ["k"]), "k") == [(1,), (2,)]
    assert rows(delta_changed(incoming, state, ["k"]), "k") == [(2,)]


def test_merge_overwrites_with_nulls_and_keeps_unlisted_columns(spark):
    target = frame(spark, [(1, "a", "keep"), (2, "b", "keep")], "k int, v string, fixed string")
    changes = frame(spark, [(1, None, "x", "update"), (3, "c", "y", "insert")], "k int, v string, fixed string, _change string")
    assert rows(merge(target, changes, ["k"], ["v"])) == [(1, None, "keep"), (2, "b", "keep"), (3, "c", "y")]


def test_updates_lacking_a_column_set_it_to_null(spark):
    target = frame(spark, [(1, "a", 5)], "k int, v string, n int")
    out = apply_updates(target, frame(spark, [(1, "z")], "k int, v string"), ["k"], ["v", "n"])
    assert rows(out) == [(1, "z", None)]
    assert align(frame(spark, [("7",)], "n string"), target).columns == ["k", "v", "n"]

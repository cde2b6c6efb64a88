"""The repair of conversations against a dynamic program over audit strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from mastermill.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(rows):
    """The contract's figures of one conversation's (turn, role, text) after damage; all (cost, audit, repaired) by state, row after row."""
    seen, faults = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(ways):
        for _ in range(3):
            for last, (cost, audit, out) in list(ways.items()):
                for new in "ua":
                    if (last, new) in after:
                        name = {"u": "user", "a": "assistant"}[new]
                        way = (cost + 5, audit + "I", out + [f"{name}:"])
                        ways[new] = min(ways.get(new, way), way)
        return ways

    ways = inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        new_ways = {}

        def add(last, way):
            new_ways[last] = min(new_ways.get(last, way), way)

        for last, (cost, audit, out) in ways.items():
            add(last, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if (last, role[:1]) in after:
                add(role[:1], (cost + extra, audit + "K", out + [f"{role}:{text}"]))
            for new, name in (("u", "user"), ("a", "assistant")):
                if (last, new) in after:
                    add(new, (cost + 1 + extra, audit + "R", out + [f"{name}:{text}"]))
        ways = inserts(new_ways)
    cost, audit, out = min(w for last, w in ways.items() if last in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
        "repaired": "\n".join(out),
    }


def damage(rows):
    """Rows by conversation after the contract's damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def random_rows(r, sizes, first=0):
    rows = []
    for conv, size in enumerate(sizes, first):
        for k in range(size):
            role = r.choice(["user", "assistant"]) if r.random() < 0.9 else r.choice(["system", "tool", "", None, "User", "ünder", "super"])
            text = r.choice(["Yes.", "No", "", " \n", " ", "a\nb!  ", None, "x" * 50 + "?", f"text {r.random()}."])
            rows.append((conv, None if r.random() < 0.05 else k + (k > 3) + r.choice([0, 0, 0, 3]), role, text))
    return rows


def check(spark, rows, block_rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text_", F.lit(1)).repartition(parts)
    got = {r.conv_id: r for r in C.repair(C.damaged(df), block_rows=block_rows).collect()}
    want = damage(rows)
    assert set(got) == set(want)
    for conv, lines in want.items():
        expected = brute(lines)
        assert {k: got[conv][k] for k in expected} == expected, conv


def test_prices_are_distances_and_traces_the_least_audits():
    r = random.Random(3)
    for _ in range(400):
        rows = [(k, r.choice(["user", "assistant", "system", "x"]), r.choice(["a.", "b", "", "c."])) for k in range(r.randint(0, 9))]
        assert {k: v for k, v in C.repair_rows(rows).items()} == brute(rows)


@pytest.mark.parametrize("block_rows", [2, 5, 512])
def test_conversations_in_blocks_and_partitions(spark, block_rows):
    r = random.Random(block_rows)
    rows = random_rows(r, [r.randint(1, 8) for _ in range(40)] + [60, 33]) + [(None, 1, "user", "q?"), (None, None, None, None), (None, 2, "assistant", "r.")]
    check(spark, rows, block_rows, 5)


def test_equal_rows_of_one_turn_and_a_long_conversation(spark):
    r = random.Random(5)
    rows = [(7, 4, "user", "Same.")] * 40 + random_rows(r, [700], 8) + [(9, 0, "user", "z" * 100_000 + "."), (9, 1, "assistant", "end.")]
    check(spark, rows, 64, 6)


def test_no_rows_extra_columns_and_undamaged_input(spark):
    empty = C.repair(C.damaged(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0 and empty.columns == ["conv_id", *FIGURES, "repaired"]
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), (None, 0, "assistant", "Only.")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    for name in ("part", "idx", "live", "audit", "_head", "code"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.conv_id: r for r in C.repair(C.as_rows(df)).collect()}
    assert (got["a"].audit, got["a"].cost, got["a"].repaired) == ("KK", 0, "user:Hi.\nassistant:Ho.")
    assert (got[None].audit, got[None].cost, got[None].repaired) == ("D", 2, "")


def test_a_conversation_without_rows_after_damage(spark):
    lost = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row = C.repair(C.damaged(spark.createDataFrame([(1, lost, "user", "x.")], SCHEMA))).first()
    assert [row[c] for c in FIGURES] == [0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()]

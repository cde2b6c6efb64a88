"""Repair of damaged conversations: the cheapest edits that give alternating turns, by the auction algorithm for shortest paths.

The rows of a conversation and the role of the last kept turn form a lattice: node ``(i, state)`` stands before row ``i``, arcs are
the edits with their costs. Every node has a price, a lower bound of its distance to the end. A path grows from a node along an arc
whose cost is the difference of the prices; where there is none, the last node's price rises to its cheapest arc and the path gets
shorter by that node (D. P. Bertsekas, 1991). A path ends at a node whose price is settled, and settles the nodes on it; paths start from the
last row backwards, so each is short. Between settled prices an arc is tight when it lies on a cheapest path: the audit takes the
least letter among the tight arcs at each node.

Rows are sorted by ranges of (conversation, turn, role, text), so a conversation of any length lies over several partitions. The stream
of a partition solves whole conversations of up to ``block_rows`` rows. Longer ones, and those cut by a partition's edge, go on in blocks: prices at a block's
first row for each state at its end, one pass over these 4 by 4 figures for each conversation, then the edits within each block.
A conversation's text passes through one task once, row after row, for its digest: SHA-256 of a joined text is sequential.

Defined results: null roles and texts are one space, also within the damage's key; rows of one turn stand by role, then text; nulls come
first. A null ``conv_id`` is a conversation. The initial of a role is its first character; an empty role has none of the three and is not kept.
Equal rows of one turn are duplicates after the first. Other columns are not read. Differences of turns beyond 64 bits wrap.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS, BLOCK_CHARS = 512, 4 << 20
# Costs of the edits, what counts as a visible character, an ended sentence and legal neighbours.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES, ENDING, LEGAL = " \t\n\x0b\x0c\r", ".!?", {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state after the only role of the two that may follow
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60
# What follows the last row: nothing, or the inserts that end the pattern, and their cost.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
ENDS = {state: INSERT * len(letters) for state, letters in CLOSING.items()}
BLANK, DUPLICATE, CUT, SOUND = "bdt-"

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired string"
ROW = "turn long, role string, text string, live boolean, part int, idx long"
ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}


def fault(role: str, text: str, seen_before: bool) -> str:
    last = text.rstrip(SPACES)[-1:]
    if not last:
        return BLANK
    if seen_before:
        return DUPLICATE
    return SOUND if last in ENDING else CUT


def arcs(i: int, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, int, tuple[int, int]]]:
    """``letter, cost, node`` of the edits at a node before row ``i``, in the order of the letters; ``rows`` are (initial, fault)."""
    initial, kind = rows[i]
    follows = NEXT[state]
    found = [("D", DELETE, (i + 1, state)), ("I", INSERT, (i, follows))]
    if kind in (BLANK, DUPLICATE):
        return found
    extra = TRUNCATED if kind == CUT else 0
    if initial == "s" and state == START:
        found.append(("K", KEEP + extra, (i + 1, SYSTEM)))
    elif initial == ROLES[follows][0]:
        found.append(("K", KEEP + extra, (i + 1, follows)))
    found.append(("R", REROLE + extra, (i + 1, follows)))
    return found


def auction_prices(rows: list[tuple[str, str]], ends: dict[int, int]) -> dict[tuple[int, int], int]:
    """The settled price of every node that reaches an end: its distance, with ``ends`` after the last row by state."""
    size, price = len(rows), {}
    settled = {(size, state): distance for state, distance in ends.items()}
    alive = set(settled)
    for i in range(size - 1, -1, -1):
        # Nodes from which no path reaches an end take no part: their prices would rise for ever. Inserts lead to the two last states only.
        for state in (ASSISTANT, USER, SYSTEM, START, ASSISTANT):
            if any(node in alive for _, _, node in arcs(i, state, rows)):
                alive.add((i, state))
    for origin in itertools.product(range(size - 1, -1, -1), range(4)):
        if origin not in alive or origin in settled:
            continue
        path = [origin]
        while path[-1] not in settled:
            node = path[-1]
            best, to = FAR, None
            for _, cost, other in arcs(*node, rows):
                if other in alive:
                    through = cost + (settled[other] if other in settled else price.get(other, 0))
                    if through < best:
                        best, to = through, other
            if price.get(node, 0) < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        settled.update((node, price.get(node, 0)) for node in path[:-1])
    return settled


def trace(rows: list[tuple[str, str]], prices: dict[tuple[int, int], int], state: int) -> tuple[list[str], int]:
    """The edits from ``state`` along tight arcs, the least letter first: for each row the inserts before it and its own; and the last state."""
    edits, i, own = [], 0, ""
    while i < len(rows):
        tight = (a for a in arcs(i, state, rows) if a[2] in prices and prices[i, state] == a[1] + prices[a[2]])
        letter, _, (after, state) = next(tight)
        own += letter
        if after > i:
            edits.append(own)
            own = ""
        i = after
    return edits, state


class Repaired:
    """A conversation's figures, gathered row after row."""

    def __init__(self, keep_text: bool):
        self.distinct = self.illegal = 0
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0, SOUND: 0}
        self.first = self.last = self.before = None
        self.state, self.cost, self.audit = START, 0, []
        self.hash, self.lines, self.texts = hashlib.sha256(), 0, [] if keep_text else None

    def add(self, turn, role: str, text: str, kind: str, edits: str) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.faults[kind] += 1
        self.inserts(edits[:-1])
        edit = edits[-1]
        self.audit.append(edit)
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if kind == CUT else 0)
        self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[self.state]
        self.line(f"{ROLES[self.state] if edit == 'R' else role}:{text}")

    def inserts(self, letters: str) -> None:
        for letter in letters:
            self.audit.append(letter)
            self.cost += INSERT
            self.state = NEXT[self.state]
            self.line(f"{ROLES[self.state]}:")

    def line(self, text: str) -> None:
        data = ("\n" if self.lines else "") + text
        self.lines += 1
        self.hash.update(data.encode())
        if self.texts is not None:
            self.texts.append(data)

    def result(self) -> dict:
        """The figures, after the inserts that end the conversation."""
        self.inserts(CLOSING[self.state])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        gaps = (gaps + (1 << 63)) % (1 << 64) - (1 << 63)
        return {
            "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT],
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
            "repaired": None if self.texts is None else "".join(self.texts),
        }


def repair_rows(rows: list[tuple], keep_text: bool = True) -> dict:
    """The figures of one conversation of ``(turn, role, text)`` in order."""
    seen, lattice = set(), []
    for _, role, text in rows:
        lattice.append((role[:1], fault(role, text, (role, text) in seen)))
        seen.add((role, text))
    edits, _ = trace(lattice, auction_prices(lattice, ENDS), START)
    out = Repaired(keep_text)
    for (turn, role, text), (_, kind), own in zip(rows, lattice, edits):
        out.add(turn, role, text, kind, own)
    return out.result()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults set in by a checksum of ``conv_id:turn``; a row that is dropped stays as a mark with ``live`` false."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    code = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 0, None).when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") != 0, text).alias("text"),
        (F.col("code") != 0).alias("live"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def as_rows(conversations: DataFrame) -> DataFrame:
    """Conversations as they are, in the form of :func:`damaged`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, F.lit(True).alias("live"))


def names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def repair(rows: DataFrame, keep_text: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each ``conv_id`` of ``rows`` (:func:`damaged` or :func:`as_rows`) with its faults, cost, audit and, on request, repaired text.

    Without ``keep_text`` the column ``repaired`` is null and only the digest is made.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    place = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    # Ranges go by the head of the text and, for equal rows, by where they were read; within a partition whole texts decide.
    spread = rows.withColumns({"_head": F.substring("text", 1, 32), "_at": F.monotonically_increasing_id()})
    spread = spread.repartitionByRange(*place, F.col("_head").asc_nulls_first(), "_at").drop("_head", "_at")
    spread = spread.sortWithinPartitions(*place, F.col("text").asc_nulls_first()).withColumn("part", F.spark_partition_id())
    read = stored(spread.mapInArrow(_solver(keep_text, block_rows), f"conv_id {kind}, {RESULT}, {ROW}"), "conversations")
    done = read.filter("idx IS NULL").select("conv_id", *names(RESULT))
    return done.unionByName(_in_blocks(read.filter("idx IS NOT NULL").drop(*names(RESULT)), keep_text, block_rows))


def _schema(conv: pa.DataType, *parts: str) -> pa.Schema:
    fields = [field.split() for part in parts for field in part.split(", ")]
    return pa.schema([("conv_id", conv), *[(name, ARROW[kind]) for name, kind in fields]])


def _solver(keep_text: bool, block_rows: int):
    """Solve the conversations that lie within a sorted partition; hand on, numbered, the rows of long ones and of those at its ends."""

    def solve(batches):
        schema, out, held, chars, handed = None, [], [], 0, 0
        current, inside = None, False

        def hand_on():
            nonlocal chars, handed
            for conv, turn, role, text, live, part in held:
                out.append({"conv_id": conv, "turn": turn, "role": role, "text": text, "live": live, "part": part, "idx": handed})
                handed += 1
            held.clear()
            chars = 0

        def finish():
            nonlocal chars
            if inside and held:
                out.append({"conv_id": current} | repair_rows([r[1:4] for r in held if r[4]], keep_text))
                held.clear()
                chars = 0
            hand_on()

        def written():
            ready = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return ready

        first = True
        for batch in batches:
            schema = schema or _schema(batch.schema.field("conv_id").type, RESULT, ROW)
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for row in zip(*[piece.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "live", "part")]):
                    if first or row[0] != current:
                        finish()
                        inside, current, first = not first, row[0], False
                    held.append(row)
                    chars += len(row[3] or "")
                    if len(held) > block_rows or chars > BLOCK_CHARS:
                        hand_on()
                        inside = False
                if out:
                    yield written()
        hand_on()
        if out:
            yield written()

    return solve


def _in_blocks(rows: DataFrame, keep_text: bool, block_rows: int) -> DataFrame:
    """The same for conversations that are long or lie over several partitions; ``part`` and ``idx`` give the order.

    Texts are neither gathered nor sent to the blocks. What one task holds of a conversation is 16 numbers for each block.
    """
    kind, block = rows.schema["conv_id"].dataType.simpleString(), ["conv", "part", "block"]
    rows = rows.withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")))
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("digest")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)).alias("last")
    number = F.floor(F.col("idx") / block_rows).alias("block")
    shape = rows.filter("live").select("conv", "part", "idx", number, F.substring("role", 1, 1).alias("initial"), last, digest)
    # The first of equal rows is found with map-side combine; both sides of the join are unique.
    first = shape.groupBy("conv", "digest").agg(F.min(F.struct("part", "idx")).alias("at")).select("at.*", F.lit(True).alias("is_first"))
    fault = F.when(F.col("last") == "", BLANK).when(F.col("is_first").isNull(), DUPLICATE).when(F.col("last").isin(*ENDING), SOUND).otherwise(CUT)
    shape = shape.join(first, ["part", "idx"], "left").select(*block, F.struct("idx", "initial", fault.alias("kind")).alias("row"))
    blocks = stored(shape.groupBy(*block).agg(F.array_sort(F.collect_list("row")).alias("rows")), "conversation-blocks")

    passages = blocks.mapInArrow(_passages, "conv string, part int, block long, figures array<long>")
    gathered = passages.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "block", "figures"))).alias("blocks"))
    following = gathered.mapInArrow(_following, "conv string, part int, block long, after array<long>")
    traced = blocks.join(following, block).select(*block, "rows", "after")
    lattice = blocks.schema["rows"].dataType.simpleString()
    traced = stored(traced.mapInArrow(_ways, f"conv string, part int, block long, rows {lattice}, edits array<array<string>>, states array<int>"), "conversation-ways")
    gathered = traced.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "block", "states"))).alias("blocks"))
    entries = gathered.mapInArrow(_entries, "conv string, part int, block long, entry int")
    chosen = traced.join(entries, block).select("rows", "part", F.get("edits", F.col("entry")).alias("edits"))
    chosen = chosen.select("part", F.explode(F.arrays_zip("rows", "edits")).alias("e"))
    chosen = chosen.select("part", F.col("e.rows.idx").alias("idx"), F.col("e.rows.kind").alias("kind"), F.col("e.edits").alias("edits"))
    ordered = rows.join(chosen, ["part", "idx"], "left").select("conv_id", "conv", "turn", "role", "text", "part", "idx", "kind", "edits")
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "part", "idx")
    return ordered.mapInArrow(_assembler(keep_text), f"conv_id {kind}, {RESULT}")


def _lattices(batch) -> list[list[tuple[str, str]]]:
    return [[(r["initial"], r["kind"]) for r in rows] for rows in batch.column("rows").to_pylist()]


def _passages(batches):
    """The distance from each state before a block to each state after it."""
    for batch in batches:
        table = []
        for lattice in _lattices(batch):
            to = [auction_prices(lattice, {state: 0}) for state in range(4)]
            table.append([to[after].get((0, before), FAR) for before in range(4) for after in range(4)])
        yield batch.select(["conv", "part", "block"]).append_column("figures", pa.array(table, pa.list_(pa.int64())))


def _by_block(batches, figures, name: str, kind: pa.DataType):
    """Rows of (conv, part, block, figure) from conversations with their blocks in order, by a function of the blocks."""
    for batch in batches:
        for conv, blocks in zip(batch.column("conv").to_pylist(), batch.column("blocks").to_pylist()):
            columns = [[conv] * len(blocks), [b["part"] for b in blocks], [b["block"] for b in blocks], figures(blocks)]
            kinds = (pa.string(), pa.int32(), pa.int64(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv", "part", "block", name])


def _following(batches):
    """For each block the distance to the conversation's end from each state after the block."""

    def figures(blocks):
        after, out = [ENDS[state] for state in range(4)], []
        for b in reversed(blocks):
            out.append(after)
            after = [min(FAR, *(b["figures"][4 * s + t] + after[t] for t in range(4))) for s in range(4)]
        return out[::-1]

    return _by_block(batches, figures, "after", pa.list_(pa.int64()))


def _ways(batches):
    """The edits within a block and the state after it, for each state before it."""
    for batch in batches:
        edits, states = [], []
        for lattice, after in zip(_lattices(batch), batch.column("after").to_pylist()):
            prices = auction_prices(lattice, {state: d for state, d in enumerate(after) if d < FAR})
            ways = [trace(lattice, prices, s) if (0, s) in prices else (None, None) for s in range(4)]
            edits.append([w[0] for w in ways])
            states.append([w[1] for w in ways])
        batch = batch.select(["conv", "part", "block", "rows"]).append_column("edits", pa.array(edits, pa.list_(pa.list_(pa.string()))))
        yield batch.append_column("states", pa.array(states, pa.list_(pa.int32())))


def _entries(batches):
    """The state before each block on the way from the conversation's beginning."""

    def figures(blocks):
        state, out = START, []
        for b in blocks:
            out.append(state)
            state = b["states"][state]
        return out

    return _by_block(batches, figures, "entry", pa.int32())


def _assembler(keep_text: bool):
    """The figures of each conversation from its rows in order."""

    def assemble(batches):
        schema, current, conv, held, out = None, None, None, None, []
        for batch in batches:
            schema = schema or _schema(batch.schema.field("conv_id").type, RESULT)
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for conv_id, key, turn, role, text, kind, edits in zip(
                    *[piece.column(c).to_pylist() for c in ("conv_id", "conv", "turn", "role", "text", "kind", "edits")]
                ):
                    if key != current:
                        if held:
                            out.append({"conv_id": conv} | held.result())
                        current, conv, held = key, conv_id, Repaired(keep_text)
                    if edits is not None:
                        held.add(turn, role, text, kind, edits)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv} | held.result()], schema=schema)

    return assemble

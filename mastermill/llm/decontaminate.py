"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in lower case with white space collapsed. An item of length n may differ from a passage by
``rate * n`` edits. It is split into one piece more than that budget; a passage within the budget holds at least one
piece unchanged. An Aho-Corasick automaton finds all pieces in one pass over a text, and Myers' bit-parallel algorithm gives the exact
distance of the item to the best passage around each hit. Items are sent to the tasks in blocks of bounded size, one pass
over the documents per block.

Defined results: a document matches an item with the least edit distance of the item to any part of its text, if within the
budget. Items with fewer than ``least_chars`` characters (null and empty ones too) match nothing: so short a text says nothing about
its origin. Null texts match nothing. Repeated items and documents each match alike. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES, MOST_BYTES = 4 << 20, 256 << 20
EXCERPT_CHARS, LEAST_WORDS = 400, 5


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def windows(text: str) -> list[str]:
    """The text and, if it is long, its windows; the last one ends with it."""
    if len(text) <= EXCERPT_CHARS:
        return [text]
    size, step = EXCERPT_CHARS // 2, EXCERPT_CHARS // 4
    return [text, *[text[a : a + size] for a in range(0, len(text) - size, step)], text[len(text) - size :]]


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float, least_chars: int = 40):
        self.items, self.automaton, by_piece = [], ahocorasick.Automaton(), {}
        self.whole: dict[str, list[int]] = {}
        for item_id, whole in items:
            if len(whole) < least_chars:
                if len(whole.split()) < LEAST_WORDS:
                    self.whole.setdefault(whole, []).append(item_id)
                else:
                    by_piece.setdefault(whole, []).append((len(self.items), 0))
                    self.items.append((item_id, len(whole), -1, {}))
                continue
            for text in windows(whole):
                budget = int(rate * len(text))
                masks: dict[str, int] = {}
                for i, c in enumerate(text):
                    masks[c] = masks.get(c, 0) | 1 << i
                for offset, piece in pieces(text, budget):
                    by_piece.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, len(text), budget, masks))
        for piece, places in by_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        if by_piece:
            self.automaton.make_automaton()

    def matches(self, text: str) -> dict[int, int]:
        """Least distance by item id."""
        found = dict.fromkeys(self.whole.get(text, ()), 0)
        if not self.items or not text:
            return found
        near: dict[int, list[tuple[int, int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for number, offset in places:
                item_id, length, budget, _ = self.items[number]
                start = end + 1 - size - offset
                if budget >= 0:
                    near.setdefault(number, []).append((start - budget, start + length + budget))
                elif not text[max(0, start - 1) : start].isalnum() and not text[end + 1 : end + 2].isalnum():
                    found[item_id] = 0
        for number, around in near.items():
            item_id, length, budget, masks = self.items[number]
            best = min(distance(masks, length, text[max(0, a) : b]) for a, b in joined(around))
            if best <= budget:
                found[item_id] = min(best, found.get(item_id, best))
        return found


def joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The windows with overlapping ones put together."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def distance(masks: dict[str, int], length: int, text: str) -> int:
    """Least edit distance between the pattern and any part of ``text``, one word operation per column (Myers 1999)."""
    full, top = (1 << length) - 1, 1 << length - 1
    plus, minus, score = full, 0, length
    best = score
    for c in text:
        same = masks.get(c, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``BLOCK_BYTES`` of text (one item at least)."""
    held = benchmark.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    if held > MOST_BYTES:
        raise ValueError(f"a benchmark of {held} bytes is beyond the {MOST_BYTES} that pass through the driver")
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = normal(row.text)
        if row.item_id is None or not text:
            continue
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    yield block


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, least_chars: int = 40) -> DataFrame:
    """``doc_id``, ``item_id`` and ``distance`` of each document and item that match."""
    out = None
    for block in item_blocks(benchmark):
        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_matching(block, rate, least_chars), "doc_id long, item_id long, distance long")
        out = part if out is None else out.union(part)
    return out


def _matching(block: list[tuple[int, str]], rate: float, least_chars: int):
    def match(batches):
        matcher = Matcher(block, rate, least_chars)
        for batch in batches:
            rows = [(d, i, n) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, n in matcher.matches(normal(t)).items()]
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance"])

    return match


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, least_chars: int = 40) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    at = [c.lower() for c in docs.columns].index("text")
    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(_clean(block, rate, least_chars, at), docs.schema)
    return docs


def _clean(block: list[tuple[int, str]], rate: float, least_chars: int, at: int):
    def clean(batches):
        matcher = Matcher(block, rate, least_chars)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.matches(normal(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

    return clean

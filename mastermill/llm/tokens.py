"""Token ids of whole texts with a byte-level BPE of the tokenizers library.

Byte-level BPE never merges across a space that stands between two visible characters, so a text falls there into units
whose ids do not depend on each other. Repeated units are encoded once per worker: the units not met before are joined
into one text and encoded together, and the ids are told apart by the space that begins each unit. Texts with other
runs of white space are encoded as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from itertools import chain

import numpy as np

# A worker's memory for units and their ids; both are dropped beyond it, which costs time but changes no result.
CACHE_UNITS = 500_000
POOL_IDS = 4_000_000
UNITS_AT_ONCE = 200
FIRST = "\0"  # marks a text's first unit, which no space begins; it is in no text that falls at spaces
END = "\1"  # marks signs that follow letters
SIGNS = ".,;:!?%$#&*|"


class Encoder:
    """Encodes texts with the tokenizer file at ``path`` as the library does by default, where the strings of its special tokens stand for
    those tokens; with ``plain`` they are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has dealt out the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (plain and t.special)]  # they may hold spaces, or stand within a word
        size = self.tokenizer.get_vocab_size()
        self.begins = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.begins[number] = token.startswith("Ġ")  # the byte-level sign for a space
        self.by_units = self._splits_at_spaces()
        self._clear()

    def _splits_at_spaces(self) -> bool:
        """Whether the tokenizer is a byte-level BPE that adds nothing of its own."""
        probe = "a b.c d\ne f 1 word!! there,"
        units = ["a", " b.c", " d\ne", " f", " 1", " word", "!!", " there", ","]
        return self.whole(probe).tolist() == [i for u in units for i in self.whole(u).tolist()] and "Ġ" in self.tokenizer.get_vocab()

    def _clear(self) -> None:
        self.units: dict[str, int] = {}
        self.start, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.n_pool = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_units:
            return [self.whole(x) for x in texts]
        if len(self.units) > CACHE_UNITS or self.n_pool > POOL_IDS:
            self._clear()
        split = [x.split(" ") if falls_at_spaces(x) and not any(t in x for t in self.added) else None for x in texts]
        found = iter(self._looked_up([parts for parts in split if parts]))
        return [self.whole(x) if parts is None else next(found) for x, parts in zip(texts, split)]

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _looked_up(self, split: list[list[str]]) -> list[np.ndarray]:
        if not split:
            return []
        for parts in split:
            parts[0] = FIRST + parts[0]
        self._learn(set().union(*split))
        words = np.cumsum([len(parts) for parts in split])
        ids, sizes = self._ids(chain.from_iterable(split), int(words[-1]))
        return np.split(ids, np.cumsum(sizes)[words[:-1] - 1])

    def _ids(self, units: Iterable[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``n`` known units one after the other, and how many each has."""
        unit = np.fromiter(map(self.units.__getitem__, units), np.int64, n)
        size = self.size[unit]
        ends = np.cumsum(size)
        return self.pool[np.repeat(self.start[unit] - ends + size, size) + np.arange(size.sum())], size

    def _learn(self, units: set[str]) -> None:
        missing = [x for x in units if x not in self.units]
        first = [x for x in missing if x[0] == FIRST]
        # Letters and the signs after them never merge: such a unit is made of two.
        plain, made, pairs = [], [], []
        for x in missing:
            stem = x.rstrip(SIGNS)
            if len(stem) < len(x) and stem.isalpha():
                made.append(x)
                pairs += (stem, END + x[len(stem) :])
            elif x[0] != FIRST:
                plain.append(x)
        plain += {x for x in pairs[::2] if x not in self.units}.difference(plain)
        first += {x for x in pairs[1::2] if x not in self.units}
        joined = self._batch([" " + " ".join(plain[i : i + UNITS_AT_ONCE]) for i in range(0, len(plain), UNITS_AT_ONCE)])
        ids = np.concatenate([np.zeros(0, np.uint32), *joined])
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(plain):  # not such a tokenizer after all
            raise ValueError("the tokenizer does not keep words apart")
        self._add(plain, ids, np.diff(np.append(starts, len(ids))))
        if first:
            others = self._batch([x[1:] for x in first])
            self._add(first, np.concatenate(others), np.array([len(x) for x in others]))
        if made:
            ids, sizes = self._ids(pairs, len(pairs))
            self._add(made, ids, sizes.reshape(-1, 2).sum(axis=1))

    def _add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known, used = len(self.units), self.n_pool
        self.units.update(zip(units, range(known, known + len(units))))
        self.start = filled(self.start, known, np.cumsum(sizes) - sizes + used)
        self.size = filled(self.size, known, sizes)
        self.pool = filled(self.pool, used, ids)
        self.n_pool = used + len(ids)


def falls_at_spaces(text: str) -> bool:
    """Whether every white space of ``text`` stands alone between visible characters; False also where that is uncertain."""
    plain = text.replace("\n", " ")
    # Of all white space only the space counts as printable.
    return bool(text) and plain.isprintable() and "  " not in plain and plain[0] != " " and plain[-1] != " "


def filled(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from position ``at``, made twice as long where they do not fit."""
    if at + len(values) > len(array):
        array = np.concatenate([array[:at], np.zeros(max(at, 2 * len(values)) + len(values), array.dtype)])
    array[at : at + len(values)] = values
    return array


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's own encoder for ``path``, with what it has learned so far."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain)
    return _ENCODERS[path, plain]


def forget() -> None:
    """Give back the encoders' memory: a worker that goes on with another operator has no use for them."""
    _ENCODERS.clear()

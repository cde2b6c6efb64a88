"""Suffix sorting by external induced sorting, with the common prefixes of neighbours.

Suffixes that start an ascending run after a descending one (S*) are sorted first: by the names of the substrings between
them, and where names repeat by a recursion over the names. All others are induced: each sorted suffix puts the one before it into a
priority queue under its first character, and the queue hands suffixes out in their order. Keys never fall below the one handed out last,
so the queue is a row of buckets of neighbouring keys, each holding its tuples in the order of their arrival. Tuples beyond the
queue's memory go to a scratch file of the task, which is deleted with it. Suffixes are taken from the queue in batches: as many as no
suffix induced by the batch itself could precede.

A tuple also carries the length of the prefix that its suffix shares with the one before it in the queue under the same character: one more than the least such
length among the suffixes handed out from the one that induced the other to the one that induced it. The least is looked up in tables of minima
by powers of two, over the batch and over all batches. Those of S* suffixes come from the recursion, whose lengths in names are lengths in
characters, and are drawn out by comparing what follows. Lengths are counted up to a cap.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 1 << 20  # tuples of a queue
BUCKET = 1 << 11
GROUP = 32
LEVELS = np.frexp(np.arange((1 << 16) + 1, dtype=float))[1].astype(np.int64) - 1  # the greatest power of two within a number; not used for 0


def stable_order(values: np.ndarray) -> np.ndarray:
    """The order of whole numbers, equal ones as they come; numpy sorts by digits what fits 16 bits."""
    least = values.min(initial=0)
    if int(values.max(initial=0)) - int(least) < 1 << 16:
        values = (values - least).astype(np.uint16)
    return np.argsort(values, kind="stable")


class BucketQueue:
    """Tuples (key, position, common prefix) by key, those with equal keys in the order of their arrival; keys handed out never decrease."""

    def __init__(self, sizes: np.ndarray, memory: int = MEMORY, dtype: type = np.int64):
        """``sizes``: how many tuples each key will have; keys with few share a bucket."""
        self.dtype = np.dtype(dtype)
        total = np.cumsum(sizes)
        large = sizes > BUCKET
        group = np.cumsum(large | np.concatenate([[False], large[:-1]]))
        number = (total - sizes) // BUCKET
        edge = np.concatenate([[True], (group[1:] != group[:-1]) | ((number[1:] != number[:-1]) & ~large[1:])])
        self.bucket = np.cumsum(edge) - 1
        self.single = np.bincount(self.bucket, minlength=int(self.bucket[-1]) + 1) == 1
        # Tuples wait by group of buckets, and by bucket once their group has its turn.
        self.groups: list[list] = [[] for _ in range(-(-len(self.single) // GROUP))]
        self.waiting: list[list] = [[] for _ in range(len(self.single))]
        self.turn, self.memory, self.held, self.file, self.spills = -1, memory, 0, None, 0

    def push(self, keys: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        bucket = self.bucket[keys]
        place = np.where(bucket // GROUP == self.turn, bucket, -1 - bucket // GROUP)
        order = stable_order(place)
        place, tuples = place[order], np.empty((3, len(order)), self.dtype)
        tuples[0], tuples[1], tuples[2] = keys[order], positions[order], prefixes[order]
        cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
        for a, b in zip(cuts, cuts[1:]):
            at = int(place[a])
            (self.waiting[at] if at >= 0 else self.groups[-1 - at]).append(tuples[:, a:b])
        self.held += len(keys)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        self.spills += 1
        for parts in (*self.groups, *self.waiting):
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    at = self.file.tell()
                    self.file.write(np.ascontiguousarray(part).tobytes())
                    parts[i] = (at, part.shape[1])
        self.held = 0

    def _read(self, parts: list) -> np.ndarray:
        out = []
        for part in parts:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.fromfile(self.file, self.dtype, 3 * part[1]).reshape(3, -1)
            else:
                self.held -= part.shape[1]
            out.append(part)
        parts.clear()
        return np.concatenate(out, axis=1) if len(out) > 1 else out[0]

    def has(self, b: int) -> bool:
        """Whether something waits in bucket ``b``, which has its turn now."""
        if b // GROUP != self.turn:
            self.turn = b // GROUP
            if self.groups[self.turn]:
                self.push(*self._read(self.groups[self.turn]))
        return bool(self.waiting[b])

    def take(self, b: int) -> np.ndarray:
        """The tuples that wait in bucket ``b``, in the order of arrival."""
        return self._read(self.waiting[b])

    def close(self) -> None:
        if self.file:
            self.file.close()


class Minima:
    """The least of any range of numbers, by the least of all ranges whose length is a power of two; numbers can be added."""

    def __init__(self, values: np.ndarray | None = None):
        self.levels, self.size, self.flat = [np.zeros(64, np.uint8)], 0, None
        if values is not None:
            self.levels, self.size, step = [values], len(values), 1
            while 2 * step <= len(values):
                last = self.levels[-1]
                self.levels.append(np.minimum(last[:-step], last[step:]))
                step *= 2

    def append(self, value: int) -> None:
        at, step, level = self.size, 1, 0
        self.size, self.flat = self.size + 1, None
        while True:
            if level == len(self.levels):
                self.levels.append(np.zeros(64, np.uint8))
            row, place = self.levels[level], at + 1 - step
            if place >= len(row):
                row = self.levels[level] = np.concatenate([row, np.zeros(len(row), np.uint8)])
            row[place] = value
            step, level = 2 * step, level + 1
            if step > self.size:
                return
            value = min(int(self.levels[level - 1][at + 1 - step]), value)

    def least(self, first: np.ndarray, last: np.ndarray, nothing: int) -> np.ndarray:
        """By range, both ends included; ``nothing`` for empty ranges."""
        size = last - first + 1
        level = LEVELS[np.minimum(size, 1 << 16)] if len(self.levels) < 17 else np.frexp(size.astype(float))[1] - 1
        empty = size <= 0
        level[empty] = 0
        if self.flat is None:
            self.flat = np.concatenate(self.levels), np.cumsum([0, *[len(row) for row in self.levels[:-1]]])
        rows, base = self.flat[0], self.flat[1][level]
        first, last = np.where(empty, 0, first), np.where(empty, 0, last)
        out = np.minimum(rows[base + first], rows[base + last + 1 - (1 << level)])
        out[empty] = nothing
        return out


def induced(key: np.ndarray, seeds: np.ndarray, seed_keys: np.ndarray, shared: np.ndarray, wanted: np.ndarray, run: np.ndarray, memory: int, cap: int) -> Iterator[tuple]:
    """Positions in order, with their keys and the prefixes shared with the position before: the seeds, and each position before one handed out
    that is ``wanted`` (under its ``key``).

    ``shared`` are the prefixes of seeds with the seeds before them. Keys 2c and 2c + 1 are of one character, of suffixes that fall and rise after
    their first ``run`` of it, so of two such the shorter run is shared.
    """
    n_keys = int(max(key.max(), seed_keys.max(initial=0))) + 1
    queue = BucketQueue(np.bincount(key[wanted], minlength=n_keys) + np.bincount(seed_keys, minlength=n_keys), memory, key.dtype)
    queue.push(seed_keys, seeds, shared)
    batches, batch_of, tail = Minima(), np.full(n_keys, -1, np.int64), np.full(n_keys, cap, np.uint8)
    last_key, last_run = -2, 0
    nothing = np.zeros((3, 0), key.dtype)
    for b in range(len(queue.waiting)):
        held = nothing
        while queue.has(b) or held.shape[1]:
            if queue.waiting[b]:
                # What came in the meantime comes after what has the same key already.
                more = queue.take(b)
                held = np.concatenate([held, more], axis=1) if held.shape[1] else more
                if not queue.single[b]:
                    held = held[:, stable_order(held[0])]
            keys, positions, prefixes = held
            before = positions - 1
            pushes = (positions > 0) & wanted[before]
            cut = len(keys)
            if not queue.single[b]:
                least = np.minimum.accumulate(np.where(pushes, key[before], np.iinfo(key.dtype).max))
                late = np.flatnonzero(keys[1:] > least[:-1])
                cut = int(late[0]) + 1 if len(late) else cut
            keys, positions, held = keys[:cut], positions[:cut], held[:, cut:]
            height = prefixes[:cut]
            new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            height[new] = np.where(keys[new] >> 1 == keys[new - 1] >> 1, np.minimum(run[positions[new]], run[positions[new - 1]]), 0)
            if keys[0] != last_key:
                height[0] = min(run[positions[0]], last_run) if keys[0] >> 1 == last_key >> 1 else 0
            last_key, last_run = int(keys[-1]), int(run[positions[-1]])
            yield positions, keys, height
            at = np.flatnonzero(pushes[:cut])
            if len(at):
                new = before[at]
                queue.push(key[new], new, _carried(key[new], at, height.astype(np.uint8), batches, batch_of, tail, cap).astype(key.dtype))
            batches.append(int(height.min()))
    queue.close()


def _carried(keys: np.ndarray, at: np.ndarray, height: np.ndarray, batches: Minima, batch_of: np.ndarray, tail: np.ndarray, cap: int) -> np.ndarray:
    """The prefixes that pushed suffixes share with those pushed before under their key; ``at`` are the places of their inducers in the batch.

    ``batch_of`` a key is the batch that pushed it last, and ``tail`` the least height after that push within that batch.
    """
    order = stable_order(keys)
    key, place = keys[order], at[order]
    first, last = np.ones(len(key), bool), np.ones(len(key), bool)
    first[1:] = last[:-1] = key[1:] != key[:-1]
    minima = Minima(height)
    begin = np.zeros(len(key), np.int64)
    begin[1:] = place[:-1] + 1
    begin[first] = 0
    least = minima.least(begin, place, cap)
    heads = np.flatnonzero(first)
    names = key[heads]
    since = np.minimum(tail[names], batches.least(batch_of[names] + 1, np.full(len(names), batches.size - 1), cap))
    least[heads] = np.minimum(least[heads], since)
    ends = place[last]
    tail[key[last]] = minima.least(ends + 1, np.full(len(ends), len(height) - 1), cap)
    batch_of[key[last]] = batches.size
    out = np.empty(len(order), np.int64)
    out[order] = np.minimum(least.astype(np.int64) + 1, cap)
    return out


def substring_names(tagged: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rank of each substring from one start to the next (both included) among all; equal substrings share theirs."""
    starts = starts.astype(np.int64)
    sizes = np.append(starts[1:] - starts[:-1] + 1, 1)
    bits = int(tagged.max()).bit_length()
    width = max(1, 62 // bits)
    group = np.zeros(len(starts), np.int64)  # rank of the first of the equal ones so far
    open_, done = np.arange(len(starts)), 0
    while len(open_):
        word = np.zeros(len(open_), np.int64)
        for k in range(done, done + width):
            at = np.minimum(starts[open_] + k, len(tagged) - 1)
            word = (word << bits) | np.where(k < sizes[open_], tagged[at], 0)
        order = np.lexsort((word, group[open_])) if done else np.argsort(word)
        open_, word = open_[order], word[order]
        old = group[open_]
        first = np.concatenate([[True], old[1:] != old[:-1]])
        new = first | np.concatenate([[True], word[1:] != word[:-1]])
        place = np.arange(len(open_))
        group[open_] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
        done += width
        last = np.append(new[1:], True)
        open_ = open_[~(new & last) & (sizes[open_] > done)]
    used = np.zeros(len(starts), np.int64)
    used[group] = 1
    return (np.cumsum(used) - 1)[group]


def suffix_array(text: np.ndarray, memory: int = MEMORY, cap: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all suffixes of ``text`` (whole numbers of at least 0) in lexicographic order, and the lengths of the prefixes that each shares
    with the one before it, up to ``cap`` (255 at most)."""
    n = len(text)
    if n < 2:
        return np.arange(n), np.zeros(n, np.int64)
    kind = np.int32 if 4 * max(n, int(text.max()) + 2) < 1 << 31 else np.int64
    chars = np.append(text.astype(kind) + 1, 0).astype(kind)  # a least character ends the text
    differs = chars[1:] != chars[:-1]
    next_change = np.flatnonzero(differs)[np.cumsum(differs) - differs]
    run = np.append(np.minimum(next_change - np.arange(n) + 1, cap), 1).astype(np.uint8)
    small = np.append(chars[next_change] < chars[next_change + 1], True)
    stars = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(kind)
    names = substring_names(chars * 2 + small, stars)
    if len(names) > 1 and names.max() + 1 < len(names):
        order, shared = suffix_array(names, memory, cap // 2 + 1)
        # So many equal names are as many characters as lie between the stars.
        known = np.minimum(stars[np.minimum(order + shared, len(stars) - 1)] - stars[order], cap)
    else:
        order = np.argsort(names, kind="stable")
        known = np.zeros(len(order), np.int64)
    stars = stars[order]
    shared = drawn_out(chars, stars, known.astype(np.int64), cap)
    large, keys, height = gathered(induced(chars * 2, stars, chars[stars] * 2 + 1, shared.astype(kind), ~small, run, memory, cap), kind)
    falls = (keys & 1) == 0
    large, height = large[falls][::-1], backwards(height[falls])
    falling = (chars.max() - chars) * 2
    wanted = np.append(small[:-1], False)
    order, _, height = gathered(induced(falling, large, falling[large] + 1, height.astype(kind), wanted, run, memory, cap), kind)
    return order[::-1], backwards(height)


def gathered(batches: Iterator[tuple], kind: type) -> list[np.ndarray]:
    parts = list(batches)
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind) for i in range(3)]


def backwards(height: np.ndarray) -> np.ndarray:
    """The prefixes shared with the one before, once the order is reversed."""
    return np.append(0, height[:0:-1]).astype(np.int64)[: len(height)]


def drawn_out(chars: np.ndarray, order: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """The lengths of the prefixes that neighbours in ``order`` share, where at least ``known`` of each is shared with the one before."""
    out = known.copy()
    out[:1] = 0
    open_ = np.flatnonzero(out < cap)
    open_ = open_[open_ > 0]
    while len(open_):
        at = out[open_]
        open_ = open_[chars[order[open_] + at] == chars[order[open_ - 1] + at]]
        out[open_] += 1
        open_ = open_[out[open_] < cap]
    return out

"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans come from four patterns and always stay. Further candidates are runs of at least eight letters, digits and
``+/_-`` that hold a digit and touch no base span; they may be secrets. Each has ``len(FEATURES)`` yes-or-no features. Labelers of three
sorts vote on it from them: patterns (hexadecimal, mixed, plain number), a gazetteer (names of credentials before it) and the context
(assignment, quotes, URL). The candidates of all documents are counted by their features, so the driver sees at most one row per
feature pattern, whatever the input. Expectation-maximisation over these counts estimates each labeler's reliability and the
probability of each pattern; a logistic classifier over all features is then trained on the probabilities, and decides every candidate.

Defined results: a null text has no spans. Without candidates no classifier is needed and only base spans are found. Positions are code
points, the end exclusive. Repeated rows give repeated results. An input column named ``spans`` is replaced; other columns
pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted

# The patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

DIGITS = re.compile(r"[0-9]+")
RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
HEX = re.compile(r"[0-9a-f]{12,}|[0-9A-F]{12,}")
BEFORE = re.compile(r"([A-Za-z_-]*)(\s?[=:]\s?)?([\"']?)$")
CREDENTIALS = frozenset("password passwd passphrase pwd secret token key apikey api_key api-key access_key auth bearer credential credentials".split())
LEAST = 8
SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"
FEATURES = ("hex", "lower", "upper", "mixed", "number", "long", "very_long", "credential", "assigned", "quoted", "varied", "uniform", "url", "joined")
LABELERS = (
    # (features that must hold, features that must not hold, vote)
    (("hex",), ("number",), 1),
    (("mixed", "varied"), ("url",), 1),
    (("number",), (), -1),
    (("uniform",), (), -1),
    (("credential",), (), 1),
    (("assigned",), (), 1),
    ((), ("assigned", "quoted"), -1),
    (("url",), (), -1),
)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of its kind, end) of the base spans in order."""
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, end, features as bits) of each candidate."""
    done = word = seen = 0
    in_url = False
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] in RUN:
            start -= 1
        while end < len(text) and text[end] in RUN:
            end += 1
        # The word that holds the run begins after the last space, however far that is; what was looked at is not looked at again.
        space = text.rfind(" ", done, start)
        if space >= 0:
            word, seen, in_url = space + 1, space + 1, False
        in_url = in_url or text.find("://", max(word, seen - 2), start) >= 0
        seen, done = start, end
        if end - start >= LEAST and not any(a < end and start < b for a, _, b in taken):
            yield start, end, features(text, start, end, in_url)


def features(text: str, start: int, end: int, in_url: bool) -> int:
    run, before = text[start:end], text[max(0, start - 48) : start]
    word, sign, quote = BEFORE.search(before).groups()
    counts = Counter(run)
    entropy = -sum(n / len(run) * math.log2(n / len(run)) for n in counts.values())
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(run, run[1:]))
    values = {
        "hex": HEX.fullmatch(run) is not None,
        "lower": any("a" <= c <= "z" for c in run),
        "upper": any("A" <= c <= "Z" for c in run),
        "mixed": changes >= 3,
        "number": run.isdigit(),
        "long": len(run) >= 16,
        "very_long": len(run) >= 32,
        "credential": word.lower().strip("_-") in CREDENTIALS,
        "assigned": sign is not None,
        "quoted": bool(quote) and text[end : end + 1] == quote,
        "varied": entropy >= 3,
        "uniform": entropy < 2.2,
        "url": in_url or run.count("/") > 1,
        "joined": any(c in run for c in "/_-"),
    }
    return sum(1 << i for i, name in enumerate(FEATURES) if values[name])


def matrix(patterns: np.ndarray) -> np.ndarray:
    return ((patterns[:, None] >> np.arange(len(FEATURES))) & 1).astype(float)


def votes(patterns: np.ndarray) -> np.ndarray:
    """The labelers' votes (1, -1, 0: none) on each pattern."""
    has = {name: column > 0 for name, column in zip(FEATURES, matrix(patterns).T)}
    out = np.zeros((len(patterns), len(LABELERS)))
    for k, (need, never, vote) in enumerate(LABELERS):
        fits = np.ones(len(patterns), bool)
        for name in need:
            fits &= has[name]
        for name in never:
            fits &= ~has[name]
        out[fits, k] = vote
    return out


def reliabilities(vote: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """How often each labeler is right, and each pattern's probability of being a secret, by EM."""
    right, prior = np.full(vote.shape[1], 0.8), 0.5
    for _ in range(rounds):
        weight = np.log(right / (1 - right))
        chance = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + vote @ weight)))
        agree = np.where(vote > 0, chance[:, None], np.where(vote < 0, 1 - chance[:, None], 0)) * counts[:, None]
        cast = (vote != 0) * counts[:, None]
        # Two votes' worth of belief that labelers are better than chance keeps the classes from swapping.
        now = np.clip((agree.sum(axis=0) + 1.6) / (cast.sum(axis=0) + 2), 0.5, 0.99)
        prior = float(np.clip((chance * counts).sum() / counts.sum(), 0.01, 0.99))
        if np.abs(now - right).max() < 1e-9:
            break
        right = now
    return right, chance


def train(patterns: np.ndarray, counts: np.ndarray, chance: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (bias last) of the logistic classifier, by Newton's method on the patterns weighted by their shares: the penalty weighs as much
    against few candidates as against many."""
    x = np.hstack([matrix(patterns), np.ones((len(patterns), 1))])
    w = np.zeros(x.shape[1])
    share = counts / counts.sum() * 1e4
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - chance)) + penalty * w
        step = np.linalg.solve(x.T @ (x * (share * p * (1 - p))[:, None]) + penalty * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_secrets(docs: DataFrame) -> np.ndarray | None:
    """Weights of the classifier, fitted on the candidates of all documents; None without candidates."""

    def find(batches):
        for batch in batches:
            found = Counter(f for text in batch.column(0).to_pylist() if text for _, _, f in candidates(text, base_spans(text)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["pattern", "n"])

    rows = docs.select("text").mapInArrow(find, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    if not rows:
        return None
    patterns, counts = np.array([r.pattern for r in rows]), np.array([r.n for r in rows], float)
    _, chance = reliabilities(votes(patterns), counts)
    return train(patterns, counts, chance)


def personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: kind, start and end of all personal data, by start, then kind in the order of ``KINDS``."""
    docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() != "spans"])
    weights = fit_secrets(docs)
    at = [c.lower() for c in docs.columns].index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", T._parse_datatype_string(SPAN_TYPE))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def secret(pattern: int) -> bool:
        return weights is not None and float(np.append(matrix(np.array([pattern]))[0], 1.0) @ weights) > 0

    def find(batches):
        known: dict[int, bool] = {}
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                spans = base_spans(text or "")
                for start, end, pattern in candidates(text or "", spans):
                    if pattern not in known:
                        known[pattern] = secret(pattern)
                    if known[pattern]:
                        spans = [*spans, (start, 4, end)]
                out.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)])
            yield batch.append_column("spans", pa.array(out, kind))

    return docs.mapInArrow(find, schema)

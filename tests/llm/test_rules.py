import hashlib
import itertools
import re

import numpy as np
import pytest

from mastermill.llm import decontaminate as D
from mastermill.llm import quality as Q
from mastermill.llm.decontaminate import Matcher, benchmark_matches, normal
from mastermill.llm.personal_data import BASE_KINDS, FEATURES, base_spans, candidates, fit_secrets, luhn, personal_data, reliabilities, train, votes
from mastermill.llm.quality import NGrams, base_metrics, fit_quality, rate_quality, repeated_words
from mastermill.llm.url_rules import judge_urls, mine_rules, url_parts, url_tokens
from tests.llm.conftest import SCHEMA


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_base_metrics(texts):
    for text in [*texts, "a # b\n\x0bc d\nc d\nc d\n \n \n", "é$ \x1c ü"]:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)))
        assert base_metrics((text or "").encode())[:4] == want
        if len(words) < 400:
            assert repeated_words([w.encode() for w in words]) == brute_repeats(words)


def test_ngram_buckets_do_not_depend_on_the_batch(texts, monkeypatch):
    data = [(t or "").encode() for t in texts]

    def counts(grams, items):
        out = [dict() for _ in items]
        for bucket, row in grams.buckets(items):
            for b, r in zip(bucket.tolist(), row.tolist()):
                out[r][b] = out[r].get(b, 0) + 1
        return out

    assert counts(NGrams(), data) == [counts(NGrams(), [x])[0] for x in data]
    assert counts(NGrams(), [b"a b,c"])[0] != counts(NGrams(), [b"a c,b"])[0]
    monkeypatch.setattr(Q, "SEGMENT", 100)
    assert sum(counts(NGrams(), [b"ab cd " * 100])[0].values()) > 200


def quality_tables(spark):
    good = [(i, f"the garden number {i} has roses and tulips in it " * 7 + f"unlike {i}") for i in range(60)]
    bad = [(100 + i, f"BUY {i} NOW!! $$$ click%%% win### " * 12 + f"offer {i}") for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in good + bad] + [(200, None, None, None, None), (201, "", "en", "s", 0)], SCHEMA)
    labels = [(i, 1, 0) for i in range(0, 60, 2)] + [(100 + i, 0, 0) for i in range(0, 30, 2)] + [(None, 1, 0), (1, None, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_separates_held_out_documents(spark):
    docs, labels = quality_tables(spark)
    model = fit_quality(docs, labels, prior=1.0)
    scores = {r.doc_id: r.quality.score for r in rate_quality(docs, model).collect()}
    assert min(scores[i] for i in range(60)) > max(scores[100 + i] for i in range(30))
    assert max(scores[100 + i] for i in range(0, 30, 2)) < model.threshold <= min(scores[i] for i in range(0, 60, 2))


def test_quality_odd_rows(spark, empty):
    docs, labels = quality_tables(spark)
    model = fit_quality(docs, labels.limit(0))
    assert model.threshold == -np.inf
    rated = rate_quality(docs.withColumnRenamed("lang", "QUALITY"), model)
    assert rated.columns == ["doc_id", "text", "source", "n_chars", "quality"]
    assert {r.doc_id: r.quality.kept for r in rated.collect() if r.doc_id >= 200} == {200: False, 201: False}
    assert rate_quality(empty, fit_quality(empty, labels)).count() == 0


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_matches_against_edit_distance(spark, monkeypatch):
    r = np.random.default_rng(4)
    items = ["".join(r.choice(list("abcde fgh"), 60)) for _ in range(6)]
    texts = []
    for item in items * 4:
        chars = list(normal(item))
        for _ in range(int(r.integers(0, 8))):
            at = int(r.integers(0, len(chars)))
            chars[at : at + int(r.integers(0, 2))] = list(r.choice(["z", "", "q "]))
        texts.append("".join(r.choice(list("abcdefgh "), 80)) + "".join(chars).upper() + "".join(r.choice(list("abcdefgh "), 50)))
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate([*texts, None, ""])], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*enumerate(items), (90, items[0]), (91, None), (92, "short"), (None, items[1])], "item_id long, text string")
    want = {}
    for d, t in enumerate(texts):
        for i, item in [*enumerate(items), (90, items[0])]:
            n = normal(item)
            best = edit_distance(n, normal(t))
            if len(n) >= 40 and best <= int(0.06 * len(n)):
                want[d, i] = best
    for size in (4 << 20, 100):
        monkeypatch.setattr(D, "BLOCK_BYTES", size)
        got = {(x.doc_id, x.item_id): x.distance for x in benchmark_matches(docs, bench).collect()}
        assert got == want and len(want) > 5
        clean = {x.doc_id for x in D.decontaminate(docs, bench).collect()}
        assert clean == set(range(len(texts) + 2)) - {d for d, _ in want}
    assert benchmark_matches(docs.limit(0), bench).count() == 0 and benchmark_matches(docs, bench.limit(0)).count() == 0
    assert Matcher([], 0.1).matches("x") == {}


def test_base_spans():
    text = "a.b+c@x.y-z.com 1.2.3.4 999.1.1.1 4111 1111 1111 1111 4111 1111 1111 1112 +1 (555) 123-4567 +12 1.2.3.4.5"
    kinds = [(BASE_KINDS[k], text[a:b]) for a, k, b in base_spans(text)]
    assert kinds == [("email", "a.b+c@x.y-z.com"), ("ip", "1.2.3.4"), ("phone", "+1 (555) 123-4567"), ("ip", "1.2.3.4")]
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    card = "é card 4111 1111-1111 1111, no"
    assert base_spans(card) == [(7, 2, 26)]


def test_secrets_are_added_and_base_spans_stay(spark, empty):
    r = np.random.default_rng(1)
    key = lambda n: "".join(r.choice(list("0123456789abcdef"), n))
    rows = [(i, f'mail me@x.org token = "{key(40)}" then password={key(18)} and code {1000000000 + i} for room20122012 end', "x") for i in range(60)]
    df = spark.createDataFrame([*rows, (900, None, None), (901, "nothing here", None)], "doc_id long, text string, spans string")
    got = {x.doc_id: (x.text, [(s.kind, x.text[s.start : s.end]) for s in x.spans]) for x in personal_data(df).collect() if x.text}
    for i, text, _ in rows:
        assert [k for k, _ in got[i][1]] == ["email", "secret", "secret"] and got[i][1][0][1] == "me@x.org"
    assert got[901][1] == [] and fit_secrets(empty) is None and personal_data(empty).count() == 0


def test_em_ranks_labelers():
    found = [f for _, _, f in candidates('token = "0123456789abcdef0123" or 1234567890', [])]
    v = votes(np.array(found))
    right, chance = reliabilities(np.repeat(v, [50, 50], axis=0), np.ones(100))
    assert chance[0] > 0.9 > 0.1 > chance[-1] and (right >= 0.5).all() and hashlib


def test_urls(spark):
    urls = ["https://A.Example.NET/en/1", "http://x.net/a?b=c#d", "http://net", "https://example.com/de/", "http://xorg/fr/", "http://a.org/fr/x", "nope", None, "://h?q", "a://b://c/d", "http://spam.test/buy/1", "http://ok.test/read/1"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id long, url string, host int")
    train = [(1000 + i, f"http://{'spam' if i % 2 else 'ok'}.test/{'buy' if i % 4 == 1 else 'read'}/{i}") for i in range(80)]
    labels = spark.createDataFrame([(1000 + i, int(not i % 2), 0) for i in range(80)] + [(None, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    trained = spark.createDataFrame(train, "page_id long, url string")
    rules = mine_rules(trained, labels)
    # Every page of host spam is bad, so combinations that hold it say nothing more.
    assert {tuple(r.tokens) for r in rules.collect()} == {("host:spam",), ("path:buy",)}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"),
        1: ("x.net", "/a", "net/", "block"),
        2: ("net", "", None, "allow"),
        3: ("example.com", "/de/", "example.com/de/", "block"),
        4: ("xorg", "/fr/", None, "allow"),
        5: ("a.org", "/fr/x", "org/fr/", "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("h", "", None, "allow"),
        9: ("b:", "//c/d", None, "allow"),
        10: ("spam.test", "/buy/1", None, "block"),
        11: ("ok.test", "/read/1", None, "allow"),
    }
    assert mine_rules(trained, labels.limit(0)).count() == 0 and judge_urls(pages.limit(0), rules).count() == 0


def test_url_rules_and_verdicts_against_brute_force(spark):
    """All token sets of all labelled pages, counted; a planted pattern besides."""
    sf = "/root/testdata/sf0.001"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    planted = spark.range(5000, 5040).selectExpr("id AS page_id", "concat('http://shop', id % 3, '.test/win/', id, '?ref=', id) AS url")
    pages = pages.unionByName(planted)
    labels = labels.unionByName(spark.range(5000, 5040).selectExpr("id AS doc_id", "if(id % 10 = 0, 1, 0) AS quality", "0 AS toxic"))
    tokens = {r.page_id: frozenset(r.tokens) for r in url_parts(pages).select("page_id", url_tokens().alias("tokens")).collect()}
    bad = {}
    for r in labels.collect():
        bad[r.doc_id] = bad.get(r.doc_id, False) or r.quality == 0 or r.toxic == 1
    counts = {}
    for page, found in tokens.items():
        if page in bad:
            for size in range(1, len(found) + 1):
                for part in itertools.combinations(sorted(found), size):
                    n, n_bad = counts.get(part, (0, 0))
                    counts[part] = (n + 1, n_bad + bad[page])
    for confidence, least in ((0.8, 5), (0.6, 3)):
        fit = {p for p, (n, b) in counts.items() if b >= least and b >= confidence * n}
        want = {p: counts[p][::-1] for p in fit if not any(set(q) < set(p) for q in fit)}
        rules = mine_rules(pages, labels, confidence=confidence, least_pages=least)
        assert {tuple(r.tokens): (r.n_bad, r.n_pages) for r in rules.collect()} == want and ("path:win",) in want
        for r in judge_urls(pages, rules, fixed=()).collect():
            assert r.rule is None and r.verdict == ("block" if any(set(m) <= tokens[r.page_id] for m in want) else "allow")


def test_short_items_and_excerpts_of_long_ones(spark):
    r = np.random.default_rng(8)
    words = ["".join(r.choice(list("abcdefghij"), 6)) for _ in range(200)]
    long = " ".join(words)
    items = [(1, "one two three four five"), (2, "Yes"), (3, long)]
    excerpt, altered = " ".join(words[60:130]), " ".join(w if i % 25 else w[:-1] + "z" for i, w in enumerate(words[60:130]))
    texts = {0: "so one TWO  three four five.", 1: "none two three four fives", 2: "yes", 3: "yes it is", 4: f"before {excerpt} after", 5: altered,
             6: " ".join(words[60:75]), 7: " ".join(reversed(words)), 8: long}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([*items, (4, ""), (5, None)], "item_id long, text string")
    found = {(x.doc_id, x.item_id): x.distance for x in benchmark_matches(docs, bench).collect()}
    assert set(found) == {(0, 1), (2, 2), (4, 3), (5, 3), (8, 3)} and found[4, 3] == found[8, 3] == 0 < found[5, 3]
    assert {x.doc_id for x in D.decontaminate(docs, bench).collect()} == {1, 3, 6, 7}
    assert len(D.windows("x" * 401)) == 5 and all(len(w) == 200 for w in D.windows("x" * 1001)[1:])


def test_a_benchmark_beyond_the_bound_is_an_error(spark, docs, monkeypatch):
    monkeypatch.setattr(D, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="beyond the 10"):
        benchmark_matches(docs, spark.createDataFrame([(1, "x" * 50)], "item_id long, text string"))


def test_a_url_is_seen_however_long_the_word_is():
    found = list(candidates("see http://h.test/" + "a." * 200 + "0123456789abcdef x 0123456789abcdef", []))
    urls = [bool(f >> FEATURES.index("url") & 1) for _, _, f in found]
    assert urls == [True, False]
    r = np.random.default_rng(2)
    for _ in range(300):
        text = "".join(r.choice(["://", " ", "ab", "12345678", "x9", "."], 12))
        for start, end, f in candidates(text, []):
            want = "://" in text[:start].split(" ")[-1] or text[start:end].count("/") > 1
            assert bool(f >> FEATURES.index("url") & 1) == want


def test_the_penalty_weighs_alike_at_every_size():
    found = np.array([f for _, _, f in candidates('token = "0123456789abcdef0123" or 1234567890 or key=abcdefgh12', [])])
    _, chance = reliabilities(votes(found), np.ones(len(found)))
    assert np.allclose(train(found, np.ones(len(found)), chance), train(found, np.full(len(found), 1e6), chance))


def brute_spans(text):
    """Base spans by trying every start, the longest match there."""
    out = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        at = 0
        while at < len(text):
            m = re.compile(pattern).match(text, at)
            if not m:
                at += 1
                continue
            digits = [c for c in m[0] if c in "0123456789"]
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            good = (
                True if kind == 0 else all(int(x) <= 255 for x in m[0].split(".")) if kind == 1
                else 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0 if kind == 2 else 9 <= len(digits) <= 15
            )
            if good:
                out.append((m.start(), kind, m.end()))
            at = m.end()
    return sorted(out)


def test_base_spans_against_a_scan(texts):
    r = np.random.default_rng(6)
    parts = ["a@b.c", "x.y@z", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "0000-0000-0000", "+1 (2) 3456-7890", "+", " ", "-", "é", "12", "\n"]
    for text in [t or "" for t in texts] + ["".join(r.choice(parts, 9)) for _ in range(300)]:
        if len(text) < 3000:
            assert base_spans(text) == brute_spans(text), text


def test_quality_scores_and_thresholds_against_counting(spark, texts):
    """Both scores from plain counts of words and pairs, and the thresholds by trying every cut."""
    docs, labels = quality_tables(spark)
    docs = docs.unionByName(spark.createDataFrame([(300 + i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA))
    docs = docs.unionByName(docs.limit(4))
    model = fit_quality(docs, labels, prior=1.0, worst_prior=1.0)
    rows = docs.select("doc_id", "text", Q.fold().alias("fold")).collect()
    trusted = {}
    for r in labels.collect():
        if None not in (r.doc_id, r.quality, r.toxic):
            trusted[r.doc_id] = trusted.get(r.doc_id, True) and r.quality == 1 and r.toxic == 0
    pattern = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x00-\x20\x7f]+")

    hasher, known = NGrams(), {}

    def bucket(gram):  # grams that fall into one bucket are counted as one
        if gram not in known:
            known[gram] = int(np.concatenate([b for b, _ in hasher.buckets([b" ".join(gram)])])[-1])
        return known[gram]

    def grams(text):
        words = pattern.findall((text or "").encode())
        return [bucket((w,)) for w in words] + [bucket(pair) for pair in zip(words, words[1:])]

    def tables(chosen, once):
        out = [{}, {}]
        for r in rows:
            if chosen(trusted.get(r.doc_id)):
                for g in set(grams(r.text)) if once else grams(r.text):
                    out[r.fold][g] = out[r.fold].get(g, 0) + 1
        return out

    def weight(raw, good, k, g, prior=1.0):
        a, b = raw[1 - k], good[1 - k]
        pairs = g >> Q.BITS
        n_raw, n_good = (sum(v for x, v in side.items() if x >> Q.BITS == pairs) for side in (a, b))
        if not a or not b:
            return 0.0
        return np.log((b.get(g, 0) + prior) / (a.get(g, 0) * n_good / max(1, n_raw) + prior))

    raw, good = tables(lambda t: True, False), tables(lambda t: t is True, False)
    once = [tables(c, True) for c in (lambda t: True, lambda t: t is True, lambda t: t is False)]
    got = {(r.doc_id, r.text): r.quality for r in rate_quality(docs, model).collect()}
    scores = {}
    for r in rows:
        found = grams(r.text)
        if len(found) > 800:
            continue
        score = sum(weight(raw, good, r.fold, g) for g in found) / max(1, len(found))
        low = sorted(max(weight(once[0], once[1], r.fold, g), weight(once[2], once[1], r.fold, g)) for g in set(found))
        worst = sum(x for x in low[:2] if x <= Q.FAINT) / 2
        mine = got[r.doc_id, r.text]
        assert abs(mine.score - score) < 1e-4 and abs(mine.worst - worst) < 1e-4, r.doc_id
        scores[r.doc_id, r.text] = mine
    for name, step, threshold in (("score", Q.SCORE_STEP, model.threshold), ("worst", Q.WORST_STEP, model.worst_threshold)):
        bins = [(int(np.floor(got[r.doc_id, r.text][name] / step)), trusted[r.doc_id]) for r in rows if r.doc_id in trusted]
        bad, clean = [b for b, t in bins if not t], [b for b, t in bins if t]
        gain = lambda cut: sum(b < cut for b in bad) / len(bad) - 10 * sum(b < cut for b in clean) / len(clean)  # noqa: B023, E731
        best = max((gain(c) for c in range(min(b for b, _ in bins), max(b for b, _ in bins) + 2)), default=0)
        cut = -np.inf if threshold == -np.inf else round(threshold / step)
        assert abs((0 if cut == -np.inf else gain(cut)) - max(0, best)) < 1e-9
    for r in rows:
        mine = got[r.doc_id, r.text]
        assert mine.kept == (not mine.base_failed and mine.score >= model.threshold and mine.worst >= model.worst_threshold)

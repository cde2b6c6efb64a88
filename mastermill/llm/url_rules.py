"""URL filters: fixed host and path rules first, then association rules mined by FP-growth; DataFrame functions only.

A URL becomes a set of tokens: labels of the host, segments of the path (numbers alike), keys of the query. Over the labelled pages
FP-growth finds the token combinations that come with the bad label on at least ``least_pages`` pages and in at least the share
``confidence`` of the pages that hold them. It runs on the bad pages alone; the pages of either label that hold a combination are then counted by an
inverted index over its rarest token. A combination whose part is a rule already adds nothing and is left out. Rules are found by an inverted index over their rarest token
and then compared whole. Equal token sets are judged once.

Defined results: a null url, or one without ``://``, has an empty host and path, no tokens and the verdict ``allow``. Labels with
null fields are not used; of several labels of a page the worst counts. Without labelled bad pages no rule is mined. Of fixed rules that fit,
the longest wins. Repeated pages are judged alike. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BAD = "label"  # tokens hold a colon, so none is equal
FIXED_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
PARTS = r"://([^/?#]*)([^?#]*)"


def url_parts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host`` (ASCII lower case) and ``path``."""
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, PARTS, 1), string.ascii_uppercase, string.ascii_lowercase)
    return pages.select("page_id", "url", host.alias("host"), F.regexp_extract(url, PARTS, 2).alias("path"))


def url_tokens() -> Column:
    """Sorted distinct tokens of ``url``, ``host`` and ``path``."""
    number = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    labelled = lambda kind, array: F.transform(F.filter(array, lambda x: x != ""), lambda x: F.concat(F.lit(kind), number(x)))
    query = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))
    tokens = F.concat(labelled("host:", F.split("host", r"\.")), labelled("path:", F.split("path", "/")), labelled("key:", keys))
    return F.array_sort(F.array_distinct(tokens))


def fixed_rule(rules: tuple) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of its name and verdict."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def mine_rules(pages: DataFrame, labels: DataFrame, confidence: float = 0.8, least_pages: int = 5) -> DataFrame:
    """``tokens`` and their rarest token ``key`` of each rule that marks a page as bad, with ``n_bad`` of the ``n_pages`` labelled pages it holds for."""
    spark = pages.sparkSession
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    marked = url_parts(pages).select("page_id", url_tokens().alias("tokens")).filter("size(tokens) > 0").join(known, "page_id")
    # Equal token sets are one row with the number of pages of each label.
    sets = stored(marked.groupBy("tokens").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")), "baskets")
    bad = marked.filter("bad").select(F.col("tokens").alias("items"))
    bad = stored(bad, "bad-baskets")
    n_bad = bad.count()
    if n_bad < least_pages:
        return spark.createDataFrame([], "tokens array<string>, key string, n_bad long, n_pages long")
    model = FPGrowth(itemsCol="items", minSupport=(least_pages - 0.5) / n_bad, minConfidence=1.0).fit(bad)
    frequent = stored(model.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n_bad")), "frequent")
    single = sets.select(F.explode("tokens").alias("token"), "n").groupBy("token").agg(F.sum("n").alias("freq"))
    by_token = frequent.select("tokens", "n_bad", F.explode("tokens").alias("token")).join(single, "token")
    keyed = by_token.groupBy("tokens", "n_bad").agg(F.min(F.struct("freq", "token"))["token"].alias("key"))
    held = sets.select(F.col("tokens").alias("page"), "n", F.explode("tokens").alias("token"))
    held = keyed.join(held, F.col("key") == F.col("token")).filter("size(array_except(tokens, page)) = 0")
    held = held.groupBy("tokens", "key", "n_bad").agg(F.sum("n").alias("n_pages"))
    mined = stored(held.filter(F.col("n_bad") >= confidence * F.col("n_pages")), "rules")
    # A rule within which another rule lies holds that rule's key.
    other = mined.select(F.col("tokens").alias("part"), F.col("key").alias("token"))
    wider = mined.select("tokens", F.explode("tokens").alias("token")).join(other, "token")
    wider = wider.filter("size(part) < size(tokens) and size(array_except(part, tokens)) = 0").select("tokens").distinct()
    return stored(mined.join(wider, "tokens", "left_anti").select("tokens", "key", "n_bad", "n_pages"), "pruned")


def judge_urls(pages: DataFrame, rules: DataFrame, fixed: tuple = FIXED_RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page."""
    parts = url_parts(pages).select("page_id", "host", "path", url_tokens().alias("tokens"), fixed_rule(fixed).alias("fixed"))
    sets = parts.filter("fixed is null and size(tokens) > 0").select("tokens").distinct()
    index = rules.select(F.col("tokens").alias("wanted"), F.col("key").alias("token"))
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token").filter("size(array_except(wanted, tokens)) = 0")
    hits = hits.select("tokens", F.lit(True).alias("hit")).distinct()
    verdict = F.coalesce("fixed.verdict", F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow")))
    return parts.join(hits, "tokens", "left").select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"))

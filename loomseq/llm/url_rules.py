"""URL filters: fixed host and path rules, and association rules mined by FP-growth.

The fixed rules label the URLs that they fit. FP-growth mines the frequent combinations of URL tokens and label over all
distinct labelled URLs; a combination that implies a label with enough support and confidence becomes a rule. A URL that no fixed rule
fits is judged by the mined rules whose tokens it all has: the most confident one decides, of equals one that blocks. Where
none fits, it is allowed.

Tokens that occur in exactly the same labelled URLs are one class: rules with any of them say the same, so FP-growth mines
classes, and a URL has a class where it has one of its tokens. Shared deep paths thus cost no more than one segment.

A rule is pruned where it says what a rule with one token less says with no less confidence: that one fits wherever it does,
so verdicts and confidences stay. The inverted index has each rule once, under the rarest of its tokens; its other tokens are
looked for in the URLs that meet it there, and a URL's rows are aggregated in the task that made them.

Everything is DataFrame and SQL functions. Null URLs, or such without ``://``, have an empty host and path and are allowed.
Repeated rows get repeated verdicts.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, dropped, written

#: Fixed rules: verdict, host, start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.02, 0.8
#: Rules in the inverted index (some hundreds of bytes each) that are sent to every executor.
MOST_ENTRIES = 100_000
LABEL = "label="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    rule = verdict = None
    for said, h, p in sorted(rules, key=lambda x: (-len(x[1] + x[2]), x)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = rule.when(fits, h + p) if rule is not None else F.when(fits, h + p)
        verdict = verdict.when(fits, said) if verdict is not None else F.when(fits, said)
    return rule, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens: domain suffixes, host labels, path segments with their depth; numbers by how many digits they have."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    digits = lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(x).cast("string"))).otherwise(x)
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
            F.transform(segments, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), digits(x))),
            F.when(F.size(labels) > 0, F.array(F.concat(F.lit("domain:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")))).otherwise(F.array().cast("array<string>")),
        )
    )


def token_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``(token, class)`` of the tokens with enough support: those of one class occur in exactly the same of the distinct labelled URLs.

    Tokens are grouped by their number of URLs and two hashes over these; then each group's URLs are counted, and one whose
    tokens don't have all of them falls apart into its tokens. Their number is bounded by the support, not by the input.
    """
    least = F.lit(max(1, math.ceil(min_support * labelled.count())))
    met = labelled.select("url", F.explode("tokens").alias("token"))
    often = met.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("url")).alias("x1"), F.bit_xor(F.xxhash64("url", F.lit(1))).alias("x2")).where(F.col("n") >= least)
    groups = often.groupBy("n", "x1", "x2").agg(F.min("token").alias("class"), F.count("*").alias("size"))
    found = written(often.join(groups, ["n", "x1", "x2"]).select("token", "class", "n", "size"), "token_groups")
    urls = met.join(found.where("size > 1"), "token").groupBy("class", "n").agg(F.count_distinct("url").alias("urls")).where("urls <> n").select("class", F.lit(True).alias("mixed"))
    return found.join(urls, "class", "left").select("token", F.when(F.col("mixed"), F.col("token")).otherwise(F.col("class")).alias("class"))


def in_classes(urls: DataFrame, classes: DataFrame) -> DataFrame:
    """``urls`` with the classes of their tokens as ``tokens``; tokens without one are in no rule. ``classes`` is a written table."""
    if classes.count() <= MOST_ENTRIES:
        classes = F.broadcast(classes)
    of = urls.select("url", F.explode("tokens").alias("token")).join(classes, "token").groupBy("url").agg(F.array_sort(F.collect_set("class")).alias("classes"))
    empty = F.array().cast("array<string>")
    return urls.join(of, "url", "left").select(*[F.coalesce("classes", empty).alias("tokens") if c == "tokens" else c for c in urls.columns])


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(rule_id, tokens, n_tokens, verdict, confidence)`` from distinct ``(url, tokens, verdict)``."""
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = model.freqItemsets
    # a rule is an itemset with a label, against the same set without it
    has = F.exists("items", lambda x: F.startswith(x, F.lit(LABEL)))
    sided = sets.select("items", "freq", has.alias("has"), F.array_sort(F.filter("items", lambda x: ~F.startswith(x, F.lit(LABEL)))).alias("tokens"))
    both = sided.where("has and size(tokens) > 0").select("tokens", F.expr(f"replace(filter(items, x -> startswith(x, '{LABEL}'))[0], '{LABEL}', '')").alias("verdict"), F.col("freq").alias("hits"))
    rules = both.join(sided.where("not has").select("tokens", "freq"), "tokens").select("tokens", F.size("tokens").alias("n_tokens"), "verdict", (F.col("hits") / F.col("freq")).alias("confidence")).where(F.col("confidence") >= min_confidence)
    return rules.select(F.xxhash64("tokens", "verdict").alias("rule_id"), "*")


def pruned(rules: DataFrame) -> DataFrame:
    """The rules that no rule with one token less makes needless."""
    shorter = rules.select(F.col("tokens").alias("part"), F.col("verdict").alias("says"), F.col("confidence").alias("as_sure"))
    parts = rules.select("rule_id", "verdict", "confidence", F.explode(F.transform("tokens", lambda x: F.array_except("tokens", F.array(x)))).alias("part"))
    needless = parts.join(shorter, "part").where("says = verdict and as_sure >= confidence").select("rule_id").distinct()
    return rules.join(needless, "rule_id", "left_anti")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, verdict, confidence)`` of distinct ``(url, tokens)`` that some mined rule fits."""
    met = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    often = met.groupBy("token").agg(F.count("*").alias("n"))
    # no URL fits a rule with a token that no URL has
    rarest = rules.select("rule_id", F.explode("tokens").alias("token")).join(often, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("least"), F.count("*").alias("known"))
    # one integer, so that the aggregation by URL keeps a hash map: confidence, then whether it blocks
    code = F.round(F.col("confidence") * 10**15).cast("long") * 2 + (F.col("verdict") == "block").cast("long")
    index = rules.join(rarest, "rule_id").where("known = n_tokens").select(F.col("least.token").alias("token"), F.col("tokens").alias("rule_tokens"), code.alias("code"))
    index = written(index, "url_rule_index")
    if index.count() <= MOST_ENTRIES:
        index = F.broadcast(index)
    fits = (met["token"] == index["token"]) & (F.size(F.array_except("rule_tokens", "tokens")) == 0)
    best = met.join(index, fits).groupBy("url").agg(F.max("code").alias("code"))
    return best.select("url", F.when(F.col("code") % 2 == 1, "block").otherwise("allow").alias("verdict"), (F.floor(F.col("code") / 2) / 10**15).alias("confidence"))


def judged(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence)``; the confidence is that of a mined rule."""
    host, path = split_url(F.col("url"))
    rows = documents(pages, "page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "fixed": verdict})
    distinct = rows.where("host <> '' or path rlike '[^/]'").groupBy("url").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.first("fixed").alias("fixed"))
    distinct = written(distinct.select("url", tokens_of(F.col("host"), F.col("path")).alias("tokens"), "fixed"), "urls")
    labelled = distinct.where("fixed is not null").select("url", "tokens", F.col("fixed").alias("verdict"))
    if labelled.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("fixed", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    classes = written(token_classes(labelled), "token_classes")
    rules = written(mine(in_classes(labelled, classes)), "url_rules")
    mined = written(match(in_classes(distinct.where("fixed is null").select("url", "tokens"), classes), pruned(rules)).withColumnRenamed("verdict", "mined"), "mined_verdicts")
    dropped(rules, distinct, classes)
    return rows.join(mined, "url", "left").select("page_id", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit("allow")).alias("verdict"), "confidence")

"""Quality rules as a short-circuit cascade of SQL expressions.

A rule is a SQL condition over the text and its counts. The verdict is a chain of rules, each asked only of texts that all
rules before it let pass: the branches of one CASE, so what a later rule computes of a text that is rejected is never
computed. Cost and selectivity are estimated on a sample, drawn by hash over all rows: a rule's cost is the time of a pass
that asks it less that of a pass that asks nothing, and what it rejects is counted together with what the others reject. The
order is greedy: the next rule is always the one with most rejections, among what the rules before it leave, per cost. The
order changes the time, never the verdict.

Texts that fail the base test aren't asked at all. Null or empty text: no words, so the base test rejects it. Repeated rows
give repeated results. An empty table has no sample; its order is that of ``RULES``.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

#: Rows of the sample, on average, and how often each of its passes is timed (the shortest counts).
SAMPLE_ROWS, TIMES = 4000, 2
SPACE = r"[\x20\x09-\x0D]+"
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"

#: Rules of the method: name and the SQL of a rejection, over ``text`` and the statistics.
RULES = {
    "symbols_per_word": "n_symbols > 0.2 * n_words",
    "long_words": "word_chars > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "duplicate_lines": "n_dup_lines >= 3 and 2 * n_dup_lines > size(split(text, '\\n'))",
    "capitals": "2 * length(regexp_replace(text, '[^A-Z]+', '')) > word_chars",
    "letters": "2 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < word_chars",
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, where a lambda would compute a plain column again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, parts: tuple[str, ...] | str) -> Column:
    for x in parts:
        text = F.replace(text, F.lit(x))
    return text


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, SPACES)) > 0)
    return let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words that lie in a window of ``width`` words which the text has more than once.

    A window is a 64-bit hash of its words' hashes. Where all windows differ, which a hash set tells, there are none. Else windows
    are sorted with a second hash and their places; a window equal to a neighbour in that order is repeated. The union of
    repeated windows then has, at each of them in order of place, as many new words as the next lies further on, ``width`` at most.
    """
    starts = lambda w: F.sequence(F.lit(1), F.size(w) - width + 1)
    hashes = lambda w, f: F.transform(starts(w), lambda i: f(*[F.get(w, i + (k - 1)) for k in range(width)]))
    windows = lambda w, h: F.zip_with(h, F.zip_with(hashes(w, F.hash), starts(w), lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda x, y: F.struct(x.alias("h"), y["g"].alias("g"), y["i"].alias("i")))
    same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False))
    # each window with its successor in sorted order; both ends of an equal pair are repeated
    linked = lambda v: F.zip_with(v, F.slice(v, F.lit(2), F.greatest(F.size(v), F.lit(1))), lambda a, b: F.when(same(a, b), F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    places = lambda v: F.sort_array(F.array_distinct(F.flatten(linked(v))))
    gaps = lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
    covered = lambda w, h: let(F.sort_array(windows(w, h)), lambda v: let(places(v), lambda p: F.aggregate(gaps(p), F.lit(0), lambda x, y: x + y)))
    total = lambda w: let(hashes(w, F.xxhash64), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(w, h)))
    return F.when(F.size(words) <= width, F.lit(0)).otherwise(let(F.transform(words, lambda x: F.xxhash64(x)), total)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and the counts of every whole text."""
    text = F.col("text")
    rows = documents(docs, "doc_id", "text").select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    spaced = without(text, SPACES)
    return rows.select(
        "doc_id",
        "text",
        let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("counts"),
        F.length(spaced).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
    ).select("doc_id", "text", F.col("counts.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("counts.r").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def order_rules(docs: DataFrame, rules: dict[str, str] = RULES, rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules, in the order in which ``cascade`` should ask them of ``docs (doc_id, text)``."""
    parts = max(1, docs.count() // rows)
    # what the base test rejects is never asked
    sample = statistics(docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(parts)) == 0)).where(~base_failed()).persist()
    try:
        if not sample.count():
            return list(rules)

        def took(column: Column) -> float:
            best = float("inf")
            for _ in range(TIMES):
                began = time.perf_counter()
                sample.agg(F.count_if(column)).first()
                best = min(best, time.perf_counter() - began)
            return best

        nothing = took(F.length("text") < 0)
        cost = {name: max(took(F.expr(rule)) - nothing, 1e-4) for name, rule in rules.items()}
        names = list(rules)
        mask = sum((F.coalesce(F.expr(rules[x]), F.lit(False)).cast("long") * (1 << i) for i, x in enumerate(names)), F.lit(0).cast("long"))
        # no more rows than combinations of rules that occur
        left = {r.mask: r.n for r in sample.groupBy(mask.alias("mask")).agg(F.count("*").alias("n")).collect()}
        order: list[str] = []
        while len(order) < len(names):
            hits = {x: sum(n for m, n in left.items() if m >> names.index(x) & 1) for x in names if x not in order}
            order.append(min(hits, key=lambda x: (-(hits[x] / cost[x]), cost[x], x)))
            left = {m: n for m, n in left.items() if not m >> names.index(order[-1]) & 1}
        return order
    finally:
        sample.unpersist()


def cascade(stats: DataFrame, order: list[str], rules: dict[str, str] = RULES) -> DataFrame:
    """``stats`` with ``base_failed``, ``rejected_by`` (the first rule that rejects, in ``order``) and ``kept``."""
    chain = F.when(base_failed(), F.lit("base"))
    for name in order:
        chain = chain.when(F.expr(rules[name]), F.lit(name))
    out = stats.withColumns({"base_failed": base_failed(), "rejected_by": chain})
    return out.withColumn("kept", F.col("rejected_by").isNull())


def judged(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    docs = documents(docs, "doc_id", "text")
    return cascade(statistics(docs), order_rules(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

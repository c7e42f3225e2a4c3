"""Queries of this subpackage, each over its whole table, and the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, cascade, exact_dedup, ftrl, html_wrappers, minhash, packing, repair_codec, secrets, shards, survival, url_rules, whitening
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: base spans and those of learnt formats. Null texts are empty; repeated rows are scanned one by one; no documents: no rows."""
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op2_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Null pages, and pages without an article or body, have an empty text; repeated pages count once in a host's wrapper."""
    return html_wrappers.extracted(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes that they stand for. Null texts are empty; texts of any length are encoded in parts of bounded size."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every URL. Null URLs and such without ``://`` have empty ones and are allowed; repeated URLs get one verdict."""
    return url_rules.judged(table(spark, sf_dir, "pages"))


def op5_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text as read back from compressed shards, in the order of ``doc_id``. Null texts have only the end id; repeated keys are ordered by their texts."""
    return repair_codec.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text's ids with their sequences. Null texts have only the end id; repeated rows are packed one by one."""
    return packing.packed_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by shingles of two words. Null texts and such without words are alone; rows that repeat a key are nodes of their own."""
    return minhash.groups(table(spark, sf_dir, "documents"), k=2)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays. Null counts as empty; rows that repeat a key count one by one, and equal rows stay or go together."""
    return exact_dedup.grouped(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text. Null and empty texts have the score of the bias; repeated rows get equal scores."""
    return ftrl.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base columns and verdict of every whole text. Null texts have no words and fail the base; repeated rows get equal verdicts."""
    return cascade.judged(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors of every order of five filters, by part; null texts are empty, null sources the part ``''``."""
    return survival.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable vector; null vectors and such with null or non-finite entries are dropped."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law ``rows``; null texts count as none, repeated rows have slots of their own."""
    return shards.placed(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_html_wrappers, op3_byte_bpe, op4_url_rules, op5_repair_ids, op6_power_packing, op7_minhash_dedup, op8_exact_dedup, op9_quality_classifier, op10_quality_rules,
    op11_filter_audit, op12_embedding_whitening, op13_feistel_shards,
)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: DuckDB SQL of whole results. The other operators are beyond it: learnt automata, wrappers and weights, tokenizers, mined rules.
SQL: dict[str, str] = {
    "op7_minhash_dedup": f"""WITH RECURSIVE d AS (SELECT doc_id, {_LOWER} AS t FROM documents), w AS (SELECT doc_id, {_WORDS} AS ws FROM d),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: concat(ws[i], ' ', ws[i + 1])) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT id, y FROM reach JOIN e ON r = x)
        SELECT id AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, id = min(r) AS kept FROM reach LEFT JOIN n ON n.doc_id = id GROUP BY id""",
    "op8_exact_dedup": f"SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM (SELECT doc_id, {_LOWER} AS t FROM documents) WINDOW w AS (PARTITION BY t)",
    "op10_quality_rules": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, {_WORDS} AS ws, string_split(t, chr(10)) AS ls FROM d),
        win AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
        twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
        r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, 5) k(k) GROUP BY 1),
        c AS (SELECT doc_id, t, len(ws) AS n_words, cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS bigint) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
          list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, len(ls) AS all_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
        b AS (SELECT *, cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
          NOT (base_failed OR 5 * n_symbols > n_words OR word_chars > 30 * n_words OR word_chars < 2 * n_words OR (n_dup_lines >= 3 AND 2 * n_dup_lines > all_lines)
            OR 2 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > word_chars OR 2 * length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) < word_chars) AS kept FROM b""",
    "op11_filter_audit": rf"""WITH g AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
        d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents), w AS (SELECT *, {_WORDS} AS ws FROM d),
        f AS (SELECT w.doc_id, part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS f FROM w LEFT JOIN g ON g.doc_id = w.doc_id),
        l AS (SELECT unnest(range(1, 6)) AS i), p AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a JOIN l b ON b.i <> a.i JOIN l c ON c.i NOT IN (a.i, b.i) JOIN l d ON d.i NOT IN (a.i, b.i, c.i) JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
        k AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (bad) AS x FROM f GROUP BY 1, 2),
        s AS (SELECT part, f, n, g, x, array_to_string(list_transform(o, lambda i: chr(cast(64 + i AS int))), '') AS filter_order, step, o[step] AS own, list_bool_or(list_transform(o[1 : step - 1], lambda i: f[i])) IS TRUE AS gone FROM k, p, (SELECT unnest(range(1, 6)) AS step)),
        r AS (SELECT part, filter_order, cast(step AS int) AS step, any_value(own) AS own, cast(coalesce(sum(n) FILTER (NOT gone AND NOT f[own]), 0) AS bigint) AS kept, cast(coalesce(sum(n) FILTER (NOT gone AND f[own]), 0) AS bigint) AS removed, cast(coalesce(sum(n) FILTER (gone AND f[own]), 0) AS bigint) AS redundant,
          cast(coalesce(sum(n) FILTER (f[own] AND list_sum(list_transform(f, lambda b: b::int)) = 1), 0) AS bigint) AS unique_fails, cast(coalesce(sum(g) FILTER (NOT gone AND f[own]), 0) AS bigint) AS good_lost, cast(coalesce(sum(x) FILTER (NOT gone AND f[own]), 0) AS bigint) AS toxic_lost FROM s GROUP BY part, filter_order, step)
        SELECT * EXCLUDE (own), cast(sum(removed) OVER (PARTITION BY part, own) AS bigint) AS shapley FROM r""",
}

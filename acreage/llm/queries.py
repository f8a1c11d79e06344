"""Registered queries of the operators, each beside the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm import bpe, html, lexical, lines, packing, pii, pitman_yor, quality, simhash, tokenfiles, topk, warc, whitening
from acreage.llm.common import read, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


# The same rule table in SQL: the words of a text are unnested and counted in windows.
QUALITY_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT row_number() OVER () AS rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
p AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM u WHERE len(w) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM p),
k AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c >= 2) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(w, lambda x: list_contains(['{stop}'], x))) AS n_stop, len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullet,
             len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) AS n_open FROM u LEFT JOIN k USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND n_symbols <= 0.25 * n_words
       AND n_stop >= 0.01 * n_words AND n_dup_lines <= 0.6 * n_lines AND n_bullet <= 0.9 * n_lines AND n_open <= 0.5 * n_lines AS kept
FROM v""".replace("{stop}", "', '".join(quality.STOP_WORDS))


@query("op10_quality_rules", QUALITY_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    d = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    d = simhash.duplicates(stored(simhash.fingerprints(docs), "prints"))
    return d.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.digest(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place in a sequence for every piece of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path
    return packing.pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


# Exact distinct counts of sites, in one statement; {docs} gives doc_id, text and source.
LINES_SQL = """l AS (SELECT rid, doc_id, source, i, t[i] AS line, regexp_replace(t[i], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS k
      FROM (SELECT rid, doc_id, source, t, unnest(range(1, len(t) + 1)) AS i FROM (SELECT row_number() OVER () AS rid, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS t FROM {docs}))),
b AS (SELECT k, min((doc_id, i)) AS first FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {sites}),
m AS (SELECT l.*, b.k IS NOT NULL AND (doc_id, i) <> first AS gone FROM l LEFT JOIN b USING (k)),
kept AS (SELECT rid, doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed
         FROM m GROUP BY rid, doc_id)"""


@query("op2_line_dedup", "WITH " + LINES_SQL.format(docs="documents", sites=lines.MIN_SITES) + " SELECT doc_id, n_lines, n_removed, sha256(text) AS text_sha256 FROM kept")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many sites share."""
    d = lines.without_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return d.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(f"substr('{_ALPHABET}', 1 + CAST((CAST('0x' || substr(sha, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31 AS BIGINT), 1)" for g in range(8) for s in (15, 10, 5, 0))

WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS sha FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY sha, n) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


@query("op5_warc", WARC_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, normalised, and read back."""
    archives, folder = warc.archive(spark, read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    d = warc.read_archives(archives, folder)
    return d.select(F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


TOP_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score FROM v q JOIN v d ON q.rid <> d.rid WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@query("op8_top_k", TOP_SQL)
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for each query row."""
    return topk.top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op7_html_text")
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op9_lm_score")
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of those that are not held out."""
    return pitman_yor.score_corpus(read(spark, sf_dir, "documents").select("doc_id", "text"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
a AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
i AS (SELECT q, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark WHERE text IS NOT NULL)),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY r, t),
g AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, a GROUP BY t, nn),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
      FROM i JOIN p USING (t) JOIN g USING (t) JOIN n USING (r) CROSS JOIN a GROUP BY q, item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM o WHERE rank <= 20"""


@query("op11_lexical_search", LEXICAL_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for each benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in its first four whitened components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, read back from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return tokenfiles.round_trip(docs, lambda: packing.encoder(*paths), packing.vocabulary(paths[0]))

"""The corpus operators as registered queries: whole tables, production parameters, full results."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import embedding_dedup, html_text, importance, line_dedup, packing, quality, sharding, simhash, spelling, substring_dedup, suffix_arrays, token_store, wfst


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; TESSELLA_TOKENIZERS names another folder."""
    if folder := os.environ.get("TESSELLA_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_tokens(manifest)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.col("text").alias("kept_text")
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("spans")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.write_shards(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_wfst, op2_token_store, op3_embedding_dedup, op4_line_dedup, op5_quality_rules,
        op6_substring_dedup, op7_best_fit_packing, op8_simhash_dedup, op9_sharding, op10_html_extraction, op11_spelling_variants, op12_importance_resampling,
        op13_benchmark_decontamination,
    )
}

_OP3 = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(v, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT links.a, reach.r FROM reach JOIN links ON links.b = reach.v
), roots AS (SELECT v, min(r) AS r FROM reach GROUP BY v)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, roots.r AS component_id, e.vec_id = roots.r AS kept
FROM embeddings e JOIN roots ON roots.v = e.vec_id
"""

_OP4 = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(l[i : i + 2], chr(10)) AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS p FROM later),
lost AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines, coalesce(lost.n, 0) AS n_removed,
  CASE WHEN lost.n IS NULL THEN d.text
       ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(d.l) + 1), lambda p: NOT list_contains(lost.ps, p)), lambda p: d.l[p]), chr(10)), '') END AS kept_text
FROM lines d LEFT JOIN lost USING (doc_id)
"""

_OP6 = r"""
WITH docs AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)
),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
later AS (SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE doc_id > first_id),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(docs.w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: CRC-32 of a text's UTF-8 bytes by a table, as SQL: ``tbl`` has the table, and ``_crc`` the value of an expression beside it.
_TBL = """tbl AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY i) AS t FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
)"""


def _crc(hexed: str) -> str:
    digit = lambda k: f"(strpos('0123456789ABCDEF', substr({hexed}, i + {k}, 1)) - 1)"
    octets = f"list_transform(range(1, length({hexed}), 2), lambda i: CAST({digit(0)} * 16 + {digit(1)} AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, o: xor(c >> 8, t[CAST((xor(c, o) & 255) + 1 AS INTEGER)])), 4294967295)"


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP11 = rf"""
WITH RECURSIVE {_TBL}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), {_LOWER}) AS r FROM documents
), long AS (SELECT r, hex(encode(doc_id || ':' || r)) AS x FROM runs WHERE length(r) >= 7),
summed AS (SELECT r, {_crc("x")} AS h FROM long, tbl),
words AS (
  SELECT w AS word, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS INTEGER)) || substr(r, CAST(h % length(r) AS INTEGER) + 2) ELSE r END AS w FROM summed)
  WHERE length(w) >= 7 GROUP BY w HAVING count(*) >= 2
), less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
links AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON less.d = words.word
  UNION SELECT words.word, less.word FROM less JOIN words ON less.d = words.word
), near AS (SELECT a.word, a.n, b.word AS v, b.n AS vn FROM links JOIN words a ON a.word = links.a JOIN words b ON b.word = links.b),
formed AS (
  SELECT word, count(*) AS n_near, first(v ORDER BY vn DESC, encode(v)) FILTER (vn >= 10 * n) AS form, max(vn) FILTER (vn >= 10 * n) AS form_n FROM near GROUP BY word
), chain(word, last, step) AS (
  SELECT word, word, 0 FROM words UNION ALL SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.last WHERE formed.form IS NOT NULL
), ends AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word)
SELECT words.word, formed.form, ends.root, words.n, coalesce(formed.n_near, 0) AS n_near, formed.form_n
FROM words JOIN ends USING (word) LEFT JOIN formed USING (word)
"""

_OP12 = rf"""
WITH {_TBL}, both_sides AS (SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark),
split AS (
  SELECT row_number() OVER () AS k, side, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM both_sides
), features AS (SELECT k, side, unnest(ws) AS w FROM split),
hexed AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM features)),
bucketed AS (SELECT w, {_crc("x")} % 10000 AS b FROM hexed, tbl),
counts AS (SELECT b, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM features JOIN bucketed USING (w) GROUP BY b),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gains AS (
  SELECT b, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counts, sums
), totals AS (SELECT k, count(*) AS n, sum(gain) AS g FROM features JOIN bucketed USING (w) JOIN gains USING (b) WHERE side = 's' GROUP BY k),
weighed AS (
  SELECT split.k, doc_id, coalesce(totals.n, 0) AS n_features,
    CASE WHEN totals.n IS NULL THEN 0 ELSE CAST((g - ((g % totals.n) + totals.n) % totals.n) // totals.n AS BIGINT) END AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM split LEFT JOIN totals USING (k) WHERE side = 's'
), scored AS (SELECT k, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM weighed),
placed AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (10 * fit) // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (k)
"""

_OP13 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT k, i, size, array_to_string(ws[i : i + size - 1], ' ') AS w
  FROM (SELECT k, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM docs, sizes WHERE len(ws) >= size)
), met AS (SELECT k, i, spots.size, item_id FROM spots JOIN windows ON spots.w = windows.w AND spots.size = windows.size),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, i + unnest(range(0, size)) AS p FROM (SELECT DISTINCT k, i, size FROM met)) GROUP BY k),
named AS (SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (k) LEFT JOIN named USING (k)
"""

ORACLE_SQL: dict[str, str] = {"op3_embedding_dedup": _OP3, "op4_line_dedup": _OP4, "op6_substring_dedup": _OP6, "op11_spelling_variants": _OP11, "op12_importance_resampling": _OP12, "op13_benchmark_decontamination": _OP13}

"""One query for each operator over the synthetic tables, and the same in SQL.

Stand-ins: documents are reports, orders of a customer are diagnoses of a patient, events of a user
are transfer reports, conversation turns are sections and variables, labels are the ground truth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import jsonx, rules, text
from tessella.operators import evaluate as E
from tessella.operators import evidence, model, sketches
from tessella.operators import relational as R
from tessella.operators.staging import shared_path
from tessella.plans.pipeline import run_task
from tessella.plans.tasks import CONTEXT, NEGATION, EvidenceGroup, ExtractionTask, SchemaField, load_task
from tessella.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TASK = load_task("corpus_notices")
GROUPS = TASK.evidence_groups


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_VIEW = r"lower(trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')))"
_SENTENCES = r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


# --- sources -------------------------------------------------------------------------------------
@query(f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, CASE WHEN coalesce(text, '') IN ({', '.join(f"'{x}'" for x in tables.MISSING)}) THEN 0 ELSE length(text) END AS n_chars,
  md5(CASE WHEN coalesce(text, '') IN ({', '.join(f"'{x}'" for x in tables.MISSING)}) THEN '' ELSE text END) AS digest, doc_id % 2 = 0 AS wide FROM documents""")
def delimited_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as quoted cells with their line ends, half of them in UTF-16, and read back block by block."""
    found = []
    for wide, encoding in ((False, "UTF-8"), (True, "UTF-16")):
        path = shared_path(spark, "delimited")
        docs = table(spark, sf, "documents").filter((F.col("doc_id") % 2 == 0) == wide).select("doc_id", "source", "text")
        docs.repartition(4).write.options(sep=";", header=True, quoteAll=True, escape='"', encoding=encoding, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="").csv(path)
        found += [tables.read_tabular(spark, file).withColumn("wide", F.lit(wide)) for file in tables.files_in(spark, f"{path}/part-*")]
    rows = R.union_all(found)
    return rows.select("doc_id", "source", F.length("text").cast("long").alias("n_chars"), F.md5(F.encode("text", "UTF-8")).alias("digest"), "wide")


# --- text ----------------------------------------------------------------------------------------
@query(r"""
WITH dirty AS (SELECT doc_id, chr(9) || chr(13) || chr(10) || replace(text, ' the ', chr(9) || ' the' || chr(7) || ' ') || '   ' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || 'end' || chr(13) AS t FROM documents),
a AS (SELECT doc_id, replace(replace(nfc_normalize(t), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM dirty),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), '[ \t]+', ' ', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g') AS t FROM b)
SELECT doc_id, regexp_replace(regexp_replace(t, '[ \t]+(\n|$)', '\1', 'g'), '^\s+|\s+$', '', 'g') AS cleaned FROM c""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    dirty = F.concat(F.lit("\t\r\n"), F.replace("text", F.lit(" the "), F.lit("\t the\x07 ")), F.lit("   \r\n\n\n\nend\r"))
    return table(spark, sf, "documents").select("doc_id", text.clean_text(dirty).alias("cleaned"))


@query(f"SELECT doc_id, {_VIEW} AS match_view FROM documents")
def match_view(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.match_view("text").alias("match_view"))


_RAW_ID = "CASE o_orderkey % 7 WHEN 0 THEN ' ' || o_custkey || '.0 ' WHEN 1 THEN o_custkey || '.000' WHEN 2 THEN 'nan' WHEN 3 THEN 'NULL' WHEN 4 THEN '-' || o_custkey || '.0' WHEN 5 THEN chr(9) || 'x' || o_custkey ELSE NULL END"


@query(rf"""
WITH raw AS (SELECT o_orderkey, {_RAW_ID} AS v FROM orders), s AS (SELECT o_orderkey, v, regexp_replace(v, '^\s+|\s+$', '', 'g') AS t FROM raw)
SELECT o_orderkey,
  CASE WHEN v IS NULL OR lower(t) IN ('nan', 'none') THEN '' WHEN regexp_matches(t, '^\d+\.0+$') THEN split_part(t, '.', 1) ELSE t END AS normalized,
  CASE WHEN v IS NULL OR lower(t) IN ('nan', 'none', 'null') THEN '' WHEN regexp_matches(t, '^-?\d+\.0$') THEN split_part(t, '.', 1) ELSE t END AS cleaned FROM s""")
def normalize_ids(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(_RAW_ID.replace("chr(9)", "char(9)"))
    orders = table(spark, sf, "orders").select("o_orderkey", raw.alias("v"))
    return R.normalize_id_column(orders.withColumn("cleaned", F.col("v")), "cleaned").select("o_orderkey", text.normalize_str("v").alias("normalized"), "cleaned")


@query(rf"""
WITH s AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents WHERE trim(text) <> '')
SELECT doc_id, unnest(range(0, len(ss))) AS place, unnest(ss) AS sentence FROM s""")
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "documents").select("doc_id", text.sentences("text").alias("s"))
    return parts.select("doc_id", F.posexplode("s").alias("place", "sentence")).withColumn("place", F.col("place").cast("long"))


@query(rf"""
WITH s AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents WHERE trim(text) <> ''),
r AS (SELECT doc_id, unnest(range(0, len(ss))) AS place, unnest(ss) AS sentence FROM s),
w AS (SELECT doc_id, place, trim(regexp_replace(string_agg(sentence, ' ') OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), '\s+', ' ', 'g')) AS t FROM r)
SELECT doc_id, place, CASE WHEN length(t) > 400 THEN substr(t, 1, 399) || '…' ELSE t END AS snippet FROM w""")
def sentence_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = evidence.sentence_rows(table(spark, sf, "documents"), "doc_id", "text")
    return rows.select("doc_id", F.col("place").cast("long").alias("place"), F.col("window").alias("snippet"))


_ROLES = (("[user]", "user"), ("[assistant]", "assistant"), ("[system]", "system"))


def _talks(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("["), F.col("role"), F.lit("]\n"), F.col("text")).alias("part"))
    return R.ordered_concat(turns, "conv_id", "part", [F.col("turn")], "\n\n", "talk", "n_turns")


_TALKS = "WITH t AS (SELECT conv_id, turn, role, '[' || role || ']' || chr(10) || text AS part FROM conversations)"


@query(rf"""{_TALKS}, o AS (SELECT conv_id, role, part, turn, coalesce(sum(length(part) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
  lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM t)
SELECT conv_id, CAST(a AS BIGINT) AS start, CAST(a + length(part) + CASE WHEN nxt IS NULL THEN 0 ELSE 2 END AS BIGINT) AS stop, role AS label FROM o""")
def section_ranges(spark: SparkSession, sf: str) -> DataFrame:
    ranges = _talks(spark, sf).select("conv_id", F.explode(text.section_ranges("talk", _ROLES)).alias("r"))
    return ranges.select("conv_id", F.col("r.start").cast("long").alias("start"), F.col("r.end").cast("long").alias("stop"), F.col("r.label").alias("label"))


@query(f"{_TALKS} SELECT conv_id, role AS label, string_agg(trim(part, chr(10) || ' '), chr(10) ORDER BY turn) AS body FROM t GROUP BY conv_id, role")
def section_map(spark: SparkSession, sf: str) -> DataFrame:
    return _talks(spark, sf).select("conv_id", F.explode(text.split_sections("talk", _ROLES)).alias("label", "body"))


@query(rf"""
WITH v AS (SELECT conv_id, string_agg('[' || role || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS talk, min_by(role, turn) AS first_role FROM conversations GROUP BY conv_id)
SELECT conv_id, first_role AS first_label, 'unknown' AS outside FROM v""")
def section_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ranges = text.section_ranges("talk", _ROLES)
    return _talks(spark, sf).select("conv_id", text.section_at(ranges, F.lit(0)).alias("first_label"), text.section_at(ranges, F.length("talk")).alias("outside"))


@query(rf"""{_TALKS}, o AS (SELECT conv_id, role, turn, coalesce(sum(length(part) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
  coalesce(sum(length(part) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS z,
  sum(length(part) + 2) OVER (PARTITION BY conv_id) - 2 AS whole FROM t),
h AS (SELECT conv_id, unnest(range(0, CAST(whole AS BIGINT) + 41, 40)) AS place FROM (SELECT DISTINCT conv_id, whole FROM o))
SELECT h.conv_id, h.place, CASE WHEN o.role IS NULL OR h.place >= o.whole THEN 'unknown' ELSE o.role END AS section FROM h LEFT JOIN o ON o.conv_id = h.conv_id AND h.place >= o.a AND h.place < o.z""")
def section_of_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The section of every fortieth character, and of places behind the end, by a join of two tables."""
    talks = _talks(spark, sf)
    sections = talks.select("conv_id", F.explode(text.section_ranges("talk", _ROLES)).alias("r")).select("conv_id", "r.*")
    hits = talks.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.length("talk").cast("long") + 40, F.lit(40).cast("long"))).alias("place"))
    return evidence.hits_in_sections(hits, sections, "conv_id", "place")


_FORMS = [(p.group, p.text) for p in evidence.flatten_phrases(GROUPS)]
_PHRASES = ", ".join(f"('{g}', '{p}')" for g, p in _FORMS)
_COUNT = r"CASE WHEN contains(k, ' ') THEN len(string_split(v, k)) - 1 ELSE len(list_filter(string_split(v, ' '), lambda w: w = k)) END"
_HITS = rf"WITH v AS (SELECT doc_id, {_VIEW} AS v FROM documents), p(g, k) AS (VALUES {_PHRASES}), h AS (SELECT doc_id, g, k, {_COUNT} AS n FROM v, p)"


@query(f"{_HITS} SELECT doc_id, g AS evidence_group, k AS keyword, CAST(n AS BIGINT) AS n FROM h WHERE n > 0")
def phrase_hits(spark: SparkSession, sf: str) -> DataFrame:
    return evidence.phrase_hits(table(spark, sf, "documents"), "doc_id", "text", GROUPS).withColumn("n", F.col("n").cast("long"))


@query(f"{_HITS} SELECT g AS evidence_group, count(DISTINCT doc_id) AS n_docs, CAST(sum(n) AS BIGINT) AS n_hits FROM h WHERE n > 0 GROUP BY g")
def phrase_hits_by_group(spark: SparkSession, sf: str) -> DataFrame:
    hits = evidence.phrase_hits(table(spark, sf, "documents"), "doc_id", "text", GROUPS)
    return hits.groupBy("evidence_group").agg(F.countDistinct("doc_id").alias("n_docs"), F.sum("n").cast("long").alias("n_hits"))


_DENIAL = r"\b(?:of|without)\b.{0,20}?\bthe\b"


@query(rf"""
WITH s AS (SELECT doc_id, unnest({_SENTENCES}) AS text FROM documents WHERE trim(text) <> ''), v AS (SELECT doc_id, {_VIEW} AS v FROM s)
SELECT doc_id, count(*) AS n_sentences FROM v WHERE regexp_matches(v, '(?s){_DENIAL}') GROUP BY doc_id""")
def negation_hits(spark: SparkSession, sf: str) -> DataFrame:
    rows = evidence.sentence_rows(table(spark, sf, "documents"), "doc_id", "text", wanted=lambda s: text.match_view(s).rlike(f"(?s){_DENIAL}"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_sentences"))


#: phrases that overlap each other in the documents, within words too, and patterns that claim before them
CLAIMS = ExtractionTask(
    name="claims",
    evidence_groups=(
        EvidenceGroup("pairs", ("of the", "the and", "and the", "in the")), EvidenceGroup("words", ("the", "of", "and", "der", "in"), CONTEXT),
        EvidenceGroup("long", ("and the in", "of the and", "der die"), NEGATION), EvidenceGroup("licence", ("mit license", "license", "not licensed"), CONTEXT),
    ),
    negation_patterns=((r"\bnicht\b.{0,20}?\bder\b", "nicht_der"), (r"\b(?:from|without)\b.{0,12}?\bthe\b", "from_the")),
)
_CLAIMED = [(k, p.text, p.group, p.role) for k, p in enumerate(evidence.flatten_phrases(CLAIMS.evidence_groups))]


@query(rf"""
WITH pieces AS (SELECT doc_id, unnest(ss) AS s, unnest(range(0, len(ss))) AS k FROM (SELECT doc_id, {_SENTENCES} AS ss FROM documents WHERE trim(text) <> '')),
sentence AS (SELECT doc_id, k, lower(trim(regexp_replace(s, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))) AS v FROM pieces),
placed AS (SELECT doc_id, k, v, sum(CASE WHEN v = '' THEN 0 ELSE len(string_split(v, ' ')) END) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM sentence),
patterns(rank, p, label) AS (VALUES {", ".join(f"({k}, '{p}', '{label}')" for k, (p, label) in enumerate(CLAIMS.negation_patterns))}),
hits AS (SELECT doc_id, k, v, coalesce(before, 0) AS before, rank, label, string_split_regex(v, '(?s)' || p) AS gaps, regexp_extract_all(v, '(?s)' || p) AS found FROM placed, patterns WHERE regexp_matches(v, '(?s)' || p)),
spans AS (
  SELECT doc_id, k, rank, label, n, before + len(string_split(array_to_string(gaps[1:n], '') || array_to_string(found[1:n - 1], ''), ' ')) - 1 AS a, len(string_split(found[n], ' ')) AS size
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS n FROM hits)
),
words AS (SELECT doc_id, string_split({_VIEW}, ' ') AS ws FROM documents),
phrases(rank, p, g, r) AS (VALUES {", ".join(f"({k}, '{p}', '{g}', '{r}')" for k, p, g, r in _CLAIMED)}),
split AS (SELECT *, string_split(p, ' ') AS ps FROM phrases),
tried AS (SELECT doc_id, ws, rank, p, g, r, ps, unnest(range(1, len(ws) - len(ps) + 2)) AS i FROM words, split WHERE len(ws) >= len(ps)),
met AS (
  SELECT doc_id, rank, p, g, r, i - 1 AS a, len(ps) AS size FROM tried
  WHERE CASE len(ps) WHEN 1 THEN ws[i] = p
    ELSE suffix(ws[i], ps[1]) AND prefix(ws[i + len(ps) - 1], ps[len(ps)]) AND (len(ps) < 3 OR ws[i + 1 : i + len(ps) - 2] = ps[2 : len(ps) - 1]) END
),
candidates AS (
  SELECT doc_id, 0 AS kind, k, rank, n, a, size, label AS keyword, '__negation__' AS evidence_group, 'negation' AS role FROM spans
  UNION ALL SELECT doc_id, 1, 0, rank, a, a, size, p, g, r FROM met
),
folded AS (
  SELECT doc_id, list_reduce(
    list([{{'a': a, 'z': a + size, 'keyword': keyword, 'evidence_group': evidence_group, 'role': role}}] ORDER BY kind, k, rank, n),
    lambda held, one: CASE WHEN len(list_filter(held, lambda h: h.a < one[1].z AND one[1].a < h.z)) > 0 THEN held ELSE list_concat(held, one) END) AS held
  FROM candidates GROUP BY doc_id
)
SELECT doc_id, CAST(h.a AS BIGINT) AS first_word, CAST(h.z - h.a AS BIGINT) AS n_words, h.keyword, h.evidence_group, h.role, array_to_string(ws[h.a + 1 : h.z], ' ') AS claimed
FROM (SELECT doc_id, unnest(held) AS h FROM folded) JOIN words USING (doc_id)""")
def claimed_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy claims of overlapping phrases and patterns, each with the words it claims."""
    found = evidence.claimed_hits(table(spark, sf, "documents").filter("doc_id is not null"), "doc_id", "text", CLAIMS)
    return found.select("doc_id", "first_word", "n_words", "keyword", "evidence_group", "role", text.match_view("span").alias("claimed"))


def _snippets(spark: SparkSession, sf: str) -> DataFrame:
    """A snippet for each sentence and frequent word it holds, with section, role and place.

    Sentences are matched first; windows are built for those that hold a word.
    """
    held = lambda s: F.array_intersect(F.split(text.match_view(s), " "), F.array(F.lit("the"), F.lit("of"), F.lit("der")))
    rows = evidence.sentence_rows(table(spark, sf, "documents"), "doc_id", "text", wanted=lambda s: s.rlike("(?i)the|of|der") & (F.size(held(s)) > 0))
    words = rows.select("doc_id", "place", F.col("window").alias("text"), F.explode(held(F.col("sentence"))).alias("keyword"))
    return words.select(
        "doc_id", "place", "text", "keyword", F.when(F.col("place") % 3 == 0, "history").when(F.col("place") % 3 == 1, "plan").otherwise("unknown").alias("section"),
        F.when(F.col("keyword") == "the", "common").otherwise("rare").alias("evidence_group"), F.when(F.col("keyword") == "of", "context").otherwise("positive").alias("role"),
    )


_SNIPPETS = rf"""
WITH s AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents WHERE trim(text) <> ''), r AS (SELECT doc_id, unnest(range(0, len(ss))) AS place, unnest(ss) AS text FROM s),
w AS (SELECT doc_id, place, {_VIEW} AS v, trim(regexp_replace(string_agg(text, ' ') OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), '\s+', ' ', 'g')) AS t FROM r),
k AS (SELECT doc_id, place, CASE WHEN length(t) > 400 THEN substr(t, 1, 399) || '…' ELSE t END AS text, unnest(list_filter(['the', 'of', 'der'], lambda x: list_contains(string_split(v, ' '), x))) AS keyword FROM w),
snippets AS (SELECT *, CASE place % 3 WHEN 0 THEN 'history' WHEN 1 THEN 'plan' ELSE 'unknown' END AS section, CASE WHEN keyword = 'the' THEN 'common' ELSE 'rare' END AS evidence_group, CASE WHEN keyword = 'of' THEN 'context' ELSE 'positive' END AS role FROM k)
"""


@query(_SNIPPETS + "SELECT doc_id, place, keyword, evidence_group FROM snippets QUALIFY row_number() OVER (PARTITION BY doc_id, evidence_group, keyword ORDER BY place) <= 3")
def cap_hits(spark: SparkSession, sf: str) -> DataFrame:
    return evidence.cap_hits(_snippets(spark, sf), "doc_id", "place").select("doc_id", F.col("place").cast("long").alias("place"), "keyword", "evidence_group")


@query(_SNIPPETS + r"SELECT doc_id, place, keyword FROM snippets QUALIFY row_number() OVER (PARTITION BY doc_id, section, evidence_group, keyword, substr(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), 1, 200) ORDER BY place) = 1")
def dedupe_snippets(spark: SparkSession, sf: str) -> DataFrame:
    return evidence.dedupe_snippets(_snippets(spark, sf), "doc_id", "place").select("doc_id", F.col("place").cast("long").alias("place"), "keyword")


@query(_SNIPPETS + """, u AS (SELECT DISTINCT doc_id, section, role, text, keyword FROM snippets)
SELECT doc_id, section, keyword, text, n AS priority FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE section WHEN 'history' THEN 1 WHEN 'plan' THEN 2 ELSE 99 END, CASE role WHEN 'positive' THEN 1 ELSE 2 END, text, keyword) AS n FROM u) WHERE n <= 12""")
def topk_snippets(spark: SparkSession, sf: str) -> DataFrame:
    unique = _snippets(spark, sf).select("doc_id", "section", "role", "text", "keyword").distinct()
    top = evidence.top_snippets(unique, "doc_id", (("[History]", "history"), ("[Plan]", "plan")))
    return top.select("doc_id", "section", "keyword", "text", F.col("priority").cast("long").alias("priority"))


@query()
def evidence_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """The whole bundle; the tests hold it against a plain version that shares no code with it."""
    found = evidence.with_evidence(table(spark, sf, "documents"), TASK, "text")
    return found.select(
        "doc_id", "evidence.original_report_text_length", "evidence.reduction_method", "evidence.keyword_hits_count", "evidence.has_positive_evidence", "evidence.has_negation",
        "evidence.llm_report_text", F.to_json("evidence.evidence_flags").alias("evidence_flags"), F.to_json("evidence.evidence_snippets").alias("evidence_snippets"),
    )


#: a task of single words, whose evidence SQL can count: a word is claimed once, and no cut falls among so few
WORDS = ExtractionTask(
    name="words", fields=(SchemaField("licensed", "boolean", True, default=False), SchemaField("licence_kind", "enum", enum=("none", "mit"), default="none")),
    evidence_groups=(EvidenceGroup("common", ("the", "der")), EvidenceGroup("tone", ("idiot",), CONTEXT), EvidenceGroup("denial", ("nicht",), NEGATION)),
    consistency_rules=({"type": "conditional_set", "if": {"licensed": False}, "set": {"licence_kind": "none"}},),
)
_WORD_HITS = rf"""
WITH w AS (SELECT doc_id, text, string_split({_VIEW}, ' ') AS ws FROM documents),
n AS (SELECT doc_id, text, least(3, len(list_filter(ws, lambda x: x = 'the'))) + least(3, len(list_filter(ws, lambda x: x = 'der'))) AS common,
  least(3, len(list_filter(ws, lambda x: x = 'idiot'))) AS tone, least(3, len(list_filter(ws, lambda x: x = 'nicht'))) AS denial FROM w)
"""


@query(_WORD_HITS + """SELECT doc_id, coalesce(length(text), 0) AS n_chars, CAST(common + tone + denial AS BIGINT) AS n_hits, common + tone > 0 AS positive, denial > 0 AS negation,
  CASE WHEN common + tone > 0 THEN 'structured_evidence' ELSE 'no_evidence' END AS reduction_method, common > 0 AS flag_common, tone > 0 AS flag_tone FROM n""")
def evidence_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and flags of the bundle, for phrases of one word."""
    found = evidence.with_evidence(table(spark, sf, "documents"), WORDS, "text")
    e = lambda name: F.col(f"evidence.{name}")
    return found.select(
        "doc_id", e("original_report_text_length").cast("long").alias("n_chars"), e("keyword_hits_count").cast("long").alias("n_hits"), e("has_positive_evidence").alias("positive"),
        e("has_negation").alias("negation"), e("reduction_method").alias("reduction_method"), e("evidence_flags.common").alias("flag_common"), e("evidence_flags.tone").alias("flag_tone"),
    )


@query(_WORD_HITS + """SELECT CAST(doc_id AS VARCHAR) AS report_id, CASE WHEN common + tone > 0 THEN 'extracted' ELSE 'skipped_no_evidence' END AS status, CAST(common + tone + denial AS BIGINT) AS n_hits,
  CASE WHEN common + tone > 0 THEN 'True' ELSE 'False' END AS llm_called, common + tone > 0 AS licensed, CASE WHEN common + tone > 0 THEN 'mit' ELSE 'none' END AS licence_kind FROM n""")
def extraction_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run with answers that never fail: evidence, call, coercion, rules, flat row."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("report_id"), F.concat(F.lit("row_"), F.col("doc_id")).alias("source_row_id"), F.col("text").alias("report_text"))
    flat, _ = run_task(docs, WORDS, model.ScriptedClient(default='{"licensed": "ja", "licence_kind": "MIT",}'), wait=False)
    return flat.select("report_id", "status", F.col("keyword_hits_count").cast("long").alias("n_hits"), "llm_called", "licensed", "licence_kind")


@query(rf"SELECT doc_id, {' OR '.join(f'contains(v, $q${p}$q$)' for _, p in _FORMS)} OR regexp_matches(v, '(?s)\bwithout\b.{{0,20}}?\blicense\b') AS may_hit FROM (SELECT doc_id, {_VIEW} AS v FROM documents)")
def evidence_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", evidence.may_hit(TASK, F.col("text")).alias("may_hit"))


_HEADERS = r"(?m)^(?:\[[^\]]+\]|\d+\.\s+)"


@query(rf"""
SELECT doc_id, length(text) > 3000 AS shortened, CASE WHEN length(text) <= 3000 THEN text WHEN NOT regexp_matches(text, '{_HEADERS}') THEN
  '{evidence.NOTICE_ENDS.split("{n}")[0]}' || length(text) || '{evidence.NOTICE_ENDS.split("{n}")[1].format(most=3000).rstrip()}' || chr(10) || chr(10)
  || substr(substr(text, 1, 1500) || chr(10) || chr(10) || '[…]' || chr(10) || chr(10) || right(text, 1420), 1, 3000) END AS sent
FROM documents""")
def budget_truncate(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without phrases: those over the budget are sent by their ends, unless they have headers."""
    plain = ExtractionTask(name="plain", fields=TASK.fields)
    docs = table(spark, sf, "documents").select("doc_id", "text", evidence.fit_column(plain, F.col("text"), 3000).alias("f"))
    return docs.select("doc_id", F.col("f.shortened").alias("shortened"), F.when(~F.col("f.shortened") | ~F.col("text").rlike(_HEADERS), F.col("f.text")).alias("sent"))


@query()
def budget_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as sent; the tests hold them against a plain version."""
    return table(spark, sf, "documents").select("doc_id", evidence.fit_column(TASK, F.col("text"), 3000)["text"].alias("sent"))


@query("""
WITH i AS (SELECT user_id, epoch_us(ts) // 1000000 AS a, epoch_us(ts) // 1000000 + CAST(floor(value * 600) AS BIGINT) AS b FROM events),
m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN a <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT user_id, min(a) AS start, max(b) AS stop FROM g GROUP BY user_id, island""")
def merge_intervals(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.expr("unix_micros(cast(ts as timestamp)) div 1000000")
    spans = table(spark, sf, "events").select("user_id", seconds.alias("start"), (seconds + F.floor(F.col("value") * 600).cast("long")).alias("stop"))
    return evidence.merge_intervals(spans, ["user_id"], "start", "stop")


# --- relational ----------------------------------------------------------------------------------
@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END NULLS LAST, o_orderkey) AS rn FROM orders),
p AS (SELECT CAST(o_custkey AS VARCHAR) AS patient_id, count(*) AS n, '[Diagnoseliste]' || chr(10) || chr(10) || string_agg('[#' || rn || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ' | time=' || strftime(o_orderdate, '%Y-%m-%d') END || ' | FallNummer=' || o_orderstatus || ']' || chr(10) || o_orderpriority, chr(10) || chr(10) ORDER BY rn) AS report_text FROM o GROUP BY o_custkey)
SELECT patient_id, CAST(n AS INTEGER) AS n_diagnosis_entries, report_text, 'patient_' || (row_number() OVER (ORDER BY patient_id) - 1) AS source_row_id FROM p""")
def patient_concat(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("PatientID"), F.col("o_orderpriority").alias("Diagnose_Value"), F.col("o_orderstatus").alias("FallNummer"),
        F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Diagnose_Time"), F.col("o_orderkey").alias(R.ORDER),
    )
    halves = R.union_all([orders.filter(f"{R.ORDER} % 2 = 0"), orders.filter(f"{R.ORDER} % 2 = 1")])
    return R.diagnosis_records(halves).select("patient_id", "n_diagnosis_entries", "report_text", "source_row_id")


def _transfers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("patnr"), F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("berdat"),
        F.col("event_type").alias("diag"), F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("epikrise"), F.col("event_id").cast("string").alias("fallnr"), F.col("event_id").alias(R.ORDER),
    )


_TRANSFERS = """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS patnr, CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS berdat, event_type, CASE WHEN event_id % 3 <> 0 THEN props END AS props, event_id FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY patnr ORDER BY berdat DESC NULLS LAST, event_id DESC) AS rn, count(*) OVER (PARTITION BY patnr) AS n FROM e),
latest AS (SELECT patnr AS patient_id, '[Verlegungsbericht] fallnr=' || event_id || CASE WHEN berdat IS NULL THEN '' ELSE ' | berdat=' || berdat END || chr(10) || chr(10) || '[diag]' || chr(10) || event_type || CASE WHEN props IS NULL THEN '' ELSE chr(10) || chr(10) || '[epikrise]' || chr(10) || props END AS verlegung_text,
  coalesce(berdat, '') AS verlegung_berdat, CAST(event_id AS VARCHAR) AS verlegung_fallnr, CAST(n AS INTEGER) AS n_verlegung_rows FROM r WHERE rn = 1)
"""


@query(_TRANSFERS + "SELECT * FROM latest")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return R.latest_transfer(_transfers(spark, sf))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, CAST(count(*) AS INTEGER) AS n FROM orders GROUP BY o_custkey")
def latest_per_key_undated(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderkey").alias(R.ORDER))
    return R.latest_per_key(rows, ["o_custkey"], None, count="n").drop(R.ORDER)


@query(_TRANSFERS + """, c AS (SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS report_text FROM customer),
j AS (SELECT c.patient_id, c.report_text, coalesce(l.verlegung_text, '') AS verlegung_text, CASE WHEN l.patient_id IS NULL THEN 'patient_diagnoseliste' ELSE 'patient_diagnoseliste_verlegung' END AS input_kind,
  CASE WHEN l.patient_id IS NULL THEN 'a.csv' ELSE 'a.csv, b.csv' END AS source_files FROM c LEFT JOIN latest l USING (patient_id))
SELECT patient_id, verlegung_text, input_kind, source_files, report_text || CASE WHEN verlegung_text = '' THEN '' ELSE chr(10) || chr(10) || verlegung_text END AS both_text FROM j""")
def attach_left_join(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"), F.col("c_custkey").cast("string").alias("report_id"), F.col("c_name").alias("report_text"),
        F.lit("patient_diagnoseliste").alias("input_kind"), F.lit("a.csv").alias("source_files"),
    )
    joined = R.attach_transfer(records, R.latest_transfer(_transfers(spark, sf)), "b.csv")
    return joined.select("patient_id", "verlegung_text", "input_kind", "source_files", R.text_for_source(joined.columns, "both").alias("both_text"))


@query("""SELECT p_partkey, concat_ws(chr(10) || chr(10), '[p_name]' || chr(10) || p_name, CASE WHEN p_partkey % 3 <> 0 THEN '[p_brand]' || chr(10) || p_brand END, '[p_type]' || chr(10) || p_type) AS stitched FROM part""")
def stitch_sections(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise("none"))
    return parts.select("p_partkey", R.stitch_sections(["p_name", "p_brand", "p_type"]).alias("stitched"))


@query("SELECT c_custkey, 'row_' || (row_number() OVER (ORDER BY c_custkey) - 1) AS source_row_id FROM customer QUALIFY row_number() OVER (ORDER BY c_custkey) <= 1000")
def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    numbered = R.with_row_order(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return R.first_rows(numbered, 1000).select("c_custkey", F.concat(F.lit("row_"), F.col(R.ORDER).cast("string")).alias("source_row_id"))


@query("SELECT l_orderkey, l_linenumber, 'row_' || (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) AS source_row_id FROM lineitem")
def all_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return R.assign_row_ids(rows, "l_orderkey", "l_linenumber")


@query("SELECT event_id, t AS event_type FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ' ' || event_type || ' ' END AS t FROM events) WHERE coalesce(trim(t), '') NOT IN ('click', 'error')")
def exclude_types(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.when(F.col("event_id") % 11 != 0, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
    return R.exclude_types(table(spark, sf, "events").select("event_id", padded.alias("event_type")), ["click", " error "], "event_type")


_STATUS = "CASE o_orderkey % 9 WHEN 0 THEN 'failed' WHEN 1 THEN 'partial' ELSE 'extracted' END"


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier results: two thirds of the orders, some without a row id."""
    rows = table(spark, sf, "orders").filter("o_orderkey % 3 != 2")
    return rows.select(F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("row_"), F.col("o_orderkey"))).alias("source_row_id"), F.col("o_orderkey").cast("string").alias("report_id"), F.expr(_STATUS).alias("status"), F.col("o_orderkey").alias(R.ORDER))


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("row_"), F.col("o_orderkey"))).alias("source_row_id"), F.col("o_orderkey").cast("string").alias("report_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias(R.ORDER))


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS report_id FROM orders WHERE o_orderkey % 3 = 2 OR {_STATUS} = 'failed'")
def anti_resume(spark: SparkSession, sf: str) -> DataFrame:
    return R.unprocessed(_incoming(spark, sf), R.keep_done(_results(spark, sf))).select("report_id")


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS report_id FROM orders WHERE o_orderkey % 3 <> 2 AND {_STATUS} IN ('failed', 'partial')")
def semi_retry(spark: SparkSession, sf: str) -> DataFrame:
    return R.to_retry(_incoming(spark, sf), _results(spark, sf)).select("report_id")


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS report_id, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE {_STATUS} END AS status,
  CASE WHEN o_orderkey % 3 <> 2 THEN o_orderkey ELSE o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders WHERE o_orderkey % 3 <> 2) END AS place
FROM orders WHERE o_orderkey % 3 <> 2 OR o_orderkey % 5 = 0""")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    fresh = _incoming(spark, sf).filter("report_id % 5 = 0")
    stale, fresh = fresh.withColumn("status", F.lit("stale")), fresh.withColumn(R.ORDER, F.col(R.ORDER) + 1_000_000_000_000)
    return R.upsert(_results(spark, sf), stale.union(fresh)).select("report_id", "status", F.col(R.ORDER).alias("place"))


@query(f"SELECT {_STATUS} AS status, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 2 GROUP BY 1")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.count_statuses(_results(spark, sf))


@query("SELECT c_custkey FROM customer ORDER BY md5('7 ' || c_custkey), c_custkey LIMIT 100")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return R.seeded_sample(table(spark, sf, "customer").select("c_custkey"), 100, 7, "c_custkey")


# --- JSON and schema -----------------------------------------------------------------------------
_PROPS = ExtractionTask(name="props", fields=(SchemaField("k", "integer", True, default=-1), SchemaField("note", "string", default="none")))


@query("""SELECT event_id, CAST(CASE WHEN event_id % 10 = 0 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS BIGINT) AS k, 'none' AS note,
  CASE WHEN event_id % 10 = 0 THEN 'missing required field ''k''' ELSE '' END AS errors FROM events""")
def json_validate(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 10 == 0, F.lit('{"other": 1}')).otherwise(F.col("props"))
    fields, errors = jsonx.validate_column(F.col("raw"), _PROPS)
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw")).select("event_id", fields.alias("f"), errors.alias("e"))
    return rows.select("event_id", "f.k", "f.note", F.array_join("e", " | ").alias("errors"))


_BROKEN = "CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN 2 THEN '<start_of_turn>model ' || replace(props, '}', ',}') || '<end_of_turn>' WHEN 3 THEN 'Sure: ' || props || ' is it.' WHEN 4 THEN 'no object' ELSE '' END"


@query(r"""SELECT event_id, CASE WHEN event_id % 6 < 4 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, event_id % 6 < 4 AS usable FROM events""")
def json_lenient(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.expr(_BROKEN.replace("chr(10)", "char(10)"))
    parsed = table(spark, sf, "events").select("event_id", jsonx.parse_answer_column(broken).alias("j"))
    return parsed.select("event_id", F.get_json_object("j", "$.k").cast("long").alias("k"), F.col("j").isNotNull().alias("usable"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'JA' WHEN 'view' THEN ' nein ' WHEN 'error' THEN '1' ELSE event_type END AS raw,
  CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE WHEN 'error' THEN TRUE ELSE NULL END AS value FROM events""")
def coerce_boolean(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_type") == "click", "JA").when(F.col("event_type") == "view", " nein ").when(F.col("event_type") == "error", "1").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", raw.alias("raw"), jsonx.coerce_text(SchemaField("b", "boolean"), text.strip(raw)).alias("value"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS value FROM orders")
def coerce_enum(spark: SparkSession, sf: str) -> DataFrame:
    field = SchemaField("p", "enum", enum=("1-URGENT", "2-HIGH"))
    return table(spark, sf, "orders").select("o_orderkey", jsonx.coerce_text(field, F.lower("o_orderpriority")).alias("value"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS whole, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS number FROM events")
def coerce_integer(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, "about 3").otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select("event_id", jsonx.coerce_text(SchemaField("i", "integer"), raw).alias("whole"), jsonx.coerce_text(SchemaField("n", "number"), raw).alias("number"))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role || '|' || turn ELSE role END AS items FROM conversations")
def coerce_array(spark: SparkSession, sf: str) -> DataFrame:
    both = F.when(F.col("turn") % 2 == 0, F.concat(F.lit('{"a": [" '), F.col("role"), F.lit('", "  ", "'), F.col("turn"), F.lit('"]}'))).otherwise(F.concat(F.lit('{"a": " '), F.col("role"), F.lit('"}')))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(jsonx.coerce_column(SchemaField("a", "array"), both), "|").alias("items"))


@query("SELECT event_id, " + ", ".join(f"CAST(event_type = '{o}' AS INTEGER) AS event_type__{o}" for o in ("click", "error", "view")) + " FROM events")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    task = ExtractionTask(name="t", fields=(SchemaField("event_type", "enum", enum=("click", "error", "view")),))
    return table(spark, sf, "events").select("event_id", *jsonx.one_hot(task))


@query("""WITH q AS (SELECT conv_id, turn, role AS quote FROM conversations UNION ALL SELECT conv_id, turn + 0.5, ' ' || role || ' ' FROM conversations),
f AS (SELECT conv_id, trim(quote) AS quote, min(turn) AS seen_at FROM q GROUP BY conv_id, trim(quote))
SELECT conv_id, string_agg(quote, ' | ' ORDER BY seen_at) AS quotes FROM f GROUP BY conv_id""")
def merge_quotes(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    roles, padded = F.transform("t", lambda x: x["role"]), F.transform("t", lambda x: F.concat(F.lit(" "), x["role"], F.lit(" ")))
    return turns.select("conv_id", jsonx.join_cell(jsonx.merge_quotes(roles, padded, F.array(F.lit("  ")))).alias("quotes"))


# --- rules ---------------------------------------------------------------------------------------
_GUARD = ExtractionTask(
    name="guard",
    fields=(SchemaField("quality", "boolean"), SchemaField("toxic", "boolean"), SchemaField("grade", "enum", enum=("good", "bad")), SchemaField("note", "string")),
    consistency_rules=(
        {"type": "normalize", "field": "grade", "map": {"FINE": "good", "poor": "bad"}},
        {"type": "conditional_set", "if": {"toxic": True}, "set": {"grade": "bad"}},
        {"type": "mutually_exclusive", "fields": ["quality", "toxic"]},
        {"type": "requires", "if": {"toxic": True}, "then_required": ["note"]},
        {"type": "impossible_combination", "when": {"quality": False, "grade": "fine"}},
    ),
)


def _guarded(spark: SparkSession, sf: str, *kinds: str, more: tuple[dict, ...] = ()) -> DataFrame:
    task = ExtractionTask(name="guard", fields=_GUARD.fields, consistency_rules=(*(r for r in _GUARD.consistency_rules if r["type"] in kinds), *more))
    rows = table(spark, sf, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"),
        F.when(F.col("doc_id") % 3 == 0, "fine").when(F.col("doc_id") % 3 == 1, "Poor").otherwise("good").alias("grade"), F.when(F.col("doc_id") % 2 == 0, "x").otherwise(" ").alias("note"),
    )
    final, report = rules.apply_rules(task, {f.name: F.col(f.name) for f in task.fields})
    out = rows.select("doc_id", final["grade"].alias("grade"), *[jsonx.join_cell(report[k]).alias(k) for k in ("normalized_fields", "contradictions", "missing_dependent_fields")], report["manual_review_candidate"].alias("review"))
    return out


_GRADE = "CASE doc_id % 3 WHEN 0 THEN 'fine' WHEN 1 THEN 'Poor' ELSE 'good' END"
_CLEAN = "'' AS contradictions, '' AS missing_dependent_fields, FALSE AS review"


@query(f"SELECT doc_id, CASE doc_id % 3 WHEN 1 THEN 'bad' ELSE 'good' END AS grade, CASE doc_id % 3 WHEN 0 THEN 'grade: ''fine'' -> ''good''' WHEN 1 THEN 'grade: ''Poor'' -> ''bad''' ELSE '' END AS normalized_fields, {_CLEAN} FROM labels")
def guard_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "normalize")


@query(f"""SELECT doc_id, CASE WHEN toxic = 1 THEN 'bad' WHEN doc_id % 3 = 1 THEN 'bad' ELSE 'good' END AS grade, concat_ws(' | ', CASE doc_id % 3 WHEN 0 THEN 'grade: ''fine'' -> ''good''' WHEN 1 THEN 'grade: ''Poor'' -> ''bad''' END,
  CASE WHEN toxic = 1 AND doc_id % 3 <> 1 THEN 'grade: ''good'' -> ''bad'' (conditional_set)' END) AS normalized_fields, {_CLEAN} FROM labels""")
def guard_conditional_set(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "normalize", "conditional_set")


@query(f"SELECT doc_id, {_GRADE} AS grade, '' AS normalized_fields, '' AS contradictions, CASE WHEN toxic = 1 AND doc_id % 2 = 1 THEN '''note'' required when {{''toxic'': True}}' ELSE '' END AS missing_dependent_fields, toxic = 1 AND doc_id % 2 = 1 AS review FROM labels")
def guard_requires(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "requires")


@query(f"SELECT doc_id, {_GRADE} AS grade, '' AS normalized_fields, CASE WHEN quality = 1 AND toxic = 1 THEN 'mutually_exclusive violated: [''quality'', ''toxic''] are all true' ELSE '' END AS contradictions, '' AS missing_dependent_fields, quality = 1 AND toxic = 1 AS review FROM labels")
def guard_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "mutually_exclusive")


@query(f"SELECT doc_id, {_GRADE} AS grade, '' AS normalized_fields, CASE WHEN quality = 0 AND doc_id % 3 = 0 THEN 'impossible_combination: {{''quality'': False, ''grade'': ''fine''}}' ELSE '' END AS contradictions, '' AS missing_dependent_fields, quality = 0 AND doc_id % 3 = 0 AS review FROM labels")
def guard_impossible(spark: SparkSession, sf: str) -> DataFrame:
    return _guarded(spark, sf, "impossible_combination")


@query(f"""WITH l AS (SELECT *, CASE WHEN toxic = 1 OR doc_id % 3 = 1 THEN 'bad' ELSE 'good' END AS g FROM labels)
SELECT doc_id, g AS grade, concat_ws(' | ', CASE doc_id % 3 WHEN 0 THEN 'grade: ''fine'' -> ''good''' WHEN 1 THEN 'grade: ''Poor'' -> ''bad''' END, CASE WHEN toxic = 1 AND doc_id % 3 <> 1 THEN 'grade: ''good'' -> ''bad'' (conditional_set)' END) AS normalized_fields,
  concat_ws(' | ', CASE WHEN quality = 1 AND toxic = 1 THEN 'mutually_exclusive violated: [''quality'', ''toxic''] are all true' END, CASE WHEN quality = 0 AND doc_id % 3 = 2 THEN 'impossible_combination: {{''quality'': False, ''grade'': ''good''}}' END) AS contradictions,
  CASE WHEN toxic = 1 AND doc_id % 2 = 1 THEN '''note'' required when {{''toxic'': True}}' ELSE '' END AS missing_dependent_fields,
  (quality = 1 AND toxic = 1) OR (quality = 0 AND doc_id % 3 = 2) OR (toxic = 1 AND doc_id % 2 = 1) AS review FROM l""")
def guard_all(spark: SparkSession, sf: str) -> DataFrame:
    """All kinds of rules one after the other: some set values, the others look at the values as they came."""
    last = {"type": "impossible_combination", "when": {"quality": False, "grade": "good"}}
    return _guarded(spark, sf, "normalize", "conditional_set", "mutually_exclusive", "requires", more=(last,))


# --- extraction ----------------------------------------------------------------------------------
@query("""SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS hits, bool_or(role = 'system') AS any_system, bool_and(length(text) > 20) AS sufficient, string_agg('### ' || role || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS reasoning, max(length(text)) AS longest,
  CASE WHEN count(*) FILTER (turn % 3 = 0) > 0 AND count(*) FILTER (turn % 3 <> 0) > 0 THEN 'partial' WHEN count(*) FILTER (turn % 3 = 0) > 0 THEN 'failed' ELSE 'extracted' END AS status FROM conversations GROUP BY conv_id""")
def variable_merge(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("failed", F.col("turn") % 3 == 0)
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("### "), F.col("role"), F.lit("\n"), F.col("text")).alias("part"))))
    n_failed, n_fine = F.count_if("failed"), F.count_if(~F.col("failed"))
    return turns.groupBy("conv_id").agg(
        F.sum(F.length("text")).cast("long").alias("hits"), F.bool_or(F.col("role") == "system").alias("any_system"), F.bool_and(F.length("text") > 20).alias("sufficient"),
        F.array_join(F.transform(parts, lambda x: x["part"]), "\n\n").alias("reasoning"), F.max(F.length("text")).cast("long").alias("longest"),
        F.when((n_failed > 0) & (n_fine > 0), "partial").when(n_failed > 0, "failed").otherwise("extracted").alias("status"),
    )


@query()
def extraction_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole task over all documents, with a client that answers without a network."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("report_id"), F.concat(F.lit("row_"), F.col("doc_id")).alias("source_row_id"), F.col("text").alias("report_text"))
    client = model.ScriptedClient({"mit license": '{"licensed": "ja", "licence_kind": "MIT"}', "pathetic": "no answer"}, '{"licensed": false, "licence_kind": "gnu",}')
    flat, _ = run_task(docs, TASK, client, wait=False)
    return flat.select("report_id", "status", "llm_called", "reduction_method", "keyword_hits_count", "licensed", "licence_kind", "schema_errors", "guardrail_normalized", "manual_review_candidate")


_KIND = ExtractionTask(
    name="kind", fields=(SchemaField("licence_kind", "enum", enum=("none", "mit"), default="none"),),
    consistency_rules=({"type": "normalize", "field": "licence_kind", "map": {"gnu": "none", "X11": "mit"}},),
)


@query("""SELECT conv_id, turn, CAST(CASE WHEN contains(text, 'ñ') THEN 3 ELSE 1 END AS BIGINT) AS attempts, contains(text, 'ñ') AS failed,
  CASE WHEN NOT contains(text, 'ñ') AND contains(text, 'ß') THEN 'mit' ELSE 'none' END AS licence_kind, CASE WHEN contains(text, 'ñ') THEN 'no object here' ELSE NULL END AS raw_output FROM conversations""")
def call_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Calls with retries: answers without an object fail after three attempts, value maps hold before validation."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.lit("kind").alias("variable"), F.col("text").alias("llm_text"))
    client = model.ScriptedClient({"ñ": "no object here", "ß": 'So: ```json {"licence_kind": "x11",} ```'}, '{"licence_kind": "gnu"}')
    found = model.call_rows(rows, {"kind": _KIND}, client, wait=False)
    return found.select(
        "conv_id", "turn", F.col("attempts").cast("long").alias("attempts"), "failed", F.get_json_object("fields", "$.licence_kind").alias("licence_kind"), F.when(F.col("failed"), F.col("raw_output")).alias("raw_output")
    )


# --- evaluation ----------------------------------------------------------------------------------
def _judged(spark: SparkSession, sf: str) -> DataFrame:
    """Labels beside a rule's guess: documents with symbols in their words are of low quality."""
    guess = table(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("text").rlike(r"[*$%&#|]{1}"), "no").otherwise("yes").alias("guess"))
    return table(spark, sf, "labels").join(guess, "doc_id").select("doc_id", "lang", F.col("quality").cast("string").alias("quality"), "guess")


_JUDGED = "WITH j AS (SELECT l.doc_id, d.lang, l.quality = 1 AS t, NOT regexp_matches(d.text, '[*$%&#|]') AS p FROM labels l JOIN documents d USING (doc_id))"
_COUNTS = "count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn"


@query(f"{_JUDGED} SELECT lang, {_COUNTS} FROM j GROUP BY lang")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return E.confusion(_judged(spark, sf), F.col("quality"), F.col("guess"), ["lang"])


@query(f"""{_JUDGED}, c AS (SELECT lang, {_COUNTS} FROM j GROUP BY lang)
SELECT *, tp + fp + fn + tn AS support, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 4) AS precision, round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 4) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 4) AS f1, round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 4) AS accuracy, round(CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END, 4) AS specificity FROM c""")
def align_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return E.binary_metrics(_judged(spark, sf), F.col("quality"), F.col("guess"), ["lang"])


@query("SELECT o_orderstatus AS truth, CASE WHEN o_totalprice > 200000 THEN 'F' ELSE 'O' END AS guess, count(*) AS n FROM orders GROUP BY 1, 2")
def categorical_confusion(spark: SparkSession, sf: str) -> DataFrame:
    guess = F.when(F.col("o_totalprice") > 200000, " F").otherwise("O ")
    return E.categorical_confusion(table(spark, sf, "orders"), F.col("o_orderstatus"), guess)


@query("SELECT count(*) AS support, round(avg(CAST(o_orderstatus = CASE WHEN o_totalprice > 200000 THEN 'F' ELSE 'O' END AS INTEGER)), 4) AS accuracy FROM orders")
def categorical_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return E.categorical_accuracy(table(spark, sf, "orders"), F.col("o_orderstatus"), F.when(F.col("o_totalprice") > 200000, "F").otherwise("O"))


@query("SELECT round(avg(CAST(quality = toxic AND doc_id % 2 = 0 AS INTEGER)), 4) AS exact_match_rate FROM labels")
def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    return E.exact_match_rate(labels, [(F.col("quality"), F.col("toxic")), (F.when(F.col("doc_id") % 2 == 0, "a"), F.lit("a"))])


@query("""WITH p AS (SELECT doc_id, NOT regexp_matches(text, '[*$%&#|]') AS quality, FALSE AS toxic FROM documents), a AS (SELECT l.quality = 1 AS tq, l.toxic = 1 AS tt, p.quality AS pq, p.toxic AS pt FROM labels l JOIN p USING (doc_id)),
u AS (SELECT 'quality' AS field, tq AS t, pq AS p, tq = pq AND tt = pt AS e FROM a UNION ALL SELECT 'toxic', tt, pt, tq = pq AND tt = pt FROM a)
SELECT field, count(*) AS n_aligned, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND NOT p) AS tn, round(avg(CAST(t = p AS INTEGER)), 4) AS accuracy, round(avg(CAST(e AS INTEGER)), 4) AS exact_match_rate FROM u GROUP BY field""")
def compare_fields(spark: SparkSession, sf: str) -> DataFrame:
    task = ExtractionTask(name="t", fields=(SchemaField("quality", "boolean"), SchemaField("toxic", "boolean")))
    guess = table(spark, sf, "documents").select(F.col("doc_id").alias("report_id"), (~F.col("text").rlike(r"[*$%&#|]")).alias("quality"), F.lit(False).alias("toxic"))
    truth = table(spark, sf, "labels").select(F.col("doc_id").alias("report_id"), (F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"), F.col("doc_id").alias(R.ORDER))
    older = truth.withColumns({"quality": ~F.col("quality"), R.ORDER: F.col(R.ORDER) - 1_000_000})
    return E.compare(guess, truth.union(older), task).select("field", "n_aligned", "tp", "tn", "accuracy", "exact_match_rate")


@query("""WITH r AS (SELECT CASE WHEN doc_id % 50 = 0 THEN '' ELSE CAST(doc_id // 2 AS VARCHAR) END AS i, CASE WHEN doc_id % 20 = 0 THEN '  ' ELSE text END AS t FROM documents),
a AS (SELECT count(*) AS n, count(*) FILTER (i = '') AS m, count(*) - count(DISTINCT i) AS d, count(*) FILTER (trim(t) = '') AS e FROM r)
SELECT 'report_row_count' AS "check", CASE WHEN n > 0 THEN 'ok' ELSE 'warn' END AS status, CAST(n AS VARCHAR) AS value, '' AS detail FROM a
UNION ALL SELECT 'missing_report_ids', CASE WHEN m = 0 THEN 'ok' ELSE 'fail' END, CAST(m AS VARCHAR), 'must be 0' FROM a
UNION ALL SELECT 'duplicate_report_ids', CASE WHEN d = 0 THEN 'ok' ELSE 'warn' END, CAST(d AS VARCHAR), 'report_id should be unique' FROM a
UNION ALL SELECT 'empty_report_text', CASE WHEN e = 0 THEN 'ok' ELSE 'warn' END, CAST(e AS VARCHAR), 'reports with no text' FROM a""")
def input_checks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return E.input_checks(docs.select(F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.expr("doc_id div 2").cast("string")).alias("report_id"), F.when(F.col("doc_id") % 20 == 0, "  ").otherwise(F.col("text")).alias("report_text")))


_LEFT, _RIGHT = "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer", "SELECT DISTINCT CASE WHEN o_custkey % 3 = 0 THEN '00' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS id FROM orders"


@query(f"""WITH l AS ({_LEFT}), r AS ({_RIGHT}), b AS (SELECT id FROM l INTERSECT SELECT id FROM r), z AS (SELECT coalesce(nullif(ltrim(id, '0'), ''), '0') AS id FROM l INTERSECT SELECT coalesce(nullif(ltrim(id, '0'), ''), '0') FROM r)
SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM r) AS n_right, (SELECT count(*) FROM b) AS n_both, (SELECT count(*) FROM (SELECT id FROM l EXCEPT SELECT id FROM r)) AS n_left_only, (SELECT count(*) FROM (SELECT id FROM r EXCEPT SELECT id FROM l)) AS n_right_only,
  (SELECT count(*) FROM z) AS n_both_without_zeros, round(100.0 * CAST((SELECT count(*) FROM b) AS DOUBLE) / (SELECT count(*) FROM l), 1) AS match_percent""")
def id_overlap(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("00"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    return E.id_overlap(E.id_set(table(spark, sf, "customer"), "c_custkey"), E.id_set(table(spark, sf, "orders").select(padded.alias("id")), "id"))


@query(ORACLE_SQL["id_overlap"])
def id_overlap_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """The same from sketches of each year's orders, dealt over so many slots that each counts exactly."""
    padded = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("00"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    files = F.concat(F.lit("orders of "), F.year("o_orderdate").cast("string"))
    left, right = table(spark, sf, "customer").withColumn("id", F.col("c_custkey").cast("string")), table(spark, sf, "orders").withColumn("id", padded)
    slots = max(sketches.slots_for(side, "id") for side in (left, right))
    return sketches.sketched_overlap(sketches.file_sketches(left, "id", F.lit("customers"), slots), sketches.file_sketches(right, "id", files, slots), slots)


@query(r"""WITH i AS (SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_custkey || '.5' WHEN 2 THEN o_orderpriority ELSE 'P' || o_custkey END AS id FROM orders),
s AS (SELECT CASE WHEN regexp_matches(id, '^\d+$') THEN 'digits_len_' || length(id) WHEN regexp_matches(id, '^\d+\.\d+$') THEN 'decimal_string' WHEN regexp_matches(id, '^[A-Za-z]') THEN 'starts_alpha' ELSE 'other_len_' || length(id) END AS shape FROM i)
SELECT shape, count(*) AS n FROM s GROUP BY shape ORDER BY n DESC, shape LIMIT 8""")
def id_shapes(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN o_custkey || '.5' WHEN 2 THEN o_orderpriority ELSE 'P' || o_custkey END")
    return E.shapes(E.id_set(table(spark, sf, "orders").select(raw.alias("id")), "id"))


@query("""SELECT conv_id AS sort_key, CAST(conv_id AS VARCHAR) AS patient_id, 'extracted' AS status, role || ' | ' || turn AS evidence_quotes, replace(text, chr(10), ' ') AS reasoning, '' AS liver_cirrhosis FROM conversations""")
def review_rows(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    results = turns.select(
        F.lit("nan").alias("report_id"), F.lit(None).cast("string").alias("patient_id"), F.col("conv_id").cast("string").alias("source_row_id"), F.lit(" extracted ").alias("status"),
        F.to_json(F.array("role", F.lit(""), F.col("turn").cast("string"))).alias("evidence_quotes"), F.col("text").alias("reasoning"), F.lit("null").alias("liver_cirrhosis"),
    )
    return E.review_rows(results).select(F.col("patient_id").cast("long").alias("sort_key"), "patient_id", "status", "evidence_quotes", "reasoning", "liver_cirrhosis")


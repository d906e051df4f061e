import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.functions import text as X

MARKERS = (("[History]", "history"), ("[Plan]", "plan"))


def column(spark, values, make):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(make(F.col("v"))).collect()]


def test_normalize_and_clean_ids(spark):
    values = ["12345.0", "12345.00", " 12345 ", "12.5", None, "NaN", "none", "null", "-5.0", " x "]
    assert column(spark, values, X.normalize_str) == ["12345", "12345", "12345", "12.5", "", "", "", "null", "-5.0", "x"]
    assert column(spark, values, X.clean_id) == ["12345", "12345.00", "12345", "12.5", "", "", "", "", "-5", "x"]
    assert column(spark, ["nan", "12.0"], X.report_type) == ["", "12.0"]


def plain_clean(s):
    s = unicodedata.normalize("NFC", s).replace("\r\n", "\n").replace("\r", "\n")
    s = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ", s)
    s = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", s))
    return "\n".join(x.rstrip() for x in s.split("\n")).strip()


def test_clean_text(spark):
    values = ["é ä", "a\r\nb\rc", "a\x00b\tc", "a\n \n \n \nb", "  x  \n\n\n\n y ", "", None, " x \ny "]
    assert column(spark, values, X.clean_text) == [plain_clean(v or "") for v in values]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text("ab .!?\n\tÄé-", max_size=40), min_size=20, max_size=20))
def test_sentences_and_view_match_plain(spark, values):
    plain = [[p for p in re.split(r"(?<=[.!?])\s+", v) if p] if v.strip() else [] for v in values]
    assert column(spark, values, X.sentences) == plain
    assert column(spark, values, X.match_view) == [" ".join(re.findall(r"[^\W_]+", v)).lower() for v in values]


def test_phrases_have_boundaries_only_as_single_words(spark):
    view = ["crt dauer", "andere thorakotomie", "fever feverish fever", "no fever"]
    assert column(spark, view, lambda c: X.phrase_count(c, X.phrase_form("crt-d"))) == [1, 0, 0, 0]
    assert column(spark, view, lambda c: X.phrase_count(c, X.phrase_form("re-thorakotomie"))) == [0, 1, 0, 0]
    assert column(spark, view, lambda c: X.phrase_count(c, "fever")) == [0, 0, 2, 1]


def test_windows_are_truncated_at_their_start(spark):
    got = column(spark, ["A b. C d. E f."], lambda c: X.sentence_windows(X.sentences(c), 1, 6))[0]
    assert got == ["A b. …", "A b. …", "C d. …"]
    assert column(spark, ["A b. C d. E f."], lambda c: X.sentence_windows(X.sentences(c), 0))[0] == ["A b.", "C d.", "E f."]


def test_sections(spark):
    values = ["x [History] a [Plan] b [History] c", "none here", "", None]
    ranges = column(spark, values, lambda c: X.section_ranges(c, MARKERS))
    assert [tuple(r) for r in ranges[0]] == [(0, 2, "unknown"), (2, 14, "history"), (14, 23, "plan"), (23, 34, "history")]
    assert [tuple(r) for r in ranges[1]] == [(0, 9, "unknown")]
    assert [tuple(r) for r in ranges[2]] == [(0, 0, "unknown")] == [tuple(r) for r in ranges[3]]
    assert column(spark, values[:1], lambda c: X.split_sections(c, MARKERS))[0] == {"unknown": "x", "history": "[History] a\n[History] c", "plan": "[Plan] b"}
    assert column(spark, values[:1], lambda c: X.section_at(X.section_ranges(c, MARKERS), F.lit(15))) == ["plan"]
    assert column(spark, values[:1], lambda c: X.section_at(X.section_ranges(c, MARKERS), F.lit(99))) == ["unknown"]

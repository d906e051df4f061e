"""Text functions as Column expressions: everything here stays in the JVM but NFC of non-ASCII text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}]+"
_BREAK = r"(?<=[.!?])(?U:\s+)"
ELLIPSIS = "…"


def let(c: Column, make) -> Column:
    """``make`` of a column's value: inside a lambda an expression is evaluated for every element, a
    variable is not."""
    return F.get(F.transform(F.array(c), make), F.lit(0))


def strip(c: Column) -> Column:
    """Trim all Unicode white space (``trim`` alone takes U+0020 only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _blank(c: Column, words: tuple[str, ...]) -> Column:
    s = strip(c)
    return F.when(c.isNull() | F.lower(s).isin(*words), "").otherwise(s)


def normalize_str(c: Column | str) -> Column:
    """Null, "nan" and "none" -> "", trimmed, ``123.0`` and ``123.00`` -> ``123``."""
    s = _blank(_text(c), ("nan", "none"))
    return F.when(s.rlike(r"^\d+\.0+$"), F.substring_index(s, ".", 1)).otherwise(s)


def clean_id(c: Column | str) -> Column:
    """Like ``normalize_str``, but also blanks "null", allows a sign and takes only ``.0``."""
    s = _blank(_text(c), ("nan", "none", "null"))
    return F.when(s.rlike(r"^-?\d+\.0$"), F.substring_index(s, ".", 1)).otherwise(s)


def report_type(c: Column | str) -> Column:
    return _blank(_text(c), ("nan", "none"))


def review_cell(c: Column | str) -> Column:
    return _blank(_text(c), ("nan", "none", "null"))


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def clean_text(c: Column | str, normalize_unicode: bool = True) -> Column:
    """NFC, line ends, control characters, runs of blanks and of blank lines, trailing blanks, ends.

    Blank lines collapse before line ends are stripped, so lines of blanks may leave more than one.
    """
    s = F.coalesce(_text(c), F.lit(""))
    if normalize_unicode:
        s = F.when(s.rlike(r"[^\x00-\x7F]"), _nfc(F.when(s.rlike(r"[^\x00-\x7F]"), s))).otherwise(s)
    for pattern, to in (
        (r"\r\n?", "\n"), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " "), (r"[ \t]+", " "), (r"\n{3,}", "\n\n"), (r"(?U)[^\S\n]+(?=\n|\z)", ""),
    ):
        s = F.regexp_replace(s, pattern, to)
    return strip(s)


def match_view(c: Column | str) -> Column:
    """Words in lower case, one space between; replaced first and lowered last."""
    return F.lower(F.trim(F.regexp_replace(_text(c), r"[^\p{L}\p{N}]+", " ")))


def phrase_form(phrase: str) -> str:
    """The matching view of a phrase, at plan time."""
    return " ".join("".join(ch.lower() for ch in w) for w in re.findall(r"[^\W_]+", phrase))


def phrase_pattern(phrase: str) -> str:
    """Regex of a phrase on the view: one word has boundaries, several words match as a substring."""
    return rf"\Q{phrase}\E" if " " in phrase else rf"(?<![^ ])\Q{phrase}\E(?![^ ])"


def phrase_count(view: Column, phrase: str) -> Column:
    return F.size(F.split(view, phrase_pattern(phrase), -1)) - 1


def sentences(c: Column | str) -> Column:
    """Pieces between sentence ends; none for a blank text."""
    s = _text(c)
    return F.when(strip(s) == "", F.array().cast("array<string>")).otherwise(F.filter(F.split(s, _BREAK, -1), lambda x: x != ""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))  # what is left at the ends is one blank


def truncate(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 1), F.lit(ELLIPSIS))).otherwise(c)


def sentence_windows(parts: Column, around: int = 1, most: int = 400, wanted: Callable[[Column], Column] | None = None) -> Column:
    """For each sentence the text from ``around`` sentences before it to as many behind it; null for
    sentences that are not ``wanted``, whose windows are not built."""
    def window(held: Column, i: Column) -> Column:
        first, count = F.greatest(i - around, F.lit(0)) + 1, F.lit(around + 1) + F.least(i, F.lit(around))
        return truncate(collapse(F.array_join(F.slice(held, first, count), " ")), most)

    chosen = lambda held, s, i: window(held, i) if wanted is None else F.when(wanted(s), window(held, i))
    return let(parts, lambda held: F.transform(held, lambda s, i: chosen(held, s, i)))


def _offsets(text: Column, literal: str) -> Column:
    """Code-point offsets of all occurrences of a literal."""
    def places(pieces: Column) -> Column:
        counts = F.slice(F.transform(pieces, lambda p: F.length(p)), 1, F.size(pieces) - 1)
        begin = F.struct(F.lit(0).alias("behind"), F.array().cast("array<int>").alias("found"))
        step = lambda a, n: F.struct((a["behind"] + n + len(literal)).alias("behind"), F.array_append(a["found"], a["behind"] + n).alias("found"))
        return F.aggregate(counts, begin, step, lambda a: a["found"])

    return let(F.split(text, rf"\Q{literal}\E", -1), places)


def _marked(rank: int, label: str):
    return lambda p: F.struct(p.alias("start"), F.lit(rank).alias("rank"), F.lit(label).alias("label"))


RANGES = "array<struct<start:int,end:int,label:string>>"


def section_ranges(c: Column | str, markers: tuple[tuple[str, str], ...]) -> Column:
    """Half-open ranges from each marker to the next; ``unknown`` before the first, or if there is none."""
    text = F.coalesce(_text(c), F.lit(""))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length(text).alias("end"), F.lit("unknown").alias("label")))
    found = [
        F.transform(_offsets(text, marker), _marked(k, label))
        for k, (marker, label) in enumerate(markers) if marker
    ]
    if not found:
        return whole.cast(RANGES)
    def spread(hits: Column) -> Column:
        starts = F.concat(F.transform(hits, lambda h: h["start"]), F.array(F.length(text)))
        ranges = let(starts, lambda at: F.transform(hits, lambda h, i: F.struct(h["start"].alias("start"), F.get(at, i + 1).alias("end"), h["label"].alias("label"))))
        before = F.filter(F.array(F.struct(F.lit(0).alias("start"), F.get(starts, F.lit(0)).alias("end"), F.lit("unknown").alias("label"))), lambda r: r["end"] > 0)
        return F.when(F.size(hits) == 0, whole.cast(RANGES)).otherwise(F.concat(before.cast(RANGES), ranges.cast(RANGES)))

    return let(F.array_sort(F.concat(*found)), spread)


def section_at(ranges: Column, index: Column) -> Column:
    return F.coalesce(F.get(F.filter(ranges, lambda r: (r["start"] <= index) & (index < r["end"])), F.lit(0))["label"], F.lit("unknown"))


def split_sections(c: Column | str, markers: tuple[tuple[str, str], ...]) -> Column:
    """Map from label to text, in order of first appearance; repeated labels are joined by a line feed."""
    text = F.coalesce(_text(c), F.lit(""))
    parts = F.filter(
        F.transform(section_ranges(text, markers), lambda r: F.struct(r["label"].alias("label"), strip(F.substring(text, r["start"] + 1, r["end"] - r["start"])).alias("text"))),
        lambda p: p["text"] != "",
    )
    def grouped(parts: Column) -> Column:
        labels = F.array_distinct(F.transform(parts, lambda p: p["label"]))
        joined = F.transform(labels, lambda one: F.array_join(F.transform(F.filter(parts, lambda p: p["label"] == one), lambda p: p["text"]), "\n"))
        return F.map_from_arrays(labels, joined)

    return let(parts, grouped)

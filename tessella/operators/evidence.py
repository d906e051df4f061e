"""Rule evidence: phrases with spans and negation, sections, sentence windows, caps, top-k, budgeted text.

Claiming spans greedily (negations first, then the longest phrases) is sequential within a document
and runs in an Arrow UDF over whole batches. One automaton finds the occurrences of all phrases in one pass
over a text (``Finder``), so a task of many phrases costs about what one of few does. Texts without any phrase or
pattern of a task of few never reach it (``may_hit`` is a plain ``rlike``). A text is handled as its list of words: the matching
view has the same words, so places in the view become word numbers by bisection and spans are whole
words by construction. The single steps are also given as DataFrame operators over rows.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.config import Settings
from tessella.functions.text import ELLIPSIS, match_view, phrase_form, sentence_windows, sentences
from tessella.operators import relational
from tessella.operators.staging import small_batches, unused
from tessella.plans.tasks import CONTEXT, NEGATION, POSITIVE, EvidenceGroup, ExtractionTask

NO_EVIDENCE, STRUCTURED = "no_evidence", "structured_evidence"
BY_PATTERN = "__negation__"
UNKNOWN, UNKNOWN_PRIORITY = "unknown", 99
# Order and labels of roles.
ROLE_ORDER = {POSITIVE: 1, CONTEXT: 2, NEGATION: 3}
ROLE_GERMAN = {POSITIVE: "positiv", CONTEXT: "kontext", NEGATION: "verneinung"}
# Headlines, labels and notices of texts as sent, German and other.
HEAD = {True: "Bericht-Evidenz-Snippets:", False: "Report evidence snippets:"}
LABEL = {
    True: "[Abschnitt={section} | Gruppe={group} | Rolle={role} | Priorität={priority}]",
    False: "[section={section} | group={group} | role={role} | priority={priority}]",
}
NOTICE_ENDS = "[HINWEIS: Text von {n} auf ca. {most} Zeichen gekürzt (keine Keyword-Treffer; Anfang + Ende behalten).]\n\n"
NOTICE_SPANS = "[HINWEIS: Diagnoseliste von {n} auf max. {most} Zeichen gekürzt. Nur Abschnittsköpfe und Keyword-Fenster wurden behalten.]\n\n"
BETWEEN, SPAN_LABEL = "\n\n[…]\n\n", "[…chars {a}-{b}…]"
SNIPPET = "struct<section:string,keyword:string,evidence_group:string,role:string,priority:int,text:string>"
BUNDLE = (
    f"struct<original_report_text_length:int,llm_report_text:string,llm_report_text_length:int,reduction_method:string,evidence_snippets:array<{SNIPPET}>,"
    "keyword_hits_count:int,evidence_flags:map<string,boolean>,has_positive_evidence:boolean,has_negation:boolean>"
)
_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"(?<=[.!?])\s+")


@dataclass(frozen=True)
class Phrase:
    text: str
    group: str
    role: str


def flatten_phrases(groups: tuple[EvidenceGroup, ...]) -> list[Phrase]:
    """Phrases in matching form, longest first, in order of declaration among equals."""
    flat = [Phrase(form, g.name, g.role) for g in groups for p in g.phrases if (form := phrase_form(p))]
    return sorted(flat, key=lambda p: -len(p.text))


class View:
    """The words of a text: in lower case with one space between, and where each is in both texts."""

    def __init__(self, text: str):
        found = list(_WORD.finditer(text))
        self.spans = [m.span() for m in found]
        words = ["".join([ch.lower() for ch in m[0]]) for m in found]
        self.text = " ".join(words)
        self.starts, at = [], 0
        for w in words:
            self.starts.append(at)
            at += len(w) + 1

    def words(self, start: int, end: int) -> tuple[int, int]:
        """Numbers of the words that a range of the view touches; a space counts to the word behind it."""
        first = bisect_right(self.starts, start) - 1
        first += start >= self.starts[first] + self._length(first)
        last = bisect_right(self.starts, end - 1) - 1
        last += end - 1 >= self.starts[last] + self._length(last)
        return first, last + 1

    def _length(self, k: int) -> int:
        return (self.starts[k + 1] - 1 if k + 1 < len(self.starts) else len(self.text)) - self.starts[k]


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Spans between sentence ends; none for a blank text."""
    if not text.strip():
        return []
    cuts = [m.span() for m in _GAP.finditer(text)]
    edges = zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(text)])
    return [(a, b) for a, b in edges if a < b] or [(0, len(text))]


def section_spans(text: str, markers: tuple[tuple[str, str], ...]) -> list[tuple[int, int, str]]:
    hits = sorted(((m.start(), k, label) for k, (mark, label) in enumerate(markers) if mark for m in re.finditer(re.escape(mark), text)), key=lambda h: h[0])
    if not hits:
        return [(0, len(text), UNKNOWN)]
    ends = [h[0] for h in hits[1:]] + [len(text)]
    return [(0, hits[0][0], UNKNOWN)] * (hits[0][0] > 0) + [(h[0], end, h[2]) for h, end in zip(hits, ends)]


class Finder:
    """Occurrences of needles in a text by one Aho-Corasick automaton, which each Python worker builds for itself.

    An occurrence that begins within the one before of the same needle is none, but for a blank that both have at an
    end; needles may overlap each other.
    """

    def __init__(self, needles: list[str]):
        self.needles = needles
        self._automaton = None

    def __getstate__(self) -> dict:
        return {"needles": self.needles, "_automaton": None}

    def _built(self):
        from ahocorasick import Automaton

        ranks: dict[str, list[int]] = {}
        for rank, needle in enumerate(self.needles):
            ranks.setdefault(needle, []).append(rank)
        self._automaton = Automaton()
        for needle, held in ranks.items():
            self._automaton.add_word(needle, (len(needle), needle[0] != " ", held))
        self._automaton.make_automaton()
        return self._automaton

    def find(self, text: str) -> list[tuple[int, int]]:
        """``(needle's number, start)``, by number, then start."""
        if not self.needles:
            return []
        found, reach = [], {}
        for last, (size, bare, ranks) in (self._automaton or self._built()).iter(text):  # ascending for each needle
            start = last - size + 1
            if start >= reach.get(ranks[0], 0):
                reach[ranks[0]] = last + bare
                found += [(rank, start) for rank in ranks]
        return sorted(found)


class PhraseFinder:
    """Phrases in the view of a text: one word has boundaries, several words match as a substring."""

    def __init__(self, phrases: list[str]):
        self.phrases = phrases
        self.one = [" " not in p for p in phrases]
        self.finder = Finder([f" {p} " if one else p for p, one in zip(phrases, self.one)])

    def find(self, view: str) -> list[tuple[int, int]]:
        """``(phrase's number, start in the view)``, by number, then start."""
        return [(rank, start if self.one[rank] else start - 1) for rank, start in self.finder.find(f" {view} ")]


class Extractor:
    """A task compiled for the executors; ``bundle`` is a pure function of a text."""

    def __init__(self, task: ExtractionTask, settings: Settings = Settings()):
        self.task, self.settings = task, settings
        self.phrases = flatten_phrases(task.evidence_groups)
        self.finder = PhraseFinder([p.text for p in self.phrases])
        self.patterns = [(re.compile(p, re.S), label) for p, label in task.negation_patterns]
        self.rank = {label: k for k, (_, label) in enumerate(task.section_markers, 1)}
        self.rank.setdefault(UNKNOWN, UNKNOWN_PRIORITY)
        self.groups = [g.name for g in task.evidence_groups]
        self.denials = {g.name for g in task.evidence_groups if g.role == NEGATION}

    def matches(self, text: str, view: View | None = None) -> list[tuple[int, int, Phrase]]:
        """Claimed spans of the text in order, before the cap."""
        view = view or View(text)
        return [(view.spans[first][0], view.spans[last - 1][1], phrase) for first, last, phrase in self.claims(text, view)]

    def claims(self, text: str, view: View) -> list[tuple[int, int, Phrase]]:
        """Claimed words of the text in order, before the cap."""
        claimed, out = bytearray(len(view.spans)), []

        def claim(first: int, last: int, phrase: Phrase) -> None:
            if not any(claimed[first:last]):
                claimed[first:last] = b"\1" * (last - first)
                out.append((first, last, phrase))

        if self.patterns and view.spans:
            heads = [a for a, _ in view.spans]
            for a, b in sentence_spans(text):
                first = bisect_right(heads, a - 1)
                sentence = View(text[a:b])
                for pattern, label in self.patterns:
                    for m in pattern.finditer(sentence.text):
                        if m.end() > m.start():
                            i, j = sentence.words(*m.span())
                            claim(first + i, first + j, Phrase(label, BY_PATTERN, NEGATION))
        for rank, start in self.finder.find(view.text):
            phrase = self.phrases[rank]
            claim(*view.words(start, start + len(phrase.text)), phrase)
        return sorted(out, key=lambda m: m[0])

    def cap(self, matches: list[tuple[int, int, Phrase]]) -> list[tuple[int, int, Phrase]]:
        seen: dict[tuple[str, str], int] = {}
        out = []
        for m in matches:
            key = (m[2].group, m[2].text.lower())
            seen[key] = seen.get(key, 0) + 1
            if seen[key] <= self.settings.max_hits_per_keyword:
                out.append(m)
        return out

    def window(self, text: str, spans: list[tuple[int, int]], at: int) -> str:
        k = max(0, bisect_right(spans, (at, len(text) + 1)) - 1)
        if not spans[k][0] <= at < spans[k][1]:
            k = 0
        around, most = self.settings.window_sentences, self.settings.max_snippet_chars
        chunk = " ".join(text[spans[max(0, k - around)][0] : spans[min(len(spans) - 1, k + around)][1]].split())
        return chunk if len(chunk) <= most else chunk[: most - 1] + ELLIPSIS

    def bundle(self, text: str | None) -> dict:
        text = text or ""
        snippets: list[dict] = []
        hits = 0
        if text.strip() and self.groups:
            found = self.cap(self.matches(text))
            hits = len(found)
            spans, ranges, seen = sentence_spans(text), section_spans(text, self.task.section_markers), set()
            heads = [r[0] for r in ranges]
            for start, _, phrase in found:
                section = ranges[max(0, bisect_right(heads, start) - 1)][2]
                snippet = self.window(text, spans, start)
                key = (section, phrase.group, phrase.text, " ".join(snippet.lower().split())[:200])
                if key not in seen:
                    seen.add(key)
                    snippets.append({"section": section, "keyword": phrase.text, "evidence_group": phrase.group, "role": phrase.role, "priority": 0, "text": snippet})
            snippets.sort(key=lambda s: (self.rank.get(s["section"], UNKNOWN_PRIORITY), ROLE_ORDER[s["role"]], s["text"]))
            snippets = snippets[: self.settings.max_snippets]
            for k, s in enumerate(snippets, 1):
                s["priority"] = k
        flags = {g: False for g in self.groups} | {s["evidence_group"]: True for s in snippets}
        positive = any(s["role"] != NEGATION for s in snippets)
        body = self.assemble(snippets) if positive else ""
        return {
            "original_report_text_length": len(text), "llm_report_text": body, "llm_report_text_length": len(body),
            "reduction_method": STRUCTURED if positive else NO_EVIDENCE, "evidence_snippets": snippets, "keyword_hits_count": hits,
            "evidence_flags": flags, "has_positive_evidence": positive, "has_negation": any(flags[g] for g in self.denials),
        }

    def assemble(self, snippets: list[dict]) -> str:
        """Labelled snippets under a headline; over the budget whole blocks go, from the first that does not fit."""
        german, most = self.task.german, self.settings.max_llm_chars
        head, blocks = HEAD[german], []
        for s in snippets:
            role = ROLE_GERMAN[s["role"]] if german else s["role"]
            label = LABEL[german].format(section=s["section"], group=s["evidence_group"], role=role, priority=s["priority"])
            blocks.append(f"{label}\n{s['text']}\n")
        whole = "\n".join([head, "", *blocks])
        if len(whole) <= most:
            return whole
        kept, used = [head, ""], len(head) + 2
        for block in blocks:
            if used + len(block) > most:
                break
            kept.append(block)
            used += len(block) + 1
        return "\n".join(kept)


FEW = 64  # phrases and patterns up to which an alternation of them is worth its price


def may_hit(task: ExtractionTask, text: Column) -> Column:
    """Whether a phrase or pattern can match at all: one alternation over the matching view.

    With more than ``FEW`` of them it is true: an alternation costs as much for each as the automaton does for all.
    """
    phrases = flatten_phrases(task.evidence_groups)
    if len(phrases) + len(task.negation_patterns) > FEW:
        return F.lit(True)
    parts = [rf"\Q{p.text}\E" for p in phrases] + [f"(?:{p})" for p, _ in task.negation_patterns]
    return match_view(text).rlike("(?s)" + "|".join(parts)) if parts else F.lit(False)


def evidence_column(task: ExtractionTask, text: Column, settings: Settings = Settings()) -> Column:
    """The evidence bundle of a text as a struct."""
    compiled = Extractor(task, settings)
    small_batches(SparkSession.active())

    @F.pandas_udf("string")
    def bundle(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else json.dumps(compiled.bundle(x), ensure_ascii=False))

    text = F.coalesce(text, F.lit(""))
    empty = F.from_json(F.lit(json.dumps(compiled.bundle(""), ensure_ascii=False)), BUNDLE).withField("original_report_text_length", F.length(text))
    hit = may_hit(task, text)
    return F.coalesce(F.from_json(bundle(F.when(hit, text)), BUNDLE), empty)


def with_evidence(df: DataFrame, task: ExtractionTask, text: str = "report_text", settings: Settings = Settings(), into: str = "evidence") -> DataFrame:
    return df.withColumn(into, evidence_column(task, F.col(text), settings))


# --- the single steps over rows ------------------------------------------------------------------
SLICE = 1 << 20  # bytes of texts whose hits a worker holds at a time


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches of keys and texts in parts of ``SLICE`` bytes beside one text at most: a part's hits are few, however large batches come."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // SLICE)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]))


def phrase_hits(df: DataFrame, key: str, text: str, groups: tuple[EvidenceGroup, ...]) -> DataFrame:
    """``key, evidence_group, keyword, n``: occurrences of each phrase that has some, overlaps of phrases allowed.

    One pass over a text for all phrases, however many they are.
    """
    flat = flatten_phrases(groups)
    finder = PhraseFinder([p.text for p in flat])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts = [Counter(rank for rank, _ in finder.find(view)) if view else {} for view in batch.column(1).to_pylist()]
            of = pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))
            ranks = [rank for c in counts for rank in c]
            columns = [batch.column(0).take(of), pa.array([flat[k].group for k in ranks], pa.string()), pa.array([flat[k].text for k in ranks], pa.string()), pa.array([n for c in counts for n in c.values()], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "evidence_group", "keyword", "n"])

    small_batches(df.sparkSession)
    view = df.select(F.col(key), match_view(text).alias("_view"))
    return view.mapInArrow(run, T.StructType([view.schema[key], *[T.StructField(c, T.StringType()) for c in ("evidence_group", "keyword")], T.StructField("n", T.IntegerType())]))


def claimed_hits(df: DataFrame, key: str, text: str, task: ExtractionTask) -> DataFrame:
    """``key, start, end, first_word, n_words, keyword, evidence_group, role, span``: the spans that patterns and phrases claim, each with its text.

    Patterns of negation go first, then phrases, the longest first; words are claimed once.
    """
    compiled = Extractor(task)
    names = ("start", "end", "first_word", "n_words", "keyword", "evidence_group", "role", "span")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            of, rows = [], []
            for k, x in enumerate(batch.column(1).to_pylist()):
                view = View(x)
                for first, last, phrase in compiled.claims(x, view):
                    of.append(k)
                    start, end = view.spans[first][0], view.spans[last - 1][1]
                    rows.append((start, end, first, last - first, phrase.text, phrase.group, phrase.role, x[start:end]))
            columns = [pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(zip(*rows) if rows else [()] * len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *columns], names=[key, *names])

    small_batches(df.sparkSession)
    held = df.select(F.col(key), F.col(text).cast("string").alias("_text")).filter(F.col("_text").isNotNull() & may_hit(task, F.col("_text")))
    return held.mapInArrow(run, T.StructType([held.schema[key], *[T.StructField(c, T.LongType() if k < 4 else T.StringType()) for k, c in enumerate(names)]]))


BIN = 4096  # characters of a text that share a join key


def hits_in_sections(hits: DataFrame, sections: DataFrame, key: str, at: str, into: str = "section") -> DataFrame:
    """``hits`` with the label of the section that holds their place; ``unknown`` outside of all.

    ``sections(key, start, end, label)`` are half-open ranges that do not overlap within a key (``section_ranges`` as rows).
    Both sides meet by key and bin of ``BIN`` characters, an equi-join, in which a long text's rows lie under many keys;
    a section stands once in each bin that it touches.
    """
    names = unused([*hits.columns, into], "_key", "_bin", "_start", "_end")
    own, part, start, end = names
    first, last = (F.floor(c / BIN) for c in (F.col("start"), F.col("end") - 1))
    spread = sections.filter("start < end").select(F.col(key).alias(own), F.explode(F.sequence(first, last)).alias(part), F.col("start").alias(start), F.col("end").alias(end), F.col("label").alias(into))
    found = (F.col(key) == F.col(own)) & (F.floor(F.col(at) / BIN) == F.col(part)) & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    return hits.join(spread, found, "left").withColumn(into, F.coalesce(into, F.lit(UNKNOWN))).drop(*names)


def sentence_rows(df: DataFrame, key: str, text: str, around: int = 1, most: int = 400, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """``key, place, sentence, window`` for every sentence of every text, or for the ``wanted`` ones."""
    windows = sentence_windows(F.col("_parts"), around, most, wanted)
    parts = df.select(F.col(key), sentences(text).alias("_parts")).select(key, "_parts", windows.alias("_windows"))
    zipped = F.arrays_zip(F.col("_parts").alias("sentence"), F.col("_windows").alias("window"))
    rows = parts.select(key, F.posexplode(zipped).alias("place", "x")).select(key, "place", "x.*")
    return rows if wanted is None else rows.filter("window is not null")


def cap_hits(hits: DataFrame, key: str, order: str, most: int = 3) -> DataFrame:
    """At most ``most`` rows of each (key, evidence_group, keyword), the first ones."""
    w = Window.partitionBy(key, "evidence_group", F.lower("keyword")).orderBy(order)
    return hits.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def dedupe_snippets(snippets: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each (key, section, evidence_group, keyword, first 200 characters of the text)."""
    same = F.substring(F.trim(F.regexp_replace(F.lower("text"), r"(?U)\s+", " ")), 1, 200)
    w = Window.partitionBy(key, "section", "evidence_group", "keyword", same).orderBy(order)
    return snippets.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_snippets(snippets: DataFrame, key: str, markers: tuple[tuple[str, str], ...], most: int = 12) -> DataFrame:
    """The ``most`` first by section, role and text, with their ``priority`` from 1."""
    rank = F.lit(UNKNOWN_PRIORITY)
    for k, (_, label) in reversed(list(enumerate(markers, 1))):
        rank = F.when(F.col("section") == label, k).otherwise(rank)
    role = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROLE_ORDER.items() for x in kv]), F.col("role")), F.lit(99))
    w = Window.partitionBy(key).orderBy(rank, role, "text", "keyword")
    return snippets.withColumn("priority", F.row_number().over(w)).filter(F.col("priority") <= most)


# --- texts over the model's budget ---------------------------------------------------------------
_HEADER = re.compile(r"(?m)^(?:\[[^\]]+\]|\d+\.\s+[^\n]{0,120})")
LEAD, REST = 180, 100  # characters kept behind a header; a cut block shorter than this goes


def needles_of(phrases: list[str]) -> Finder:
    """Phrases as they are looked for in a text in lower case, the longest first."""
    return Finder(sorted((p.strip().lower() for p in phrases if p.strip()), key=len, reverse=True))


def hit_spans(text: str, phrases: list[str] | Finder) -> list[tuple[int, int]]:
    """Raw occurrences of phrases, longest first, without overlap and without word boundaries."""
    finder = phrases if isinstance(phrases, Finder) else needles_of(phrases)
    claimed, out = bytearray(len(text) + 1), []
    for rank, at in finder.find(text.lower()):
        end = at + len(finder.needles[rank])
        if not any(claimed[at:end]):
            claimed[at:end] = b"\1" * (end - at)
            out.append((at, end))
    return sorted(out)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals; touching ones merge."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def kept_characters(text: str, phrases: list[str] | Finder, around: int) -> np.ndarray:
    """A mark for each character: near a phrase, or in a header or the beginning of its entry."""
    ranges = [(a - around, b + around) for a, b in hit_spans(text, phrases)] + [(m.start(), m.end() + LEAD) for m in _HEADER.finditer(text)]
    depth = np.zeros(len(text) + 1, np.int64)
    if ranges:
        np.add.at(depth, np.clip([a for a, _ in ranges], 0, len(text)), 1)
        np.add.at(depth, np.clip([b for _, b in ranges], 0, len(text)), -1)
    return np.cumsum(depth[:-1]) > 0


def fit_text(text: str, task: ExtractionTask, most: int | None = None, settings: Settings = Settings(), finder: Finder | None = None) -> tuple[str, bool]:
    """The text within the budget, and whether it was shortened. The notice comes on top of the budget."""
    most = settings.max_full_text_chars if most is None else most
    if len(text) <= most:
        return text, False
    kept = kept_characters(text, finder or [p for g in task.evidence_groups for p in g.phrases], settings.full_text_window_chars)
    numbers = {"n": len(text), "most": most}
    if not kept.any():
        behind = max(0, most - most // 2 - 80)
        ends = text[: most // 2] + BETWEEN + text[len(text) - (behind or len(text)) :]
        return NOTICE_ENDS.format(**numbers) + ends[:most], True
    edges = np.flatnonzero(np.diff(kept.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
    blocks = [f"{SPAN_LABEL.format(a=a, b=b)}\n{chunk}\n\n" for a, b in edges if (chunk := text[a:b].strip())]
    reach = np.cumsum([0, *map(len, blocks)])  # blocks go whole as long as they fit, the next one in part
    whole = int(np.searchsorted(reach, most, side="right")) - 1
    spare = most - int(reach[whole])
    return NOTICE_SPANS.format(**numbers) + "".join([*blocks[:whole], *[x[:spare] for x in blocks[whole : whole + 1] if spare > REST]]), True


def fit_column(task: ExtractionTask, text: Column, most: int | None = None, settings: Settings = Settings()) -> Column:
    """Struct ``text, shortened``; only texts over the budget leave the JVM."""
    most = settings.max_full_text_chars if most is None else most

    finder = needles_of([p for g in task.evidence_groups for p in g.phrases])
    small_batches(SparkSession.active())

    @F.pandas_udf("string")
    def fit(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else fit_text(x, task, most, settings, finder)[0])

    text = F.coalesce(text, F.lit(""))
    long = F.length(text) > most
    return F.struct(F.coalesce(fit(F.when(long, text)), text).alias("text"), long.alias("shortened"))


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Gaps and islands: the union of the intervals of each key; touching intervals merge.

    Two levels: a key's intervals are numbered by ranges and taken ``relational.INTERVALS`` at a time; each such block
    needs only the furthest end, and then the number of islands, of the blocks before it. So one key's intervals lie in many tasks.
    """
    rows = relational.numbered_within(df, keys, [start, end], "_rn", "_of").withColumn("_block", F.floor((F.col("_rn") - 1) / relational.INTERVALS))
    within = Window.partitionBy(*keys, "_block").orderBy("_rn")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    def from_blocks(rows: DataFrame, value: Column, into: str, whole: Callable[[Column], Column]) -> DataFrame:
        """What an aggregate says of all blocks before a row's own."""
        known = rows.groupBy(*keys, "_block").agg(whole(value).alias("_v")).withColumn(into, whole(F.col("_v")).over(before))
        known = known.select(*[F.col(k).alias(f"_{n}_key") for n, k in enumerate(keys)], F.col("_block").alias("_of_block"), into)
        same = [F.col(k).eqNullSafe(F.col(f"_{n}_key")) for n, k in enumerate(keys)]
        return rows.join(known, reduce(lambda a, b: a & b, [*same, F.col("_block") == F.col("_of_block")])).drop("_of_block", *[f"_{n}_key" for n in range(len(keys))])

    rows = from_blocks(rows, F.col(end), "_reach", F.max)
    reach = F.greatest("_reach", F.max(end).over(within.rowsBetween(Window.unboundedPreceding, -1)))
    rows = from_blocks(rows.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1)), F.col("_new"), "_islands", F.sum)
    island = F.coalesce("_islands", F.lit(0)) + F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def settings_with(**changes) -> Settings:
    return replace(Settings(), **changes)

"""The extractor against a naive version that marks single characters, and the traps of the format."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.config import Settings
from tessella.operators import evidence as E
from tessella.plans.tasks import CONTEXT, NEGATION, EvidenceGroup, ExtractionTask, load_task

DEMO, CARDIO, CORPUS = load_task("demo_extraction"), load_task("cardiology_smoke"), load_task("corpus_notices")


def naive_matches(text, task):
    """Every position tried, spans as character sets: slow and plain."""
    spans = [m.span() for m in re.finditer(r"[^\W_]+", text)]
    words = [text[a:b].lower() for a, b in spans]
    taken, out = set(), []

    def claim(i, j, label, group, role):
        a, b = spans[i][0], spans[j - 1][1]
        if not taken & set(range(a, b)):
            taken.update(range(a, b))
            out.append((a, b, label, group, role))

    def word_at(view_words, offset):
        at = 0
        for k, w in enumerate(view_words):
            if offset < at + len(w) + (k + 1 < len(view_words)):
                return k if offset < at + len(w) else k + 1
            at += len(w) + 1
        return len(view_words) - 1

    for a, b in E.sentence_spans(text):
        inside = [k for k, s in enumerate(spans) if a <= s[0] < b]
        view = " ".join(words[k] for k in inside)
        for pattern, label in task.negation_patterns:
            for m in re.finditer(pattern, view, re.S):
                mine = [words[k] for k in inside]
                claim(inside[word_at(mine, m.start())], inside[word_at(mine, m.end() - 1)] + 1, label, E.BY_PATTERN, NEGATION)
    flat = [(E.phrase_form(p), g.name, g.role) for g in task.evidence_groups for p in g.phrases]
    view = " ".join(words)
    for phrase, group, role in sorted(flat, key=lambda x: -len(x[0])):
        at = 0
        while at + len(phrase) <= len(view):
            if view[at : at + len(phrase)] == phrase and (" " in phrase or ((at == 0 or view[at - 1] == " ") and view[at + len(phrase) : at + len(phrase) + 1] in ("", " "))):
                claim(word_at(words, at), word_at(words, at + len(phrase) - 1) + 1, phrase, group, role)
                at += len(phrase)
            else:
                at += 1
    return sorted(out)


@pytest.mark.parametrize("task", [DEMO, CARDIO])
def test_matches_equal_the_naive_version(task):
    rnd = random.Random(3)
    pieces = [p for g in task.evidence_groups for p in g.phrases] + ["no", "kein", "keine", "ohne", "and", "Fieber,", ".", "!", "-", "[Plan]", "\n", "  ", "andere", "dauer", "without", "x"]
    for _ in range(400):
        text = "".join(rnd.choice(pieces) + rnd.choice([" ", " ", "-", ". ", ""]) for _ in range(rnd.randint(0, 25)))
        got = [(a, b, p.text, p.group, p.role) for a, b, p in E.Extractor(task).matches(text)]
        assert sorted(got) == naive_matches(text, task)


def naive_spans(text, phrases):
    lower, taken, out = text.lower(), set(), []
    for p in sorted((p.strip().lower() for p in phrases if p.strip()), key=len, reverse=True):
        at = 0
        while at + len(p) <= len(lower):
            if lower[at : at + len(p)] != p:
                at += 1
                continue
            if not taken & set(range(at, at + len(p))):
                taken.update(range(at, at + len(p)))
                out.append((at, at + len(p)))
            at += len(p)
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_many_phrases_equal_the_naive_versions(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 3)))
    phrases = [" ".join(word() for _ in range(rnd.choice([1, 1, 2, 2, 3]))) for _ in range(60)]
    groups = tuple(EvidenceGroup(f"g{k}", tuple(phrases[k::6]), CONTEXT if k % 2 else NEGATION) for k in range(6))
    task = ExtractionTask(name="many", evidence_groups=groups, negation_patterns=((r"\bab\b.{0,5}?\ba\b", "ab_a"), (r"b{2}", "bb")))
    finder = E.needles_of(phrases)
    for _ in range(150):
        text = " ".join(word() + rnd.choice(["", "", ".", ", "]) for _ in range(rnd.randint(0, 40)))
        assert sorted((a, b, p.text, p.group, p.role) for a, b, p in E.Extractor(task).matches(text)) == naive_matches(text, task)
        assert E.hit_spans(text, finder) == E.hit_spans(text, phrases) == naive_spans(text, phrases)


def naive_bundle(text, task, settings=Settings()):
    """The whole bundle by the rules, one after the other, from the naive matches."""
    text = text or ""
    cuts = [m.span() for m in re.finditer(r"(?<=[.!?])\s+", text)]
    pieces = [p for p in zip([0] + [b for _, b in cuts], [a for a, _ in cuts] + [len(text)]) if p[0] < p[1]] if text.strip() else []
    marks = sorted([(m.start(), n, label) for n, (mark, label) in enumerate(task.section_markers) for m in re.finditer(re.escape(mark), text)], key=lambda x: x[0])
    counts, hits, snippets = {}, 0, []
    for start, _, label, group, role in naive_matches(text, task) if text.strip() else []:
        counts[group, label.lower()] = counts.get((group, label.lower()), 0) + 1
        if counts[group, label.lower()] > settings.max_hits_per_keyword:
            continue
        hits += 1
        section = ([x[2] for x in marks if x[0] <= start] or ["unknown"])[-1]
        at = next((n for n, (a, b) in enumerate(pieces) if a <= start < b), 0)
        chunk = " ".join(text[pieces[max(0, at - settings.window_sentences)][0] : pieces[min(len(pieces) - 1, at + settings.window_sentences)][1]].split())
        chunk = chunk if len(chunk) <= settings.max_snippet_chars else chunk[: settings.max_snippet_chars - 1] + "…"
        known = (section, group, label, " ".join(chunk.lower().split())[:200])
        if known not in [s[0] for s in snippets]:
            snippets.append((known, {"section": section, "keyword": label, "evidence_group": group, "role": role, "text": chunk}))
    labels = [label for _, label in task.section_markers]
    last = {label: n + 1 for n, label in enumerate(labels)} | {"unknown": 99} if "unknown" not in labels else {label: n + 1 for n, label in enumerate(labels)}
    roles = ["positive", "context", "negation"]
    ranked = sorted([s for _, s in snippets], key=lambda s: (last.get(s["section"], 99), roles.index(s["role"]), s["text"]))[: settings.max_snippets]
    found = [dict(s, priority=n + 1) for n, s in enumerate(ranked)]
    positive = any(s["role"] != "negation" for s in found)
    body = ""
    if positive:
        blocks = []
        for s in found:
            names = ("Abschnitt", "Gruppe", "Rolle", "Priorität", {"positive": "positiv", "context": "kontext", "negation": "verneinung"}[s["role"]]) if task.german else ("section", "group", "role", "priority", s["role"])
            blocks.append(f"[{names[0]}={s['section']} | {names[1]}={s['evidence_group']} | {names[2]}={names[4]} | {names[3]}={s['priority']}]\n{s['text']}\n")
        body = ("Bericht-Evidenz-Snippets:" if task.german else "Report evidence snippets:") + "\n"
        if len("\n".join([body, *blocks])) > settings.max_llm_chars:
            size = len(body) + 1
            for n, block in enumerate(blocks):
                if size + len(block) > settings.max_llm_chars:
                    blocks = blocks[:n]
                    break
                size += len(block) + 1
        body = "\n".join([body, *blocks])
    flags = {g.name: any(s["evidence_group"] == g.name for s in found) for g in task.evidence_groups} | {s["evidence_group"]: True for s in found}
    return {
        "original_report_text_length": len(text), "llm_report_text": body, "llm_report_text_length": len(body), "reduction_method": "structured_evidence" if positive else "no_evidence",
        "evidence_snippets": found, "keyword_hits_count": hits, "evidence_flags": flags, "has_positive_evidence": positive,
        "has_negation": any(flags[g.name] for g in task.evidence_groups if g.role == NEGATION),
    }


def naive_fit(text, task, most, settings=Settings()):
    """A text within the budget, character by character."""
    if len(text) <= most:
        return text
    around, near = settings.full_text_window_chars, [False] * len(text)
    ranges = [(a - around, b + around) for a, b in naive_spans(text, [p for g in task.evidence_groups for p in g.phrases])]
    ranges += [(m.start(), m.end() + 180) for m in re.finditer(r"^(?:\[[^\]]+\]|\d+\.\s+[^\n]{0,120})", text, re.M)]
    for a, b in ranges:
        for k in range(max(0, a), min(len(text), b)):
            near[k] = True
    if not any(near):
        behind = max(0, most - most // 2 - 80) or len(text)
        return f"[HINWEIS: Text von {len(text)} auf ca. {most} Zeichen gekürzt (keine Keyword-Treffer; Anfang + Ende behalten).]\n\n" + (text[: most // 2] + "\n\n[…]\n\n" + text[-behind:])[:most]
    out, k = "", 0
    while k < len(text):
        z = k
        while z < len(text) and near[z] == near[k]:
            z += 1
        if near[k] and text[k:z].strip():
            block = f"[…chars {k}-{z}…]\n{text[k:z].strip()}\n\n"
            if len(out) + len(block) > most:
                out += block[: most - len(out)] if most - len(out) > 100 else ""
                break
            out += block
        k = z
    return f"[HINWEIS: Diagnoseliste von {len(text)} auf max. {most} Zeichen gekürzt. Nur Abschnittsköpfe und Keyword-Fenster wurden behalten.]\n\n" + out


@pytest.mark.parametrize("task", [DEMO, CARDIO, CORPUS])
def test_bundles_and_budgets_equal_the_naive_versions(task):
    rnd = random.Random(8)
    pieces = [p for g in task.evidence_groups for p in g.phrases] + [m for m, _ in task.section_markers] + ["no", "kein", "without", "lorem", "ipsum", "dolor"] * 4 + ["1. ", "\n[#1 | time=x]\n", "\n2. Entry\n"]
    for k in range(120):
        text = "".join(rnd.choice(pieces) + rnd.choice([" ", " ", " ", ". ", "! ", "\n"]) for _ in range(rnd.randint(0, 150)))
        settings = rnd.choice([Settings(), Settings(max_llm_chars=700, max_snippets=5), Settings(max_hits_per_keyword=1, window_sentences=0, max_snippet_chars=40)])
        assert E.Extractor(task, settings).bundle(text) == naive_bundle(text, task, settings)
        for most in (300, 800):
            small = Settings(full_text_window_chars=rnd.choice([5, 60]))
            assert E.fit_text(text, task, most, small)[0] == naive_fit(text, task, most, small)


def test_negation_only_is_no_evidence():
    b = E.Extractor(DEMO).bundle("Patient is afebrile. No fever documented.")
    assert b["has_negation"] and not b["has_positive_evidence"] and b["reduction_method"] == E.NO_EVIDENCE and b["llm_report_text"] == ""


def test_pattern_negation_claims_first_and_is_not_a_declared_group():
    b = E.Extractor(DEMO).bundle("No sign of fever today.")
    assert b["evidence_flags"][E.BY_PATTERN] and not b["has_negation"] and not b["evidence_flags"]["fever_terms"]


def test_section_label_and_priority():
    b = E.Extractor(DEMO).bundle("[History]\nhigh fever.\n[Plan]\nchills.")
    assert [(s["section"], s["keyword"], s["priority"]) for s in b["evidence_snippets"]] == [("history", "high fever", 1), ("plan", "chills", 2)]
    assert b["llm_report_text"].startswith("Bericht-Evidenz-Snippets:\n\n[Abschnitt=history | Gruppe=fever_terms | Rolle=positiv | Priorität=1]")


def test_caps_and_hits_before_dedupe():
    b = E.Extractor(DEMO).bundle("fever. " * 10)
    assert b["keyword_hits_count"] == 3
    assert len(b["evidence_snippets"]) == 2  # the windows of the second and third sentence are equal


def test_first_declared_group_claims_equal_phrases():
    found = E.Extractor(CARDIO).bundle("Rethorakotomie erfolgte.")["evidence_snippets"]
    assert [s["evidence_group"] for s in found] == ["reeingriff"]
    mini = CARDIO.for_variable(next(v for v in CARDIO.variables if v.name == "rethoracotomy"))
    assert [g.name for g in mini.evidence_groups] == ["reeingriff", "rethorakotomie", "verneinung"]


def test_hyphens_lose_boundaries():
    assert E.Extractor(CARDIO).bundle("CRT Dauer")["evidence_snippets"][0]["keyword"] == "crt d"
    assert E.Extractor(CARDIO).bundle("andere Thorakotomie")["evidence_snippets"][0]["keyword"] == "re thorakotomie"


def test_budget_of_snippets():
    task = ExtractionTask(name="t", evidence_groups=(EvidenceGroup("g", ("alpha", "beta", "gamma")),))
    text = "alpha one. x y z. q r s. beta two. x y z. q r s. gamma three."
    small = E.Extractor(task, Settings(max_llm_chars=150)).bundle(text)
    assert len(small["llm_report_text"]) <= 150 and small["llm_report_text"].count("[section=") == 1
    assert E.Extractor(task).bundle(text)["llm_report_text"].count("[section=") == 3


def test_empty_bundles():
    for text in ("", None, "   "):
        b = E.Extractor(DEMO).bundle(text)
        assert b["keyword_hits_count"] == 0 and b["evidence_flags"] == {"fever_terms": False, "associated_symptoms": False, "fever_negation": False}
    assert E.Extractor(ExtractionTask(name="n")).bundle("fever")["evidence_snippets"] == []


def test_column_equals_plain_bundles(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(200)
    got = E.with_evidence(docs, CORPUS, "text").collect()
    for r in got:
        assert r["evidence"].asDict(recursive=True) == naive_bundle(r["text"], CORPUS)


def test_row_operators(spark):
    df = spark.createDataFrame([(1, 0, "g", "k", "s", "positive", "A"), (1, 1, "g", "K", "s", "positive", "a "), (1, 2, "g", "k", "s", "context", "b"), (1, 3, "g", "k", "u", "positive", "c")], "id int, at int, evidence_group string, keyword string, section string, role string, text string")
    assert E.cap_hits(df, "id", "at", 3).count() == 3
    assert E.dedupe_snippets(df.withColumn("keyword", F.lower("keyword")), "id", "at").count() == 3
    assert [r["text"] for r in E.top_snippets(df, "id", (("[S]", "s"),), 3).orderBy("priority").collect()] == ["A", "a ", "b"]
    assert CONTEXT == "context"


def test_fit_text():
    task = DEMO
    assert E.fit_text("short", task) == ("short", False)
    text = "lorem ipsum " * 3000 + "[#1 | time=x]\nhigh fever noted\n" + "lorem ipsum " * 3000
    out, cut = E.fit_text(text, task, 4000)
    assert cut and "high fever" in out and len(out) <= 4000 + 200 and out.startswith("[HINWEIS:")
    none, cut = E.fit_text("y" * 9000, task, 4000)
    assert cut and "\n\n[…]\n\n" in none and len(none) <= 4000 + none.index("\n\n") + 2
    assert E.hit_spans("initial", ["tia"]) == [(3, 6)]  # no word boundaries here
    assert E.merge_spans([(5, 9), (0, 2), (2, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_fit_column(spark):
    values = ["short", "fever " * 1000, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r[0]) for r in df.select(E.fit_column(DEMO, F.col("v"), 2000)).collect()]
    assert got == [(naive_fit(v or "", DEMO, 2000), len(v or "") > 2000) for v in values]


def test_merge_intervals(spark):
    df = spark.createDataFrame([(1, 0, 2), (1, 2, 3), (1, 5, 9), (1, 6, 7), (2, 1, 1)], "k int, start int, end int")
    assert sorted(map(tuple, E.merge_intervals(df, ["k"]).select("k", "start", "end").collect())) == [(1, 0, 3), (1, 5, 9), (2, 1, 1)]


def test_hits_are_held_for_a_part_of_a_batch(spark, monkeypatch):
    texts = ["fever and chills " * k for k in (20, 0, 7, 600, 3, 0, 900, 5)] + ["high fever"] * 2000 + [""] * 3
    df = spark.createDataFrame([(1, "x")], "k long, t string")
    runs = []
    with monkeypatch.context() as m:
        m.setattr(type(df), "mapInArrow", lambda self, run, schema: runs.append(run))
        E.claimed_hits(df, "k", "t", DEMO)
        E.phrase_hits(df, "k", "t", DEMO.evidence_groups)
    monkeypatch.setattr(E, "SLICE", 4096, raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    for run in runs:
        parts = [part.to_pylist() for part in run(iter([batch, batch.slice(0, 0), batch.slice(1, 1)]))]
        alone = [x for k in range(len(texts)) for x in next(run(iter([batch.slice(k, 1)]))).to_pylist()]
        assert all(sum(len(texts[k]) for k in sorted({x["k"] for x in part}, key=lambda k: len(texts[k]))[:-1]) <= E.SLICE for part in parts)
        assert [x for part in parts for x in part] == alone and len({x["k"] for x in alone}) == 2006
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000

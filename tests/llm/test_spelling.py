"""Operator 11 against a plain version."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import queries
from tessella.llm import spelling as S

from .helpers import empty_docs, odd_docs


def plain_counts(docs, least=7):
    found = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return found


def one_apart(a, b):
    """Whether one inserted, deleted or replaced code point sets a and b apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(docs, least=7, count=2, times=10):
    """Rows (word, form, root, n, n_near, form_n)."""
    n = {w: c for w, c in plain_counts(docs, least).items() if c >= count}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {w: min((v for v in near[w] if n[v] >= times * n[w]), key=lambda v: (-n[v], v), default=None) for w in n}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n]


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
key = lambda rows: sorted((tuple(r) for r in rows), key=repr)


def misspelt(n, seed):
    """Texts over words whose edits, edits of edits and repeats stand beside them."""
    rnd = random.Random(seed)
    letters = "aabé÷"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, 10))) for _ in range(12)] + ["aaaaaaa", "ababababab", "x" * 300]

    def edit(w):
        k, kind = rnd.randrange(len(w) + 1), rnd.randrange(3)
        return w[:k] + rnd.choice(letters) * (kind != 1) + w[k + (kind > 0) :]

    once = {w: [edit(w) for _ in range(6)] for w in base}
    twice = {w: [edit(v) for v in once[w] for _ in range(2)] for w in base}
    out = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 60)):
            w = rnd.choice(base)
            pool = rnd.choices([[w], once[w], twice[w]], [30, 3, 1])[0]
            words.append(rnd.choice(pool))
        out.append("".join(x.upper() if rnd.random() < 0.1 and x.isascii() else x + rnd.choice([" ", "\n", "1", "ā", "中"]) for x in words))
    return out


def test_groups_equal_brute_force(spark, monkeypatch):
    docs = odd_docs(spark, misspelt(300, 1)).repartition(3)
    want = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = S.spelling_groups(docs)
    assert got.columns == COLUMNS and key(got.collect()) == key(want)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    monkeypatch.setattr(S, "HELD_WORDS", 5)
    want = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 1, 2)
    assert key(S.spelling_groups(docs, 4, 1, 2).collect()) == key(want)


def test_query_equals_brute_force(spark, sf):
    """Every row of the table is counted; near words by deletions, which two words one edit apart share."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n = {w: c for w, c in plain_counts(docs).items() if c >= 2}
    less = {}
    for w in n:
        for v in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            less.setdefault(v, set()).add(w)
    links = {w: {v for d in (w, *(w[:k] + w[k + 1 :] for k in range(len(w)))) for v in less[d] if one_apart(w, v)} for w in n}
    got = {r["word"]: r for r in queries.op11_spelling_variants(spark, sf).collect()}
    assert {w: r["n"] for w, r in got.items()} == n and {w: r["n_near"] for w, r in got.items()} == {w: len(x) for w, x in links.items()}
    for w, r in got.items():
        best = min(((-n[v], v) for v in links[w] if n[v] >= 10 * n[w]), default=(None, None))
        assert (r["form"], r["form_n"]) == (best[1], n.get(best[1])) and r["root"] == (got[r["form"]]["root"] if r["form"] else w)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("abc", min_size=4, max_size=12), min_size=1, max_size=30, unique=True), st.integers(2, 7), st.integers(1, 4))
def test_words_one_edit_apart_share_a_key(words, part, nxt):
    counts = Counter(w[k : k + 2] for w in words for k in range(len(w) - 1))
    rank = {g: k for k, (_, g) in enumerate(sorted((n, g) for g, n in counts.items()))}
    keys = {w: S.rare_keys(w, rank, 3, part, nxt) for w in words}
    assert all(keys[a] & keys[b] for a in words for b in words if one_apart(a, b))


@pytest.mark.parametrize("length", [1, 2, 5])
def test_roots_of_chains(spark, length):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(length)] + [("other", "w1")]
    got = {r["word"]: r["root"] for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: f"w{length}" for w, _ in chain}


def test_no_words(spark):
    assert S.spelling_groups(empty_docs(spark)).count() == 0 and S.spelling_groups(spark.createDataFrame([(1, "a few")], "doc_id long, text string")).count() == 0
    assert S.long_words(None, None) == []

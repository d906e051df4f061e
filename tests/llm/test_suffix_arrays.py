"""Operator 13 against a plain version."""

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import queries
from tessella.llm import suffix_arrays as A
from tessella.llm.words import plain_texts, plain_words, word_hashes

from .helpers import empty_docs, odd_docs


def plain_contamination(docs, items, window):
    """Rows (doc_id, n_words, n_hit, ids) by looking every item window up in every document's windows."""
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = plain_words((text or "").encode())
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(name)
    sizes = {len(w) for w in windows}
    out = []
    for d, text in docs:
        w = plain_words((text or "").encode())
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (names := windows.get(tuple(w[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    found |= {str(n) for n in names if n is not None}
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def digest(row):
    d, n, hit, found = row
    return d, n, hit, len(found), sha256(",".join(found).encode()).hexdigest(), hit > 0


key = lambda rows: sorted((tuple(r) for r in rows), key=repr)


def planted(n, seed, vocabulary=60):
    """Items, some of few words, alike or nested, and documents that hold stretches of them."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["A", "b", "É", "c3"]) + str(rnd.randint(0, vocabulary))
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 2, 3, 9, 10, 11, 30])))) for k in range(12)]
    items += [(20, items[3][1]), (21, items[-1][1] + " " + items[3][1]), (22, None), (23, ""), (24, "-- !"), (None, items[5][1]), (9, items[4][1]), (9, items[4][1]), (100, "long " * 50)]
    docs = []
    for k in range(n):
        body = [word() for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 5))
            at = rnd.randint(0, len(body))
            body[at:at] = w[a : a + rnd.randint(1, 30)]
        docs.append((k, rnd.choice([" ", "\n", "; "]).join(body)))
    return docs, items


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=8), st.integers(1, 20))
def test_arrays_are_sorted(texts, depth):
    hashes, bounds = word_hashes(plain_texts(pa.array([" ".join(t) for t in texts], pa.string())))
    array = A.SuffixArray(hashes, bounds, depth)
    of = {h: s for h, s in zip(array.hashes.tolist(), array.symbol.tolist())}
    flat = [s for t in texts for s in [*(of[int(word_hashes(pa.array([w]))[0][0])] for w in t), 0]]
    assert flat == array.symbol.tolist() and sorted(array.order.tolist()) == [k for k, s in enumerate(flat) if s]
    suffix = lambda k: flat[k : flat.index(0, k)][:depth]
    assert [suffix(k) for k in array.order.tolist()] == sorted(suffix(k) for k in array.order.tolist())


@pytest.mark.parametrize("window,shard,block", [(10, 1 << 20, 1 << 20), (10, 300, 200), (3, 500, 1 << 20), (1, 1 << 20, 100), (40, 1 << 20, 1 << 20)])
def test_hits_equal_brute_force(spark, window, shard, block):
    docs, items = planted(60, 3)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).unionByName(odd_docs(spark, [docs[0][1]] * 3).select("doc_id", "text"))
    listed = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    want = plain_contamination([(r["doc_id"], r["text"]) for r in table.collect()], items, window)
    found = A.find_items(table, listed, window, shard, block).collect()
    assert key((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == key(want)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in found) and any(r["n_hit"] for r in found)
    assert key(A.contamination(table, listed, window=window, shard_bytes=shard, block_bytes=block).collect()) == key(map(digest, want))


def test_query_equals_brute_force(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = [digest(r) for r in plain_contamination([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items], 10)]
    got = queries.op13_benchmark_decontamination(spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"] and key(got.collect()) == key(want) and any(r[5] for r in want)


def test_longest_matches(spark):
    docs, items = planted(40, 5)
    table = spark.createDataFrame(docs + [(None, items[4][1])], "doc_id long, text string").repartition(3)
    want = {}
    for name, text in items:
        w = plain_words((text or "").encode())
        for d, body in docs + [(None, items[4][1])]:
            b = plain_words(body.encode())
            for i in range(len(w)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(w) and j + n < len(b) and w[i + n] == b[j + n]:
                        n += 1
                    if name is not None and n >= min(5, len(w)):
                        rank = (-n, i, d is None, d or 0, j)
                        want[str(name)] = min(want.get(str(name), rank), rank)
    for shard in (200, 1 << 20):
        got = A.longest_matches(table, spark.createDataFrame(items, "item_id long, text string"), 5, shard, 150).collect()
        assert {r["item_id"]: (-r["length"], r["item_start"], r["doc_id"] is None, r["doc_id"] or 0, r["doc_start"]) for r in got} == want


def test_symbols_alone_decide_nothing(spark, monkeypatch):
    monkeypatch.setattr(A, "_symbols", lambda hashes: (hashes % np.uint64(3)).astype(np.int64) + 1)
    docs, items = planted(30, 6)
    small = A.Shard(pa.array([t for _, t in docs]), 10)
    small.search(A.items_of([str(i) if i is not None else None for i, _ in items], pa.array([t or "" for _, t in items]), 10))
    n_words, n_hit, names, _ = small.results()
    assert [(d, n, h, x) for (d, _), n, h, x in zip(docs, n_words.tolist(), n_hit.tolist(), names)] == plain_contamination(docs, items, 10)


def test_clean_documents_and_empty_tables(spark):
    docs, items = planted(40, 7)
    table = odd_docs(spark, [t for _, t in docs]).withColumnRenamed("fp", "_row_key")
    listed = spark.createDataFrame(items, "item_id long, text string")
    bad = {(r[0], r[1]) for r in [(d, n) for d, n, hit, _ in plain_contamination([(r["doc_id"], r["text"]) for r in table.collect()], items, 10) if hit]}
    kept = A.clean_documents(table, listed)
    assert kept.columns == table.columns
    rest = [r for r in table.collect() if (r["doc_id"], len(plain_words((r["text"] or "").encode()))) not in bad]
    assert key(kept.collect()) == key(rest) and len(rest) < table.count()
    assert A.find_items(empty_docs(spark), listed).count() == 0
    assert {r["n_hit"] for r in A.find_items(table, listed.limit(0)).collect()} == {0}

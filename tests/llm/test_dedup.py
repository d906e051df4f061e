import hashlib
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import common
from tessella.llm import embedding_dedup as V
from tessella.llm import line_dedup as L
from tessella.llm import near_copies as N
from tessella.llm import sharding as S
from tessella.llm import simhash as H
from tessella.llm import substring_dedup as D
from tessella.llm import words
from tessella.llm.components import connected_components
from tessella.llm.words import word_hashes

from .helpers import empty_docs, odd_docs, random_texts


def union_find(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- components ----------------------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rnd = random.Random(2)
    n = 300
    edges = {"path": [(k, k + 1) for k in range(n)], "star": [(n, k) for k in range(n)], "random": [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n // 2)]}[kind]
    rnd.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([*edges, (7, 7), (None, 3), edges[0]], "a long, b long")).collect()}
    want = union_find(edges, {x for e in edges for x in e})
    assert got == {k: v for k, v in want.items() if k in got} and set(want) - set(got) <= {a for a, b in edges if a == b}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- words ---------------------------------------------------------------------------------------
def test_word_hashes_by_words():
    texts = ["a b", None, "", " b\ta ", "x" * 3_000_000 + " a", "é a\x0bb c", "b" * 40]
    hashes, bounds = words.word_hashes(pa.array(texts))
    split = [(t or "").encode().split() for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in split]
    seen = {}
    for w, h in zip([w for s in split for w in s], hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    part, _ = words.word_hashes(pa.array(texts)[3:4])
    assert part.tolist() == [seen[b"b"], seen[b"a"]]
    assert words.rolling(hashes[:2], 3).tolist() == [] and len(words.within(bounds, 2)[0]) == 5


# --- op4: lines ----------------------------------------------------------------------------------
def brute_lines(docs, window=3):
    seen, out = {}, []
    rows = sorted({(d["doc_id"], d["text"]) for d in docs}, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in rows:
        lines = (t or "").split("\n")
        for k in range(len(lines) - window + 1):
            seen.setdefault(tuple(lines[k : k + window]), (d, t, k))
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = {p for k in range(len(lines) - window + 1) if seen[tuple(lines[k : k + window])] != (d, t, k) for p in range(k, k + window)}
        out.append((d, t, None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(4)
    bodies = ["\n".join(rnd.choice(["", "one", "two ", "three", "four"]) for _ in range(rnd.randint(0, 12))) for _ in range(120)]
    docs = odd_docs(spark, [*bodies, *bodies[:5]]).filter("doc_id is null or doc_id != 1")
    out = L.dedup_lines(docs.withColumn("before", F.col("text")))
    assert out.columns == [*docs.columns, "before", "_n_lines", "_n_removed"] and out.count() == docs.count()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or "")
    assert sorted(((r["doc_id"], r["before"], r["text"], r["_n_removed"]) for r in out.collect()), key=key) == sorted(brute_lines(docs.collect()), key=key)


def test_repeated_rows_keep_their_lines(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc")] * 3 + [(2, "x\na\nb\nc\ny"), (3, "q\n" * 4)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in L.dedup_lines(docs).collect())
    assert got == [(1, "a\nb\nc")] * 3 + [(2, "x\ny"), (3, "q\n")]
    assert L.dedup_lines(empty_docs(spark)).collect() == []


def test_removed_lines_stand_elsewhere(spark):
    texts = random_texts(60, 30, 6, 9, 30, lines=True)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {line for r in L.dedup_lines(docs).collect() for line in r["text"].split("\n")}
    assert {line for t in texts for line in t.split("\n")} <= left


def test_line_plan_has_no_python(spark):
    plan = L.dedup_lines(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- op6: substrings -----------------------------------------------------------------------------
def brute_substrings(docs, window):
    rows = [(d["doc_id"], (d["text"] or "").encode().split()) for d in docs]
    first = {}
    for d, w in rows:
        for k in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in rows:
        gone = {p for k in range(len(w) - window + 1) if d is not None and first[tuple(w[k : k + window])] < d for p in range(k, k + window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window,shard_phrases,routed", [
    (13, D.SHARD_PHRASES, D.ROUTED), (13, 20, 10**6), (8, 30, 10**6), (5, D.SHARD_PHRASES, D.ROUTED), (1, 5, 10**6), (13, D.SHARD_PHRASES, 0), (13, 20, 0), (5, 30, 0), (1, 5, 0),
])
def test_substrings_equal_brute_force(spark, window, shard_phrases, routed, monkeypatch):
    monkeypatch.setattr(D, "CHUNK_BYTES", 500)
    monkeypatch.setattr(D, "HELD_BYTES", 2000)
    monkeypatch.setattr(D, "ROUTED", routed)  # 0: documents are sent to the shards
    docs = odd_docs(spark, random_texts(80, 60, 12 if window == 13 else 30, 5, 25))
    got = D.dedup_substrings(docs, window, shard_phrases)
    want = brute_substrings(docs.collect(), window)
    key = lambda r: (r[0] is not None, *(x or 0 for x in r[:3]), r[3])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()), key=key) == sorted((w[:4] for w in want), key=key)


def test_common_and_other_windows_alike(spark, monkeypatch):
    docs = odd_docs(spark, random_texts(60, 60, 500, 6, 60))
    want = {(w[0], w[2], w[3]) for w in brute_substrings(docs.collect(), 13)}
    for share in (0, 50, 10**6):  # no window is common, some are, all are
        monkeypatch.setattr(common, "COMMON_SHARE", share)
        assert {(r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in D.dedup_substrings(docs).collect()} == want


def test_windows_are_located_by_the_automaton_alone():
    values = ["", " ".join(f"a{k}" for k in range(40)), None, "x " + " ".join(f"a{k}" for k in range(10, 30)) + " y", " ".join(f"b{k}" for k in range(30))]
    texts = pa.array(values, pa.string())
    words = [(v or "").split() for v in values]
    phrase, _ = D.anchors(texts)
    byte = lambda w: int(word_hashes(pa.array([w]))[0][0]) >> 56
    number = lambda ws: sum(byte(w) << 8 * (7 - k) for k, w in enumerate(ws))
    every = {number(w[k : k + 8]) for w in words for k in range(len(w) - 7)}
    assert set(phrase.tolist()) <= every
    known = np.array([number([f"a{k}" for k in range(12, 20)])], np.uint64)  # one phrase, in two of the texts
    stream = D.symbols(word_hashes(texts)[0])
    shards = D.Shards(8, 0, D.bit_table(D.phrase_slots(known, 8)), [(0, "all")])
    shard = pickle.loads(pickle.dumps(D.Phrases(known)))
    place, text, one, two = D.located(texts, D.occurrences(stream, shards, lambda _: shard))
    held = lambda w, k: any(number(w[j : j + 8]) == known[0] for j in range(k, k + 6))
    assert list(zip(text.tolist(), place.tolist())) == [(t, k) for t, w in enumerate(words) for k in range(len(w) - 12) if held(w, k)]
    by_words = {}
    for t, k, *h in zip(text.tolist(), place.tolist(), one.tolist(), two.tolist()):
        by_words.setdefault(tuple(words[t][k : k + 13]), set()).add(tuple(h))
    assert all(len(h) == 1 for h in by_words.values()) and len(set.union(*by_words.values())) == len(by_words)

    class Blind:
        def iter(self, stream):
            return iter(())

    shard.automaton = Blind()
    assert all(len(x) == 0 for x in D.located(texts, D.occurrences(stream, shards, lambda _: shard)))


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_occurrences_equal_a_search(size):
    rnd = np.random.default_rng(size)
    for n in (0, 1, size, 400):
        symbol = rnd.integers(0, 3, n).astype(np.uint8) * 85
        every = D.phrases(symbol, size)
        known = np.unique(np.concatenate([every[rnd.random(len(every)) < 0.1], rnd.integers(0, 256, 2, dtype=np.uint64)]))
        want = [k + size - 1 for k, x in enumerate(every.tolist()) if x in set(known.tolist())]
        for bits in (0, 3):
            slots = D.phrase_slots(known, size)
            base = slots >> np.uint32(D.LEAD_BITS - bits)
            held = {str(k): D.Phrases(known[base == k], size) for k in np.unique(base).tolist()}
            shards = D.Shards(size, bits, D.bit_table(slots), sorted((int(k), k) for k in held))
            assert D.occurrences(symbol, shards, held.__getitem__).tolist() == want


def test_second_hashes_part_words_of_any_length():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.choice([1, 2, 5, 63, 64, 65, 128, 300]))) for _ in range(800)})
    rnd.shuffle(words)
    one, bounds, two = word_hashes(pa.array([" ".join(words), None, "", words[0]]), second=True)
    assert len(set(two.tolist())) == len(set(one.tolist())) == len(words) == bounds[1] and (one[-1], two[-1]) == (one[0], two[0])


def test_hashes_of_a_word_are_its_own():
    rnd = random.Random(4)
    make = lambda n: "".join(rnd.choice("abcde") for _ in range(n))
    kinds = sorted({make(n) for n in [1, 5, 63, 64, 65, 127, 128, 129, 200, 65_535, 65_536, 65_537, 100_000] for _ in range(3)})
    alone = {w: tuple(x[0] for x in (r[0], r[2])) for w in kinds for r in [word_hashes(pa.array([w]), second=True)]}
    assert len({a for a, _ in alone.values()}) == len({b for _, b in alone.values()}) == len(kinds)
    for _ in range(4):  # beside long words and over the borders of segments
        row = [rnd.choice(kinds) for _ in range(60)]
        one, _, two = word_hashes(pa.array([" ".join(row[:25]), " ".join(row[25:])]), second=True)
        assert list(zip(one.tolist(), two.tolist())) == [(int(alone[w][0]), int(alone[w][1])) for w in row]


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_long_words_beside_shared_passages(spark, parts):
    rnd = random.Random(5)
    long = ["x" * n for n in (63, 64, 65, 200, 100_000)] + ["https://example.org/" + "a/" * 40]
    passage = [f"p{k}" for k in range(40)]
    passages = [passage, passage[:20] + long[:3] + passage[20:], [*long, *passage[:15]]]
    texts = []
    for k in range(24):
        body = [f"own{k}_{i}" for i in range(rnd.randint(0, 30))] + rnd.sample(long, rnd.randint(0, 4))
        at = rnd.randint(0, len(body))
        texts.append(" ".join(body[:at] + passages[k % 3] + body[at:]))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    want = {(w[0], w[2], w[3]) for w in brute_substrings(docs.collect(), 13)}
    assert {(r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in D.dedup_substrings(docs).collect()} == want and sum(w[1] for w in want) > 500


def test_shortened_texts_keep_their_words_and_white_space(spark):
    docs = odd_docs(spark, random_texts(40, 60, 400, 7, 20, lines=True))
    out = D.shorten_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    want = sorted(((w[0] or -1, b" ".join(w[4])) for w in brute_substrings(docs.collect(), 13)))
    assert sorted((r["doc_id"] or -1, b" ".join((r["text"] or "").encode().split())) for r in out.collect()) == want
    assert D.kept_text(b"a b  c\nd  e", np.array([False, False, True, False, False])) == "a b\nd  e"
    assert D.kept_text(b"a b", np.array([True, True])) == ""


def test_spans(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = spark.createDataFrame([(1, passage), (2, f"x y {passage} z"), (3, passage)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in D.dedup_substrings(docs).collect()}
    assert [tuple(s) for s in got[2]["spans"]] == [(2, 22)] and got[1]["n_removed"] == 0 and got[3]["n_removed"] == 20
    assert D.dedup_substrings(empty_docs(spark)).collect() == []


# --- op8: SimHash --------------------------------------------------------------------------------
def plain_fingerprint(text):
    import xxhash

    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), seed=42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints():
    for t in ["", None, "One", "a b c", "a b c d", "A b C d É f", "x " * 200_000, "p q r s t u v w x y z"]:
        assert H.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("block", [H.BLOCK, 3000])
def test_simhash_components_equal_brute_force(spark, block):
    docs = odd_docs(spark, random_texts(120, 90, 300, 8, 80))
    got = H.simhash_groups(docs, block=block).collect()
    rows = [(d["doc_id"], plain_fingerprint(d["text"])) for d in docs.collect()]
    prints = sorted({fp for _, fp in rows})
    root = union_find([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4], prints)
    smallest = {r: min((d for d, fp in rows if root[fp] == r and d is not None), default=None) for r in set(root.values())}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(((d, f"{fp:016x}", smallest[root[fp]]) for d, fp in rows), key=key)


def test_links_of_random_and_crowded_fingerprints(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rnd.choice(64, n, replace=False)) for b in base[:60] for n in (1, 2, 3, 4, 5)]
    crowd = [int(base[0]) ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    prints = sorted({int(b) for b in base} | set(near) | set(crowd))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    arr = np.array(prints, np.uint64)
    want = union_find([(prints[i], prints[j]) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 4).tolist() if i < j], prints)
    for crowd in (8, 0, 10**9):  # some prefixes are dealt by further bits, all, none
        monkeypatch.setattr(H, "CROWD", crowd)
        got = [(a % (1 << 64), b % (1 << 64)) for a, b in H.near_links(df, block=4000).collect()]
        assert union_find(got, prints) == want


def test_keep_one(spark):
    text = " ".join(f"w{k}" for k in range(200))
    docs = spark.createDataFrame([(5, text), (3, text), (3, text), (None, text), (9, "other words here entirely"), (None, "alone"), (None, "alone")], "doc_id long, text string")
    got = H.keep_one(docs).collect()
    assert sorted((r["doc_id"] or -1, r["text"][:5]) for r in got) == [(-1, "alone"), (3, "w0 w1"), (9, "other")]
    assert H.keep_one(empty_docs(spark)).collect() == [] and H.simhash_groups(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        H.near_links(docs.select(F.col("doc_id").alias("fp")), radius=3)


# --- near copies of the pipeline -----------------------------------------------------------------
@pytest.mark.parametrize("chunk", [256, 3])
def test_near_copies_equal_brute_force(spark, sf, chunk):
    rnd = random.Random(12)
    texts = {}
    for group in range(12):
        words = [f"g{group}w{k}" for k in range(120)]
        for copy in range(6):
            changed = list(words)
            for k in rnd.sample(range(120), rnd.choice([0, 1, 2, 3, 4])):
                changed[k] = f"x{copy}y{k}"
            texts[len(texts)] = " ".join(changed)
    sets = {d: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for d, t in texts.items() for w in [t.split()]}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = union_find(near, sets)
    assert any((plain_fingerprint(texts[a]) ^ plain_fingerprint(texts[b])).bit_count() > 4 for a, b in near)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    want = {d for d in texts if root[d] == d}
    assert {r["first"]["doc_id"] for r in N.similar_groups(docs, chunk=chunk)[1].collect()} == want
    assert {r["doc_id"] for r in corpus_pipeline.remove_near_copies(spark, docs, sf).collect()} == want
    assert H.keep_one(empty_docs(spark), similarity=0.8).collect() == []
    with pytest.raises(ValueError):
        H.keep_one(docs, similarity=0.5)


CLASHES = ["_id", "_key", "_at", "_gone", "_lines", "hash", "first", "n", "_doc_id", "_row_key", "_kept_text", "_kept_id", "_kept_key", "_many", "row_key", "fp", "root", "set_id", "shard", "_h", "_shard", "n_words", "l0"]


@pytest.mark.parametrize("shorten", [L.dedup_lines, D.shorten_documents, H.keep_one, lambda d: H.keep_one(d, similarity=0.8), lambda d: S.write_shards(d)[0]], ids=["op4", "op6", "op8", "similar", "op9"])
def test_columns_of_any_name_stay(spark, shorten):
    docs = odd_docs(spark, ["a b c\nd\ne\nf", "a b c\nd\ne\nf\ng"]).select("doc_id", "text", F.col("kept").alias("a.b"), *[F.format_string(f"{c} %s", "doc_id").alias(c) for c in CLASHES])
    out = shorten(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert got and all(r[c] == f"{c} {'null' if r['doc_id'] is None else r['doc_id']}" for r in got for c in CLASHES)


# --- op3: embeddings -----------------------------------------------------------------------------
def brute_vectors(rows):
    good = [(i, k, np.array(v, float)) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = [0] * len(rows), []
    for a, ka, va in good:
        for b, kb, vb in good:
            if ka < kb and len(va) == len(vb) and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.95:
                links[ka] += 1
                links[kb] += 1
                pairs.append((ka, kb))
    root = union_find(pairs, range(len(rows)))
    name = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root.values())}
    return [(i, links[k], name[root[k]] if i is not None else None, i is not None and i == name[root[k]]) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("chunk", [V.CHUNK, 16])
def test_vectors_equal_brute_force(spark, chunk):
    rnd = np.random.default_rng(6)
    rows = [(k, rnd.standard_normal(24).tolist()) for k in range(60)]
    for k in range(60, 160):
        v = np.array(rows[k % 5][1])
        rows.append((k, (v + rnd.standard_normal(24) * 0.15).tolist()))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, (np.array(rows[0][1]) * 3).tolist()), (203, None), (204, [0.0] * 24), (205, [float("nan")] * 24), (206, [1.0, None]), (207, []), (208, [1.0, 2.0]), (209, [2.0, 4.0]),
             (None, rows[0][1]), (200, rows[7][1]), (7, rows[7][1]), (210, [float("inf")] + [1.0] * 23)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, links int")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, V.embedding_groups(df, chunk=chunk).collect()), key=key) == sorted(brute_vectors(rows), key=key)


def planted(n, size, cosine, seed, base=None):
    """``2 n`` unit vectors, of which neighbours have exactly the cosine."""
    rnd = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(rnd.standard_normal((n, size)))
    if base is not None:  # a dense topic: all have about this cosine to each other
        centre = unit(rnd.standard_normal(size))
        x = unit(np.sqrt(base) * centre + np.sqrt(1 - base) * x)
    noise = rnd.standard_normal((n, size))
    noise = unit(noise - (noise * x).sum(1, keepdims=True) * x)
    return np.stack([x, cosine * x + np.sqrt(1 - cosine**2) * noise], axis=1).reshape(2 * n, size)


def found_pairs(spark, x, rounds=V.ROUNDS):
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = V.embedding_groups(df, rounds=rounds).toPandas().set_index("vec_id")["component_id"]
    return sum(got[2 * k] == got[2 * k + 1] for k in range(len(x) // 2)) / (len(x) // 2)


def test_recall_among_scattered_vectors(spark):
    assert found_pairs(spark, planted(4000, 64, 0.952, 9)) > 0.995


def test_recall_in_a_dense_topic(spark):
    """Further rounds find what the passes for scattered vectors miss, and so does the last resort."""
    x = planted(4000, 64, 0.952, 10, base=0.8)
    assert found_pairs(spark, x) > 0.98
    assert found_pairs(spark, x, rounds=1) > 0.98


def test_codes_bound_the_cosine():
    x = planted(300, 64, 0.95, 11)
    y, e = V.decoded([r.tobytes() for r in V.codes(x)])
    apart = np.abs(y @ y.T - x @ x.T)
    assert (apart <= V._slack(e[:, None], e[None, :], 64)).all() and apart.max() < 0.02


def test_labels_and_passes():
    rnd = np.random.default_rng(2)
    u, v = rnd.integers(0, 300, 250), rnd.integers(0, 300, 250)
    want = union_find(list(zip(u.tolist(), v.tolist())), range(300))
    assert V.smallest_labels(u, v, 300).tolist() == [want[k] for k in range(300)]
    assert V.passes_for(100) == 1 and 8 <= V.passes_for(10_000) < V.passes_for(50_000) < V.passes_for(10**9) < 70
    assert all(V.bits_within(V.passes_for(n)) >= np.log2(n / V.WINDOW) - 1e-9 for n in (10**4, 10**6, 10**9))


@pytest.mark.parametrize("parts", [1, 7])
def test_windows_reach_over_borders(spark, parts):
    """Every pair within the window of a pass is judged, wherever partitions end."""
    x, window = planted(150, 16, 0.96, 12), 20
    rows = [(k, 24, r.tobytes()) for k, r in enumerate(V.codes(x))]
    out = common.staged(V.window_links(spark.createDataFrame(rows, "node long, size int, code binary"), range(1), parts, window=window), "borders")
    edge = V.border_links(out, window=window)
    got = {(r["kind"], *sorted((r["a"], r["b"]))) for r in out.filter("kind < 2").select("kind", "a", "b").union(edge).collect()}
    y = V.decoded([r[2] for r in rows])[0].astype(float)
    order = np.argsort(V.projection_keys(y, 0, V.SEED), kind="stable")
    near = [(int(a), int(b)) for k, a in enumerate(order) for b in order[k + 1 : k + 1 + window] if x[a] @ x[b] >= 0.95]
    want, have = union_find(near, range(len(x))), union_find([(a, b) for _, a, b in got], range(len(x)))
    assert all(have[a] == have[b] for a, b in near) and want  # links and pairs to verify hold all of them


def test_vectors_of_nothing(spark):
    assert V.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    with pytest.raises(ValueError):
        V.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>"), threshold=1.5)

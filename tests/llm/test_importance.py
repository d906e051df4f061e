"""Operator 12 against a plain version."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from tessella.llm import importance as I
from tessella.llm import queries
from tessella.llm.words import plain_words

from .helpers import empty_docs, odd_docs, random_texts


def plain_features(text, n):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return len(words), [" ".join(words[a : a + k]) for k in range(1, n + 1) for a in range(len(words) - k + 1)]


def plain_ranks(docs, target, n=1, buckets=10_000, percent=10, least=20, seed="2024"):
    """Rows (doc_id, n_words, n_features, weight, score, rank) by the definition."""
    bucket = lambda f: crc32(f.encode()) % buckets
    found = [(d, *plain_features(t, n)) for d, t in docs]
    s, t = Counter(bucket(f) for _, _, x in found for f in x), Counter(bucket(f) for x in target for f in plain_features(x, n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for d, words, x in found:
        weight = math.floor(sum(gain[bucket(f)] for f in x) / len(x)) if x else 0
        h = int(sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, words, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        r[5] = k + 1
    return out


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
key = lambda rows: sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("n,buckets,percent,least", [(1, 10_000, 10, 20), (1, 7, 50, 1), (2, 100, 30, 0), (3, 70_000, 100, 5), (1, 10_000, 0, 20)])
def test_ranks_equal_the_definition(spark, n, buckets, percent, least):
    docs = odd_docs(spark, random_texts(80, 60, 50, 11, 20, lines=True))
    target = random_texts(10, 40, 60, 12) + [None, "", "Ünïcode 123 a-b c_d"]
    got = I.importance_ranks(docs, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"), n, buckets, percent, least)
    assert got.columns == list(COLUMNS)
    want = plain_ranks([(r["doc_id"], r["text"]) for r in docs.collect()], target, n, buckets, percent, least)
    # of equal rows under one id any may be drawn; two rows of one id and score have their ranks in any order
    loose = lambda rows: (sorted(repr(tuple(r)[:5]) for r in rows), sorted(repr((r[0], r[4], r[5])) for r in rows))
    assert loose(got.collect()) == loose(want)


def test_query_equals_the_definition(spark, sf):
    docs, target = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = plain_ranks([(r["doc_id"], r["text"]) for r in docs], [r["text"] for r in target])
    got = queries.op12_importance_resampling(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and key(got.collect()) == key((r[0], *r[2:]) for r in want)
    assert all(kind == "bigint" for _, kind in got.dtypes) and sum(r[5] is not None for r in want) > 10


def test_the_ring_extends_every_start():
    rnd = random.Random(1)
    for n in (1, 2, 3, 5):
        words = [bytes(rnd.choice(b"ab\xc3\xa9") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(0, 30))]
        want = Counter(crc32(b" ".join(words[a : a + k])) % 97 for k in range(1, n + 1) for a in range(len(words) - k + 1))
        assert Counter(I.feature_buckets(words, n, 97).tolist()) == want
    assert plain_words("Ab-C é9\x85_x\x7fy".encode()) == [b"ab", b"c", "é9\x85".encode(), b"x", b"y"] and plain_words(None) == []


def test_sample_and_empty_tables(spark):
    texts = random_texts(60, 60, 50, 13)
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)] + [(None, texts[0], 0)], "doc_id long, text string, score int")
    target = spark.createDataFrame([(texts[3],)], "text string")
    drawn = {r["doc_id"] for r in I.importance_ranks(docs.filter("doc_id is not null"), target, percent=30).filter("rank is not null").collect()}
    kept = I.resample(docs, target, percent=30)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == drawn and len(drawn) > 5
    assert I.importance_ranks(empty_docs(spark), target).count() == 0
    none = I.importance_ranks(docs, target.limit(0)).collect()
    assert len(none) == 61 and sum(r["rank"] is not None for r in none) == sum(r["n_words"] >= 20 for r in none) // 10

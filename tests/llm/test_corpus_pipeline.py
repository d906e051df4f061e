"""The pipeline's stages one by one, each held against brute force on its own input."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from tessella.llm import common, queries

from .helpers import odd_docs
from .test_dedup import brute_lines, brute_substrings, union_find
from .test_documents import check_pieces, plain_stats


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def five_words(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = common.staged(C.quality_rules(spark, docs, sf), "t1")
    assert kept.columns == docs.columns == list(C.COLUMNS)
    rejected = docs.join(kept, "doc_id", "left_anti").collect()
    assert all((s := plain_stats(r["text"]))[0] >= 50 and 2 * s[4] <= s[0] for r in kept.collect())
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    assert not [r for r in rejected if r["doc_id"] in good and plain_stats(r["text"])[0] >= 50 and 2 * plain_stats(r["text"])[4] <= plain_stats(r["text"])[0]]

    lines = common.staged(C.remove_lines(spark, kept, sf), "t2")
    assert texts(lines) == {d: t for d, _, t, _ in brute_lines(kept.collect())} and lines.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    # the pipeline's rule for near copies: five words, a similarity of 0.8 or more
    single = common.staged(C.remove_near_copies(spark, lines, sf), "t3")
    sets = {d: five_words(t) for d, t in texts(lines).items()}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = union_find(near, sets)
    assert texts(single) == {d: t for d, t in texts(lines).items() if root[d] == d} and any(sets[a] != sets[b] for a, b in near)

    short = common.staged(C.remove_passages(spark, single, sf), "t4")
    want = {w[0]: b" ".join(w[4]) for w in brute_substrings(single.collect(), 13)}
    assert {d: b" ".join(t.encode().split()) for d, t in texts(short).items()} == want and short.columns == docs.columns

    import numpy as np

    packed = C.pack(spark, short, sf).toPandas()
    rows = short.toPandas()
    place = {d: k for k, d in enumerate(rows["doc_id"])}
    words = [t.encode().split() for t in rows["text"]]
    check_pieces([(place[r.doc_id], r.start_word, r.n_words, r.bin_id) for r in packed.itertuples()], np.array([len(w) for w in words]), list(rows["source"]), [tuple(w) for w in words], 2048)
    assert sorted(tuple(r)[:4] for r in C.run(spark, sf).select("doc_id", "piece", "start_word", "n_words").collect()) == sorted(packed[["doc_id", "piece", "start_word", "n_words"]].itertuples(index=False, name=None))


def test_odd_rows_pass_every_stage(spark, sf):
    body = " ".join(f"w{k}" for k in range(80))
    docs = odd_docs(spark, ["one two three " * 5, body, body])
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    ids = lambda rows: sorted(((r["doc_id"], r["text"]) for r in rows), key=key)
    held = {name: stage(spark, docs, sf).collect() for name, stage in C.STAGES}
    assert {r["doc_id"] for r in held["quality_rules"]} <= {4, 101, 102}  # the others have fewer than 50 words
    assert ids(held["line_dedup"]) == ids(docs.collect()) == ids(C.remove_lines(spark, docs, sf).collect())
    # no words: one group, whose smallest id is 2; equal rows stay once
    assert [r[0] for r in ids(held["simhash_dedup"])] == [None, 1, 1, 2, 4, 6, 100, 101]
    lost = {r["doc_id"] for r in held["substring_dedup"] if r["text"] == "" and r["doc_id"] not in (3, 5)}
    assert len(held["substring_dedup"]) == docs.count() and lost == {102}
    assert {r["doc_id"] for r in held["best_fit_packing"]} == {r["doc_id"] for r in docs.collect()}
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "substring_dedup", "best_fit_packing"]


def test_queries_are_registered(spark, sf):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and "pipeline" in entry.queries() and set(queries.ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    import os

    import duckdb

    from tests.test_queries import plain

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    assert plain(queries.QUERIES[name](spark, sf).toPandas()) == plain(con.execute(queries.ORACLE_SQL[name]).df())


def test_staged_tables_can_be_dropped(spark):
    df = common.staged(spark.range(3).toDF("x"), "drop-me")
    assert df.count() == 3
    common.drop_staged(spark)
    assert common._CREATED == []

"""Near copies by the Jaccard similarity of word shingles: operator 8 where the rule is a similarity.

Two kinds of candidates: SimHash fingerprints of the shingles within ``radius`` bits (ball hashing), and
texts that share a MinHash band. A text's shingles become ``BANDS`` hashes of ``ROWS`` minima each; a
pair at similarity s shares none with a probability of (1 - s^ROWS)^BANDS: 3 in 100,000 at 0.8, less
above. Ball hashing alone would miss most pairs at 0.8, where some ten bits differ; the bands alone
would miss next to none. Exact sets decide: the texts of each candidate component travel once to one
place, where all of their pairs are counted over an inverted index. In components beyond ``CHUNK`` texts,
those similar to the first one are linked by that; only the others are compared with all members, in
blocks that many tasks share.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import join_counted, map_arrow, ragged, small_batches, staged, text_bytes
from tessella.llm.components import connected_components
from tessella.llm.simhash import BLOCK, RADIUS, Forest, _row_key, near_links, of_hashes, place

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
BANDS, ROWS = 20, 4
CHUNK = 256
_STEP = 8192  # shingles whose hashes are permuted at once
_LINKS = "a long, b long"


def shingles(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of the word windows, repeats included; shorter texts are one window, no words are none."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # as fingerprints: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if n <= shingle:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: n - shingle + 1].tolist()
    parts = map(joined.__getitem__, map(slice, starts, ends[shingle - 1 :].tolist()))
    return np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), np.uint64, n - shingle + 1)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)
    return draw[0] | np.uint64(1), draw[1]


def bands(found: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> list[int]:
    """A signed long for each band of minima; none for an empty set."""
    from xxhash import xxh64_intdigest

    if not len(found):
        return []
    least = np.full(len(factor), 2**64 - 1, np.uint64)
    for k in range(0, len(found), _STEP):
        np.minimum(least, (found[None, k : k + _STEP] * factor + shift).min(1), out=least)
    raw = least.tobytes()
    hashes = [xxh64_intdigest(raw[8 * ROWS * k : 8 * ROWS * (k + 1)], k) for k in range(BANDS)]
    return np.array(hashes, np.uint64).view(np.int64).tolist()


def _with_bands(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``doc_id, row_key, set_id, fp, bands`` of every row; equal sets have one ``set_id``."""
    small_batches(docs.sparkSession)

    def make():
        from xxhash import xxh64_intdigest

        factor, shift = _permutations()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingles(x, shingle, seed) for x in text_bytes(batch.column(2))]
            fps = np.array([of_hashes(x) for x in found], np.uint64).view(np.int64)
            sets = [np.unique(x) for x in found]
            ids = np.array([xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids), pa.array(fps), pa.array([bands(s, factor, shift) for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "set_id", "fp", "bands"],
            )

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, make, "doc_id long, row_key long, set_id long, fp long, bands array<long>")


def similar_pairs(sets: list[np.ndarray], outer: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each place of ``outer`` with all places whose sets are similar to its own, by exact counts."""
    size = np.array([len(s) for s in sets], np.int64)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    holder = np.repeat(np.arange(len(sets)), size)[order]
    start = np.searchsorted(token[order], np.arange(token.max(initial=-1) + 2))
    at = np.concatenate([[0], np.cumsum(size)])
    for k in outer.tolist():
        places, _ = ragged(start[:-1], np.diff(start), token[at[k] : at[k + 1]])
        both = np.bincount(holder[places], minlength=len(sets))
        near = np.flatnonzero(both >= similarity * (size + size[k] - both) - 1e-9)
        yield k, near[near != k]


def _block_links(blocks: DataFrame, similarity: float, shingle: int, seed: int) -> DataFrame:
    """``root, i, j, outer, set_id, text`` -> a spanning forest of each block's links."""
    keys = ["root", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        at = None
        for pdf in batches:
            for key, part in pdf.groupby(keys, sort=False):
                if key != at and held:
                    yield done(pd.concat(held))
                    held = []
                at = key
                held.append(part)
        if held:
            yield done(pd.concat(held))

    def done(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("outer", ascending=False).drop_duplicates("set_id")  # an outer text is a member too
        ids, forest = pdf["set_id"].tolist(), Forest()
        sets = [np.unique(shingles(x.encode(), shingle, seed)) for x in pdf["text"]]
        for k, near in similar_pairs(sets, np.flatnonzero(pdf["outer"].to_numpy(bool)), similarity):
            for other in near.tolist():
                forest.link(ids[k], ids[other])
        a = list(forest.up)
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array([forest.find(x) for x in a], np.int64)})

    return blocks.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, _LINKS)


def _large(members: DataFrame, similarity: float, chunk: int, shingle: int, seed: int) -> DataFrame:
    """Links of components of more than ``chunk`` texts, their first member's links by one join."""

    @F.pandas_udf("boolean")
    def like(text: pd.Series, lead: pd.Series) -> pd.Series:
        known: dict[str, np.ndarray] = {}
        out = []
        for x, y in zip(text, lead):
            if y not in known:
                known[y] = np.unique(shingles(y.encode(), shingle, seed))
            a, b = np.unique(shingles(x.encode(), shingle, seed)), known[y]
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
        return pd.Series(out, dtype=bool)

    leads = staged(members.filter("set_id = root").select("root", F.col("text").alias("lead"), F.col("size").alias("n")), "near-leads")
    members = members.drop("size")
    judged = staged(join_counted(members, leads, ["root"], "n").withColumn("core", like("text", "lead")).drop("lead"), "near-large")
    links = judged.filter("core and set_id != root").select(F.col("set_id").alias("a"), F.col("root").alias("b"))
    totals = judged.groupBy("root").agg(
        F.ceil(F.count_if(~F.col("core")) / chunk).cast("int").alias("ni"), F.ceil(F.count("*") / chunk).cast("int").alias("nj")
    )
    busy = join_counted(judged, staged(totals.filter("ni > 0").withColumn("n", F.col("nj")), "near-busy"), ["root"], "n")
    part = lambda n: F.pmod(F.xxhash64("set_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = busy.filter("not core").select("root", part("ni").alias("i"), every("nj").alias("j"), F.lit(True).alias("outer"), "set_id", "text")
    cols = busy.select("root", every("ni").alias("i"), part("nj").alias("j"), F.lit(False).alias("outer"), "set_id", "text")
    return links.union(_block_links(rows.union(cols), similarity, shingle, seed))


def candidates(first: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``first(set_id, fp, bands)`` -> edges ``a, b`` of sets that share a band or whose fingerprints are near."""
    met = first.select("set_id", F.explode("bands").alias("band"))
    heads = met.groupBy("band").agg(F.min("set_id").alias("head"), F.count("*").alias("n")).filter("n > 1")
    edges = join_counted(met, staged(heads, "near-bands"), ["band"], "n").filter("set_id != head").select(F.col("set_id").alias("a"), F.col("head").alias("b"))
    some = first.filter(F.size("bands") > 0).select("set_id", "fp")  # texts without words are one set anyway
    prints = staged(some.groupBy("fp").agg(F.min("set_id").alias("head")), "near-heads")
    same = some.join(prints, "fp").filter("set_id != head").select(F.col("set_id").alias("a"), F.col("head").alias("b"))
    head = lambda end: prints.select(F.col("fp").alias(end), F.col("head").alias(f"{end}_set"))
    near = near_links(prints, radius, block).join(head("a"), "a").join(head("b"), "b").select(F.col("a_set").alias("a"), F.col("b_set").alias("b"))
    return edges.union(same).union(near)


def similar_links(docs: DataFrame, first: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``first(set_id, first, fp, bands)`` -> links ``a, b`` of sets that connect all similar candidates."""
    roots = staged(connected_components(candidates(first, radius, block)), "near-candidates")
    sizes = staged(roots.groupBy("root").agg(F.count("*").alias("size")).withColumn("n", F.col("size")), "near-sizes")
    wanted = join_counted(roots, sizes, ["root"], "n").join(first, F.col("node") == F.col("set_id")).select(
        "root", "size", "set_id", F.col("first.doc_id").alias("_id"), F.col("first.row_key").alias("_key")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_key") == F.col("_key"))
    members = staged(texts.join(wanted, same).select("root", "size", "set_id", "text").dropDuplicates(["set_id"]), "near-members")
    small = members.filter(F.col("size") <= chunk).select("root", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("outer"), "set_id", "text")
    return _block_links(small, similarity, shingle, seed).union(_large(members.filter(F.col("size") > chunk), similarity, chunk, shingle, seed))


def similar_groups(docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, block: int = BLOCK, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row_key, set_id`` of every row; and for each component of similar texts, under ``first``,
    the (no id, id, row key) that stands for it.

    Texts without words are one component. Very long texts are read whole. Columns other than ``doc_id``
    and ``text`` play no part, whatever their names. An empty table gives empty tables.
    """
    if not 0.8 <= similarity <= 1:
        raise ValueError("the bands propose pairs from a similarity of 0.8 on")
    prints = staged(_with_bands(docs, shingle, seed), "near-prints")
    first = staged(prints.groupBy("set_id").agg(F.min(place()).alias("first"), F.min("fp").alias("fp"), F.first("bands").alias("bands")), "near-first")
    roots = connected_components(similar_links(docs, first, similarity, chunk, radius, shingle, seed, block))
    classes = first.join(roots, F.col("set_id") == F.col("node"), "left").select("first", F.coalesce("root", "set_id").alias("root"))
    return prints.select("doc_id", "row_key", "set_id"), classes.groupBy("root").agg(F.min("first").alias("first"))

"""Conflict-constrained best-fit packing (operator 7).

Documents become pieces of at most ``capacity`` words; pieces go, longest first, into the tightest
bin that has room and no conflict: a bin never holds two pieces of one duplicate cluster, nor two
documents of one source. Bins are ordered by the room they have left. Each bin carries a bitmap of
its sources and clusters, and each range of residuals the bits that all of its bins share, so the
successor search skips ranges in which every bin conflicts and goes on until the tightest
compatible bin is found. Where there is none a bin is opened.

Bins are packed within groups of rows of bounded size, dealt by a hash: groups are independent, so
a lost task repeats one group alone, and a source or cluster with a third of all rows is spread
over all groups. Clusters are exact: documents whose word sequences are equal.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, small_batches, staged, text_bytes

CAPACITY = 2048
GROUP_ROWS = 4000


class Bins:
    """Open bins by residual, with a tree over residuals of the conflict bits shared by all bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.shared = [-1] * (2 * self.size)  # no bin: every bit is shared, nothing to find
        self.leaf: list[dict[int, list[int]]] = [{} for _ in range(self.size)]  # bitmap -> bins
        self.mask: list[int] = []
        self.room: list[int] = []

    def _update(self, residual: int) -> None:
        both = -1
        for m in self.leaf[residual]:
            both &= m
        k = residual + self.size
        shared = self.shared
        shared[k] = both
        k >>= 1
        while k:
            new = shared[2 * k] & shared[2 * k + 1]
            if shared[k] == new:
                break
            shared[k] = new
            k >>= 1

    def put(self, b: int) -> None:
        if self.room[b]:
            same = self.leaf[self.room[b]].setdefault(self.mask[b], [])
            same.append(b)
            if len(same) == 1:
                self._update(self.room[b])

    def open(self, room: int, bits: int) -> int:
        self.room.append(room)
        self.mask.append(bits)
        self.put(len(self.room) - 1)
        return len(self.room) - 1

    def tightest(self, need: int, bits: int) -> int:
        """The bin with the least room >= need that shares none of ``bits``; -1 if there is none."""
        k = self._successor(need, bits)
        while k >= 0:
            best = min((found[-1] for m, found in self.leaf[k].items() if not m & bits), default=-1)
            if best >= 0:
                return best
            k = self._successor(k + 1, bits)
        return -1

    def _successor(self, start: int, bits: int) -> int:
        """Smallest residual >= start whose bins do not all share one of ``bits``."""
        if start >= self.size:
            return -1
        shared, k = self.shared, start + self.size
        while shared[k] & bits:
            while k & 1:  # up until a right sibling is unseen
                k >>= 1
            if not k:
                return -1
            k += 1
        while k < self.size:
            k *= 2
            if shared[k] & bits:
                k += 1
                if shared[k] & bits:  # each half is all in conflict, for another reason: go on behind
                    return self._successor_from(k, bits)
        return k - self.size

    def _successor_from(self, k: int, bits: int) -> int:
        while k < self.size:
            k = 2 * k + 1
        return self._successor(k - self.size + 1, bits)

    def add(self, b: int, need: int, bits: int) -> None:
        same = self.leaf[self.room[b]][self.mask[b]]
        same.remove(b)
        if not same:
            del self.leaf[self.room[b]][self.mask[b]]
            self._update(self.room[b])
        self.room[b] -= need
        self.mask[b] |= bits
        self.put(b)


def pack_group(length: np.ndarray, source: list, cluster: list, capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Pieces ``(row, first word, words, bin)`` of one group, and the number of bins."""
    sources = {s: k for k, s in enumerate(dict.fromkeys(source))}
    counts: dict = {}
    for c in cluster:
        counts[c] = counts.get(c, 0) + 1
    bit = {c: k for k, c in enumerate((c for c, n in counts.items() if n > 1), len(sources))}
    bins, pieces = Bins(capacity), []
    rest = []
    for row, n in enumerate(length.tolist()):
        at = 0
        while n - at >= capacity:  # a full piece is a bin of its own
            pieces.append((row, at, capacity, bins.open(0, 0)))
            at += capacity
        if n > at or n == 0:
            rest.append((n - at, row, at))
    rest.sort(key=lambda x: (-x[0], x[1]))
    for need, row, at in rest:
        bits = 1 << sources[source[row]] | (1 << bit[cluster[row]] if cluster[row] in bit else 0)
        b = bins.tightest(max(need, 1), bits)
        if b < 0:
            b = bins.open(capacity - max(need, 1), bits)
        else:
            bins.add(b, max(need, 1), bits)
        pieces.append((row, at, need, b))
    return pieces, len(bins.room)


def with_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_words, cluster``: the cluster is a digest of the word sequence."""
    from hashlib import blake2b

    small_batches(docs.sparkSession)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [(x or b"").split() for x in text_bytes(batch.column(2))]
            return pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int64()),
                pa.array([blake2b(b" ".join(w), digest_size=16).digest() for w in words], pa.binary()),
            ], names=["doc_id", "source", "n_words", "cluster"])

        return step

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return map_arrow(rows, make, "doc_id long, source string, n_words long, cluster binary")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``docs(doc_id, source, text)`` -> ``doc_id, piece, start_word, n_words, bin_id, bin_words``.

    A row for each piece; pieces of a document cover its words in order, without gap or overlap.
    Documents without words (null or empty text) take one word's room and are one empty piece, so
    that every row is placed. A null source is a source of its own. Equal lengths are taken in the
    order of doc_id and text; repeated rows are copies of one cluster and go to different bins. Very
    long texts are cut into pieces, of which all but the last fill a bin. Bins depend on the rows alone,
    not on files or tasks. Columns other than ``doc_id``, ``source`` and ``text`` play no part, whatever
    their names. An empty table gives an empty result.
    """
    if capacity < 1 or group_rows < 1:
        raise ValueError("capacity and group_rows are positive")
    rows = staged(with_lengths(docs), "pack-lengths")
    groups = max(1, math.ceil(rows.count() / group_rows))
    # rows that repeat are counted and numbered, so they are dealt by values alone, however files are laid out
    same = rows.groupBy("doc_id", "source", "n_words", "cluster").agg((F.count("*") - 1).alias("last"))
    blocks = same.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr("last div 10000"))))
    inside = F.sequence(F.lit(0).cast("long"), F.least(F.lit(9999), F.col("last") - F.col("block") * 10000))
    numbered = blocks.withColumn("again", F.explode(inside)).withColumn("again", F.col("again") + F.col("block") * 10000).drop("last", "block")
    dealt = numbered.withColumn("part", F.pmod(F.xxhash64("doc_id", "source", "cluster", "again"), F.lit(groups)))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "cluster", "source", "again"], na_position="first", kind="stable").reset_index(drop=True)
        source = [None if pd.isna(x) else x for x in pdf["source"]]
        pieces, n = pack_group(pdf["n_words"].to_numpy(np.int64), source, list(pdf["cluster"]), capacity)
        out = pd.DataFrame(pieces, columns=["row", "start_word", "n_words", "bin"])
        used = np.bincount(out["bin"], out["n_words"], n).astype(np.int64)
        out["piece"] = out["start_word"] // capacity
        out["doc_id"] = pdf["doc_id"].to_numpy()[out["row"]]
        out["bin_id"] = np.int64(key[0]) * (1 << 32) + out["bin"]
        out["bin_words"] = used[out["bin"]]
        return out[["doc_id", "piece", "start_word", "n_words", "bin_id", "bin_words"]].astype({"doc_id": "Int64"})

    return dealt.groupBy("part").applyInPandas(pack, "doc_id long, piece long, start_word long, n_words long, bin_id long, bin_words long")

"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 8).

Two fingerprints within ``radius`` bits have a word half way between them, within ``radius / 2``
bits of both. So every fingerprint stands for all its variants within half the radius, and
fingerprints that share a variant are linked. A shared variant proves the distance by the triangle
inequality; links are verified against the fingerprints all the same.

The shuffle is on a prefix of the variants: a fingerprint is sent once to every prefix that one of
its variants has (1 + b + b(b-1)/2 rows for b prefix bits instead of 2,081), and the variants with
that prefix are spelled out at the receiver, where they are sorted and runs of equal variants
found. Every prefix that holds ``CROWD`` times its even share, however many there are, is dealt over tasks by
``MORE_BITS`` further bits; within a task a crowded prefix is split on further bits until its variants fit the block size, so
memory is bounded whatever the fingerprints are; no bucket is capped. A run of m fingerprints yields
m - 1 links, and a prefix yields a spanning forest of its links, so large groups stay linear.

Four bits of 64 is a stricter rule than a similarity of 0.8 of word shingles, at which some ten bits
differ. Where the rule is a similarity (``keep_one`` with ``similarity``), ball hashing proposes links
beside MinHash bands, and the shingles themselves decide (``near_copies``).
"""

from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import join_counted, map_arrow, small_batches, staged, text_bytes
from tessella.llm.components import connected_components
from tessella.operators.staging import unused

SHINGLE, SEED, RADIUS = 4, 42, 4
BLOCK = 1 << 19  # variants held at once
MORE_BITS, CROWD = 10, 8
_U = np.uint64


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text: bit set if set in over half of the shingles' XXH64; no words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: n - shingle + 1].tolist()
    parts = map(joined.__getitem__, map(slice, starts, ends[shingle - 1 :].tolist()))
    return of_hashes(np.fromiter(map(xxh64_intdigest, parts, repeat(seed)), np.uint64, n - shingle + 1))


def of_hashes(hashes: np.ndarray) -> int:
    """The SimHash of shingles given by their hashes; of none zero."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        part = hashes[k : k + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, row_key, fp`` of every row: a hash of the text, and the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(x, shingle, seed) for x in text_bytes(batch.column(2))], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "row_key", "fp"])

        return step

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), text.alias("text"))
    return map_arrow(rows, make, "doc_id long, row_key long, fp long")


def _row_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All words with at most ``flips`` of the lowest ``bits`` bits set."""
    return np.array([sum(1 << p for p in c) for k in range(flips + 1) for c in combinations(range(bits), k)], np.uint64)


def _count(bits: int, flips: int) -> int:
    return sum(math.comb(bits, k) for k in range(flips + 1))


def _flips(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.int64)


class Forest:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _meet(fps: np.ndarray, left: np.ndarray, low: int, forest: Forest, radius: int, block: int) -> None:
    """Link fingerprints that share a variant: ``left`` flips are left for the ``low`` lowest bits."""
    if len(fps) < 2:
        return
    total = sum(int((left == r).sum()) * _count(low, r) for r in np.unique(left).tolist())
    if total > block and low > 0:
        bits = min(3, low)
        tops = (fps >> _U(low - bits)) & _U((1 << bits) - 1)
        for value in range(1 << bits):
            rest = left - _flips(tops ^ _U(value))
            keep = rest >= 0
            _meet(fps[keep], rest[keep], low - bits, forest, radius, block)
        return
    own = fps & _U((1 << low) - 1) if low < 64 else fps
    variants, owner = [], []
    for r in np.unique(left).tolist():
        k = np.flatnonzero(left == r)
        masks = _masks(low, r)
        variants.append((own[k][:, None] ^ masks[None, :]).ravel())
        owner.append(np.repeat(k, len(masks)))
    v, o = np.concatenate(variants), np.concatenate(owner)
    sv = np.sort(v)
    twice = sv[1:][sv[1:] == sv[:-1]]
    if not len(twice):
        return
    seen = np.zeros(1 << 16, bool)
    mix = lambda x: ((x * _U(0x9E3779B97F4A7C15)) >> _U(48)).astype(np.int64)
    seen[mix(twice)] = True
    some = np.flatnonzero(seen[mix(v)])
    v, o = v[some], o[some]
    order = np.argsort(v, kind="stable")
    v, o = v[order], o[order]
    same = np.flatnonzero(v[1:] == v[:-1])
    pairs = np.unique(np.minimum(o[same], o[same + 1]) * len(fps) + np.maximum(o[same], o[same + 1]))
    a, b = fps[pairs // len(fps)], fps[pairs % len(fps)]
    near = (_flips(a ^ b) <= radius) & (a != b)
    for x, y in zip(a[near].view(np.int64).tolist(), b[near].view(np.int64).tolist()):
        forest.link(x, y)


def prefix_bits(n: int, radius: int, block: int) -> int:
    """Prefix bits at which an even spread of ``n`` fingerprints fills four blocks at each receiver."""
    return max(4, min(24, math.ceil(math.log2(max(1, n * _count(64, radius // 2) / (4 * block))))))


def near_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``fp`` (distinct longs) -> ``a, b``: links that connect all fingerprints within ``radius``."""
    if radius % 2 or not 0 <= radius <= 6:
        raise ValueError("the radius is an even number up to 6")
    prints = prints.select("fp")
    half, total = radius // 2, prints.count()
    bits = prefix_bits(total, radius, block)
    top = F.shiftrightunsigned("fp", 64 - bits)
    sent = prints.select("fp", F.explode(F.transform(_longs(_masks(bits, half)), lambda d: top.bitwiseXOR(d))).alias("prefix"))
    fair = total * _count(bits, half) / (1 << bits)  # rows of a prefix if fingerprints are spread evenly
    often = sent.groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD * fair)  # at most 2^bits / CROWD
    often = staged(often.select("prefix", F.lit(True).alias("crowded")), "simhash-crowded")
    # a crowded prefix goes on by further bits, with the flips that are left; its rows are told by a negative key
    spent = F.bit_count(top.bitwiseXOR(F.col("prefix")))
    own = F.shiftrightunsigned("fp", 64 - bits - MORE_BITS).bitwiseAND(F.lit((1 << MORE_BITS) - 1))
    further = F.filter(_longs(_masks(MORE_BITS, half)), lambda d: F.bit_count(d) + spent <= half)
    longer = F.transform(further, lambda d: -1 - (F.shiftleft("prefix", MORE_BITS).bitwiseOR(own.bitwiseXOR(d))))
    if not often.isEmpty():  # a table whose size decides how it is joined
        sent = sent.join(often, "prefix", "left").select("fp", F.explode(F.when(F.col("crowded"), longer).otherwise(F.array("prefix"))).alias("prefix"))

    def run(batches):
        at, held = None, []
        for pdf in batches:
            prefix, fps = pdf["prefix"].to_numpy(), pdf["fp"].to_numpy()
            cuts = np.flatnonzero(np.diff(prefix)) + 1
            for p, part in zip(prefix[np.concatenate([[0], cuts])].tolist(), np.split(fps, cuts)):
                if p != at and held:
                    yield done(at, held)
                    held = []
                at = p
                held.append(part)
        if held:
            yield done(at, held)

    def done(prefix: int, held: list[np.ndarray]) -> pd.DataFrame:
        forest, depth = Forest(), bits
        if prefix < 0:
            prefix, depth = -1 - prefix, bits + MORE_BITS
        fps = np.concatenate(held).view(np.uint64)
        left = half - _flips((fps >> _U(64 - depth)) ^ _U(prefix))
        _meet(fps, left, 64 - depth, forest, radius, block)
        return pd.DataFrame({"a": np.array(list(forest.up), np.int64), "b": np.array([forest.find(x) for x in list(forest.up)], np.int64)})

    return sent.repartition("prefix").sortWithinPartitions("prefix").mapInPandas(run, "a long, b long")


def _longs(values: np.ndarray):
    return F.from_json(F.lit(str(values.tolist())), "array<bigint>")


def _grouped(docs: DataFrame, radius: int, shingle: int, seed: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row_key, fp, first`` of every row: first is the (no id, id, row key) that stands for the
    component; and the smallest ones themselves."""
    prints = staged(with_fingerprints(docs, shingle, seed), "simhash-prints")
    first = staged(prints.groupBy("fp").agg(F.min(place()).alias("first"), F.count("*").alias("n")), "simhash-first")
    roots = connected_components(near_links(first, radius, block))
    classes = first.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    classes = staged(classes, "simhash-classes")
    smallest = staged(classes.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count("*").alias("fps")), "simhash-smallest")
    named = join_counted(classes.select("fp", "root", "n"), smallest.select("root", "first", "fps"), ["root"], "fps")
    return join_counted(prints, staged(named.select("fp", "first", "n"), "simhash-named"), ["fp"], "n"), smallest


def place():
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")


def simhash_groups(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, fingerprint, component_id``, a row for each row.

    ``component_id`` is the smallest doc_id that links reach. Null and empty texts have the
    fingerprint zero and are linked like any other; very long texts are read whole. Rows with a null
    doc_id take part in linking; they never name a component, unless no member has an id (then it is
    null). Rows repeated with one id share their row's result. Columns other than ``doc_id`` and
    ``text`` play no part, whatever their names. An empty table gives an empty result.
    """
    return _grouped(docs, radius, shingle, seed, block)[0].select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, block: int = BLOCK, similarity: float | None = None) -> DataFrame:
    """One row of each component, all columns: the one with the smallest id.

    Components are those of ``simhash_groups``; with ``similarity`` those of texts whose sets of word
    shingles have at least this Jaccard similarity. A component without ids keeps the text with the
    smallest hash; equal rows with one id keep one. Columns stay as they are, whatever their names.
    """
    if similarity is not None:
        from tessella.llm.near_copies import similar_groups

        prints, smallest = similar_groups(docs, similarity, radius, shingle, seed, block)
    else:
        prints, smallest = _grouped(docs, radius, shingle, seed, block)
    return pick_rows(docs, smallest.select("first.doc_id", "first.row_key"), prints)


def pick_rows(docs: DataFrame, chosen: DataFrame, prints: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen(doc_id, row_key)`` names, one for each name.

    Only names that ``prints(doc_id, row_key)`` has more than once can belong to several rows, so only
    those rows are grouped; the others meet their names and that is all.
    """
    doc, row, kept_doc, kept_row, many = unused(docs.columns, "_doc_id", "_row_key", "_kept_id", "_kept_key", "_many")
    again = prints.groupBy("doc_id", "row_key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("again_id"), F.col("row_key").alias("again_key"))
    names = chosen.join(again, F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("row_key") == F.col("again_key")), "left")
    names = staged(names.select(F.col("doc_id").alias(kept_doc), F.col("row_key").alias(kept_row), F.col("again_key").isNotNull().alias(many)), "picked")
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), row: _row_key()})
    found = keyed.join(names, F.col(doc).eqNullSafe(F.col(kept_doc)) & (F.col(row) == F.col(kept_row)))
    once = found.filter(~F.col(many)).select(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = found.filter(many).dropDuplicates([doc, row]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return once.unionByName(repeated)

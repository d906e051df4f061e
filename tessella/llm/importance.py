"""Resampling of documents by importance for a target distribution (operator 12).

A document's features are its runs of 1 to ``n`` words, each known by a bucket: the crc32 of its bytes,
modulo the number of buckets. One scan of a document keeps the running crc32 states of the last ``n``
starts in a ring; a word extends each of them by a space and itself and opens a state of its own, and
every state it touches is a feature (``feature_buckets``). The buckets are written once, two bytes each
where they fit; counts and weights are read from them, and no text is scanned twice.

Counts of both sides cover all rows. A task adds up its own counts in an array of one number for each
bucket, so what is shuffled and what every task then knows of the corpus, the gains, has the size of the
bucket table, a parameter. The drawn documents are those with the highest sum of weight and Gumbel
noise, which is sampling without replacement. Scores are whole numbers in a range that logarithms
of counts bound (some 100,000 values), so their histogram tells the lowest score that can be drawn; only rows
at or above it are sorted and numbered, by a range partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, small_batches, staged, text_bytes
from tessella.llm.words import plain_words
from tessella.operators.relational import with_row_order

BUCKETS, N, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, "2024"
NOISE_BITS = 32
_SCANNED = "doc_id long, n_words long, n_features long, buckets binary"


def feature_buckets(words: list[bytes], n: int = N, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all runs of 1 to ``n`` words, in the order in which the scan meets their ends."""
    if n == 1:  # a ring of one start
        states = list(map(crc32, words))
    else:
        ring: list[int] = []
        states = []
        for word in words:
            behind = b" " + word
            ring = [*[crc32(behind, state) for state in ring[1 - n :]], crc32(word)]
            states += ring
    return np.array(states, np.uint32) % np.uint32(buckets)


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scan(docs: DataFrame, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` of every row of ``docs(doc_id, text)``, by one scan of each text."""
    small_batches(docs.sparkSession)
    kind = _width(buckets)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, packed = [], []
            for text in text_bytes(batch.column(1)):
                words = plain_words(text)
                n_words.append(len(words))
                packed.append(feature_buckets(words, n, buckets).astype(kind).tobytes())
            size = int(kind[-1])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array([len(x) // size for x in packed], pa.int64()), pa.array(packed, pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, _SCANNED)


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, count`` over all rows; a task sends at most a row for each bucket."""
    kind = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in text_bytes(batch.column(0)):
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "count"])

    return scanned.select("buckets").mapInArrow(run, "bucket long, count long").groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` for the buckets that either side has, from the counts of both."""
    both = corpus.select("bucket", F.col("count").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("count").alias("t")))
    both = staged(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "importance-counts")
    sums = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("all_s"), F.coalesce(F.sum("t"), F.lit(0)).alias("all_t"))
    double = lambda name, more: (F.col(name) + more).cast("double")
    ratio = double("t", 1) * double("all_s", buckets) / (double("s", 1) * double("all_t", buckets))
    return both.crossJoin(F.broadcast(sums)).select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain"))  # a single row of sums


def _weights(scanned: DataFrame, gain: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of the row's features."""
    kind = _width(buckets)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.frombuffer(x, kind) for x in text_bytes(batch.column(3))]
            weight = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in found]
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

        return step

    return map_arrow(scanned, make, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: str = SEED):
    """Gumbel noise in thousandths, from the first 32 bits of the id's SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, NOISE_BITS // 4), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(float(1 << NOISE_BITS)))))


def importance_ranks(
    docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``, a row for each row of ``docs(doc_id, text)``.

    ``target(text)`` gives the wanted distribution. Of the rows with at least ``least_words`` words,
    ``percent`` hundredths (rounded down) are drawn: those with the highest scores, ties to the smaller
    doc_id; ``rank`` counts them from 1 and is null for all others. Null and empty texts have no features and weight 0.
    A null doc_id has the noise of an empty id and comes behind all others among equal scores. Rows that
    repeat with one id share their noise; each counts and may be drawn, equal ones in any order. Very long
    texts are scanned whole. Other columns of both tables play no part, whatever their names. An empty
    ``docs`` gives an empty result; with an empty ``target`` all wanted counts are zero.
    """
    if n < 1 or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("runs hold a word at least, there is a bucket at least, and percent is within 0 and 100")
    spark = docs.sparkSession
    scanned = staged(scan(docs, n, buckets), "importance-buckets")
    wanted = scan(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), n, buckets)
    known = gains(bucket_counts(scanned, buckets), bucket_counts(wanted, buckets), buckets).collect()  # at most a row for each bucket
    gain = np.zeros(buckets, np.int64)
    for bucket, value in known:
        gain[bucket] = value
    weighed = _weights(scanned, gain, buckets)
    scored = staged(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")

    fit = scored.filter(F.col("n_words") >= least_words)
    histogram = staged(fit.groupBy("score").agg(F.count("*").alias("n")), "importance-histogram")
    drawn = (histogram.agg(F.sum("n")).first()[0] or 0) * percent // 100
    above = histogram.withColumn("up_to", F.sum("n").over(Window.orderBy(F.desc("score"))))  # a row for each score there is
    lowest = above.filter(F.col("up_to") >= drawn).agg(F.max("score")).first()[0] if drawn else None
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    may = F.coalesce((F.col("n_words") >= least_words) & (F.col("score") >= lowest), F.lit(False))
    by = scored.filter(may).select("*", (-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_unnamed"), F.monotonically_increasing_id().alias("_place"))
    numbered = with_row_order(by, "_down", "_unnamed", "doc_id", "_place", into="_n")  # rows of one id and score may lie in several partitions
    first = numbered.select(*scored.columns, F.when(F.col("_n") < drawn, F.col("_n") + 1).cast("long").alias("rank"))
    return first.unionByName(scored.filter(~may).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn rows of ``docs``, all columns; of rows with one doc_id those are kept whose weight was drawn.

    Rows without a doc_id can't be told apart by it and are not part of the sample. Cases and
    parameters are those of ``importance_ranks``.
    """
    chosen = importance_ranks(docs.filter("doc_id is not null"), target, **parameters).filter("rank is not null")
    ids = chosen.select(F.col("doc_id").alias("_drawn_id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("_drawn_id"), "left_semi")

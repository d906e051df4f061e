"""Line dedup with overlapping three-line windows (operator 4), DataFrame functions only.

Every run of three consecutive lines of a document is hashed (128 bits over the lines themselves).
Windows found more than once in the corpus keep their first occurrence, in the order of doc_id and
position; the positions that later occurrences cover are merged and those lines removed. A removed
line always stands, with equal content, earlier in the corpus: nothing disappears everywhere.

The text takes part in one shuffle, to meet the positions to remove; what is grouped globally is a
hash, an id and a position for each window, combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import join_counted, staged
from tessella.operators.staging import unused

WINDOW = 3
N_LINES, N_REMOVED = "_n_lines", "_n_removed"


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``text`` shortened, plus ``_n_lines`` and ``_n_removed``.

    Lines end at \\n and count as they are. Documents with fewer than ``window`` lines, null and
    empty texts are unchanged (a null text has no line, an empty one has one). Rows with a null
    doc_id come before all others. Of rows that repeat with one doc_id and text, all are treated
    alike: a window counts once for them, so such copies do not remove each other. Very long texts are
    read whole; rows of a window so common that it holds over a thousandth of all repeated ones are dealt
    over tasks by a salt. Other columns stay as they are, whatever their names, but for columns named
    ``_n_lines`` and ``_n_removed``, which are replaced. An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c not in (N_LINES, N_REMOVED)]
    ident, key, at, gone, cut = unused([*others, N_LINES, N_REMOVED], "_id", "_key", "_at", "_gone", "_lines")
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in others], F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias(ident), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias(key)
    )
    lines = F.split(F.col("text"), "\n", -1)
    # windows as a zip of shifted copies: the lambda sees only its element, and costs the same for any length
    shifted = [F.slice(cut, k + 1, F.size(cut) - (window - 1)).alias(f"l{k}") for k in range(window)]
    hashes = F.transform(F.arrays_zip(*shifted), lambda w: F.unhex(F.md5(F.concat_ws("\n", *[w[f"l{k}"] for k in range(window)]))))
    # no line holds \n, so the joined window is unambiguous
    seen = keyed.select(ident, key, lines.alias(cut)).filter(F.size(cut) >= window).select(ident, key, F.posexplode(hashes).alias(at, "hash"))
    place = F.struct(ident, key, at)
    repeated = seen.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = join_counted(seen, staged(repeated, "line-windows"), ["hash"], "n").filter(place > F.col("first"))
    covered = later.groupBy(ident, key).agg(F.collect_set(at).alias(at)).select(
        ident, key, F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + (window - 1))))).alias(gone)
    )
    merged = keyed.join(covered, [ident, key], "left").withColumn(cut, lines)
    left = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col(gone))
    kept = F.concat_ws("\n", F.transform(left, lambda p: F.element_at(F.col(cut), p + 1)))
    whole = F.col(gone).isNull()
    return merged.select(
        *[F.when(whole, F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in others],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(cut)).cast("long").alias(N_LINES),
        F.when(whole, 0).otherwise(F.size(gone)).cast("long").alias(N_REMOVED),
    )

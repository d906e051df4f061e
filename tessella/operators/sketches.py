"""Join diagnostics from sketches that are kept for each input file, so a new file does not rescan the old ones.

A file's sketches are a theta sketch of its ids, one of its ids without leading zeros, an HLL sketch of the ids and a KLL sketch
of their lengths: some hundred kilobytes, whatever the file has. They merge in any order. Below 2^``LG_K`` distinct ids
theta sketches count exactly; beyond that the standard error of a union is 2^(-``LG_K`` / 2), 0.4 %, and that of an
overlap or difference is this share of the union.

Where counts must be exact, ids are dealt by a hash over ``slots_for`` slots, and a file has sketches for each slot, so that none
reaches that bound however many ids there are. Sketches then grow with the ids, by 8 bytes for each form of each id of a file; two ids
are taken for one only where 63 bits of their hash and the slot are equal, some 2e-15 times for each id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import normalize_str
from tessella.operators.evaluate import without_leading_zeros

LG_K, HLL_K, KLL_K = 16, 14, 400
STORED = "file string, slots int, slot int, n long, ids binary, loose binary, hll binary, lengths binary"


def _sketches() -> list[Column]:
    return [
        F.count("*").alias("n"), F.theta_sketch_agg("id", LG_K).alias("ids"), F.theta_sketch_agg(without_leading_zeros(F.col("id")), LG_K).alias("loose"),
        F.hll_sketch_agg("id", HLL_K).alias("hll"), F.kll_sketch_agg_bigint(F.length("id").cast("long"), KLL_K).alias("lengths"),
    ]


def slots_for(df: DataFrame, column: str) -> int:
    """A power of two of slots, in which a quarter of what sketches count exactly lies at most, by an estimate that errs by 2 %."""
    n = df.agg(F.approx_count_distinct(normalize_str(column), 0.02)).first()[0]
    return 1 << math.ceil(math.log2(max(1, n / 2 ** (LG_K - 2))))


def file_sketches(df: DataFrame, column: str, file: Column, slots: int = 1) -> DataFrame:
    """``file, slots, slot, n, ids, loose, hll, lengths``: a row for each file and slot that has ids; blank ids do not count.

    An id lies in the slot of its form without leading zeros, so both of its forms do.
    """
    ids = df.select(file.alias("file"), normalize_str(column).alias("id")).filter("id != ''")
    slot = F.pmod(F.xxhash64(without_leading_zeros(F.col("id"))), F.lit(slots)).cast("int")
    return ids.groupBy("file", F.lit(slots).alias("slots"), slot.alias("slot")).agg(*_sketches())


def update_sketches(spark: SparkSession, store: str, paths: Sequence[str], read: Callable[[str], DataFrame], column: Callable[[DataFrame], str], slots: int = 1) -> DataFrame:
    """The sketches of ``paths``: those in ``store``, and those of files that it lacks, which alone are read and are added to it.

    A store may hold a file under several numbers of slots; rows of before there were slots have one.
    """
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    held = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs)
    stored = lambda: spark.read.schema(STORED).parquet(store).fillna({"slots": 1, "slot": 0}).filter(F.col("slots") == slots)
    known = {r["file"] for r in stored().select("file").distinct().collect()} if held else set()  # names of files
    for path in [p for p in paths if p not in known]:
        df = read(path)
        file_sketches(df, column(df), F.lit(path), slots).write.mode("append").parquet(store)
    if not held and not [p for p in paths if p not in known]:
        return spark.createDataFrame([], STORED)
    return stored().filter(F.col("file").isin(*paths))


def merged(sketches: DataFrame, *by: Column) -> DataFrame:
    """One row for all files, or for each value of ``by``: the number of ids with repeats, and the united sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.theta_union_agg("ids", LG_K).alias("ids"), F.theta_union_agg("loose", LG_K).alias("loose"), F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
    )


def sketched_overlap(left: DataFrame, right: DataFrame, slots: int = 1) -> DataFrame:
    """What ``evaluate.id_overlap`` says, from the merged sketches of both sides, in one row.

    With more than one slot, which all sketches must have, slots are counted apart and summed; a slot that cannot be counted exactly is an error.
    """
    fits = F.when(F.col("slots") % slots == 0, F.col("slot") % slots).otherwise(F.raise_error(F.lit(f"sketches of fewer than {slots} slots")))
    l, r = (merged(side, fits.alias("slot")).select("slot", F.col("ids").alias(f"{n}_ids"), F.col("loose").alias(f"{n}_loose")) for n, side in (("l", left), ("r", right)))

    def count(*sketches: Column) -> Column:
        n = F.coalesce(*[F.theta_sketch_estimate(c) for c in sketches], F.lit(0)).cast("long")
        return n if slots == 1 else F.when(n < 2**LG_K, n).otherwise(F.raise_error(F.lit(f"a slot of {slots} holds more ids than are counted exactly")))

    numbers = l.join(r, "slot", "full").select(  # a slot without ids on one side has all of the other for difference
        count(F.col("l_ids")).alias("n_left"), count(F.col("r_ids")).alias("n_right"), count(F.theta_intersection("l_ids", "r_ids")).alias("n_both"),
        count(F.theta_difference("l_ids", "r_ids"), F.col("l_ids")).alias("n_left_only"), count(F.theta_difference("r_ids", "l_ids"), F.col("r_ids")).alias("n_right_only"),
        count(F.theta_intersection("l_loose", "r_loose")).alias("n_both_without_zeros"),
    )
    summed = numbers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers.columns])
    return summed.withColumn("match_percent", F.round(F.when(F.col("n_left") > 0, 100.0 * F.col("n_both") / F.col("n_left")), 1))


def length_quantiles(sketches: DataFrame, at: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """``quantile, length, n_distinct``: lengths of ids at quantiles, and the estimate of distinct ids by HLL."""
    one = merged(sketches).filter("lengths is not null")
    points = F.array(*[F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_bigint("lengths", F.lit(q)).alias("length")) for q in at])
    return one.select(F.explode(points).alias("x"), F.hll_sketch_estimate("hll").alias("n_distinct")).select("x.*", "n_distinct")

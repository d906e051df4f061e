"""Structured Streaming over arriving reports: an extension; results are those of the batch plan.

Evidence is stateless; the latest report of a key is a stateful aggregate with a watermark; results
are upserted batch by batch, in buckets of keys, so a restart repeats at most the batch that was under
way and a batch rewrites only the buckets that it touches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.config import Settings
from tessella.operators.evidence import with_evidence
from tessella.operators.relational import ORDER, resume_key, upsert
from tessella.plans.tasks import ExtractionTask
from tessella.sources.sinks import current_version, next_version, publish


def stream_evidence(reports: DataFrame, task: ExtractionTask, text: str = "report_text", settings: Settings = Settings()) -> DataFrame:
    """Evidence of every arriving report; works on a stream as on a table."""
    return with_evidence(reports, task, text, settings)


def latest_in_window(reports: DataFrame, key: str, time: str, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Latest row of each key in tumbling windows; rows later than the watermark are left out."""
    rest = [c for c in reports.columns if c not in (key, time)]
    w = F.window(time, length)
    return reports.withWatermark(time, late).groupBy(w, key).agg(F.max(time).alias(time), F.max_by(F.struct(*rest), F.col(time)).alias("_row"), F.count("*").alias("n")).select(
        F.col("window.start").alias("window_start"), key, time, "_row.*", "n"
    )


def current_rows(spark: SparkSession, output: str) -> DataFrame | None:
    """The results of ``upsert_sink`` so far; None before the first batch."""
    held = _buckets(spark, current_version(spark, output))
    return spark.read.parquet(*held.values()) if held else None


def _buckets(spark: SparkSession, version: str | None) -> dict[int, str]:
    """Where the rows of each bucket stand that a version names."""
    return {r["bucket"]: r["path"] for r in spark.read.json(f"{version}/buckets", "bucket int, path string").collect()} if version else {}


def upsert_sink(spark: SparkSession, output: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: merge a micro-batch into the current results by resume key.

    Rows are held in buckets of their keys; a batch rewrites the buckets that it touches, and the new
    version names these and the others where they are. Order continues within a bucket.
    """

    def bucket(df: DataFrame) -> DataFrame:
        key = resume_key(df.drop(ORDER))
        return df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    def sink(batch: DataFrame, _: int) -> None:
        before = current_version(spark, output)
        held = _buckets(spark, before)
        rows = batch if ORDER in batch.columns else batch.withColumn(ORDER, F.monotonically_increasing_id())
        touched = [r["_bucket"] for r in bucket(rows).select("_bucket").distinct().collect()]  # at most one for each bucket
        if not touched:
            return
        old = [held[b] for b in touched if b in held]
        empty = spark.createDataFrame([], rows.schema)
        merged = upsert(spark.read.parquet(*old) if old else empty, rows)
        version = next_version(output, before)
        bucket(merged).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{version}/rows")
        named = held | {b: f"{version}/rows/_bucket={b}" for b in touched}
        spark.createDataFrame(sorted(named.items()), "bucket int, path string").coalesce(1).write.json(f"{version}/buckets")
        publish(output, version)

    return sink

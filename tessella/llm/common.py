"""Shared plumbing of the corpus operators: the shared folder, staged tables, Arrow helpers.

Lineage is cut with tables written to the folder named in ``spark.checkpoint.dir`` (the only
folder besides the warehouse that driver and executors share). Nothing here touches local disk
on a cluster: without that setting a cluster is an error, and only a local session gets a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.staging import checkpoint_folder, small_batches, unused  # noqa: F401

_CREATED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that every executor and the driver can reach; checkpoints go there too."""
    checkpoint_folder(spark)
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (path or spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _CREATED.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans start from files."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete every table and folder the operators of this process left in the shared folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _CREATED:
        path = jvm.org.apache.hadoop.fs.Path(_CREATED.pop())
        path.getFileSystem(conf).delete(path, True)


COMMON_SHARE, SALTS = 1000, 64


def common_keys(table: DataFrame, count: str) -> tuple[DataFrame, DataFrame]:
    """``table``, a row for each key with the ``count`` of its rows, in two parts: keys that hold over a
    ``COMMON_SHARE``-th of all counted rows, and the rest. The first part has fewer than ``COMMON_SHARE``
    rows whatever the data, so it may be broadcast, and rows with such keys need not meet in one task.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    often = F.col(count) * COMMON_SHARE > F.lit(total)
    return table.filter(often).drop(count), table.filter(~often).drop(count)


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, a row for each key with the ``count`` of its rows.

    Rows whose key holds over a ``COMMON_SHARE``-th of the rows are told by a broadcast of those keys and
    dealt over ``SALTS`` tasks; the table has a row for each. So no task gathers a common key's rows, and
    the rows are read once. ``table`` is read three times: stage it.
    """
    mark, salt = unused([*rows.columns, *table.columns], "_common", "_salt")
    often, seldom = common_keys(table, count)
    marked = rows.join(F.broadcast(often.select(*keys, F.lit(True).alias(mark))), keys, "left")
    dealt = F.when(F.col(mark), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))).otherwise(0).cast("int")  # by the row alone: a task that runs again deals alike
    spread = often.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return marked.withColumn(salt, dealt).join(spread.unionByName(seldom.withColumn(salt, F.lit(0))), [*keys, salt]).drop(mark, salt)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, chunk_bytes: int = 0) -> DataFrame:
    """``mapInArrow`` with state per task: ``make`` builds the batch function on the executor.

    With ``chunk_bytes`` batches are put together until they hold so many bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        held, size = [], 0
        for batch in batches:
            if not chunk_bytes:
                yield step(batch)
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= chunk_bytes:
                yield step(joined(held))
                held, size = [], 0
        if held:
            yield step(joined(held))

    return df.mapInArrow(run, schema)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    columns = [pa.concat_arrays([b.column(k) for b in batches]) for k in range(batches[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batches[0].schema)


def ragged(start: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places, in a pool, of the entries ``order`` one behind the other, and where each entry ends."""
    n = size[order]
    ends = np.cumsum(n, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(size) and int(start.max())) < 2**31 else np.int64  # half the memory to go through
    return np.repeat((start[order] - ends + n).astype(kind), n) + np.arange(total, dtype=kind), ends

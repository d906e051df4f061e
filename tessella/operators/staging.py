"""Rows fixed in the shared folder, so that plans that read them twice read the same rows twice, and the size of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> None:
    """Let checkpoints go to the folder named in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder; a cluster must name one, since its
    executors have no local folder in common.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tessella-")
    context.setCheckpointDir(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that driver and executors share."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def fixed(df: DataFrame) -> DataFrame:
    """``df`` written once: later plans neither compute nor partition it again."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts fits beside its results.

    Plans read the setting when they run, so it stays lowered in the session; other plans get smaller
    batches by it, and nothing else.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores put in front until no column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out

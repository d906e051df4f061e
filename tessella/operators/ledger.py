"""Answers of the model that are known already: a ledger of calls in a shared folder.

An answer is kept under a hash of the client, its parameters and the prompts, so what was asked once is not
asked again: not by a task that was killed and runs anew, and not by a later run that is told to resume.
A task appends to a file of its own and flushes after every answer; where a store shows files only when they
are closed (object stores), a killed task loses the answers it had. Failed calls are not kept.

The ledger may hold an answer several times, when equal questions were asked at once; the least one counts.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "key string, answer string"


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    import os

    return pafs.FileSystem.from_uri(path if urlparse(path).scheme else f"file://{os.path.abspath(path)}")


@dataclass(frozen=True)
class Ledger:
    path: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def known(self, spark: SparkSession) -> DataFrame | None:
        """``key, answer`` of all earlier runs; None before the first."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        lines = spark.read.schema(ROWS).option("recursiveFileLookup", True).json(self.path)  # a line that was cut off has no key
        return lines.filter("key is not null and answer is not null").groupBy("key").agg(F.min("answer").alias("answer"))

    def page(self, task: int) -> Page:
        return Page(self, task)


class Page:
    """What one task of a run writes, and what its earlier attempts wrote."""

    def __init__(self, ledger: Ledger, task: int):
        self.store, root = store_of(ledger.path)
        self.folder = f"{root}/run-{ledger.run}/task-{task}"
        self.lock, self.stream = threading.Lock(), None

    def earlier(self) -> dict[str, dict]:
        """Answers of this task's attempts before, by key."""
        found: dict[str, dict] = {}
        for file in self.store.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True)):
            for line in self.store.open_input_stream(file.path).read().decode("utf-8", "replace").splitlines():
                try:
                    row = json.loads(line)
                    found[row["key"]] = json.loads(row["answer"])
                except (ValueError, KeyError):
                    continue
        return found

    def put(self, key: str, answer: dict) -> None:
        line = json.dumps({"key": key, "answer": json.dumps(answer, ensure_ascii=False, sort_keys=True)}, ensure_ascii=False)
        with self.lock:
            if self.stream is None:
                self.store.create_dir(self.folder, recursive=True)
                self.stream = self.store.open_output_stream(f"{self.folder}/{uuid.uuid4().hex}.json")
            self.stream.write(f"{line}\n".encode())
            self.stream.flush()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()

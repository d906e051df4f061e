"""Sharding by extendible hashing (operator 9).

A row's bucket is a prefix of its hash bits. The directory starts with one bucket; only a bucket
over the byte limit splits, on the next bit, until every shard fits. The finished directory is a table of
prefixes in the order of hashes. Splits are decided on sums: a pass sums the rows of the buckets still over the limit by
``STEP`` further bits, and each such bucket is split on these sums by a task, which has at most 2^``STEP`` of them
whatever the rows are. Nothing of the directory passes through the driver, and rows move once, when the shards are
written.

Rows find their shard by a broadcast of the directory, indexed by the first hash bits, where it has at most
``HELD`` shards (8 bytes each, as checked by a count); a larger directory is joined with the distinct hashes
by the prefixes of the depths there are. A row larger than the limit, or rows that share all 64 hash bits, cannot be
split and form a shard of their own that is marked ``oversize``; the rows of such a shard are written by as many tasks as
it holds limits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import fresh_path, staged
from tessella.operators.relational import with_row_order
from tessella.operators.staging import unused

LIMIT_BYTES = 32 << 20
STEP, SLOT_BITS, HELD = 12, 20, 1 << 23
_TOP = 64
_GROWN = "done boolean, prefix long, depth int, size long, rows long"


@dataclass(frozen=True)
class Lookup:
    """Shards in prefix order: ``start`` is the smallest hash of each, as an unsigned number."""

    start: np.ndarray
    depth: np.ndarray
    parts: np.ndarray

    @cached_property
    def bits(self) -> int:
        """Hash bits that index the slots."""
        return min(int(self.depth.max()), SLOT_BITS)

    @cached_property
    def slots(self) -> np.ndarray:
        """The shard of every prefix of ``bits`` bits; -1 where several shards share one."""
        spread = np.where(self.depth <= self.bits, 1 << np.maximum(self.bits - self.depth, 0), 0)
        out = np.full(1 << self.bits, -1, np.int64)
        at = (self.start >> np.uint64(_TOP - self.bits)).astype(np.int64) if self.bits else np.zeros(len(self.start), np.int64)
        out[np.repeat(at - np.cumsum(spread) + spread, spread) + np.arange(int(spread.sum()))] = np.repeat(np.arange(len(at)), spread)
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        found = self.slots[(h >> np.uint64(_TOP - self.bits)).astype(np.int64)] if self.bits else np.broadcast_to(self.slots, len(h)).copy()
        deep = np.flatnonzero(found < 0)
        found[deep] = np.searchsorted(self.start, h[deep], side="right") - 1
        return found


@dataclass(frozen=True)
class Directory:
    """``table``: ``shard, start`` (smallest hash)``, depth, n_bytes, n_rows, oversize, parts`` (tasks that write it), a row for
    each shard in prefix order; ``more``: the parts of shards that have several."""

    table: DataFrame
    count: int
    more: int

    def lookup(self) -> Lookup:
        """The directory as arrays; for at most ``HELD`` shards."""
        held = self.table.select("shard", "start", "depth", "parts").toPandas().sort_values("shard")
        return Lookup(held["start"].to_numpy().view(np.uint64), held["depth"].to_numpy().astype(np.int64), held["parts"].to_numpy().astype(np.int32))


def _grow(cell: np.ndarray, size: np.ndarray, rows: np.ndarray, base: int, depth: int, limit: int) -> list[tuple]:
    """Split one bucket of ``base`` bits, given by the sums of its cells of ``depth`` bits: (done, prefix, depth, size, rows)."""
    order = np.argsort(cell.view(np.uint64))
    cell, sizes, counts = cell.view(np.uint64)[order], np.append(0, np.cumsum(size[order])), np.append(0, np.cumsum(rows[order]))
    first = int(cell[0]) >> (depth - base) << (depth - base)
    local = (cell - np.uint64(first)).astype(np.int64)
    out: list[tuple] = []

    def split(a: int, z: int, at: int, bits: int) -> None:
        """The cells a to z, which begin at ``at`` within the bucket and share ``bits`` bits."""
        held, n = int(sizes[z] - sizes[a]), int(counts[z] - counts[a])
        fits = held <= limit or bits == _TOP or n <= 1
        if fits or bits == depth:
            prefix = (first + at) >> (depth - bits)
            out.append((fits, prefix - (1 << 64) if prefix >> 63 else prefix, bits, held, n))
            return
        half = at + (1 << (depth - bits - 1))
        middle = int(np.searchsorted(local, half))
        split(a, middle, at, bits + 1)
        split(middle, z, half, bits + 1)

    split(0, len(cell), 0, base)
    return out


def _grown(base: int, depth: int, limit: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_grow(pdf["cell"].to_numpy(), pdf["size"].to_numpy(), pdf["rows"].to_numpy(), base, depth, limit), columns=["done", "prefix", "depth", "size", "rows"])

    return grow


def build_directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> Directory:
    """``rows(h long, size long)`` -> the directory under which no shard of several rows is over ``limit``."""
    if limit <= 0:
        raise ValueError("the byte limit is positive")
    prefix = lambda c, bits, of=_TOP: F.shiftrightunsigned(c, of - bits) if bits else F.lit(0).cast("long")
    found, kept, base = [], rows, 0
    while True:
        depth = min(_TOP, base + STEP)
        cells = kept.groupBy(prefix("h", depth).alias("cell")).agg(F.sum("size").cast("long").alias("size"), F.count("*").alias("rows"))
        grown = staged(cells.withColumn("bucket", prefix("cell", base, depth)).groupBy("bucket").applyInPandas(_grown(base, depth, limit), _GROWN), "shard-buckets")
        found.append(grown.filter("done").select(F.expr(f"CASE WHEN depth = 0 THEN 0L ELSE shiftleft(prefix, {_TOP} - depth) END").alias("start"), "depth", "size", "rows"))
        active = grown.filter("not done").select(F.col("prefix").alias("p"))
        if active.isEmpty():
            break
        base = depth
        kept = rows.join(active, prefix("h", base) == F.col("p"), "left_semi")
    leaves = reduce(DataFrame.unionByName, found)
    if leaves.isEmpty():
        leaves = rows.sparkSession.createDataFrame([(0, 0, 0, 0)], "start long, depth int, size long, rows long")
    unsigned = leaves.withColumn("_at", F.col("start").bitwiseXOR(F.lit(-(1 << 63))))
    numbered = with_row_order(unsigned, "_at", into="_shard")
    parts = F.when((F.col("size") > limit) & (F.col("rows") > 1), F.least(F.ceil(F.col("size") / limit), F.col("rows"))).otherwise(1)
    table = staged(numbered.select(F.col("_shard").cast("int").alias("shard"), "start", "depth", F.col("size").alias("n_bytes"), F.col("rows").alias("n_rows"), (F.col("size") > limit).alias("oversize"), parts.cast("int").alias("parts")), "shard-directory")
    known = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("parts") > 1, F.col("parts"))), F.lit(0)).alias("more")).first()
    return Directory(table, known["n"], known["more"])


def _joined_shards(hashed: DataFrame, h: str, directory: Directory) -> DataFrame:
    """``h, number, parts`` of every distinct hash by joins: of its prefixes one is in the directory."""
    leaves = directory.table.select("depth", F.expr(f"CASE WHEN depth = 0 THEN 0L ELSE shiftrightunsigned(start, {_TOP} - depth) END").alias("prefix"), F.col("shard").alias("number"), "parts")
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]  # at most 65
    tried = F.array(*[F.struct(F.lit(d).alias("depth"), (F.shiftrightunsigned(h, _TOP - d) if d else F.lit(0).cast("long")).alias("prefix")) for d in depths])
    keys = hashed.select(h).distinct().select(h, F.explode(tried).alias("x")).select(h, "x.*")
    return staged(keys.join(leaves, ["depth", "prefix"]).select(h, "number", "parts"), "shard-hashes")


def _placed(docs: DataFrame, limit: int, key: str) -> tuple[DataFrame, str, str, Directory]:
    """``docs`` with their shards and the parts of these, the names of both columns, and the directory."""
    shard, parts, h, found = unused(docs.columns, "shard", "_parts", "_h", "_found")
    hashed = docs.withColumn(h, F.xxhash64(F.col(f"`{key}`")))
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    directory = build_directory(staged(hashed.select(F.col(h).alias("h"), size.alias("size")), "shard-sizes"), limit)
    names = [F.col(f"`{c}`") for c in docs.columns]
    if directory.count > HELD:
        known = _joined_shards(hashed, h, directory).select(h, F.struct("number", "parts").alias(found))
        placed = hashed.join(known, h)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(directory.lookup())  # at most HELD shards

        @F.pandas_udf("number int, parts int")
        def find(h: pd.Series) -> pd.DataFrame:
            number = shared.value.find(h.to_numpy())
            return pd.DataFrame({"number": number.astype(np.int32), "parts": shared.value.parts[number]})

        placed = hashed.withColumn(found, find(h))
    return placed.select(*names, F.col(found)["number"].alias(shard), F.col(found)["parts"].alias(parts)), shard, parts, directory


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id") -> tuple[DataFrame, Directory]:
    """Adds the shard to every row of ``docs``, as its last column; a row weighs the UTF-8 bytes of its text.

    That column is named ``shard``, or where ``docs`` have such a column ``_shard``, and so on. Null
    texts weigh nothing; rows with a null key hash together with 42, the hash's seed; rows repeated
    with one key stay together (and are oversize if they alone exceed the limit), and so does a text
    longer than the limit. Other columns stay as they are, whatever their names. An empty table has one
    empty shard.
    """
    placed, _, parts, directory = _placed(docs, limit, key)
    return placed.drop(parts), directory


def write_shards(docs: DataFrame, folder: str | None = None, limit: int = LIMIT_BYTES, key: str = "doc_id") -> tuple[DataFrame, Directory]:
    """Write ``docs`` as one folder ``shard=N`` for each shard; returns the rows read back.

    Columns and cases are those of ``assign_shards``, which names the last column.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "shards")
    rows, shard, parts, directory = _placed(docs, limit, key)
    salt = F.pmod(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.col(parts))  # by the row alone: a task that runs again deals alike
    spread = F.pmod(F.xxhash64(shard, salt), F.lit(max(1, directory.more))) + directory.count
    task = F.when(F.col(parts) == 1, F.col(shard)).otherwise(spread).cast("int")  # a task for each shard, and more for those that cannot be split
    rows.withColumn(parts, task).repartitionById(directory.count + directory.more, F.col(parts)).drop(parts).write.partitionBy(shard).parquet(folder)
    return spark.read.schema(rows.drop(parts).schema).parquet(folder), directory

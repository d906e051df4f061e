"""Token ids in bit-packed files (operator 2).

File layout, little-endian: blocks of ``BLOCK_IDS`` ids (the last may be shorter), each id in the
minimum bits for the vocabulary and each block padded to a byte; then the footer: byte offsets of
the blocks, the first id position of every document plus the end, document ids, a null flag for
each document id; then a fixed trailer. Any block can be unpacked alone with numpy, so a reader
finds ids by position without reading what stands before them.

Shards hold ascending document ids. Every attempt of a task writes files of its own names, and the
manifest, which Spark commits for one attempt of each task, says which of them count: a task that runs
again needs neither a rename nor a delete, and a half-written shard is never listed.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import fresh_path, joined, ragged, small_batches, staged

MAGIC = b"TSLBITS1"
TRAILER = struct.Struct("<8sBxxxxxxxQQQQ")  # magic, bits, ids, documents, ids in a block, footer's place
BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 26  # a task starts another shard beyond this
END_ID = 0
# letters of old standing on which all versions of Unicode agree, then ASCII punctuation but the apostrophe
_STOP = r"([A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-я])([!-&(-/:-@\[-`{-~])"
_BLANK = r"\t\n\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNSAFE = rf"^(?:[{_BLANK}]| [ {_BLANK}])|[ {_BLANK}]$"
_MEET = ("\0", "  ", "\n\n", "\n ", " \n")
CHUNK_BYTES = 24 << 20  # text that an encoder takes at a time


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits for each id, least significant first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    out = np.zeros(count, np.uint32)
    for k in range(bits):
        out |= planes[:, k].astype(np.uint32) << np.uint32(k)
    return out


class ShardWriter:
    """Writes one shard as ids come; holds one block of ids and the document table. Complete with ``close``."""

    def __init__(self, store: pafs.FileSystem, path: str, bits: int, block_ids: int = BLOCK_IDS):
        self.path, self.bits, self.block_ids = path, bits, block_ids
        self.out = store.open_output_stream(path)
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = self.at = 0
        self.offsets, self.starts, self.docs, self.nulls = [0], [0], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ids += len(ids)
        self.starts.append(self.ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for k in range(0, whole, self.block_ids):
            data = pack(ids[k : min(k + self.block_ids, whole)], self.bits)
            self.out.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> tuple[str, int, int]:
        self._write(last=True)
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.docs, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, self.ids, len(self.docs), self.block_ids, self.at))
        self.out.close()
        return self.path, len(self.docs), self.ids


class ShardReader:
    """Random access to one shard: documents and id ranges."""

    def __init__(self, store: pafs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, self.bits, self.ids, n, self.block_ids, foot = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard of token ids")
        table = self.file.read_at(size - TRAILER.size - foot, foot)
        blocks = -(-self.ids // self.block_ids)
        self.offsets = np.frombuffer(table, "<u8", blocks + 1).astype(np.int64)
        self.starts = np.frombuffer(table, "<u8", n + 1, 8 * (blocks + 1)).astype(np.int64)
        docs = np.frombuffer(table, "<i8", n, 8 * (blocks + n + 2)).tolist()
        nulls = np.frombuffer(table, "u1", n, 8 * (blocks + 2 * n + 2))
        self.docs = [None if x else d for d, x in zip(docs, nulls)]

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard, from the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        parts = []
        for b in range(first, last + 1):
            a, z = int(self.offsets[b]), int(self.offsets[b + 1])
            parts.append(unpack(self.file.read_at(z - a, a), min(self.block_ids, self.ids - b * self.block_ids), self.bits))
        return np.concatenate(parts)[start - first * self.block_ids : end - first * self.block_ids]

    def documents(self, span: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document as (doc_id, first position, ids), reading about ``span`` ids at a time."""
        k = 0
        while k < len(self.docs):
            to = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + span, side="right")) - 1)
            base = int(self.starts[k])
            ids = self.range(base, int(self.starts[to]))
            for d in range(k, to):
                yield self.docs[d], int(self.starts[d]), ids[int(self.starts[d]) - base : int(self.starts[d + 1]) - base]
            k = to


class UnitEncoder:
    """Encodes texts with the tokenizers library, each distinct unit of a chunk of texts once.

    Texts are cut before each space, around each line feed and between a letter and punctuation. After
    a character that is not white space a byte-level pre-tokenizer always begins anew there, so the ids of the units in a row are
    the whole text's. Texts where white space meets (two spaces, blank lines, CR LF and the like)
    are encoded whole, and so are texts that hold the string of an added token, which the library
    takes for that token wherever it stands. Cutting and finding the distinct units is Arrow's work,
    putting ids in a row is numpy's; nothing is kept between chunks.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.end = np.array([end_id], "<u4")
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None

    def _encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row and the number of each one's; no unit holds a line feed."""
        if self.feed is None:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(units.to_pylist(), add_special_tokens=False)]
            return np.array([x for ids in found for x in ids], "<u4"), np.fromiter(map(len, found), np.int64, len(found))
        pool, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        bounds = np.append(np.arange(0, len(units), 3000), len(units)).astype(np.int32)
        groups = pc.binary_join(pa.ListArray.from_arrays(bounds, units), "\n").to_pylist()
        for k in range(0, len(groups), 8):  # a line feed between units is a token of its own
            lines = [group + "\n" for group in groups[k : k + 8]]
            for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
                ids = np.array(e.ids, "<u4")
                feeds = np.flatnonzero(ids == self.feed)
                sizes.append(np.diff(feeds, prepend=-1) - 1)
                pool.append(ids[ids != self.feed])
        return np.concatenate(pool), np.concatenate(sizes)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and where each text begins (and the last ends)."""
        texts = pc.fill_null(texts, "")
        meets = reduce(pc.or_, [pc.match_substring(texts, x) for x in (*_MEET, *self.added)])
        marked = pc.replace_substring(pc.replace_substring(pc.if_else(meets, "", texts), "\n", "\0\n\0"), " ", "\0 ")
        cut = pc.split_pattern(pc.replace_substring_regex(marked, _STOP, "\\1\0\\2"), "\0")
        coded = cut.values.dictionary_encode()
        units = coded.dictionary
        which, bounds = coded.indices.to_numpy(), cut.offsets.to_numpy().astype(np.int64)
        lone = pc.equal(units, "\n").to_numpy(zero_copy_only=False)
        plain = ~lone & pc.not_equal(units, "").to_numpy(zero_copy_only=False)
        # beside others a unit is unsafe that ends in white space, or begins with white space but for one space
        unsafe = plain & pc.match_substring_regex(units, _UNSAFE).to_numpy(zero_copy_only=False)
        whole = meets.to_numpy(zero_copy_only=False)
        if unsafe.any():
            hits = np.concatenate([[0], np.cumsum(unsafe[which])])
            whole = whole | (hits[bounds[1:]] > hits[bounds[:-1]])
        fine = np.flatnonzero(plain & ~unsafe)
        pool, sizes = self._encode(units.take(pa.array(fine)))
        size, start = np.zeros(len(units) + 1, np.int32), np.zeros(len(units) + 1, np.int32)
        size[fine], start[fine] = sizes, np.cumsum(sizes) - sizes
        feed = np.array(self.tokenizer.encode("\n", add_special_tokens=False).ids, "<u4")
        size[:-1][lone], start[:-1][lone] = len(feed), len(pool)
        size[-1], start[-1] = 1, len(pool) + len(feed)  # the end id, put behind each text as one more unit
        pool = np.concatenate([pool, feed, self.end])
        order = np.insert(which, bounds[1:], len(size) - 1)
        places, ends = ragged(start, size, order)
        ids = pool[places]
        offsets = np.concatenate([[0], ends[bounds[1:] + np.arange(len(texts))]]) if len(texts) else np.zeros(1, np.int64)
        if whole.any():
            parts = np.split(ids, offsets[1:-1])
            at = np.flatnonzero(whole).tolist()
            for d, e in zip(at, self.tokenizer.encode_batch_fast([texts[d].as_py() for d in at], add_special_tokens=False)):
                parts[d] = np.append(np.array(e.ids, "<u4"), self.end)
            ids, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, offsets


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into shards under ``folder`` and return their manifest.

    ``manifest``: part, seq, path, n_docs, n_ids, in file order by (part, seq). Ids of documents
    ascend through the shards (null ids first, rows repeated with an id by text); a null text is
    an empty one; every document ends with ``end_id``. An empty table gives no shard and an empty
    manifest. Texts are encoded whole, however long; one text and its ids fit in a task. Columns other
    than ``doc_id`` and ``text`` play no part, whatever their names. ``tokenizer`` is a path on every
    executor; ``folder`` a URI that pyarrow can open there (a shared mount, HDFS, an object store).
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    folder = folder or fresh_path(spark, "tokens")
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        store, root = pafs.FileSystem.from_uri(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        encode, writer, done = UnitEncoder(tokenizer, end_id), None, []

        def put(batch: pa.RecordBatch) -> None:
            nonlocal writer
            ids, offsets = encode(batch.column(1))
            for doc_id, a, z in zip(batch.column(0).to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                if writer and writer.ids >= shard_ids:
                    done.append(writer.close())
                    writer = None
                writer = writer or ShardWriter(store, f"{root}/part-{part:06d}-{len(done):04d}-{attempt}.bits", bits_for(encode.vocabulary), block_ids)
                writer.add(doc_id, ids[a:z])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= CHUNK_BYTES:
                put(joined(held))
                held, size = [], 0
        if held:
            put(joined(held))
        if writer:
            done.append(writer.close())
        frame = pd.DataFrame([(part, k, f"{folder}/{path.rpartition('/')[2]}", *x) for k, (path, *x) in enumerate(done)], columns=["part", "seq", "path", "n_docs", "n_ids"])
        yield pa.RecordBatch.from_pandas(frame, schema=pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(run, "part long, seq long, path string, n_docs long, n_ids long"), "tokens-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Read shards back: ``doc_id, start, n_tokens, ids_crc32``, a row for each document.

    ``start``: ids of all documents before it. The manifest has one row for each shard of up to
    ``SHARD_IDS`` ids; running totals over it are all that the driver holds.
    """
    spark = manifest.sparkSession
    shards, base, rows = manifest.orderBy("part", "seq").collect(), 0, []
    for s in shards:
        rows.append((s["path"], base))
        base += s["n_ids"]

    def run(batches):
        for pdf in batches:
            for path, base in zip(pdf["path"], pdf["base"]):
                found = []
                for doc_id, start, ids in ShardReader(*pafs.FileSystem.from_uri(path)).documents():
                    found.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(found) == 20_000:
                        yield _frame(found)
                        found = []
                yield _frame(found)

    table = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "k int, path string, base long")
    return table.repartitionById(max(1, len(rows)), F.col("k")).select("path", "base").mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

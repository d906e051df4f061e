"""Substring dedup with repeated-phrase automata (operator 6).

A window is 13 consecutive words. A word goes if a window that covers it also starts in a document
with a smaller id. Five steps:

1. Phrases are 8 words, each word a byte of its hash, so a phrase is 64 bits and a text a string of
   one symbol for each word. Of the 6 phrases of a window the one with the smallest mixed value is its
   anchor: equal windows have equal anchors, at some 29 % of the positions. One aggregate, combined on
   the map side, confirms the anchors that stand in texts of different word sequences.
2. The confirmed phrases of the corpus are dealt to shards of about ``SHARD_PHRASES`` by a hash of their
   first four symbols, and every shard is compiled into an Aho-Corasick automaton in the shared folder.
3. All documents are streamed past the automata. Up to ``ROUTED`` shards a task holds ``HELD_BYTES`` of text
   against one automaton after the other; beyond, the symbols that a document's phrases may cover are sent to the shards
   they begin in, so that a shard is loaded by its own tasks alone, and what was located meets the documents again. They locate every occurrence of their phrases, chosen as an anchor or not; nothing else tells
   where phrases stand. A table of fixed size tells beginnings that some phrase has; an automaton reads
   the words that phrases of its shard may cover by it and skips the others, so that all automata
   together read a word about as often as one would.
4. The windows around located phrases are hashed over all their 13 words, by 128 bits, and the
   smallest document of each is found, combined on the map side.
5. Windows with a smaller document than their own mark their words; the texts that lose some meet the
   marks in one join.

Documents with the word sequence of an earlier document are wholly repeated and need no windows. No
text moves before step 5, but for symbols sent to shards and their way back. Rows of a window or word sequence so common
that it holds over a thousandth of all rows, and of a shard with more than its share, are dealt over tasks by a salt. Loading
of automata is bounded by ``ROUTED`` for every ``HELD_BYTES`` of text; all else grows in proportion. A
document is never split over tasks, and no list is longer than one document.
"""

from __future__ import annotations

import ctypes
import io
import math
import pickle
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import fresh_path, join_counted, joined, map_arrow, small_batches, staged, text_bytes
from tessella.llm.words import mix, rolling, within, word_hashes
from tessella.operators.staging import unused

WINDOW, PHRASE = 13, 8
SHARD_PHRASES = 60_000  # some 330 bytes each in an automaton
LEAD, LEAD_BITS = 4, 26  # symbols that tell where a phrase may begin, and bits of their hash
CHUNK_BYTES = 2 << 20  # text that a worker hashes at a time
HELD_BYTES = 16 << 20  # text that it holds against one automaton after the other
PAGE = 1024  # numbers of the table of beginnings in a row
ROUTED = 64  # shards beyond which documents are sent to them
_SENT = "base int, doc_id long, row_key long, places array<int>, stream binary"
_WINDOWS = "doc_id long, row_key long, places array<int>, ones array<long>, twos array<long>"
_U = np.uint64
_BLANKS = bytes(32 if c in b"\t\n\x0b\x0c\r" else c for c in range(256))


def joined_words(text: bytes) -> bytes:
    """The words of a text, joined by one space."""
    flat = text.translate(_BLANKS)
    return b" ".join(text.split()) if b"  " in flat or flat[:1] == b" " or flat[-1:] == b" " else flat


def symbols(hashes: np.ndarray) -> np.ndarray:
    """The byte that stands for each word."""
    return (hashes >> _U(56)).astype(np.uint8)


def phrases(symbol: np.ndarray, size: int = PHRASE) -> np.ndarray:
    """Every run of ``size`` symbols as a number, the last in its lowest byte."""
    n = max(0, len(symbol) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out << _U(8) | symbol[k : k + n]
    return out


def anchors(texts: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Phrases that are smallest among those of some window, and the text of each; neighbours are distinct."""
    hashes, bounds = word_hashes(texts)
    at, text = within(bounds, window)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(PHRASE, window)
    phrase = phrases(symbols(hashes), size)
    mixed = mix(phrase)  # one to one, so the smallest mixed value tells the phrase
    least, best = mixed[at], phrase[at]
    for k in range(1, window - size + 1):
        less = mixed[at + k] < least
        least, best = np.where(less, mixed[at + k], least), np.where(less, phrase[at + k], best)
    new = np.concatenate([[True], (best[1:] != best[:-1]) | (text[1:] != text[:-1])])
    return best[new], text[new]


class Phrases:
    """The automaton of phrases of ``size`` words given as numbers."""

    def __init__(self, found: np.ndarray, size: int = PHRASE):
        from ahocorasick import STORE_LENGTH, Automaton

        symbol = found.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :]
        # a state's arcs are searched in the order in which they came: frequent symbols come first
        rank = np.empty(256, np.uint8)
        rank[np.argsort(-np.bincount(symbol.ravel(), minlength=256), kind="stable")] = np.arange(256)
        text = symbol[np.lexsort(rank[symbol].T[::-1])].tobytes().decode("latin-1")
        self.size, self.automaton = size, Automaton(STORE_LENGTH)
        for k in range(0, len(text), size):
            self.automaton.add_word(text[k : k + size])
        self.automaton.make_automaton()

    def located(self, stream: bytes, read: np.ndarray) -> np.ndarray:
        """The last place of every occurrence in a stream of symbols that stand at ``read``, with gaps."""
        found = np.fromiter((end for end, _ in self.automaton.iter(stream.decode("latin-1"))), np.int64)
        ends = read[found]
        return ends[ends - read[found - self.size + 1] == self.size - 1]  # not across words that were skipped

    def ends(self, symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The last place of every occurrence, from a stream of the words that phrases begun at ``starts`` cover."""
        if not len(starts):
            return starts
        reach = np.minimum(np.diff(starts, append=starts[-1] + self.size), self.size)  # up to the next beginning
        read = np.arange(int(reach.sum())) + np.repeat(starts - np.cumsum(reach) + reach, reach)
        return self.located(symbol[read].tobytes(), read)


def slots_of(lead: np.ndarray) -> np.ndarray:
    """Hashes of the first symbols of phrases, ``LEAD_BITS`` wide."""
    return lead * np.uint32(0x9E3779B1) >> np.uint32(32 - LEAD_BITS)


def phrase_slots(found: np.ndarray, size: int) -> np.ndarray:
    return slots_of((found >> _U(8 * (size - min(LEAD, size)))).astype(np.uint32))


def bit_table(slots: np.ndarray) -> np.ndarray:
    """A bit for every slot; ``LEAD_BITS`` fix its size, whatever the corpus is."""
    table = np.zeros(1 << LEAD_BITS - 3, np.uint8)
    np.bitwise_or.at(table, slots >> 3, np.uint8(1) << (slots & 7).astype(np.uint8))
    return table


def beginnings(symbol: np.ndarray, size: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a phrase may begin by its first symbols, and their slots."""
    lead = np.zeros(max(0, len(symbol) - size + 1), np.uint32)
    for k in range(min(LEAD, size)):
        lead = lead << np.uint32(8) | symbol[k : k + len(lead)]
    at = slots_of(lead)
    starts = np.flatnonzero(begins[at >> 3] >> (at & 7).astype(np.uint8) & 1)
    return starts, at[starts]


@dataclass
class Shards:
    """The table of beginnings, and the files of automata by the first ``bits`` bits of the slots of their phrases; none
    where documents are sent to the shards."""

    size: int
    bits: int
    begins: np.ndarray
    files: list[tuple[int, str]]


def _compile(confirmed: DataFrame, shard_phrases: int, size: int) -> tuple[Shards, DataFrame] | None:
    """Write an automaton for each shard of ``confirmed(phrase)``: the table of beginnings, and ``base, names`` of the files.

    Phrases are dealt by ranges of the slots of their beginnings, so a place in a text concerns one
    shard; a range that holds too many is dealt again by the phrases' hashes. A task writes files of
    names of its own and the table that Spark commits names the ones that count. The driver gets the table of
    beginnings, of fixed size, and the names of at most ``ROUTED`` files.
    """
    total = confirmed.count()
    if not total:
        return None
    bits = min(20, max(0, math.ceil(math.log2(total / shard_phrases))))
    folder = fresh_path(confirmed.sparkSession, "substring-automata")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            slots = phrase_slots(batch.column(0).to_numpy().view(np.uint64), size)
            base = slots >> np.uint32(LEAD_BITS - bits)
            bit = _U(1) << (slots & np.uint32(63)).astype(np.uint64)
            columns = [batch.column(0), pa.array(base.astype(np.int32)), pa.array((slots >> np.uint32(6)).astype(np.int32)), pa.array(bit.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["phrase", "base", "word", "bit"])

        return step

    ranged = staged(map_arrow(confirmed.select("phrase"), make, "phrase long, base int, word int, bit long"), "substring-ranged")

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        page = np.zeros(PAGE, np.uint64)
        page[pdf["word"].to_numpy() % PAGE] = pdf["bits"].to_numpy().view(np.uint64)
        return pd.DataFrame({"page": [key[0]], "bits": [page.astype("<u8").tobytes()]})

    begins = np.zeros(1 << LEAD_BITS - 6, np.uint64)
    words = ranged.groupBy("word").agg(F.bit_or("bit").alias("bits")).withColumn("page", F.floor(F.col("word") / PAGE).cast("int"))
    for r in words.groupBy("page").applyInPandas(pack, "page int, bits binary").collect():  # the bytes of the table
        begins[r["page"] * PAGE : (r["page"] + 1) * PAGE] = np.frombuffer(r["bits"], "<u8")
    parts = ranged.groupBy("base").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * shard_phrases).select("base", F.ceil(F.col("n") / shard_phrases).alias("parts"))
    dealt = ranged.select("phrase", "base").join(parts, "base", "left")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("phrase"), F.coalesce("parts", F.lit(1))).cast("int"))

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, found = f"shard-{key[0]:06d}-{key[1]:04d}-{uuid.uuid4().hex}", pdf["phrase"].to_numpy().view(np.uint64)
        with store.open_output_stream(f"{root}/{name}", compression="zstd") as out:
            pickle.dump(Phrases(found, size), out)
        _release()
        return pd.DataFrame({"base": [key[0]], "name": [f"{folder}/{name}"]})

    written = staged(dealt.groupBy("base", "part").applyInPandas(write, "base int, name string"), "substring-shards")
    files = [tuple(r) for r in written.collect()] if written.count() <= ROUTED else []
    names = written.groupBy("base").agg(F.array_sort(F.collect_list("name")).alias("names"))
    return Shards(size, bits, begins.astype("<u8").view(np.uint8), sorted(files)), names


_held: dict[str, Phrases] = {}


def _automaton(path: str) -> Phrases:
    """An automaton of ``_compile``; a Python worker keeps the last one, and never two."""
    if path not in _held:
        _held.clear()
        store, place = pafs.FileSystem.from_uri(path)
        with store.open_input_stream(place, compression="zstd") as file:
            _held[path] = pickle.load(io.BufferedReader(file, 1 << 20))
    return _held[path]


def _release() -> None:
    """Give freed memory back, where the C library can: a worker goes on to other tasks beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def occurrences(symbol: np.ndarray, shards: Shards, load=_automaton) -> np.ndarray:
    """The last places of all occurrences of all phrases in a stream of symbols, ascending."""
    starts, slots = beginnings(symbol, shards.size, shards.begins)
    base = slots >> np.uint32(LEAD_BITS - shards.bits)
    order = np.argsort(base, kind="stable")
    starts, base = starts[order], base[order]
    found = [np.zeros(0, np.int64)]
    for number, path in shards.files:
        a, z = np.searchsorted(base, [number, number + 1])
        if a < z:
            found.append(load(path).ends(symbol, starts[a:z]))
    return np.sort(np.concatenate(found))


def located(texts: pa.Array, ends: np.ndarray, size: int = PHRASE, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows around occurrences of phrases, given by their last places: place in the text, text, two hashes."""
    hashes, bounds, others = word_hashes(texts, second=True)
    text = np.searchsorted(bounds, ends, side="right") - 1
    inside = ends - size + 1 >= bounds[text]  # not across the border of two texts
    ends, low, high = ends[inside], bounds[text[inside]], bounds[text[inside] + 1]
    first, last = np.maximum(ends - window + 1, low), np.minimum(ends - size + 2, high - window + 1)
    fits = first < last
    # +1 where a run of windows that hold a phrase begins, -1 behind it
    near = np.bincount(first[fits], minlength=len(hashes) + 1) - np.bincount(last[fits], minlength=len(hashes) + 1)
    spots, text = within(bounds, window)
    held = np.cumsum(near)[spots] > 0
    spots, text = spots[held], text[held]
    return spots - bounds[text], text, rolling(hashes, window)[spots], rolling(others, window)[spots]


def _brief(rows: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_words, digest`` of every row."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            joined = [joined_words(x) for x in text_bytes(batch.column(2))]
            count = [x.count(b" ") + 1 if x else 0 for x in joined]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array([sha256(x).digest() for x in joined], pa.binary())],
                names=["doc_id", "row_key", "n_words", "digest"],
            )

        return step

    return map_arrow(rows, make, "doc_id long, row_key long, n_words long, digest binary")


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """``phrase, sequence`` of every anchor: its number, and a hash of the word sequence it stands in."""

    def make():
        from xxhash import xxh3_64_intdigest

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            phrase, text = anchors(batch.column(0), window)
            sequence = np.array([xxh3_64_intdigest(joined_words(x)) for x in text_bytes(batch.column(0))], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(phrase.view(np.int64)), pa.array(sequence[text])], names=["phrase", "sequence"])

        return step

    return map_arrow(rows.select("text"), make, "phrase long, sequence long", CHUNK_BYTES)


def _windows(batch: pa.RecordBatch, ends: np.ndarray, size: int, window: int) -> pa.RecordBatch:
    """The windows around phrases of ``doc_id, row_key, text``, given by the phrases' last places, for rows that have some."""
    place, text, one, two = located(batch.column(2), ends, size, window)
    counts = np.bincount(text, minlength=batch.num_rows)
    held = np.flatnonzero(counts)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts[held])]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (place.astype(np.int32), one.view(np.int64), two.view(np.int64))]
    return pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(held)) for k in (0, 1)] + lists, names=["doc_id", "row_key", "places", "ones", "twos"])


def sent_symbols(texts: pa.Array, shards: Shards) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What of a column concerns each shard: of every (text, shard) the text, the shard, and where its words begin in the
    two lists behind (and the last ends): places within the text, and symbols."""
    hashes, bounds, *_ = word_hashes(texts)
    symbol = symbols(hashes)
    starts, slots = beginnings(symbol, shards.size, shards.begins)
    text = np.searchsorted(bounds, starts, side="right") - 1
    fits = starts + shards.size <= bounds[text + 1]  # not across the border of two texts
    starts, text, base = starts[fits], text[fits], slots[fits] >> np.uint32(LEAD_BITS - shards.bits)
    order = np.lexsort((starts, base, text))
    starts, text, base = starts[order], text[order], base[order]
    last = np.append((text[1:] != text[:-1]) | (base[1:] != base[:-1]), True)[: len(starts)]
    reach = np.where(last, shards.size, np.minimum(np.diff(starts, append=0), shards.size))
    upto = np.cumsum(reach)
    read = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(starts - upto + reach, reach)
    ends = np.flatnonzero(last)
    return text[ends], base[ends].astype(np.int32), np.append(0, upto[ends]), read - np.repeat(bounds[text], reach), symbol[read]


def _routed(rows: DataFrame, shards: Shards, names: DataFrame, window: int) -> DataFrame:
    """As ``_stream``, where documents are sent to the shards."""
    shared = rows.sparkSession.sparkContext.broadcast(shards)  # of fixed size

    def send():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            text, base, cuts, places, stream = sent_symbols(batch.column(2), shared.value)
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(places.astype(np.int32)))
            raw = pa.Array.from_buffers(pa.binary(), len(text), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(stream.tobytes())])
            of = pa.array(text)
            return pa.RecordBatch.from_arrays([pa.array(base), batch.column(0).take(of), batch.column(1).take(of), lists, raw], names=["base", "doc_id", "row_key", "places", "stream"])

        return step

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column(0).to_numpy()
            for a, z in zip(*(lambda cuts: (cuts, np.append(cuts[1:], len(base))))(np.flatnonzero(np.append(True, base[1:] != base[:-1])[: len(base)]))):
                part = batch.slice(int(a), int(z - a))
                lists, raw = part.column(3), part.column(4).to_pylist()
                sizes = np.fromiter(map(len, raw), np.int64, len(raw))
                read = lists.flatten().to_numpy().astype(np.int64) + (np.repeat(np.arange(len(raw)), sizes) << 32)  # rows lie apart
                found = [_automaton(path).located(b"".join(raw), read) for path in part.column(5)[0].as_py()]
                ends = np.sort(np.concatenate(found))
                counts = np.bincount(ends >> 32, minlength=len(raw))
                held = np.flatnonzero(counts)
                offsets = pa.array(np.append(0, np.cumsum(counts[held])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(held)), part.column(2).take(pa.array(held)), pa.ListArray.from_arrays(offsets, pa.array((ends & 0xFFFFFFFF).astype(np.int32)))],
                    names=["doc_id", "row_key", "ends"],
                )
        _release()

    def windows():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bounds = word_hashes(batch.column(2))[1]
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            ends = lists.flatten().to_numpy().astype(np.int64) + np.repeat(bounds[:-1], sizes)
            return _windows(batch, np.sort(ends), shared.value.size, window)

        return step

    key = ["doc_id", "row_key"]
    sent = staged(map_arrow(rows, send, _SENT, CHUNK_BYTES), "substring-sent")
    counts = sent.groupBy("base").agg(F.count("*").alias("n"))
    fair = F.broadcast(counts.agg((F.avg("n") * 4).alias("fair")))  # one row
    dealt = names.join(counts.crossJoin(fair), "base").select("base", "names", F.ceil(F.col("n") / F.col("fair")).alias("salts"))
    met = sent.join(dealt, "base").withColumn("salt", F.pmod(F.xxhash64(*key), F.col("salts")))
    met = met.select("base", *key, "places", "stream", "names", "salt").repartition("base", "salt").sortWithinPartitions("base")
    found = met.drop("salt").mapInArrow(locate, "doc_id long, row_key long, ends array<int>")
    ends = found.groupBy(*key).agg(F.flatten(F.collect_set("ends")).alias("ends"))  # of repeated rows once
    return map_arrow(rows.join(ends, key).select(*key, "text", "ends"), windows, _WINDOWS, CHUNK_BYTES)


def _stream(rows: DataFrame, shards: Shards, window: int) -> DataFrame:
    """``doc_id, row_key, text`` -> the windows around phrases, for rows that have some."""
    shared = rows.sparkSession.sparkContext.broadcast(shards)  # a file name for each shard, and the table of fixed size

    def found(chunks: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = [symbols(word_hashes(batch.column(2))[0]) for batch in chunks]
        begun = np.cumsum([0, *map(len, stream)])
        ends = occurrences(np.concatenate(stream), shared.value)
        del stream
        for k in reversed(range(len(chunks))):  # a chunk goes as its windows go out
            batch = chunks.pop()
            a, z = np.searchsorted(ends, begun[k : k + 2])
            yield _windows(batch, ends[a:z] - begun[k], shared.value.size, window)
        _release()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, part, size, held = [], [], 0, 0
        for batch in batches:
            part.append(batch)
            size += batch.column(2).nbytes
            if size >= CHUNK_BYTES:
                chunks.append(joined(part))
                part, size, held = [], 0, held + size
            if held >= HELD_BYTES:
                yield from found(chunks)
                chunks, held = [], 0
        if part:
            chunks.append(joined(part))
        if chunks:
            yield from found(chunks)

    return rows.mapInArrow(run, _WINDOWS)


@contextmanager
def _filtered_joins(spark: SparkSession):
    """Let Spark filter the larger side of a shuffle join by a Bloom filter of the smaller one's keys.

    The filter has a fixed size (``spark.sql.optimizer.runtime.bloomFilter.maxNumBits``); where keys
    outgrow it, it lets more rows pass, and the join stays what it is.
    """
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1t", "expectedNumItems": "4000000"}
    names = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in wanted.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def kept_text(text: bytes, gone: np.ndarray) -> str:
    """The text without its removed words: runs of kept words as they stand, joined by a line feed
    where the words between held one, else by a space."""
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (~gone).astype(np.int8), [0]]))).reshape(-1, 2).tolist()
    out, behind = [], None
    for a, b in edges:
        start, end = places[a][0], places[b - 1][1]
        if behind is not None:
            out.append(b"\n" if b"\n" in text[behind:start] else b" ")
        out.append(text[start:end])
        behind = end
    return b"".join(out).decode()


def _strip(marked: DataFrame, window: int) -> DataFrame:
    """``doc_id, row_key, text, gone`` -> what is left and what was removed of each document."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, digests, removed, spans = [], [], [], []
            lists = batch.column(3).to_pylist()
            for text, starts in zip(text_bytes(batch.column(2)), lists):
                words = text.split()
                near = np.zeros(len(words) + 1, np.int32)
                starts = np.array(starts, np.int64)
                np.add.at(near, starts, 1)
                np.add.at(near, starts + window, -1)
                gone = np.cumsum(near[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
                texts.append(kept_text(text, gone))
                digests.append(sha256(b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()])).digest())
                removed.append(int(gone.sum()))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.binary()), pa.array(spans, span)],
                names=["doc_id", "row_key", "n_removed", "kept_text", "kept_digest", "spans"],
            )

        return step

    return map_arrow(marked, make, "doc_id long, row_key long, n_removed long, kept_text string, kept_digest binary, spans array<struct<start long, end long>>")


def repeated_windows(docs: DataFrame, window: int = WINDOW, shard_phrases: int = SHARD_PHRASES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts of the answer, keyed by ``doc_id, row_key`` (a hash of the text):

    all documents (``n_words``, ``digest``), the wholly repeated ones, and those that lose some
    words (``n_removed, kept_text, kept_digest, spans`` of words). See ``dedup_substrings``.
    """
    if window < 1 or shard_phrases < 1:
        raise ValueError("a window holds a word at least, a shard a phrase")
    spark = docs.sparkSession
    small_batches(spark)
    key = ["doc_id", "row_key"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), text.alias("text"))
    brief = staged(_brief(rows), "substring-brief")

    ranked = brief.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    earliest = ranked.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n")).filter("first_id < last_id")
    earliest = staged(earliest.select("digest", "first_id", "n"), "substring-first")
    copies = staged(join_counted(ranked, earliest, ["digest"], "n").filter("doc_id > first_id").select(*key).distinct(), "substring-copies")

    rows = rows.filter("doc_id is not null")
    several = _anchors(rows, window).groupBy("phrase").agg(F.min("sequence").alias("low"), F.max("sequence").alias("high")).filter("low < high")
    confirmed = staged(several.select("phrase"), "substring-confirmed")
    compiled = _compile(confirmed, shard_phrases, min(PHRASE, window))
    if compiled is None:
        streamed = spark.createDataFrame([], _WINDOWS)
    else:
        shards, names = compiled
        streamed = _stream(rows, shards, window) if shards.files else _routed(rows, shards, names, window)
    windows = staged(streamed, "substring-windows").join(copies, key, "left_anti")
    spots = windows.select(*key, F.explode(F.arrays_zip("places", "ones", "twos")).alias("x")).select(*key, F.col("x.places").alias("place"), F.col("x.ones").alias("one"), F.col("x.twos").alias("two"))

    which = ["one", "two"]
    owners = spots.groupBy(*which).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n")).filter("first_id < last_id")
    owners = staged(owners.select(*which, "first_id", "n"), "substring-owners")
    later = join_counted(spots, owners, which, "n").filter(F.col("doc_id") > F.col("first_id"))
    later = staged(later.groupBy(*key).agg(F.collect_set("place").alias("gone")), "substring-later")
    with _filtered_joins(spark):
        marked = rows.join(later.filter(F.size("gone") > 0), key)
        partly = staged(_strip(marked.select(*key, "text", "gone"), window), "substring-partly")
    return brief, copies, partly


def dedup_substrings(docs: DataFrame, window: int = WINDOW, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_words, n_removed, kept_sha256, spans``, a row for each row.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words and keep none.
    Rows with a null doc_id are smaller than nothing and lose nothing, nor do they make others lose.
    Rows that repeat with one doc_id never take from each other. ``spans`` are the removed word
    ranges (null where nothing or everything was removed). Very long texts are read whole. Columns
    other than ``doc_id`` and ``text`` play no part, whatever their names. An empty table gives an
    empty result.
    """
    brief, copies, partly = repeated_windows(docs, window, shard_phrases)
    key = ["doc_id", "row_key"]
    lost = partly.dropDuplicates(key).select(*key, "n_removed", "kept_digest", "spans")
    whole = copies.select(*key, F.lit(True).alias("all_gone"))
    nothing = F.unhex(F.lit(sha256(b"").hexdigest()))
    out = brief.join(lost, key, "left").join(whole, key, "left")
    return out.select(
        "doc_id", "n_words",
        F.when(F.col("all_gone"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.lower(F.hex(F.when(F.col("all_gone"), nothing).otherwise(F.coalesce("kept_digest", "digest")))).alias("kept_sha256"),
        "spans",
    )


def shorten_documents(docs: DataFrame, window: int = WINDOW, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """``docs``, all columns and rows, with the words that ``dedup_substrings`` removes gone from ``text``.

    Other columns stay as they are, whatever their names; the column order stays.
    """
    _, copies, partly = repeated_windows(docs, window, shard_phrases)
    doc, row, left = unused(docs.columns, "_doc_id", "_row_key", "_kept_text")
    rename = lambda df: df.withColumnsRenamed({"doc_id": doc, "row_key": row})
    texts = rename(partly.select("doc_id", "row_key", F.col("kept_text").alias(left)).dropDuplicates(["doc_id", "row_key"]))
    changed = texts.unionByName(rename(copies).withColumn(left, F.lit("")))
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), row: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    text = F.coalesce(left, F.col("text").cast("string")).alias("text")
    return keyed.join(changed, [doc, row], "left").select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns])

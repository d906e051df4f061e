"""Decontamination with suffix arrays of the training texts (operator 13).

Documents are taken in shards of about ``SHARD_BYTES`` of text, where they lie. Every word is a symbol
of 20 bits of its hash, and the shard's suffix array orders all of its word suffixes: first by three
symbols, which one sort of 60-bit keys does, then by twice as many words a round, which touches only
suffixes that are still equal to another (``SuffixArray``). A suffix ends with its document.

The items' texts lie in blocks of at most about ``BLOCK_BYTES`` in the shared folder. A task holds one
block at a time against its shard: each suffix of each item is looked up by binary search, all suffixes
at once, first its three leading symbols, then the range is narrowed word by word. A range of depth
``window`` is a window's occurrences; they are verified by the words' 64-bit hashes. Going on to narrow the
range gives the longest verbatim match. Suffixes that many documents share are one range, however many items
have the same window, so positions are listed once for each window.

No text is shuffled. A task's memory is a shard, a block and the results of the shard; a document is
never split. The work is that of the arrays plus blocks times shards searches, a stated set of queries
against all rows in blocks; a benchmark of thousands of items is one block, read once by each Python worker.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import fresh_path, map_arrow, ragged, small_batches
from tessella.llm.words import plain_texts, rolling, word_hashes
from tessella.operators.staging import unused

WINDOW = 10
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 16 << 20
LEAD, BITS = 3, 20  # symbols in a key, and bits of a symbol
_U = np.uint64
_SPAN = "array<struct<start: long, end: long>>"
_FOUND = f"doc_id long, row_key long, n_words long, n_hit long, items array<string>, spans {_SPAN}"
_LONGEST = "item_id string, length long, item_start long, doc_id long, doc_start long"


def _symbols(hashes: np.ndarray) -> np.ndarray:
    """The symbol of each word; 0 is no word's."""
    return np.maximum((hashes >> _U(64 - BITS)).astype(np.int64), 1)


def _keys(symbol: np.ndarray) -> np.ndarray:
    """``LEAD`` symbols from each place on as one number; behind an end (0) there are zeros."""
    n = len(symbol)
    key, live = symbol.copy(), symbol > 0
    for k in range(1, LEAD):
        key <<= BITS
        nxt = np.zeros(n, np.int64)
        nxt[: n - k] = symbol[k:]
        live &= nxt > 0
        key |= np.where(live, nxt, 0)
    return key


class SuffixArray:
    """All suffixes of a row of texts in the order of their first ``depth`` words, as symbols.

    ``hashes`` are the words' hashes, ``bounds`` where each text begins and the last ends. ``places`` counts
    an end behind each text. ``order`` has the places of the suffixes that have a word, ascending.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, depth: int):
        n_texts, size = len(bounds) - 1, np.diff(bounds)
        self.first = bounds[:-1] + np.arange(n_texts)  # place of each text's first word
        self.end = self.first + size  # place of its end
        n = len(hashes) + n_texts
        word = np.ones(n, bool)
        word[self.end] = False
        self.hashes = np.zeros(n, np.uint64)
        self.hashes[word] = hashes
        self.symbol = np.zeros(n, np.int64)
        self.symbol[word] = _symbols(hashes)
        key = _keys(self.symbol)
        order = np.argsort(key)
        self.order = order[n_texts:]  # the ends have the least key
        self.keys = key[self.order]
        del key, order
        if len(self.order):
            self._refine(np.repeat(self.end, size + 1), depth)

    def _refine(self, end: np.ndarray, depth: int) -> None:
        """Order suffixes of equal keys by the ranks of what follows, twice as many words a round."""
        starts = np.concatenate([[True], self.keys[1:] != self.keys[:-1]])
        rank = np.zeros(len(self.symbol), np.int64)
        at = np.flatnonzero(starts)
        size = np.diff(at, append=len(starts))
        rank[self.order] = np.repeat(at + 1, size)  # of a group: its first place in the order; an end has 0
        several = np.repeat(size > 1, size)
        spot = np.flatnonzero(several)
        known = LEAD
        while len(spot) and known < depth:
            place = self.order[spot]
            going = place + known <= end[place]  # the others end within the known words, and so do their equals
            spot, place = spot[going], place[going]
            if not len(spot):
                break
            group, follows = rank[place], rank[place + known]
            by = np.lexsort((follows, group))
            place, group, follows = place[by], group[by], follows[by]
            self.order[spot] = place  # spots of a group ascend, and so do groups
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])])
            at = np.flatnonzero(new)
            size = np.diff(at, append=len(new))
            rank[place] = np.repeat(spot[at] + 1, size)
            spot = spot[np.repeat(size > 1, size)]
            known *= 2

    def lead(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of suffixes that begin with the ``count`` (1 to LEAD) symbols packed in ``symbols``."""
        free = (LEAD - count) * BITS
        return np.searchsorted(self.keys, symbols, "left"), np.searchsorted(self.keys, symbols + (np.int64(1) << free), "left")

    def narrow(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each range whose suffixes have ``symbol`` behind their first ``depth`` words."""
        out = []
        for behind in (0, 1):
            a, z = lo.copy(), hi.copy()
            while (open_ := a < z).any():
                mid = (a + z) >> 1
                spot = np.minimum(mid, len(self.order) - 1)
                less = self.symbol[np.minimum(self.order[spot] + depth, len(self.symbol) - 1)] < symbol + behind
                a, z = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, z)
            out.append(a)
        return out[0], out[1]


@dataclass
class Items:
    """A block of items: names, the words' hashes and the windows to look up."""

    names: list[str | None]
    hashes: np.ndarray
    bounds: np.ndarray
    window: int

    def __post_init__(self) -> None:
        size = np.diff(self.bounds)
        need = np.minimum(size, self.window)
        counts = np.where(size > 0, size - need + 1, 0)
        self.item = np.repeat(np.arange(len(size)), counts)
        ends = np.cumsum(counts)
        self.start = np.arange(int(counts.sum())) - np.repeat(ends - counts, counts)  # within the item
        self.at = self.bounds[self.item] + self.start
        self.need = need[self.item]
        self.left = size[self.item] - self.start
        self.symbol = _symbols(self.hashes)
        padded = np.concatenate([self.symbol, np.zeros(LEAD, np.int64)])
        lead = np.zeros(len(self.at), np.int64)
        for k in range(LEAD):
            lead = lead << BITS | np.where(k < self.need, padded[self.at + k], 0)
        self.lead = lead

    def longest(self) -> int:
        return int(np.diff(self.bounds).max(initial=0))


def items_of(names: list[str | None], texts: pa.Array, window: int) -> Items:
    hashes, bounds = word_hashes(plain_texts(texts))
    return Items(names, hashes, bounds, window)


def window_ranges(array: SuffixArray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``items`` that occur, by number, and the range of each in the array."""
    lo, hi = array.lead(items.lead, np.minimum(items.need, LEAD))
    found = np.flatnonzero(lo < hi)
    lo, hi = lo[found], hi[found]
    for depth in range(LEAD, items.window):
        more = items.need[found] > depth
        if not more.any():
            break
        part = found[more]
        a, z = array.narrow(lo[more], hi[more], np.full(len(part), depth), items.symbol[items.at[part] + depth])
        lo[more], hi[more] = a, z
        held = lo < hi
        found, lo, hi = found[held], lo[held], hi[held]
    return found, lo, hi


def longest_ranges(array: SuffixArray, items: Items, found: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Words of the longest match of each window of ``window_ranges``, carried on to its item's end."""
    length, lo, hi = items.need[found].copy(), lo.copy(), hi.copy()
    which = np.arange(len(found))
    while len(which := which[items.left[found[which]] > length[which]]):
        a, z = array.narrow(lo[which], hi[which], length[which], items.symbol[items.at[found[which]] + length[which]])
        longer = a < z
        which = which[longer]
        lo[which], hi[which] = a[longer], z[longer]
        length[which] += 1
    return length


def best_matches(array: SuffixArray, items: Items, found: np.ndarray, lo: np.ndarray, hi: np.ndarray, ids: np.ndarray, known: np.ndarray) -> dict[int, tuple]:
    """Of each item with a window: words of the longest match, its place in the item, the document and the place there."""
    length = longest_ranges(array, items, found, lo, hi)
    best: dict[int, tuple] = {}
    for k in np.lexsort((items.start[found], -length, items.item[found])).tolist():
        window, item = found[k], int(items.item[found[k]])
        if item in best and best[item][0] >= length[k]:
            continue
        places, words = array.order[lo[k] : hi[k]], 0
        while words < length[k]:  # symbols tell the candidates, the words' hashes decide
            nxt = places[array.hashes[places + words] == items.hashes[items.at[window] + words]]
            if not len(nxt):
                break
            places, words = nxt, words + 1
        if words < items.need[window] or item in best and best[item][0] >= words:
            continue
        text = np.searchsorted(array.first, places, "right") - 1
        at = places - array.first[text]
        first = np.lexsort((at, ids[text], ~known[text]))[0]
        best[item] = (words, int(items.start[window]), int(ids[text[first]]) if known[text[first]] else None, int(at[first]))
    return best


class Shard:
    """A shard's texts, what of them is hit, and the items that each text shares a window with."""

    def __init__(self, texts: pa.Array, depth: int):
        self.hashes, self.bounds = word_hashes(plain_texts(texts))
        self.array = SuffixArray(self.hashes, self.bounds, depth)
        self.near = np.zeros(len(self.array.symbol) + 1, np.int32)  # +1 where an occurrence begins, -1 behind it
        self.items: dict[int, set[str]] = {}
        self._rolled: dict[int, np.ndarray] = {}

    def _rolling(self, size: int) -> np.ndarray:
        if size not in self._rolled:
            self._rolled[size] = rolling(self.array.hashes, size)
        return self._rolled[size]

    def occurrences(self, items: Items, found: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Windows of one size that are equal to each other: size, their numbers, and all verified places in the shard."""
        need = items.need[found]
        for size in np.unique(need).tolist():
            of = found[need == size]
            want = rolling(items.hashes, size)[items.at[of]]
            a, z = lo[need == size], hi[need == size]
            by = np.lexsort((want, a))
            of, want, a, z = of[by], want[by], a[by], z[by]
            cuts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (want[1:] != want[:-1])]))
            for k, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)]):
                places = self.array.order[a[k] : z[k]]
                places = places[self._rolling(size)[places] == want[k]]
                if len(places):
                    yield size, of[k:stop], places

    def search(self, items: Items) -> None:
        groups: dict[tuple, int] = {}  # items that share a window; equal groups are gone through once for a text
        texts: dict[int, set[int]] = {}
        for size, windows, places in self.occurrences(items, *window_ranges(self.array, items)):
            np.add.at(self.near, places, 1)
            np.add.at(self.near, places + size, -1)
            group = groups.setdefault(tuple(np.unique(items.item[windows]).tolist()), len(groups))
            for text in np.unique(np.searchsorted(self.array.first, places, "right") - 1).tolist():
                texts.setdefault(text, set()).add(group)
        named = [{items.names[k] for k in group} - {None} for group in groups]
        for text, held in texts.items():
            self.items.setdefault(text, set()).update(*[named[group] for group in held])

    def results(self) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[dict]]]:
        """Of every text: words, hit words, the names of items, and its hit spans."""
        hit = np.cumsum(self.near[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_hit = total[self.array.end] - total[self.array.first]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2)
        text = np.searchsorted(self.array.first, edges[:, 0], "right") - 1
        spans: list[list[dict]] = [[] for _ in self.array.first]
        for k, (a, z) in zip(text.tolist(), (edges - self.array.first[text][:, None]).tolist()):
            spans[k].append({"start": a, "end": z})
        return np.diff(self.bounds), n_hit, [sorted(self.items.get(k, ())) for k in range(len(n_hit))], spans


@dataclass
class Blocks:
    """Files of a block of items each, and the words of the longest item."""

    paths: list[str]
    depth: int
    window: int


def write_blocks(items: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Put ``items(item_id, text)`` into files of about ``block_bytes`` of text; equal rows once, nulls and texts without words not."""
    spark = items.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), text.alias("text")).filter(F.octet_length("text") > 0).distinct()
    sums = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    path = fresh_path(spark, "suffix-items")
    n = math.ceil(sums / block_bytes)
    (rows.repartition(n) if n > 1 else rows.coalesce(1)).write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.diff(word_hashes(plain_texts(batch.column(0)))[1]))], names=["n"])

        return step

    depth = map_arrow(stored.select("text"), make, "n long").agg(F.max("n")).first()[0] or 0
    return Blocks(stored.inputFiles(), int(depth), window)


_held: dict[tuple[str, int], Items] = {}


def _block(path: str, window: int) -> Items:
    """A block's items; a Python worker keeps the last one, and never two."""
    if (path, window) not in _held:
        _held.clear()
        store, place = pafs.FileSystem.from_uri(path)
        with store.open_input_file(place) as file:
            table = pq.read_table(io.BytesIO(file.read()))
        texts = table.column("text").combine_chunks()
        _held[path, window] = items_of(table.column("item_id").to_pylist(), texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks), window)
    return _held[path, window]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), text.alias("text"))


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What of ``docs(doc_id, text)`` stands in ``items(item_id, text)``, a row for each row of ``docs``:

    ``doc_id, row_key`` (a hash of the text)``, n_words, n_hit`` (words inside an occurrence of a
    window)``, items`` (distinct item_ids with an occurring window, sorted as strings)``, spans`` (of hit
    words). A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window. Words are ``plain_words``. Null and empty texts have no words. Rows that repeat are
    answered each. Items that repeat, or share an id, count once; an item without an id hits words and is not named.
    Very long texts are read whole. Other columns of both tables play no part, whatever their names. An
    empty ``docs`` gives an empty result, with empty ``items`` nothing is hit.
    """
    if window < 1 or shard_bytes < 1 or block_bytes < 1:
        raise ValueError("a window holds a word at least, and sizes are positive")
    small_batches(docs.sparkSession)
    blocks = write_blocks(items, window, block_bytes)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            shard = Shard(batch.column(2), min(blocks.depth, window))
            for path in blocks.paths:
                shard.search(_block(path, window))
            n_words, n_hit, names, spans = shard.results()
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, span)],
                names=["doc_id", "row_key", "n_words", "n_hit", "items", "spans"],
            )

        return step

    return map_arrow(_rows(docs), make, _FOUND, shard_bytes)


def longest_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, length, item_start, doc_id, doc_start``: the longest verbatim match of each item that has a window in ``docs``.

    Of matches of one length the first in the item counts, then the one with the smallest doc_id and
    place (a null id comes last); items without an id are left out. Other cases are those of ``find_items``.
    """
    small_batches(docs.sparkSession)
    blocks = write_blocks(items.filter("item_id is not null"), window, block_bytes)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            shard = Shard(batch.column(2), blocks.depth)
            out: dict[str, list] = {"item_id": [], "length": [], "item_start": [], "doc_id": [], "doc_start": []}
            ids, known = batch.column(0).fill_null(0).to_numpy(), ~np.asarray(batch.column(0).is_null())
            for path in blocks.paths:
                items = _block(path, window)
                found, lo, hi = window_ranges(shard.array, items)
                for item, row in best_matches(shard.array, items, found, lo, hi, ids, known).items():
                    for name, value in zip(out, (items.names[item], *row)):
                        out[name].append(value)
            return pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.string()), *[pa.array(out[c], pa.int64()) for c in list(out)[1:]]], names=list(out))

        return step

    found = map_arrow(_rows(docs), make, _LONGEST, shard_bytes)
    best = F.max_by(F.struct("length", "item_start", "doc_id", "doc_start"), F.struct("length", -F.col("item_start"), F.col("doc_id").isNotNull(), -F.col("doc_id"), -F.col("doc_start")))
    return found.groupBy("item_id").agg(best.alias("best")).select("item_id", "best.*")


def contamination(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` from ``find_items``, a row for each row."""
    found = find_items(docs, items, **parameters)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, that share no window with an item. Cases are those of ``find_items``."""
    doc, row, bad_doc, bad_row = unused(docs.columns, "_doc_id", "_row_key", "_bad_id", "_bad_key")
    bad = find_items(docs, items, **parameters).filter("n_hit > 0").select(F.col("doc_id").alias(bad_doc), F.col("row_key").alias(bad_row)).distinct()
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), row: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    return keyed.join(bad, F.col(doc).eqNullSafe(F.col(bad_doc)) & (F.col(row) == F.col(bad_row)), "left_anti").drop(doc, row)

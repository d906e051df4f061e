"""SentencePiece encoding and decoding by weighted finite-state transducers (operator 1).

A model compiles into machines of states and arcs: the normaliser (the charsmap's rules, each an arc
path whose last state emits the rule's output; then white space to U+2581 and the dummy prefix), the
pieces (arc paths whose last states emit piece ids and lead back to the start), and byte fallback (for
a character without a piece an arc that emits the ids of its UTF-8 bytes). An input is composed with
them lazily, position by position, and one relaxation in the tropical semiring, for models of both
kinds, finds the shortest path.

Weights: a unigram model has minus the log probability on each piece. A BPE model has an acceptor
of piece pairs composed in: the pair (a, b) weighs 0 if merging the text of a and b by the model's
own ranks ends in exactly a, b, and infinity otherwise. A sequence of pieces is the BPE encoding of
its text if and only if all its neighbours are such pairs (merges are chosen by rank, then from the
left, and restricting them to two neighbours keeps their order), so the only path of finite weight
is the encoding. Pair weights are computed when a pair is first met and kept.

If no piece continues with U+2581 after another character, every path passes a fixed state before
each run of U+2581, and the segments between such points are solved apart and remembered.

Decoding inverts the transducer: ids to pieces, runs of byte pieces to UTF-8 (invalid bytes to
U+FFFD), U+2581 to spaces, without the dummy prefix.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, ragged, small_batches, text_bytes

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM, BPE = 1, 2
_INF = float("inf")
# letters of old standing on which all versions of Unicode agree, and ASCII punctuation
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-я"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CHUNK_BYTES = 12 << 20
_CACHE = 250_000
_PAIRS = 2_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each field of a protocol buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 5:
            yield key >> 3, data[at : at + 4]
            at += 4
        elif kind == 1:
            yield key >> 3, data[at : at + 8]
            at += 8
        else:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size


class Machine:
    """A deterministic transducer: ``arcs[state][character]`` is the next state, ``emits[state]`` what the
    path to a state writes (None where it writes nothing). State 0 is the start."""

    def __init__(self, paths: Iterable[tuple[str, object]]):
        self.arcs: list[dict[str, int]] = [{}]
        self.emits: list = [None]
        for label, output in paths:
            state = 0
            for c in label:
                to = self.arcs[state].setdefault(c, len(self.arcs))
                if to == len(self.arcs):
                    self.arcs.append({})
                    self.emits.append(None)
                state = to
            self.emits[state] = output

    def outputs(self, text: str, k: int) -> Iterator[tuple[int, object]]:
        """The machine composed with the text from ``k`` on: where each emitting path ends, and its output."""
        arcs, emits, state = self.arcs, self.emits, 0
        for end in range(k, len(text)):
            state = arcs[state].get(text[end])
            if state is None:
                return
            if emits[state] is not None:
                yield end + 1, emits[state]


class Normaliser:
    """Characters to characters: the longest rule first, then white space, then U+2581."""

    def __init__(self, spec: dict):
        self.prefix, self.squeeze, self.escape = spec["add_dummy_prefix"], spec["remove_extra_whitespaces"], spec["escape_whitespaces"]
        self.machine = Machine(spec["rules"].items()) if spec["rules"] else None

    def __call__(self, text: str) -> str:
        if self.machine:
            out, k = [], 0
            while k < len(text):
                k, to = max(self.machine.outputs(text, k), key=itemgetter(0), default=(k + 1, text[k]))
                out.append(to)
            text = "".join(out)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if self.prefix and text:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text


def charsmap_rules(blob: bytes) -> dict[str, str]:
    """The rules of a precompiled charsmap: a double-array trie whose leaves point into the outputs."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
    outputs, rules = blob[4 + size :], {}
    offset = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
    todo = [(0, b"")]
    while todo:
        node, key = todo.pop()
        base = node ^ offset(units[node])
        if units[node] >> 8 & 1:  # a rule ends here
            at = units[base] & 0x7FFFFFFF
            rules[key.decode("utf-8", "replace")] = outputs[at : outputs.index(b"\0", at)].decode()
        for c in range(1, 256):
            to = base ^ c
            if to < len(units) and units[to] & 0x800000FF == c:
                todo.append((to, key + bytes([c])))
    return rules


class Model:
    """A compiled model: ``encode`` and ``decode`` texts."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.kind, self.fallback = UNIGRAM, False
        spec = {"add_dummy_prefix": True, "remove_extra_whitespaces": True, "escape_whitespaces": True, "rules": {}}
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0])
                self.kinds.append(piece[3])
            elif number == 2:
                trainer = dict(_fields(value))
                self.kind, self.fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                given = dict(_fields(value))
                spec |= {n: bool(given[k]) for k, n in ((3, "add_dummy_prefix"), (4, "remove_extra_whitespaces"), (5, "escape_whitespaces")) if k in given}
                spec["rules"] = charsmap_rules(given.get(2, b""))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("unigram and BPE models are supported")
        self.normalise = Normaliser(spec)
        self.unknown = next((k for k, x in enumerate(self.kinds) if x == UNKNOWN), 0)
        self.id = {p: k for k, (p, x) in enumerate(zip(self.pieces, self.kinds)) if x in (NORMAL, USER)}
        self.byte = {int(p[3:5], 16): k for k, (p, x) in enumerate(zip(self.pieces, self.kinds)) if x == BYTE}
        self.machine = Machine((p, p) for p in self.id)
        self.cost = {p: -self.scores[k] if self.kind == UNIGRAM else 0.0 for p, k in self.id.items()}
        self.cut = re.compile(f"(?<=[^{SPACE}])(?={SPACE})") if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id) else None
        self.pair: dict[tuple[str, str], bool] = {}
        # punctuation that no piece holds behind a letter: segments end before it too
        free = [c for c in _PUNCTUATION if not any(re.search(f"[{_LETTERS}]{re.escape(c)}", p) for p in self.id)]
        self.stop = f"([{_LETTERS}])([{''.join(map(re.escape, free))}])" if free else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, "rb") as f:
            return cls(f.read())

    @cached_property
    def worst(self) -> float:
        """Weight of a character without a piece in a unigram model: worse than any piece."""
        return 10 - min((s for s, k in zip(self.scores, self.kinds) if k == NORMAL), default=0.0)

    # --- the pair acceptor of BPE -------------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """Merge neighbours by rank, from the left among equals, until none are pieces."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -_INF, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and self.scores[i] > best:
                    best, at = self.scores[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def pair_weight(self, a: str, b: str) -> float:
        """0 if merging a and b apart gives exactly these two pieces, else infinity; a is "" at the start."""
        fine = self.pair.get((a, b))
        if fine is None:
            if len(self.pair) > _PAIRS:
                self.pair.clear()
            fine = self.pair[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return 0.0 if fine else _INF

    # --- composition and shortest path ---------------------------------------------------------
    def shortest(self, text: str) -> list[str]:
        """Labels of the shortest path through the composed transducer.

        A state is a position and the piece that ends there; the pair acceptor leaves a position one such
        state of finite weight, and a unigram model needs the position alone.
        """
        n, arcs, emits, cost, pair = len(text), self.machine.arcs, self.machine.emits, self.cost, self.pair
        bpe = self.kind == BPE
        other = 0.0 if bpe else self.worst
        weight: list[float] = [0.0] + [_INF] * n
        last: list[str] = [""] * (n + 1)
        for k in range(n):
            begun = weight[k]
            if begun == _INF:
                continue
            before, state, alone = last[k], 0, True
            for end in range(k, n):
                state = arcs[state].get(text[end])
                if state is None:
                    break
                piece = emits[state]
                if piece is None:
                    continue
                alone = alone and end > k
                through = begun + cost[piece]
                if through < weight[end + 1]:
                    if bpe:
                        fine = pair.get((before, piece))
                        if not fine and (fine is False or self.pair_weight(before, piece)):
                            continue
                    weight[end + 1], last[end + 1] = through, piece
            if alone:  # no piece is this character: the arc of byte fallback, or of the unknown piece
                through = begun + other
                if through < weight[k + 1] and not (bpe and self.pair_weight(before, text[k])):
                    weight[k + 1], last[k + 1] = through, text[k]
        path, k = [], n
        while k:
            path.append(last[k])
            k -= len(last[k])
        return path[::-1]

    def labels(self, path: list[str]) -> list[int]:
        out: list[int] = []
        for part in path:
            if part in self.id:
                out.append(self.id[part])
            elif self.fallback:
                out.extend(self.byte_path(part))
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters are one piece
                out.append(self.unknown)
        return out

    def byte_path(self, character: str) -> list[int]:
        """What the arc of byte fallback emits."""
        return [self.byte[b] for b in character.encode()]

    def encode(self, text: str | None) -> np.ndarray:
        text = self.normalise(text or "")
        if not text:
            return np.zeros(0, np.int32)
        if self.cut is None or not self.fallback:
            return np.array(self.labels(self.shortest(text)), np.int32)
        if len(self.known) > _CACHE:  # what was met since the last turn stays for another
            self.older, self.known = self.known, {}
        parts, known, older = self.cut.split(text), self.known, self.older
        for p in set(parts).difference(known):
            known[p] = older.get(p) or np.array(self.labels(self.shortest(p)), "<i4").tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, parts)), "<i4")

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (and the last's end).

        Arrow cuts the texts into segments and finds the distinct ones; a path is looked for once for
        each, and numpy puts the ids in a row.
        """
        normal = [self.normalise(t or "") for t in texts]
        if self.cut is None or not self.fallback or any("\0" in t for t in normal):
            found = [self.encode(t) for t in texts]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        marked = pc.replace_substring_regex(pa.array(normal, pa.string()), f"([^{SPACE}])({SPACE})", "\\1\0\\2")
        if self.stop:
            marked = pc.replace_substring_regex(marked, self.stop, "\\1\0\\2")
        cut = pc.split_pattern(marked, "\0")
        coded = cut.values.dictionary_encode()
        known, older, raw = self.known, self.older, []
        for u in coded.dictionary.to_pylist():
            if (ids := known.get(u)) is None:
                ids = known[u] = older.get(u) or np.array(self.labels(self.shortest(u)), "<i4").tobytes()
            raw.append(ids)
        if len(known) > _CACHE:  # what was met since the last turn stays for another
            self.older, self.known = known, {}
        pool = np.frombuffer(b"".join(raw), "<i4")
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        places, ends = ragged(np.cumsum(size) - size, size, coded.indices.to_numpy())
        return pool[places], np.concatenate([[0], ends])[cut.offsets.to_numpy()]

    # --- decoding -------------------------------------------------------------------------------
    @cached_property
    def outputs(self) -> list[bytes]:
        """What each id writes; control pieces write nothing."""
        byte = {k: bytes([b]) for b, k in self.byte.items()}
        return [byte[k] if k in byte else b"" if x == CONTROL else " ⁇ ".encode() if x == UNKNOWN else p.replace(SPACE, " ").encode() for k, (p, x) in enumerate(zip(self.pieces, self.kinds))]

    @cached_property
    def _output_pool(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, self.outputs), np.int64, len(self.outputs))
        return np.frombuffer(b"".join(self.outputs), np.uint8), np.cumsum(size) - size, size

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of all texts; of bytes that are none, as they are."""
        pool, start, size = self._output_pool
        places, ends = ragged(start, size, ids)
        data, bounds = pool[places].tobytes(), np.concatenate([[0], ends])[offsets].tolist()
        lead = self.normalise.prefix
        return [data[a + (lead and data[a : a + 1] == b" " and a < z) : z] for a, z in zip(bounds, bounds[1:])]

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.pieces):
            raise ValueError("an id is outside the vocabulary")
        outputs = self.outputs
        text = b"".join([outputs[k] for k in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.normalise.prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def loaded(path: str) -> Model:
    """One compiled model for each Python worker, so that what it remembers outlives a task."""
    return Model.load(path)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, ids, decoded``, a row for each row.

    ``ids`` is the array of piece ids, ``decoded`` the text they decode to. Null and empty texts
    have no ids and decode to an empty text; very long texts are encoded whole; rows that repeat are
    answered row by row; columns other than ``doc_id`` and ``text`` play no part, whatever their names;
    an empty table gives an empty result. ``model_path`` is a path on every executor.
    """

    def make():
        model = loaded(model_path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, offsets = model.encode_batch(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            decoded = [x.decode("utf-8", "replace") for x in model.decode_batch(ids, offsets)]
            return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

        return step

    return _mapped(docs, make, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, exact``: digests of ``encode_documents`` without moving its arrays.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers; ``exact``: whether the
    ids decode to the very text (a null text to an empty one).
    """

    def make():
        model = loaded(model_path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, offsets = model.encode_batch(batch.column(1).to_pylist())
            raw, bounds = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
            exact = [x == (t or b"") for x, t in zip(model.decode_batch(ids, offsets), text_bytes(batch.column(1)))]
            return pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(offsets)), pa.array([zlib.crc32(raw[a:z]) for a, z in zip(bounds, bounds[1:])], pa.int64()), pa.array(exact, pa.bool_()),
            ], names=["doc_id", "n_tokens", "ids_crc32", "exact"])

        return step

    return _mapped(docs, make, "doc_id long, n_tokens long, ids_crc32 long, exact boolean")


def _mapped(docs: DataFrame, make, schema: str) -> DataFrame:
    small_batches(docs.sparkSession, 500)
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema, CHUNK_BYTES)

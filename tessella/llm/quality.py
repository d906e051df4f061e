"""Quality rules: gradient-boosted trees over document statistics (operator 5).

Statistics are counted per document over its whole text. The trees are grown here, with histogram
splits, logistic loss and monotone constraints (more symbols, shouting or repetition never raises
the score), on a bounded, deterministic sample of labelled rows. A fitted model is flattened into
numpy node arrays, which score a batch level by level without a Python loop over rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, small_batches, staged, text_bytes

_SPACE = b" \t\n\x0b\x0c\r"
_TAIL = bytes(range(0x80, 0xC0))  # continuation bytes: the others begin a code point
_SYMBOLS = b"#*$%&|<>"
_UPPER, _DIGIT, _SHOUT = bytes(range(65, 91)), b"0123456789", b"!?"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_shouts")
#: name -> +1, -1 or 0: how the score may change as the feature grows
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 1, "upper_share": -1, "digit_share": 0, "shout_share": -1, "words_per_line": 0,
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SAMPLE_ROWS = 20_000  # labelled rows at most in a fit
CUTOFF = 0.5


def document_stats(text: bytes | None) -> tuple[int, ...]:
    """COUNTS then EXTRA of one text; null counts as no words."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * (len(COUNTS) + len(EXTRA))
    less = lambda drop: len(text) - len(text.translate(None, drop))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    repeated = 0
    if n >= 3:
        triples = list(zip(words, words[1:], words[2:]))
        if len(set(triples)) < n - 2:
            often = Counter(triples)
            covered = bytearray(n)
            for k, t in enumerate(triples):
                if often[t] > 1:
                    covered[k : k + 3] = b"\x01\x01\x01"
            repeated = sum(covered)
    return (
        n, len(text.translate(None, _TAIL + _SPACE)), less(_SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(lines), len(set(words)), less(_UPPER), less(_DIGIT), less(_SHOUT),
    )


def with_stats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row."""
    small_batches(docs.sparkSession)
    names = ["doc_id", *COUNTS, *EXTRA]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = np.array([document_stats(x) for x in text_bytes(batch.column(1))], np.int64).reshape(-1, len(names) - 1)
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], names=names)

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, ", ".join(f"{x} long" for x in names))


def features(stats: pd.DataFrame) -> np.ndarray:
    n = np.maximum(stats["n_words"].to_numpy(float), 1)
    lines = np.maximum(stats["n_lines"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    col = lambda name: stats[name].to_numpy(float)
    return np.stack([
        np.log1p(col("n_words")), col("word_chars") / n, col("n_symbols") / n, col("n_dup_lines") / lines, col("n_repeat_words") / n,
        col("n_distinct") / n, col("n_upper") / chars, col("n_digits") / chars, col("n_shouts") / n, n / lines,
    ], axis=1)


@dataclass
class Trees:
    """All trees in flat arrays; a leaf points to itself, so every row takes ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -60, 60)))


@dataclass
class _Grower:
    codes: np.ndarray  # row, feature -> bin
    edges: list[np.ndarray]
    signs: list[int]
    depth: int
    min_rows: int
    rate: float
    ridge: float = 1.0
    nodes: list[list[float]] = field(default_factory=list)  # feature, threshold, left, right, value

    def leaf(self, value: float) -> int:
        k = len(self.nodes)
        self.nodes.append([0, np.inf, k, k, value])
        return k

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        weight = lambda a, b: np.clip(-a / (b + self.ridge), low, high)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        own = float(weight(total_g, total_h))
        if depth == self.depth or len(rows) < 2 * self.min_rows:
            return self.leaf(own * self.rate)
        best = (1e-6, -1, -1, 0.0, 0.0)
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            code, bins = self.codes[rows, f], len(edges) + 1
            gl, hl = (np.cumsum(np.bincount(code, v[rows], bins))[:-1] for v in (g, h))
            nl = np.cumsum(np.bincount(code, minlength=bins))[:-1]
            gr, hr = total_g - gl, total_h - hl
            wl, wr = weight(gl, hl), weight(gr, hr)
            gain = lambda a, b, w: -(2 * a * w + (b + self.ridge) * w * w)
            won = gain(gl, hl, wl) + gain(gr, hr, wr) - gain(total_g, total_h, own)
            won[(nl < self.min_rows) | (len(rows) - nl < self.min_rows) | (self.signs[f] * (wr - wl) < 0)] = -np.inf
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (float(won[k]), f, k, float(wl[k]), float(wr[k]))
        _, f, k, wl, wr = best
        if f < 0:
            return self.leaf(own * self.rate)
        at, mid = len(self.nodes), (wl + wr) / 2
        self.nodes.append([f, float(self.edges[f][k]), 0, 0, 0.0])
        to_left = self.codes[rows, f] <= k
        bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[self.signs[f]]
        self.nodes[at][2] = self.grow(rows[to_left], g, h, depth + 1, *bounds[0])
        self.nodes[at][3] = self.grow(rows[~to_left], g, h, depth + 1, *bounds[1])
        return at


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, min_rows: int = 10, signs: list[int] | None = None) -> Trees | None:
    """Boosted trees for ``y`` in {0, 1}; None if one of the classes is missing."""
    if len(set(y.tolist())) < 2:
        return None
    signs = list(FEATURES.values()) if signs is None else signs
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    edges = [e[e < c.max()] for e, c in zip(edges, x.T)]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    rows, grower, roots = np.arange(len(y)), _Grower(codes, edges, signs, depth, min(min_rows, max(1, len(y) // 10)), rate), []
    share = y.mean()
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grower.grow(rows, p - y, np.maximum(p * (1 - p), 1e-9), 0, -np.inf, np.inf))
        n = np.array(grower.nodes)
        flat = Trees(n[:, 0].astype(np.int64), n[:, 1], n[:, 2].astype(np.int64), n[:, 3].astype(np.int64), n[:, 4], np.array(roots[-1:]), depth)
        margin += flat.raw(x)
    return Trees(flat.feature, flat.threshold, flat.left, flat.right, flat.value, np.array(roots), depth, base)


def labelled_sample(ids: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``ids(doc_id)``, ``labels(doc_id, quality)`` -> ``doc_id, quality`` of at most ``sample_rows`` documents:
    of those that have a label the ones with the smallest hashes of their id.

    Rows with a null label are left out, of repeated labels the smallest holds; labels of other
    documents take no part.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = staged(known.join(ids.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi").withColumn("hash", F.xxhash64("doc_id")), "quality-labels")
    n = known.count()
    if n > 2 * sample_rows:  # only about so many rows take part in the sort, however many are labelled
        known = known.filter(F.col("hash") < int(-(2**63) + 2**64 * (2 * sample_rows / n)))
    return known.orderBy("hash", "doc_id").limit(sample_rows).select("doc_id", "quality")


def fit_on_labels(stats: DataFrame, sample: DataFrame) -> Trees | None:
    """Fit on the documents of a ``labelled_sample``; of rows with one id the one with the smallest counts."""
    row = F.min(F.struct(*COUNTS, *EXTRA)).alias("x")
    rows = stats.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(row, F.first("quality").alias("quality")).select("doc_id", "quality", "x.*")
    rows = rows.toPandas().sort_values("doc_id")
    return fit(features(rows), rows["quality"].to_numpy(float)) if len(rows) else None


def quality_verdicts(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, sample_rows: int = SAMPLE_ROWS, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``docs(doc_id, text)``, ``labels(doc_id, quality)`` -> statistics, base rule, score, verdict.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score, kept``, a row for each row. Null and empty texts have no words and fail the base rule.
    Without labels of both classes there is no model: the score is null and the base rule decides.
    Repeated rows are answered row by row; very long texts are counted whole; columns other than
    ``doc_id`` and ``text`` play no part, whatever their names; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    stats = staged(with_stats(docs), "quality-stats")
    model = fit_on_labels(stats, labelled_sample(stats, labels, sample_rows))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    if model is None:
        return stats.select("doc_id", *COUNTS, failed.alias("base_failed"), F.lit(None).cast("double").alias("score"), (~failed).alias("kept"))
    shared = spark.sparkContext.broadcast(model)  # a few thousand nodes, whatever the corpus is

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(features(pd.DataFrame(dict(zip((*COUNTS, *EXTRA), columns))))))

    scored = stats.withColumn("score", score(*COUNTS, *EXTRA)).withColumn("base_failed", failed)
    return scored.select("doc_id", *COUNTS, "base_failed", "score", (~F.col("base_failed") & (F.col("score") >= cutoff)).alias("kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, sample_rows: int = SAMPLE_ROWS, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_verdicts`` keeps.

    The labelled sample is chosen by ids and its texts alone are counted for the fit; then all texts are
    counted and judged where they are read, so no text is shuffled to meet its verdict.
    """
    sample = staged(labelled_sample(docs, labels, sample_rows), "quality-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id", "left_semi")
    model = fit_on_labels(with_stats(texts), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, names = docs.columns.index("text"), [*COUNTS, *EXTRA]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = np.array([document_stats(x) for x in text_bytes(batch.column(place))], np.int64).reshape(-1, len(names))
            stats = pd.DataFrame(rows, columns=names)
            kept = (stats["n_words"] >= min_words) & (stats["n_repeat_words"] * 100 <= stats["n_words"] * max_repeat_percent)
            if shared.value is not None:
                kept &= shared.value.score(features(stats)) >= cutoff
            return batch.filter(pa.array(kept.to_numpy(bool)))

        return step

    return map_arrow(docs, make, docs.schema)

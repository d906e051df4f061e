"""Spelling variants by a rare-first q-gram prefix filter (operator 11).

Words and their counts come from one pass over the texts; a task adds up its own words before they are
shuffled. Bigrams are ordered by the number of their occurrences in words, rarest first. One edit takes at most two
of a word's bigrams away, so of two words one edit apart, the least bigram that both keep is among the
three rarest of each. It stands in both at places that differ by one at most: at the same distance from
the start if the edit comes behind it, at the same distance from the end if the edit comes before.

Words meet by their three rarest bigrams with that limit on places, and more than the place must be
equal: all of the word on the bigram's side away from the edit. Where that is less than ``PART``
characters, many words would still meet; there the next ``NEXT`` characters on the edit's side are equal too,
or else all behind them is, so each such bigram stands under three finer keys. The join evaluates the edit distance
of what meets, within its condition; pairs that fail never become rows.

A word has at most (2 x 90 x its length) near words, so no group of links is large. Forms have ten times
the count of their word, so a chain of them has at most 18 links and five rounds of pointer jumping settle it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import map_arrow, small_batches, staged

LEAST_LENGTH, LEAST_COUNT, TIMES, RARE = 7, 2, 10, 3
DROP = 31  # of runs whose checksum this divides one character is left out
PART, NEXT = 6, 3
HELD_WORDS = 200_000  # distinct words that a task adds up before it sends them
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def long_words(doc_id: int | None, text: str | None, least: int = LEAST_LENGTH) -> list[bytes]:
    """Runs of letters in Latin-1 (a byte for each code point), A-Z in lower case, of at least ``least`` characters after the omission."""
    if not text:
        return []
    state = crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    out = []
    for run in text.encode("latin-1", "replace").translate(_LETTERS).split():
        if len(run) < least:
            continue
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), state)
        if not h % DROP:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
            if len(run) < least:
                continue
        out.append(run)
    return out


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """``word, n`` over all rows of ``docs(doc_id, text)``."""
    small_batches(docs.sparkSession)

    def sent(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(long_words(doc_id, text.as_py(), least))
                if len(held) >= HELD_WORDS:
                    yield sent(held)
                    held.clear()
        if held:
            yield sent(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bigram_ranks(words: DataFrame) -> dict[str, int]:
    """Place of each bigram in the order of occurrences, then of code points; 90 letters make at most 8,100."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, 2))
    counted = words.filter(F.length("word") > 1).select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {gram: k for k, (_, gram) in enumerate(sorted((r["n"], r["gram"]) for r in counted.collect()))}


def _side(name: str, word: str, at: int, part: int, nxt: int) -> list[str]:
    """Keys of ``word`` for an edit behind the bigram at ``at``."""
    known, rest = word[: at + 2], word[at + 2 :]
    if len(known) >= part:
        return [f"{name} {known}"]
    return [f"{name}+{known} {rest[:nxt]}", f"{name}-{known} {rest[nxt:]}", f"{name}-{known} {rest[nxt - 1 :]}"]


def rare_keys(word: str, rank: dict[str, int], rare: int = RARE, part: int = PART, nxt: int = NEXT) -> set[str]:
    """What a word shares at least one of with every word that is one edit away."""
    rarest = sorted((rank[word[k : k + 2]], k) for k in range(len(word) - 1))[:rare]
    back = word[::-1]
    return {key for _, k in rarest for key in (*_side("b", word, k, part, nxt), *_side("f", back, len(word) - 2 - k, part, nxt))}


def near_words(words: DataFrame, part: int = PART, nxt: int = NEXT) -> DataFrame:
    """``a, n_a, b, n_b`` for all pairs a < b of ``words(word, n)`` that one inserted, deleted or replaced code point sets apart.

    Words have at least four code points; each stands in ``words`` once, and should be read from a table.
    """
    rank = bigram_ranks(words)

    def make():
        from xxhash import xxh3_64_intdigest

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            held = [[xxh3_64_intdigest(key) for key in rare_keys(w, rank, RARE, part, nxt)] for w in batch.column(0).to_pylist()]
            of = pa.array(np.repeat(np.arange(len(held)), [len(x) for x in held]))
            keys = np.fromiter((k for x in held for k in x), np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(0).take(of), batch.column(1).take(of)], names=["key", "word", "n"])

        return step

    keys = staged(map_arrow(words.select("word", "n"), make, "key long, word string, n long"), "spelling-keys")
    side = lambda w, n: keys.select("key", F.col("word").alias(w), F.col("n").alias(n))
    apart = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return side("a", "n_a").join(side("b", "n_b").withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & apart).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, form`` (words with a form) -> ``word, root``: the last of the chain of forms."""
    state = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        moved = staged(state.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, a row for each word of ``docs(doc_id, text)``.

    Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower case, one character left out of every
    31st (by a checksum of id and run), of at least ``least_length`` characters and ``least_count``
    occurrences. ``form`` is the near word with the largest count, ties to the first in code-point order, if its count is
    ``times`` the word's at least; ``root`` follows forms to the last. Null and empty texts have no words; a null
    doc_id is an empty string in the checksum; repeated rows count each. Very long texts and words are read whole.
    Other columns play no part, whatever their names. An empty table gives an empty result.
    """
    if least_length < 4 or least_count < 1 or times < 2:
        raise ValueError("words have four characters at least, and forms a larger count than their word")
    words = staged(word_counts(docs, least_length).filter(F.col("n") >= least_count), "spelling-words")
    pairs = staged(near_words(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    able = F.when(F.col("near_n") >= times * F.col("n"), F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("form")))
    linked = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(able).alias("best"))
    linked = staged(linked.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.down")).alias("form_n")), "spelling-linked")
    ends = roots(linked.filter("form is not null"))
    return words.join(linked, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )

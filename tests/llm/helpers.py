"""Odd rows that every operator has to bear, and brute force to hold results against."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, root long, kept string, _id string"


def odd_docs(spark, texts=()):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    long = " ".join(f"word{k % 977}" for k in range(30_000)) + " " + "y" * 100_000 + " end"
    rows = [
        (1, "alpha beta gamma delta epsilon\nzeta", "en", "s", 5, 1, 1, "x", "y"), (1, "alpha beta gamma delta epsilon\nzeta", "en", "s", 5, 1, 1, "x", "y"),
        (2, None, None, None, None, None, None, None, None), (3, "", "", "", 0, 0, 0, "", ""), (None, "no id at all", None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None), (4, long, "en", "s", len(long), 2, 2, "x", "y"), (5, " \t\r\n ", "en", "s", 5, 3, 3, "x", "y"),
        (6, "é\x00 ü   😀\x85", "de", None, 5, 4, 4, "x", "y"), (1, "another text under the same id", "en", "t", 5, 1, 1, "x", "y"),
    ]
    rows += [(100 + k, t, "en", f"s{k % 3}", len(t), k, k, "x", "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def random_texts(n, words, vocabulary, seed, copies=0, lines=False):
    """Texts over a small vocabulary, with copies, near copies and shared passages."""
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(vocabulary)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    out = []
    for _ in range(n):
        body = [rnd.choice(vocab) for _ in range(rnd.randint(0, words))]
        if rnd.random() < 0.3:
            at = rnd.randint(0, len(body))
            a = rnd.randint(0, 20)
            body[at:at] = passage[a : a + rnd.randint(5, 30)]
        out.append(body)
    for _ in range(copies):
        body = list(rnd.choice(out))
        if body and rnd.random() < 0.6:
            body[rnd.randrange(len(body))] = rnd.choice(vocab)
        out.append(body)
    sep = (lambda: "\n" if rnd.random() < 0.3 else " ") if lines else (lambda: " ")
    return ["".join(w + sep() for w in b)[:-1] if b else "" for b in out]

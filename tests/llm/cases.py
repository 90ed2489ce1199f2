"""Awkward documents: nulls, empty and long texts, repeated rows, ties, clashing columns."""

import random

import pyarrow as pa

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, y int, label string, fp long, "
          "cell int, node long, word string")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(spark, n=60, seed=3):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(n)]
    texts += [None, "", " \t\n ", "One", "one two", texts[0], texts[0], texts[1].upper(), words(rng, 5000),
              "K İ É\nline\nline\n\nline", "\u0085word joined", texts[2] + " extra"]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", None]), None if t is None else len(t),
             i, "x", i, i, i, "w") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[5], None, None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def as_batches(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])

"""Quality rules: counted text statistics and a calibrated n-gram classifier.

A document fails the base rules when it has under 20 words, or when over 30 % of its words
stand in 8-word windows that the text repeats.  The verdict comes from a logistic
regression over hashed words and character n-grams, trained on labelled rows, calibrated
by Platt scaling on rows it was not fitted to, and held against a fixed threshold.  One
pass scores whole texts in Arrow batches; the model is the only thing sent to the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import row_bytes
from tidewatch.llm.text_model import (HASH_BITS, SparseRows, WordCache, WordIndex, fit_logistic, fit_platt, sigmoid,
                                      word_features)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
NGRAMS = (1, 2, 3)
SAMPLE_PER_CLASS = 1500   # labelled rows per class that the model is fitted to, at most
MIN_KEEP = 0.2            # kept when the calibrated probability of quality 1 reaches this


@dataclass
class QualityModel:
    weights: np.ndarray | None  # None: no model (a class has no labelled row); all pass
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, mean_score: float) -> float:
        if self.weights is None:
            return 1.0
        return float(sigmoid(self.slope * (mean_score + self.bias) + self.shift))


def repeated_words(code: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text (as word numbers) holds more
    than once.  All pairs of neighbours in such a window repeat as well, which leaves few
    windows to compare in full."""
    n = len(code) - window + 1
    if n < 2:
        return 0
    _, pair, counts = np.unique(code[:-1] * (int(code.max()) + 1) + code[1:], return_inverse=True, return_counts=True)
    again = counts[pair] > 1
    offsets = sorted({*range(0, window - 1, 2), window - 2})
    at = np.flatnonzero(np.logical_and.reduce([again[o:o + n] for o in offsets]))
    if len(at) < 2:
        return 0
    _, same, counts = np.unique(np.stack([pair[at + o] for o in offsets], axis=1), axis=0,
                                return_inverse=True, return_counts=True)
    at = at[counts[same.ravel()] > 1]
    edges = np.zeros(len(code) + 1, dtype=np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_counts(text: bytes, code: np.ndarray) -> tuple[int, int, int, int]:
    """``(word_chars, n_symbols, n_dup_lines, n_repeat_words)``."""
    chars = len(text.decode("utf-8", "replace")) - (len(text) - len(text.translate(None, WHITE)))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line and not line.isspace():
            seen.add(line)
    return chars, symbols, dup, repeated_words(code)


def mean_features(words: list[bytes], cache: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts per word of the text, as sorted indices and values."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts = Counter(words)
    lists = cache.many(counts)
    total = np.concatenate([np.asarray(f, dtype=np.int64) for f in lists])
    weight = np.repeat(np.fromiter(counts.values(), dtype=np.float64), [len(f) for f in lists])
    idx, inverse = np.unique(total, return_inverse=True)
    return idx.astype(np.int32), (np.bincount(inverse, weights=weight) / len(words)).astype(np.float32)


def labelled_sample(labels: DataFrame, label_col: str, per_class: int, where=None) -> DataFrame:
    """At most ``per_class`` labelled ids of each class, the same on every run: those whose
    hash ranks first.  An id with conflicting labels has its smallest label."""
    clean = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
    if where is not None:
        clean = clean.where(where)
    one = clean.groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y"))
    parts = [one.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def train_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
                  id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on a bounded, documented sample of labelled rows (``per_class`` of each class)."""
    sample = labelled_sample(labels, "quality", per_class)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(lambda w: word_features(w, NGRAMS))
        for batch in batches:
            rows = [mean_features(t.split(), cache) for t in row_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([i for i, _ in rows], pa.list_(pa.int32())),
                 pa.array([v for _, v in rows], pa.list_(pa.float32()))], names=["doc_id", "y", "idx", "val"])

    # the sample has at most 2 * per_class rows of 12 bytes
    picked = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
    rows = picked.mapInArrow(run, "doc_id long, y int, idx array<int>, val array<float>").toArrow().sort_by("doc_id")
    y = rows.column("y").to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return QualityModel(None)
    x = [(np.asarray(i.values), np.asarray(v.values))
         for i, v in zip(rows.column("idx"), rows.column("val"))]
    hold = np.arange(len(y)) % 4 == 3  # calibration rows
    if len(np.unique(y[hold])) < 2 or len(np.unique(y[~hold])) < 2:
        hold = np.zeros(len(y), dtype=bool)

    def pick(which: np.ndarray) -> SparseRows:
        return SparseRows([x[i] for i in np.flatnonzero(which)], 1 << HASH_BITS)

    fit = ~hold
    balance = np.where(y[fit] > 0, 0.5 / max(1, y[fit].sum()), 0.5 / max(1, (1 - y[fit]).sum()))
    weights, bias = fit_logistic(pick(fit), y[fit], balance, l2=1e-6, steps=120)
    check = hold if hold.any() else fit
    slope, shift = fit_platt(pick(check).dot(weights) + bias, y[check])
    return QualityModel(weights.astype(np.float32), bias, slope, shift)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  min_keep: float = MIN_KEEP, carry: bool = False) -> DataFrame:
    """One row per document: the counts, ``probability``, ``base_failed`` and ``kept``.

    A null text has no words and fails the base rules, as an empty one does.  Rows whose id
    is null or repeats are scored like any other.  With ``carry`` the columns of ``docs``
    are returned and only the rows that are kept.
    """
    weights = None if model.weights is None else model.weights.tolist()
    shipped = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** HASH_BITS numbers at most
    head = QualityModel(None if weights is None else np.zeros(0), model.bias, model.slope, model.shift)
    out_schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                  "n_repeat_words long, probability double, base_failed boolean, kept boolean")

    def judge(text: bytes, index: WordIndex) -> tuple:
        code = index.numbers(text.split())
        n = len(code)
        chars, symbols, dup, repeat = text_counts(text, code)
        p = head.probability(float(index.values[code].mean()) if n else 0.0)
        failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
        return n, chars, symbols, dup, repeat, p, failed, not failed and p >= min_keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        index = WordIndex(lambda w: sum([table[f] for f in word_features(w, NGRAMS)]) if table else 0.0)
        for batch in batches:
            if carry:
                keep = [judge(t, index)[-1] for t in row_bytes(batch, text_col)]
                yield batch.filter(pa.array(keep, pa.bool_()))
                continue
            rows = [judge(t, index) for t in row_bytes(batch, "text")]
            cols = list(zip(*rows)) if rows else [[] for _ in range(8)]
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "probability", "base_failed", "kept"])

    if carry:
        return docs.mapInArrow(run, docs.schema)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, out_schema)

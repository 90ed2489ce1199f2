"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic rows are the positives, all other text is unlabelled.  With class prior
``p`` the risk of a scorer f is  p R+(f) + max(0, Ru-(f) - p Rp-(f)):  the unlabelled part,
corrected for the positives hidden in it, may not fall below zero; where it would, the
step goes back along that part.  Features say whether a hashed word or character n-gram
occurs in the text.  Only features whose rate among the positives clearly exceeds their
rate in clean text (again estimated from the unlabelled text by the class prior) enter
the model, so a long text gathers no noise from its ordinary words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.quality import labelled_sample
from tidewatch.llm.shared import row_bytes
from tidewatch.llm.text_model import HASH_BITS, Adam, SparseRows, WordCache, fit_platt, sigmoid, word_features

FOLDS = 4
HELD_OUT_FOLD = 2
THRESHOLD = 0.3
NGRAMS = (4, 5)
MAX_POSITIVE = 2000       # confirmed toxic rows that the model is fitted to, at most
MAX_UNLABELLED = 4000     # unlabelled rows that the model is fitted to, at most
MAX_CALIBRATION = 2000    # labelled clean rows that set the scale of the finished scores, at most
MIN_LIFT = 3            # rate among positives over the estimated rate in clean text
MIN_Z = 3.0               # and standard errors between the two
PUNCTUATION = b".,;:!?\"'()[]{}*#%&$|<>-_/\\"


@dataclass
class ToxicityModel:
    weights: dict[int, float] | None  # by feature; None: no positive to learn from, scores are zero
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, features: set[int]) -> float:
        return sum(self.weights[f] for f in sorted(features)) + self.bias

    def score(self, features: set[int]) -> float:
        if self.weights is None:
            return 0.0
        return float(sigmoid(self.slope * self.raw(features) + self.shift))


def fold(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def distinct_words(text: bytes) -> set[bytes]:
    words = {w.strip(PUNCTUATION) for w in text.lower().split()}
    words.discard(b"")
    return words


def presence(text: bytes, cache: WordCache) -> np.ndarray:
    lists = cache.many(distinct_words(text))
    return np.unique(np.concatenate(lists)).astype(np.int32) if lists else np.zeros(0, np.int32)


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
                   max_calibration: int = MAX_CALIBRATION, steps: int = 300, rate: float = 0.05) -> ToxicityModel:
    """Fit on bounded samples: confirmed toxic rows outside the held-out fold, and text whose
    label is not looked at.  The class prior is the toxic share of the labelled rows.  Labelled
    clean rows outside the fold serve only to put the finished scores on the scale of a
    probability (Platt)."""
    learn = fold() != HELD_OUT_FOLD
    share = labels.where(F.col("toxic").isin(0, 1) & learn).agg(F.avg("toxic")).first()[0]
    if not share:
        return ToxicityModel(None)
    prior = min(float(share), 0.9)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labelled = labelled_sample(labels, "toxic", max(max_positive, max_calibration), learn)
    positive = labelled.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive)
    clean = labelled.where("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_calibration)
    # a seeded, hash-ranked sample of the whole table outside the held-out fold
    unlabelled = (texts.select("doc_id").where(learn).distinct()
                  .orderBy(F.xxhash64(F.lit("unlabelled"), F.col("doc_id")), "doc_id").limit(max_unlabelled)
                  .select("doc_id", F.lit(0).alias("y")))
    sample = positive.unionByName(unlabelled).unionByName(clean.select("doc_id", F.lit(2).alias("y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(lambda w: np.array(word_features(w, NGRAMS)))
        for batch in batches:
            rows = [presence(t, cache) for t in row_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "y", "idx"])

    # at most max_positive + max_unlabelled + max_calibration rows of 12 bytes
    table = (texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
             .mapInArrow(run, "doc_id long, y int, idx array<int>").toArrow()
             .sort_by([("doc_id", "ascending"), ("y", "ascending")]))
    y = table.column("y").to_numpy()
    rows = [np.asarray(i.values) for i in table.column("idx")]
    groups = [[rows[i] for i in np.flatnonzero(y == kind)] for kind in (0, 1, 2)]
    if not groups[0] or not groups[1]:
        return ToxicityModel(None)
    model = fit_nnpu(groups[1], groups[0], prior, steps, rate)
    if groups[2]:
        calibrate(model, groups[1], groups[2], prior)
    return model


def calibrate(model: ToxicityModel, positive: list[np.ndarray], clean: list[np.ndarray], prior: float) -> None:
    """Platt scaling of the finished scores, the two samples weighted to the class prior."""
    known = model.weights.keys()
    raw = [np.array([model.raw(set(r.tolist()) & known) for r in rows]) for rows in (positive, clean)]
    copies = max(1, round((1 - prior) / prior * len(positive) / len(clean)))
    spare = max(1, round(prior / (1 - prior) * len(clean) / len(positive)))
    raw = [np.repeat(raw[0], spare), np.repeat(raw[1], copies)]
    model.slope, model.shift = fit_platt(np.concatenate(raw), np.repeat([1.0, 0.0], [len(r) for r in raw]))


def marking_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Features that are clearly more frequent among positives than in clean text."""
    dim = 1 << HASH_BITS
    in_p = np.bincount(np.concatenate(positive), minlength=dim) / len(positive)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=dim) / len(unlabelled)
    clean = np.clip((in_u - prior * in_p) / (1 - prior), 0, None)
    floor = 0.5 / len(unlabelled)
    error = np.sqrt(in_p * (1 - in_p) / len(positive) + (in_u * (1 - in_u) + floor) / len(unlabelled) / (1 - prior) ** 2)
    return (in_p * len(positive) >= 2) & (in_p >= MIN_LIFT * (clean + floor)) & (in_p - clean >= MIN_Z * error)


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
             steps: int = 300, rate: float = 0.05, l2: float = 1e-4, slack: float = 0.0) -> ToxicityModel:
    """Full-batch non-negative PU risk with the logistic loss over the marking features."""
    dim = 1 << HASH_BITS
    chosen = marking_features(positive, unlabelled, prior)

    def matrix(rows: list[np.ndarray]) -> SparseRows:
        return SparseRows([(own := i[chosen[i]], np.ones(len(own))) for i in rows], dim)

    p, u = matrix(positive), matrix(unlabelled)
    w, adam = np.zeros(dim + 1), Adam(dim + 1, rate)
    w[-1] = np.log(prior / (1 - prior))

    def back(x: SparseRows, err: np.ndarray) -> np.ndarray:
        return np.r_[x.back(err), err.sum()]

    for _ in range(steps):
        fp, fu = p.dot(w[:-1]) + w[-1], u.dot(w[:-1]) + w[-1]
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        from_p = back(p, -prior * sigmoid(-fp) / p.n)
        corrected = back(u, sigmoid(fu) / u.n) - back(p, prior * sigmoid(fp) / p.n)
        grad = from_p + corrected if negative >= -slack else -corrected
        grad[:-1] += l2 * w[:-1]
        w = adam.step(w, grad)
    return ToxicityModel({int(f): float(w[f]) for f in np.flatnonzero(chosen)}, float(w[-1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row.

    A null text is empty and scores as a text without words.  A null id is not held out;
    repeated rows are scored each.
    """
    # 2 ** HASH_BITS features at most; plain data, as a broadcast's classes would have to be on the workers
    shipped = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(*shipped.value)
        known = own.weights or {}
        cache = WordCache(lambda w: [f for f in word_features(w, NGRAMS) if f in known])
        for batch in batches:
            score = np.array([own.score(set().union(*cache.many(distinct_words(t)))) for t in row_bytes(batch, "text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()),
                 pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(fold(id_col) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

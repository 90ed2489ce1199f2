import zlib

from tests.llm import cases
from tidewatch.llm import toxicity as T


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = T.score_toxicity(docs, T.train_toxicity(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert {r.held_out for r in got} == {True}
    toxic = [r.predicted for r in got if r.toxic == 1]
    clean = [r.predicted for r in got if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.75 and sum(clean) / len(clean) < 0.06


def test_rows_folds_and_threshold(spark):
    docs = cases.documents(spark)
    toxic = [(i, 0, int(i % 5 == 0)) for i in range(60)] + [(None, 0, 1), (3, None, None)]
    labels = spark.createDataFrame(toxic, "doc_id long, quality int, toxic int")
    got = T.score_toxicity(docs, T.train_toxicity(docs, labels)).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("toxic", T.F.when(T.fold() == T.HELD_OUT_FOLD, 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    a, b = T.train_toxicity(docs, labels), T.train_toxicity(docs, flipped)
    assert a == b


def test_no_positive_and_empty_table(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = T.train_toxicity(docs, none)
    assert {r.score for r in T.score_toxicity(docs, model).collect()} == {0.0}
    assert T.score_toxicity(cases.empty_documents(spark), model).collect() == []


def plain_nnpu(positive, unlabelled, prior, chosen, steps, rate, l2):
    """The non-negative PU fit by loops over rows and features."""
    import math
    sig = lambda x: 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))
    soft = lambda x: max(x, 0) + math.log1p(math.exp(-abs(x)))
    keep = sorted(chosen)
    rows = [[sorted(set(r) & chosen) for r in group] for group in (positive, unlabelled)]
    w, bias = dict.fromkeys(keep, 0.0), math.log(prior / (1 - prior))
    m, v = dict.fromkeys([*keep, "b"], 0.0), dict.fromkeys([*keep, "b"], 0.0)
    for t in range(1, steps + 1):
        f = [[sum(w[i] for i in r) + bias for r in group] for group in rows]
        n_p, n_u = len(rows[0]), len(rows[1])
        negative = sum(map(soft, f[1])) / n_u - prior * sum(map(soft, f[0])) / n_p
        grad = dict.fromkeys([*keep, "b"], 0.0)
        for group, scores, n in ((0, f[0], n_p), (1, f[1], n_u)):
            for r, x in zip(rows[group], scores):
                corrected = sig(x) / n if group else -prior * sig(x) / n
                step = (corrected + (0 if group else -prior * sig(-x) / n)) if negative >= 0 else -corrected
                for i in [*r, "b"]:
                    grad[i] += step
        for i in keep:
            grad[i] += l2 * w[i]
        for i in [*keep, "b"]:
            m[i] = 0.9 * m[i] + 0.1 * grad[i]
            v[i] = 0.999 * v[i] + 0.001 * grad[i] ** 2
            change = rate * (m[i] / (1 - 0.9 ** t)) / (math.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
            if i == "b":
                bias -= change
            else:
                w[i] -= change
    return w, bias


def test_fit_and_scores_equal_a_plain_version():
    import math
    import random
    import numpy as np
    rng = random.Random(3)
    row = lambda marks: sorted({*rng.sample(range(100, 400), 12), *(x for x in marks if rng.random() < 0.7)})
    positive = [row((1, 2, 3, 4)) for _ in range(40)]
    unlabelled = [row((1, 2, 3, 4) if rng.random() < 0.2 else ()) for _ in range(120)]
    arrays = [[np.array(r, np.int32) for r in group] for group in (positive, unlabelled)]
    chosen = set(np.flatnonzero(T.marking_features(*arrays, 0.2)).tolist())
    assert {1, 2, 3, 4} <= chosen
    model = T.fit_nnpu(*arrays, 0.2, steps=60, rate=0.05)
    w, bias = plain_nnpu(positive, unlabelled, 0.2, chosen, 60, 0.05, 1e-4)
    assert model.weights.keys() == w.keys()
    assert abs(model.bias - bias) < 1e-3 and all(abs(model.weights[i] - x) < 1e-3 for i, x in w.items())
    for r in positive[:5] + unlabelled[:20]:
        raw = sum(w[i] for i in set(r) & chosen) + bias
        assert abs(model.score(set(r) & chosen) - 1 / (1 + math.exp(-raw))) < 1e-3

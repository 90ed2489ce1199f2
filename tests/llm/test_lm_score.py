import math
import re
import zlib
from collections import Counter

import numpy as np

from tests.llm import cases
from tidewatch.llm import lm_score as L

WORD = re.compile("[^\x20\x09-\x0d]+")


def low_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    train = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            train.update(low_words(text))
            train["\n"] += 1  # the end; no word holds a line feed
    n, v = sum(train.values()), len(train)
    out = []
    for doc_id, text in rows:
        tokens = low_words(text) + ["\n"]
        out.append((doc_id, held(doc_id), len(tokens), sum(train[t] > 0 for t in tokens), n,
                    round(sum(math.log10((train[t] + 1) / (n + v + 1)) for t in tokens), 6)))
    return out


def shown(r):
    return (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))


def test_counts_and_base_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "KNOWN_WORDS", 30)  # most words go through the join
    docs = cases.documents(spark)
    got = L.lm_scores(docs).collect()
    assert sorted(map(str, map(shown, got))) == sorted(map(str, brute([(r.doc_id, r.text) for r in docs.collect()])))


def test_held_out_rows_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = L.lm_scores(docs).collect()
    rows = {r.doc_id: r for r in got}
    for doc_id, *rest in brute([(r.doc_id, r.text) for r in docs.collect()]):
        assert shown(rows[doc_id])[1:5] == tuple(rest[:4]) and abs(rows[doc_id].base_score - rest[4]) < 1e-4
    own = [r for r in got if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


def corpus():
    words = [b"w%d" % i for i in range(5000)]
    counts = np.arange(5000, 0, -1)
    own = L.outputs_of(L.CLASSES) - L.FIRST_WORD
    return L.Corpus(words, counts, 10, int(counts.sum()) + 10, 5001, int(counts[own:].sum()), 5000 - own)


def test_probabilities_add_up_to_one():
    c = corpus()
    model = L.Model.start(c)
    rng = np.random.default_rng(2)
    model.flat += rng.normal(0, 0.2, model.flat.shape).astype(np.float32)
    every = np.arange(L.outputs_of(L.CLASSES))
    context = np.tile(np.array([[5, 4096]]), (len(every), 1))
    assert abs((10 ** model.log10_probs(context, every)).sum() - 1) < 1e-4
    spelled = 10 ** c.spelled(c.counts[c.modelled:])
    assert abs(spelled.sum() + 10 ** c.spelled(0) - 1) < 1e-9


def test_training_learns_a_bigram():
    c = corpus()
    model = L.Model.start(c)
    trainer = L.Trainer(model, L.Model.unigram(c))
    rng = np.random.default_rng(3)
    first = rng.integers(2, 300, 4000)
    tokens = np.stack([first, (first * 7) % 300 + 2], axis=1).ravel()
    context = L.contexts(tokens, np.array([0]))
    before = model.log10_probs(context, tokens).mean()
    for _ in range(30):
        trainer.step(context, tokens)
    assert model.log10_probs(context, tokens)[1::2].mean() > before + 0.5


def test_contexts_stop_at_text_starts():
    got = L.contexts(np.array([7, 8, 9, 5, 6]), np.array([0, 3]))
    m = L.outputs_of(L.CLASSES)
    assert got.tolist() == [[m, m], [7, m], [8, 7], [m, m], [5, m]]


def test_empty_and_all_held_out(spark):
    assert L.lm_scores(cases.empty_documents(spark)).collect() == []
    only = next(i for i in range(100) if held(i))
    (row,) = L.lm_scores(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert shown(row) == (only, True, 3, 0, 0, 0.0) and row.score < 0


def test_model_size_and_step_are_not_cut_to_fit_a_budget():
    model = L.Model.start(corpus())
    assert model.r.shape[1] == model.q.shape[1] == model.u.shape[1] == 24
    assert L.BATCH_TOKENS == 8192


def test_outputs_grow_with_the_distinct_words(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i * 50, i * 50 + 50)) + " the of") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = L.word_counts(docs.select("text"))
    c = L.gather(counts, len(rows))
    outputs = L.outputs_of(c.side)
    assert c.side > L.CLASSES and c.modelled == outputs - L.FIRST_WORD > 10_000
    assert L.outputs_of(L.side_of(10 ** 8)) > 5 * L.outputs_of(L.side_of(10 ** 6)) >= 5 * 64 * 1000
    model = L.train(docs.select("text"), c)
    start = L.Model.start(c)
    assert model.r.shape[0] == outputs + 1 and np.isfinite(model.flat).all()
    assert (model.q[4096:] != start.q[4096:]).any()
    every = np.arange(outputs)
    context = np.tile(np.array([[5, outputs]]), (len(every), 1))
    assert abs((10 ** model.log10_probs(context, every)).sum() - 1) < 1e-3


def plain_step_gradients(m, unigram, side, context, token, noise):
    """The step's gradients by loops over tokens, given the noise it drew per level and parent."""
    classes, groups, leaves = L.Model.shares(unigram, side)
    sig = lambda x: 1 / (1 + math.exp(-x))
    grads = {name: np.zeros(getattr(m, name).shape) for name in ("r", "p", "u", "g", "q", "ub", "gb", "qb")}
    for c, t in zip(context.tolist(), token.tolist()):
        g = t // L.LEAVES
        k = g // side
        q = sum(m.r[c[j]].astype(float) * m.p[j] for j in range(L.CONTEXT))
        pull = np.zeros(L.DIM)
        levels = [("u", k, noise["u"], classes.ravel(), L.CLASS_NOISE), ("g", g, noise["g"][k], groups.ravel(), L.GROUP_NOISE),
                  ("q", t, noise["q"][g], leaves.ravel(), L.LEAF_NOISE)]
        for name, own, drawn, share, n in levels:
            value, bias = getattr(m, name), getattr(m, name + "b")
            for place, target in [(own, 1)] + [(x, 0) for x in drawn]:
                err = sig(float(q @ value[place]) + float(bias[place]) - math.log(n * max(share[place], 1e-12))) - target
                grads[name][place] += err * q
                grads[name + "b"][place] += err
                pull += err * value[place]
        for j in range(L.CONTEXT):
            grads["r"][c[j]] += pull * m.p[j]
            grads["p"][j] += pull * m.r[c[j]]
    return grads


def test_a_step_equals_plain_loops(monkeypatch):
    c = corpus()
    model = L.Model.start(c)
    rng = np.random.default_rng(4)
    model.flat += rng.normal(0, 0.2, model.flat.shape).astype(np.float32)
    unigram = L.Model.unigram(c)
    trainer = L.Trainer(model, unigram)
    tokens = rng.integers(0, 400, 300)
    context = L.contexts(tokens, np.array([0, 50, 51, 200]))
    noise, moved = {}, {}
    draw = trainer._draw

    def remember(edges, parents, n):
        out = draw(edges, parents, n)
        noise["g" if edges is trainer.group_edges else "q"] = dict(zip(parents.tolist(), out.tolist()))
        return out

    class Rng:
        random = trainer.rng.random

        @staticmethod
        def choice(side, size, p):
            noise["u"] = [1, 5, 5, *range(size - 3)]
            return np.array(noise["u"])

    trainer.rng = Rng()
    monkeypatch.setattr(trainer, "_draw", remember)
    monkeypatch.setattr(trainer, "_move", lambda name, rows, grad: moved.update({name: (rows, grad)}))
    trainer.step(context, tokens)
    want = plain_step_gradients(model, unigram, model.side, context, tokens, noise)
    assert moved.keys() == want.keys()
    for name, (rows, grad) in moved.items():
        assert len(set(rows.tolist())) == len(rows)
        full = np.zeros_like(want[name])
        full[rows] = grad
        assert np.allclose(full, want[name], atol=2e-3), name


def test_batched_probabilities_equal_plain_softmaxes():
    c = corpus()
    model = L.Model.start(c)
    rng = np.random.default_rng(6)
    model.flat += rng.normal(0, 0.5, model.flat.shape).astype(np.float32)
    token = np.r_[rng.integers(0, 40, 1500), rng.integers(0, 4096, 300)]
    context = L.contexts(token, np.array([0]))
    got = model.log10_probs(context, token)

    def part(q, vectors, biases, pick):
        logits = vectors.astype(float) @ q + biases
        return logits[pick] - logits.max() - math.log(np.exp(logits - logits.max()).sum())

    for i in range(0, len(token), 7):
        t, q = int(token[i]), sum(model.r[context[i, j]].astype(float) * model.p[j] for j in range(L.CONTEXT))
        g, s = t // L.LEAVES, model.side
        k = g // s
        want = (part(q, model.u, model.ub, k) + part(q, model.g[k * s:(k + 1) * s], model.gb[k * s:(k + 1) * s], g % s)
                + part(q, model.q[g * 16:(g + 1) * 16], model.qb[g * 16:(g + 1) * 16], t % 16))
        assert abs(got[i] - want / math.log(10)) < 1e-3


def test_training_and_scoring_read_stored_ids_and_split_no_text(spark, monkeypatch):
    monkeypatch.setattr(L, "KNOWN_WORDS", 30)
    monkeypatch.setattr(L, "CODED_BYTES", 40)  # a batch's texts are handed on in several pieces
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    texts = docs.where(L.in_training("doc_id")).select("text")
    counts = L.word_counts(texts)
    c = L.gather(counts, texts.count())
    place = {w: i + L.FIRST_WORD for i, w in enumerate(c.words[:c.modelled])}
    coded = L.encode(docs, c)
    got = [(r.doc_id, np.frombuffer(r.ids, L.ID_TYPE).tolist()) for r in coded.collect()]
    want = [(i, [place.get(w.encode(), L.OTHER) for w in low_words(t)] + [L.END]) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = spark.createDataFrame(coded.toPandas().assign(row=range(len(rows))), coded.schema.add("row", "long"))

    def never(text):
        raise AssertionError("split again")

    monkeypatch.setattr(L, "words_of", never)
    model = L.fit(kept.where("not held_out"), c)
    assert not np.array_equal(model.flat, L.Model.start(c).flat)
    scored = L.score_texts(kept, c, model, L.materialize(spark.createDataFrame(
        [(bytearray(w), int(n)) for w, n in zip(c.words, c.counts)], "word binary, c long"), "counts")).collect()
    assert len(scored) == len(rows)


def test_a_step_adds_up_no_run_of_one_token(monkeypatch):
    rng = np.random.default_rng(8)
    size = np.array([1, 1, 5, 1, 70, 2, 1, 1])
    rows = rng.normal(0, 1, (size.sum(), L.DIM)).astype(np.float32)
    first = np.cumsum(size) - size
    want = np.stack([rows[lo:lo + n].astype(float).sum(axis=0) for lo, n in zip(first, size)])
    assert np.allclose(L._sum_runs(rows, first, size), want, atol=1e-4)
    summed = []
    add = np.add

    class Add:
        @staticmethod
        def reduceat(part, starts, axis):
            summed.append((len(part), len(starts)))
            return add.reduceat(part, starts, axis=axis)

    monkeypatch.setattr(L.np, "add", Add)
    got = L._sum_runs(rows, first, size)
    monkeypatch.undo()
    assert summed == [(77, 3)] and np.allclose(got, want, atol=1e-4)
    single = np.arange(4)
    assert np.array_equal(L._sum_runs(rows[:4], single, np.ones(4, np.int64)), rows[:4])


def test_long_and_short_runs_pull_alike(monkeypatch):
    rng = np.random.default_rng(9)
    size = np.array([60, 1, 2, 30, 1])
    first = np.cumsum(size) - size
    q = rng.normal(0, 1, (size.sum(), L.DIM)).astype(np.float32)
    own = rng.normal(0, 1, (5, L.DIM)).astype(np.float32), rng.normal(0, 1, 5).astype(np.float32)
    noise = rng.normal(0, 1, (5, 3, L.DIM)).astype(np.float32), rng.normal(0, 1, (5, 3)).astype(np.float32)
    found = []
    for long_run in (1, 48, 10 ** 6):
        monkeypatch.setattr(L, "LONG_RUN", long_run)
        pull = np.zeros_like(q)
        found.append([pull, *(x for pair in L.Trainer._pulled(q, pull, own, noise, first, size) for x in pair)])
    for other in found[1:]:
        assert all(np.allclose(x, y, atol=1e-3) for x, y in zip(found[0], other))

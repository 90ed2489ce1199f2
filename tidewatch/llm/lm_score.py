"""LM scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Counts.  All tokens of all training rows are counted (per task first, then by word).  The
most frequent words (``KNOWN_WORDS`` and one for each output that a larger corpus adds) travel
to the tasks with their counts; the counts of
all other words stay distributed and meet the texts in a join.  A word that many rows hold is
thus looked up in the task, and the join keys are rare by construction.

Model.  The most frequent words, the end and one class "other word" are the outputs, the
leaves of a tree of three levels by rank: classes, as many groups in each, ``LEAVES`` outputs in
each group.  Their number grows with the corpus: 2 V^(1/4) classes for V distinct training
words, so 64 sqrt(V) outputs, and never under ``CLASSES`` classes.  The vectors of the last two
tokens, weighted per position, add up to the prediction q; P(token) = P(class | q)
P(group | class, q) P(token | group, q), all log-bilinear softmaxes, normalised exactly by
batched matrix products over 4 V^(1/4) + ``LEAVES`` terms a token.  An "other word" is then
spelled out by its add-one share among the other training words, with one place left for all
unseen words, so probabilities over all words add up to one.

Texts are split and looked up once (``encode``); training and scoring read the stored ids.

Training.  The rows are split into one part per ``TOKENS_PER_MODEL`` tokens; a task trains on
all rows of its part with noise-contrastive estimation (noise from the unigram distributions
of each level); a part hands over the chunks of parameters it changed, which are averaged by
tokens, chunk by chunk, in Spark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import materialize, row_bytes

FOLDS, HELD_OUT_FOLD = 7, 2
CLASSES = 16               # of a small corpus; see side_of
LEAVES = 16                # outputs of a group
DIM = 24
CONTEXT = 2
KNOWN_WORDS = 200_000      # most frequent words whose counts travel to the tasks
END, OTHER, FIRST_WORD = 0, 1, 2
CLASS_NOISE, GROUP_NOISE, LEAF_NOISE = 16, 4, 2
ID_TYPE = "<i4"            # of the outputs in a coded text
CODED_BYTES = 64_000_000   # of coded texts that one batch holds, about
BATCH_TOKENS = 8192        # per training step
SCORE_TOKENS = 32768       # per scoring batch
TILE = 1024                # rows whose terms are computed at once
LONG_RUN = 48              # tokens times terms of a training step that make a product of their own
RATE = 0.08
CHUNK = 1024               # parameters per row when tasks hand them over
TOKENS_PER_MODEL = 4_000_000  # tokens that one part of the training holds, about


def fold(id_col: str, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def in_training(id_col: str) -> Column:
    """Rows with a null id are in no fold: they are scored, and learned from."""
    return F.coalesce(fold(id_col) != HELD_OUT_FOLD, F.lit(True))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: only A-Z change, only ASCII white space splits


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word binary, c)`` over all rows of ``texts`` (column ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
            held.clear()
            return batch

        for batch in batches:
            for text in row_bytes(batch, "text"):
                held.update(words_of(text))
                if len(held) > 200_000:
                    yield out()
        yield out()

    return texts.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Corpus:
    """What the counts say; ``words`` holds the KNOWN_WORDS most frequent, in order."""
    words: list[bytes]
    counts: np.ndarray
    rows: int
    tokens: int      # N, with one end per row
    distinct: int    # V, the end included
    other_tokens: int    # tokens and distinct words outside the model's own
    other_distinct: int
    side: int = CLASSES  # classes of the model, and groups in each

    @property
    def modelled(self) -> int:
        return min(len(self.words), outputs_of(self.side) - FIRST_WORD)

    def base(self, c: np.ndarray | int) -> np.ndarray | float:
        return np.log10((c + 1) / (self.tokens + self.distinct + 1))

    def spelled(self, c: np.ndarray | int) -> np.ndarray | float:
        return np.log10((c + 1) / (self.other_tokens + self.other_distinct + 1))


def side_of(distinct: int) -> int:
    """Classes, and groups in each, for so many distinct training words."""
    return max(CLASSES, math.ceil(2 * distinct ** 0.25))


def outputs_of(side: int) -> int:
    return side * side * LEAVES


def gather(counts: DataFrame, rows: int) -> Corpus:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    side = side_of(distinct)
    top = counts.orderBy(F.desc("c"), "word").limit(KNOWN_WORDS + outputs_of(side) - outputs_of(CLASSES)).toArrow()
    c = top.column("c").to_numpy().astype(np.int64)
    own = min(len(c), outputs_of(side) - FIRST_WORD)
    return Corpus(top.column("word").to_pylist(), c, rows, total + rows, distinct + (rows > 0),
                  int(total - c[:own].sum()), int(distinct - own), side)


class Model:
    """Parameters in one flat vector; ``r`` input vectors, ``p`` position weights; vectors and
    biases of the classes (``u``), the groups (``g``) and the outputs (``q``)."""

    @staticmethod
    def shapes(side: int) -> dict[str, tuple[int, ...]]:
        outputs = outputs_of(side)
        return {"r": (outputs + 1, DIM), "p": (CONTEXT, DIM), "u": (side, DIM), "ub": (side,),
                "g": (side * side, DIM), "gb": (side * side,), "q": (outputs, DIM), "qb": (outputs,)}

    def __init__(self, flat: np.ndarray, side: int = CLASSES):
        self.flat, self.side, at = flat, side, 0
        for name, shape in self.shapes(side).items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size

    @classmethod
    def start(cls, corpus: Corpus) -> Model:
        """Biases are the unigram model; input vectors are small and random."""
        side = corpus.side
        model = cls(np.zeros(sum(int(np.prod(s)) for s in cls.shapes(side).values()), np.float32), side)
        model.r[:] = np.random.default_rng(11).normal(0, 0.3, model.r.shape)
        model.p[:] = 1.0
        for name, share in zip(("ub", "gb", "qb"), cls.shares(cls.unigram(corpus), side)):
            getattr(model, name)[:] = np.log(np.maximum(share, 1e-30)).ravel()
        return model

    @staticmethod
    def unigram(corpus: Corpus) -> np.ndarray:
        """Counts of the outputs; places without a word count nothing."""
        c = np.zeros(outputs_of(corpus.side))
        c[END] = max(corpus.rows, 1)
        c[OTHER] = corpus.other_tokens + corpus.other_distinct + 1
        c[FIRST_WORD:FIRST_WORD + corpus.modelled] = corpus.counts[:corpus.modelled]
        return c

    @staticmethod
    def shares(unigram: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares of the classes, of the groups in their class and of the outputs in their group."""
        leaves = unigram.reshape(side * side, LEAVES)
        groups = leaves.sum(axis=1).reshape(side, side)
        classes = groups.sum(axis=1)
        return (classes / classes.sum(), groups / np.maximum(classes, 1e-30)[:, None],
                leaves / np.maximum(leaves.sum(axis=1), 1e-30)[:, None])

    def inputs(self, context: np.ndarray) -> list[np.ndarray]:
        return [self.r.take(context[:, j], axis=0) for j in range(CONTEXT)]

    def predict(self, inputs: list[np.ndarray]) -> np.ndarray:
        q = inputs[0] * self.p[0]
        for j in range(1, CONTEXT):
            q += inputs[j] * self.p[j]
        return q

    def log10_probs(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        order, side = sorted_places(token), self.side  # one sort for all levels
        token = token[order]
        group = token // LEAVES
        klass = group // side
        q = np.ones((len(token), DIM + 1), np.float32)  # the last column takes the biases into the products
        q[:, :DIM] = self.predict(self.inputs(context[order]))
        u, g = [np.concatenate([value, bias[:, None]], axis=1) for value, bias in ((self.u, self.ub), (self.g, self.gb))]
        found = np.empty(len(token), np.float32)
        room = np.empty((TILE, side), np.float32)
        for part in tiles(0, len(token)):
            logits = np.dot(q[part], u.T, out=room[:part.stop - part.start])
            found[part] = _log_softmax_pick(logits, klass[part])
        for k, lo, hi in spans(*_runs(klass)):
            own = g[k * side:(k + 1) * side].T
            for part in tiles(lo, hi):
                logits = np.dot(q[part], own, out=room[:part.stop - part.start])
                found[part] += _log_softmax_pick(logits, group[part] - k * side)
        q = q[:, :DIM]
        leaves, biases = self.q.reshape(-1, LEAVES, DIM), self.qb.reshape(-1, LEAVES)
        logits = np.empty((len(token), LEAVES), np.float32)
        groups, first, size = _runs(group)
        often = size >= 8  # one product for the group; the tokens of rare groups bring their own outputs
        for k, lo, hi in spans(groups[often], first[often], size[often]):
            np.dot(q[lo:hi], leaves[k].T, out=logits[lo:hi])
        rare = np.flatnonzero(np.repeat(~often, size))
        for part in tiles(0, len(rare)):
            some = rare[part]
            logits[some] = np.matmul(leaves.take(group[some], axis=0), q[some, :, None])[:, :, 0]
        logits += biases.take(group, axis=0)
        found += _log_softmax_pick(logits, token % LEAVES)
        out = np.empty(len(token))
        out[order] = found
        return out / np.log(10)


def spans(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> list[tuple[int, int, int]]:
    """``(value, start, end)`` of runs."""
    return list(zip(values.tolist(), first.tolist(), (first + size).tolist()))


def tiles(lo: int, hi: int) -> list[slice]:
    return [slice(at, min(at + TILE, hi)) for at in range(lo, hi, TILE)]


def _log_softmax_pick(logits: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Overwrites ``logits``."""
    top = logits.max()
    if top - logits.min() > 80:  # beyond single precision without a maximum per row
        logits -= logits.max(axis=1, keepdims=True)
    else:
        logits -= top
    chosen = logits[np.arange(len(pick)), pick]
    np.exp(logits, out=logits)
    return chosen - np.log(logits @ np.ones(logits.shape[1], np.float32))


def contexts(tokens: np.ndarray, starts: np.ndarray, side: int = CLASSES) -> np.ndarray:
    """The CONTEXT tokens before each token; before a text's start stands a mark of its own."""
    mark = outputs_of(side)
    first = np.repeat(starts, np.diff(np.r_[starts, len(tokens)]))
    at = np.arange(len(tokens))
    out = np.empty((len(tokens), CONTEXT), np.int64)
    for j in range(CONTEXT):
        before = at - j - 1
        out[:, j] = np.where(before >= first, tokens[np.maximum(before, 0)], mark)
    return out


class Trainer:
    """Noise-contrastive steps with AdaGrad on the rows a step touches."""

    def __init__(self, model: Model, unigram: np.ndarray):
        self.model, self.tokens, side = model, 0, model.side
        self.rng = np.random.default_rng(13)
        self.sums = Model(np.full_like(model.flat, 1e-2), side)
        self.class_p, *lower = Model.shares(unigram, side)
        # places without a word get an even share of their level: they may be drawn as noise
        self.group_p, self.leaf_p = [np.where(p.sum(axis=1, keepdims=True) > 0, p, 1 / p.shape[1]) for p in lower]
        self.group_edges, self.leaf_edges = [p.cumsum(axis=1).astype(np.float32) for p in (self.group_p, self.leaf_p)]
        self.log_class, self.log_group, self.log_leaf = [
            np.log(n * np.maximum(p.ravel(), 1e-12)).astype(np.float32)
            for n, p in ((CLASS_NOISE, self.class_p), (GROUP_NOISE, self.group_p), (LEAF_NOISE, self.leaf_p))]

    def _move(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        value, seen = getattr(self.model, name), getattr(self.sums, name)
        total = grad * grad
        total += seen.take(rows, axis=0)
        seen[rows] = total
        np.sqrt(total, out=total)
        np.divide(grad, total, out=total)
        total *= -RATE
        total += value.take(rows, axis=0)
        value[rows] = total

    def _draw(self, edges: np.ndarray, parents: np.ndarray, n: int) -> np.ndarray:
        """``n`` children of each parent by their shares, as places in the level."""
        width = edges.shape[1]
        draw = self.rng.random((len(parents), n), dtype=np.float32)
        local = (draw[:, :, None] > edges[parents][:, None, :]).sum(axis=2)
        return np.minimum(local, width - 1) + parents[:, None] * width

    def step(self, context: np.ndarray, token: np.ndarray) -> None:
        m, side = self.model, self.model.side
        self.tokens += len(token)
        order = sorted_places(token)  # one sort: tokens, groups and classes come in runs
        context, token = context.take(order, axis=0), token[order]
        group = token // LEAVES
        klass = group // side
        inputs = m.inputs(context)
        q = m.predict(inputs)

        # classes: the token's own against noise that the whole step shares
        noise = self.rng.choice(side, size=CLASS_NOISE, p=self.class_p)
        shift_u, shift_g, shift_q = m.ub - self.log_class, m.gb - self.log_group, m.qb - self.log_leaf
        err = _sigmoid(q @ m.u[noise].T + shift_u[noise])
        pull = err @ m.u[noise]
        # with it, as all tokens of a class share them: noise among its groups
        classes, first, size = _runs(klass)
        drawn_g = self._draw(self.group_edges, classes, GROUP_NOISE)
        grad_u, grad_g = self._pulled(q, pull, (m.u[classes], shift_u[classes]), (m.g[drawn_g], shift_g[drawn_g]), first, size)
        rows_u = _sum_terms((classes, *grad_u), (noise, err.T @ q, err.sum(axis=0)))

        # groups: the token's own, and noise among its outputs
        groups, first, size = _runs(group)
        drawn_q = self._draw(self.leaf_edges, groups, LEAF_NOISE)
        own, grad_q = self._pulled(q, pull, (m.g.take(groups, axis=0), shift_g[groups]),
                                   (m.q.take(drawn_q, axis=0), shift_q[drawn_q]), first, size)
        rows_g = _sum_terms((groups, *own), (drawn_g, *grad_g))

        # outputs: the token's own
        tokens, first, size = _runs(token)
        own, _ = self._pulled(q, pull, (m.q.take(tokens, axis=0), shift_q[tokens]), None, first, size)
        rows_q = _sum_terms((tokens, *own), (drawn_q, *grad_q))

        # inputs
        grad_p = np.stack([np.einsum("nk,nk->k", pull, x) for x in inputs])
        ctx, ctx_grad = self._inputs(order, token, context, pull, tokens, first, size)
        for name, (ids, grad, grad_b) in (("u", rows_u), ("g", rows_g), ("q", rows_q)):
            self._move(name, ids, grad)
            self._move(name + "b", ids, grad_b)
        self._move("p", np.arange(CONTEXT), grad_p)
        self._move("r", ctx, ctx_grad)

    def _inputs(self, order: np.ndarray, token: np.ndarray, context: np.ndarray, pull: np.ndarray,
                own: np.ndarray, first: np.ndarray, size: np.ndarray):
        """Gradients of the input vectors that the step touches; ``own``: the runs of its tokens.

        An input is mostly the token one or two places before, so what pulls at it is gathered
        at that token's place and summed over the sorted tokens; the rest (text starts, the
        step before) is summed apart.
        """
        m, n = self.model, len(token)
        at_place = np.empty_like(pull)
        at_place[order] = pull
        text, before = np.empty_like(token), np.empty_like(context)
        text[order], before[order] = token, context
        gathered, ids, rest = np.zeros_like(pull), [], []
        for j in range(CONTEXT):
            part = at_place * m.p[j]
            apart = np.ones(n, bool)
            apart[j + 1:] = before[j + 1:, j] != text[:max(n - j - 1, 0)]
            apart = np.flatnonzero(apart)
            ids.append(before[apart, j])
            rest.append(part[apart])
            part[apart] = 0
            gathered[:max(n - j - 1, 0)] += part[j + 1:]
        rows = np.concatenate([_sum_runs(gathered.take(order, axis=0), first, size), *rest])
        return _sum_rows(np.concatenate([own, *ids]), rows)[:2]

    @staticmethod
    def _pulled(q: np.ndarray, pull: np.ndarray, own: tuple[np.ndarray, np.ndarray],
                noise: tuple[np.ndarray, np.ndarray] | None, first: np.ndarray, size: np.ndarray):
        """Gradients of the terms (vectors, biases) that all tokens of a run of ``q`` share; adds to ``pull``.

        ``own`` holds a term for each run, the place of its tokens, and ``noise`` some more.  A long
        run is a product of its own; the tokens of all short runs are computed together, term by term.
        """
        terms, shift = own[0][:, None], own[1][:, None]
        if noise:
            terms, shift = np.concatenate([terms, noise[0]], axis=1), np.concatenate([shift, noise[1]], axis=1)
        count = terms.shape[1]
        short = size * count < LONG_RUN
        sizes, long = size[short], np.flatnonzero(~short)
        products = spans(long, first[long], size[long])
        few = np.flatnonzero(np.repeat(short, size))
        some = q.take(few, axis=0)
        vecs = [np.repeat(terms[short, j], sizes, axis=0) for j in range(count)]

        err = np.empty((len(q), count), np.float32)
        for k, lo, hi in products:
            np.dot(q[lo:hi], terms[k].T, out=err[lo:hi])
        if len(few):
            err[few] = np.stack([np.einsum("nk,nk->n", some, vec) for vec in vecs], axis=1)
        err += np.repeat(shift, size, axis=0)
        err = _sigmoid(err)
        err[:, 0] -= 1

        grads, more = np.empty_like(terms), np.empty_like(q)
        for k, lo, hi in products:
            part = err[lo:hi]
            np.dot(part, terms[k], out=more[lo:hi])
            np.dot(part.T, q[lo:hi], out=grads[k])
        if len(few):
            starts, moved = np.cumsum(sizes) - sizes, np.zeros_like(some)
            for j, vec in enumerate(vecs):
                weight = np.repeat(err[few, j], DIM).reshape(-1, DIM)
                vec *= weight
                moved += vec
                weight *= some
                grads[short, j] = _sum_runs(weight, starts, sizes)
            more[few] = moved
        pull += more
        sums = np.add.reduceat(err, first, axis=0)
        return (grads[:, 0], sums[:, 0]), (grads[:, 1:], sums[:, 1:])


def _sum_runs(rows: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``rows``; a run of one is its row, and columns are added two by two, as complex numbers."""
    out = rows.take(first, axis=0)
    many = size > 1
    if many.any():
        sizes = size[many]
        part = rows.compress(np.repeat(many, size), axis=0).view(np.complex64)
        out[many] = np.add.reduceat(part, np.cumsum(sizes) - sizes, axis=0).view(np.float32)
    return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted values: the distinct ones, where each starts, and how often it stands."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    first = np.flatnonzero(new)
    size = np.empty_like(first)
    size[:-1] = first[1:] - first[:-1]
    size[-1:] = len(values) - first[-1:]
    return values[first], first, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def sorted_places(keys: np.ndarray) -> np.ndarray:
    """The stable order of non-negative keys: key and place are sorted as one number."""
    bits = len(keys).bit_length()
    both = keys << bits
    both |= np.arange(len(keys))
    both.sort()
    both &= (1 << bits) - 1
    return both


def _sum_rows(idx: np.ndarray, rows: np.ndarray, scalars: np.ndarray | None = None):
    order = sorted_places(idx)
    ids, first, size = _runs(idx[order])
    return (ids, _sum_runs(rows.take(order, axis=0), first, size),
            None if scalars is None else np.add.reduceat(scalars[order], first))


def _sum_terms(*parts: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """The places, vectors and biases of terms, each place once."""
    places, grads, biases = zip(*parts)
    return _sum_rows(np.concatenate([x.ravel() for x in places]), np.concatenate([x.reshape(-1, DIM) for x in grads]),
                     np.concatenate([x.ravel() for x in biases]))


class Ids:
    """Token ids of texts, gathered until a batch is full."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.parts, self.starts, self.size = [], [], 0

    def add(self, coded: bytes) -> None:
        """A text as ``encode`` stores it."""
        own = np.frombuffer(coded, ID_TYPE)
        self.parts.append(own)
        self.starts.append(self.size)
        self.size += len(own)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = np.concatenate(self.parts).astype(np.int64), np.array(self.starts)
        self.reset()
        return out


def ranks_of(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Frequency ranks; -1: beyond the known words."""
    return np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))


def ids_of(ranks: np.ndarray, modelled: int) -> np.ndarray:
    own = np.empty(len(ranks) + 1, ID_TYPE)
    own[:-1] = np.where((ranks < 0) | (ranks >= modelled), OTHER, ranks + FIRST_WORD)
    own[-1] = END
    return own


def encode(docs: DataFrame, corpus: Corpus, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: fold, token numbers, base score and share of the spelled words as far as
    the known words tell, the text's tokens as outputs of the model, and its other words with their numbers.

    Texts are split and words looked up here, once; training and scoring read the ids.
    """
    # KNOWN_WORDS and the outputs; plain data, as a broadcast's classes would have to be on the workers
    shipped = docs.sparkSession.sparkContext.broadcast(astuple(corpus))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Corpus(*shipped.value)
        known, modelled = {w: i for i, w in enumerate(seen.words)}, seen.modelled
        base_of, spelled_of = seen.base(seen.counts), seen.spelled(seen.counts)
        base_end, end_known = float(seen.base(seen.rows)), int(seen.rows > 0)

        for batch in batches:
            n_tokens, n_known, base, spelled, ids, rare, times, ends, held, done = [], [], [], [], [], [], [], [0], 0, 0

            def out() -> pa.RecordBatch:
                part = batch.slice(done, len(n_tokens))
                pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
                return pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(spelled, pa.float64()), pa.array(ids, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base", "spelled", "ids", "rare"])

            for text in row_bytes(batch, "text"):
                words = words_of(text)
                ranks = ranks_of(words, known)
                found = ranks[ranks >= 0]
                missing = Counter([words[i] for i in np.flatnonzero(ranks < 0).tolist()])
                n_tokens.append(len(words) + 1)
                n_known.append(len(found) + end_known)
                base.append(base_end + float(base_of[found].sum()))
                spelled.append(float(spelled_of[found[found >= modelled]].sum()))
                ids.append(ids_of(ranks, modelled).tobytes())
                rare.extend(missing)
                times.extend(missing.values())
                ends.append(len(rare))
                held += len(ids[-1])
                if held > CODED_BYTES:
                    yield out()
                    done += len(n_tokens)
                    n_tokens, n_known, base, spelled, ids, rare, times, ends, held = [], [], [], [], [], [], [], [0], 0
            if n_tokens:
                yield out()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(fold(id_col) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
                                "spelled double, ids binary, rare array<struct<word:binary,n:bigint>>")


def train(texts: DataFrame, corpus: Corpus) -> Model:
    """``fit`` on all rows of ``texts`` (column ``text``)."""
    return fit(encode(texts.withColumn("doc_id", F.lit(None).cast("long")), corpus), corpus)


def fit(coded: DataFrame, corpus: Corpus) -> Model:
    """One pass over all rows of ``coded``; returns the token-weighted mean of the parts' models."""
    start = Model.start(corpus)
    if not corpus.tokens:
        return start
    shipped = coded.sparkSession.sparkContext.broadcast((start.flat, Model.unigram(corpus)))
    side = corpus.side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, unigram = shipped.value
        trainer, ids = Trainer(Model(flat.copy(), side), unigram), Ids()

        def learn() -> None:
            tokens, starts = ids.take()
            context = contexts(tokens, starts, side)
            for lo in range(0, len(tokens), BATCH_TOKENS):
                trainer.step(context[lo:lo + BATCH_TOKENS], tokens[lo:lo + BATCH_TOKENS])

        for batch in batches:
            for text in row_bytes(batch, "ids"):
                ids.add(text)
                if ids.size >= BATCH_TOKENS:
                    learn()
        if ids.size:
            learn()
        if trainer.tokens:
            moved = (trainer.model.flat - flat) * np.float32(trainer.tokens / total)
            for chunk, lo in enumerate(range(0, len(flat), CHUNK)):
                part = moved[lo:lo + CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int32()), pa.array([part], pa.list_(pa.float32()))], names=["chunk", "part"])

    def add_up(table: pa.Table) -> pa.Table:
        part = sum(np.asarray(v.values, np.float64) for v in table.column("part"))
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "part": pa.array([part], pa.list_(pa.float64()))})

    total = corpus.tokens  # the tokens of all parts, one end per row included
    parts = -(-corpus.tokens // TOKENS_PER_MODEL)  # joins neighbouring partitions, moves no row
    mean = (coded.select("ids").coalesce(parts).mapInArrow(run, "chunk int, part array<float>")
            .groupBy("chunk").applyInArrow(add_up, "chunk int, part array<double>").toArrow())
    flat = start.flat.copy()
    for chunk, part in zip(mean.column("chunk").to_pylist(), mean.column("part")):
        flat[chunk * CHUNK:(chunk + 1) * CHUNK] += np.asarray(part.values)
    return Model(flat, side)


def score_texts(coded: DataFrame, corpus: Corpus, model: Model, counts: DataFrame) -> DataFrame:
    """One row per row of ``coded``: fold, token numbers, base score and model score.

    ``coded`` is what ``encode`` returns, stored, with a column ``row`` that tells its rows apart.
    """
    shipped = coded.sparkSession.sparkContext.broadcast(model.flat)
    side = model.side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = Model(shipped.value, side), Ids()
        for batch in batches:
            done = []

            def flush() -> None:
                tokens, starts = ids.take()
                done.append(np.add.reduceat(own.log10_probs(contexts(tokens, starts, side), tokens), starts))

            for text in row_bytes(batch, "ids"):
                ids.add(text)
                if ids.size >= SCORE_TOKENS:
                    flush()
            if ids.size:
                flush()
            neural = np.concatenate(done) if done else np.zeros(0)
            at = batch.schema.get_field_index("spelled")
            yield pa.RecordBatch.from_arrays(
                batch.columns[:at] + [pa.array(batch.column(at).to_numpy(zero_copy_only=False) + neural, pa.float64())],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    scored = coded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "spelled", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")
    stored = materialize(scored, "lm-scores")
    words = coded.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.n")
    c = F.coalesce("c", F.lit(0))
    share = (words.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(corpus.tokens + corpus.distinct + 1)))).alias("more_base"),
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(corpus.other_tokens + corpus.other_distinct + 1))))
        .alias("more_score")))
    joined = stored.join(share, "row", "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows outside the held-out fold and score every row.

    A null text is empty and has the end as its only token.  Repeated rows are counted and
    scored each; a null id is never held out.  Without any training row the model is
    uniform over its outputs.  Extra columns are ignored.
    """
    texts = docs.where(in_training(id_col)).select(F.col(text_col).cast("string").alias("text"))
    counts = materialize(word_counts(texts), "word-counts")
    corpus = gather(counts, texts.count())
    # the row number is stored with the row, so it is the same for all who read it
    coded = materialize(encode(docs, corpus, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "lm-ids")
    return score_texts(coded, corpus, fit(coded.where(~F.col("held_out")), corpus), counts)

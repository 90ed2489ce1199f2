import numpy as np
import pytest

from tidewatch.llm import embedding_dedup as E


def brute(rows, limit=0.95):
    good = [i for i, (v, e) in enumerate(rows) if v is not None and e is not None and len(e) > 0
            and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    near = {i: [j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= limit] for i in good}
    out = []
    for i, (v, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen]
        comp = v if v is None else min(ids)
        out.append((v, len(near.get(i, [])), comp, v is not None and v == comp))
    return out


@pytest.fixture()
def vectors():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 8))
    rows = []
    for i in range(400):
        x = centers[rng.integers(12)] + rng.normal(size=8) * rng.choice([0.05, 0.3, 1.0])
        rows.append((i, [float(np.float32(v)) for v in x]))
    rows += [(400, rows[7][1]), (401, rows[7][1]), (402, [2 * v for v in rows[7][1]]), (403, None), (404, []),
             (405, [0.0] * 8), (406, [None] + [1.0] * 7), (407, [float("nan")] * 8), (408, [float("inf")] + [1.0] * 7),
             (409, [1.0] * 5), (None, rows[7][1]), (410, [1e30] * 8), (411, [1e-30] * 8)]
    return rows


def test_groups_equal_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_ROWS", 16)  # several blocks per cell
    monkeypatch.setattr(E, "PROBE_ROWS", 7)
    df = spark.createDataFrame([(v, e, 1, 2) for v, e in vectors], "vec_id long, embedding array<float>, rep int, node int")
    got = sorted(map(tuple, E.embedding_groups(df).collect()), key=str)
    assert got == sorted(brute(vectors), key=str)


def test_cells_lose_no_pair_whatever_their_number(spark, vectors, monkeypatch):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    expect = sorted(brute(vectors), key=str)
    for cells in (1, 40):
        monkeypatch.setattr(E, "choose_cells", lambda *_, k=cells: k)
        got = E.embedding_groups(df, sample=320)
        assert sorted(map(tuple, got.collect()), key=str) == expect


def test_representatives_and_empty_table(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    kept = {r.vec_id for r in E.keep_representatives(df).collect()}
    assert kept == {v for v, _, _, keep in brute(vectors) if keep} | {None}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert E.embedding_groups(none).collect() == []


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    e = np.eye(8)
    rows = [(1, e[0].tolist()), (2, e[1].tolist()), (2, e[0].tolist()), (5, e[2].tolist()), (5, e[1].tolist()), (6, e[2].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, E.embedding_groups(df).collect()))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (5, 1, 2, False), (5, 1, 5, True), (6, 1, 5, False)]
    assert got == sorted(brute(rows))


def test_every_length_has_its_links(spark, vectors, monkeypatch):
    """Two lengths with cells of their own and several with a few vectors."""
    rng = np.random.default_rng(9)
    rows = vectors + [(1000 + i, (rng.normal(size=1) * np.ones(12) + rng.normal(size=12) * 0.5).tolist()) for i in range(300)]
    rows += [(2000, [1.0, 2.0, 3.0]), (2001, [1.0, 2.0, 3.0]), (2002, [2.0, 4.0, 6.1]), (2003, [1.0, 2.0]), (2004, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(E, "BLOCK_ROWS", 32)
    got = sorted(map(tuple, E.embedding_groups(df).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    links = {r[0]: r[1] for r in got}
    assert links[2000] == 2 and links[2003] == links[2004] == 0


def test_the_number_of_cells_follows_clusters_and_size():
    rng = np.random.default_rng(8)
    centers = E.unit_rows(rng.normal(size=(16, 32)))
    x = E.unit_rows(centers[rng.integers(16, size=3000)] + rng.normal(size=(3000, 32)) * 0.02)
    assert 8 <= E.choose_cells(x, 200_000, 0.95, 1024) <= 64
    assert E.choose_cells(x[:10], 10, 0.95, 1024) <= 2

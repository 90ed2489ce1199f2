import numpy as np
import xxhash

from tests.llm import cases
from tidewatch.llm import simhash


def brute_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [cur] if cur else []
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    grams = [words] if len(words) < k else [words[i:i + k] for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, codes, bits):
    group = list(range(len(ids)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= bits:
                group[find(i)] = find(j)
    low = {}
    for i, v in enumerate(ids):
        if v is not None:
            low[find(i)] = min(v, low.get(find(i), v))
    return [low.get(find(i)) for i in range(len(ids))]


def test_groups_equal_brute_force(spark):
    docs = cases.documents(spark)
    rows = docs.select("doc_id", "text").collect()
    codes = [brute_fingerprint(r.text) for r in rows]
    expect = sorted(zip([r.doc_id for r in rows], [f"{c:016x}" for c in codes],
                        brute_components([r.doc_id for r in rows], codes, 2)), key=str)
    got = sorted(cases.rows_of(simhash.simhash_groups(docs)), key=str)
    assert got == expect


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    codes = [brute_fingerprint(r.text) for r in rows]
    expect = dict(zip([r.doc_id for r in rows], brute_components([r.doc_id for r in rows], codes, 2)))
    assert {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()} == expect


def test_index_finds_every_pair_in_dense_buckets():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 12, 900, dtype=np.uint64) | np.uint64(5 << 40))
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    found = set()
    for i, j in simhash.GrayIndex(codes).pairs(2):
        found |= {(int(a), int(b)) for a, b in zip(i, j)}
    expect = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes))
              if int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert found == expect


def test_masks_hold_every_pair_within_two_bits():
    masks = [m & (1 << 64) - 1 for m in simhash.bucket_masks(2)]
    assert all(any(not (m >> i & 1 or m >> j & 1) for m in masks) for i in range(64) for j in range(64))
    assert min(m.bit_count() for m in masks) >= 42


def test_gray_rank_sorts_in_gray_order(spark):
    rows = spark.range(16).selectExpr("id", "id ^ shiftright(id, 1) AS gray")
    ranked = rows.orderBy(simhash.gray_rank(rows["gray"])).collect()
    assert [r.id for r in ranked] == list(range(16))


def test_representatives_keep_columns_and_unique_texts(spark):
    docs = cases.documents(spark)
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 0 in ids and 65 not in ids and ids.count(None) == 2 and ids.count(4) == 3


def test_empty_table(spark):
    docs = cases.empty_documents(spark)
    assert simhash.simhash_groups(docs).collect() == []
    assert simhash.keep_representatives(docs).collect() == []

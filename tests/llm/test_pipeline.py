import corpus_pipeline as C
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_packing import check_packed
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tidewatch.llm import line_dedup, packing
from tidewatch.llm.shared import materialize
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


def test_every_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert len(names) == 5
    out, at = {}, docs
    for name, stage in C.STAGES:
        at = materialize(stage(spark, at, SF), "test")
        out[name] = at
    assert out["quality rules"].columns == docs.columns
    kept = out["quality rules"].collect()
    assert 0.8 * docs.count() < len(kept) < docs.count()

    lines = out["line dedup"].collect()
    expect = line_brute([(r.source, r.text) for r in kept], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    assert sorted((r.doc_id, r.text) for r in lines) == sorted((r.doc_id, t) for r, (_, t) in zip(kept, expect))
    assert all(r.n_chars == len(r.text) for r in lines)

    ids, codes = [r.doc_id for r in lines], [brute_fingerprint(r.text) for r in lines]
    alone = {i for i, c in zip(ids, brute_components(ids, codes, 2)) if i == c}
    assert {r.doc_id for r in out["SimHash near-dedup"].collect()} == alone and len(alone) < len(ids)

    mix = out["mixing sources to target weights"]
    assert mix.columns[:5] == docs.columns and sorted(r.doc_id for r in mix.collect()) == sorted(alone)
    packed = out["best-fit packing"].collect()
    texts = [(r.doc_id, r.text) for r in mix.collect()]
    bins, least = check_packed(packed, texts, Tokenizer.from_file(packing.tokenizer_path()))
    assert bins <= least + 1
    first = {}
    place = {r.doc_id: (r.mix_slot, r.mix_offset) for r in mix.collect()}
    for r in packed:
        first[r.sequence_id] = min(first.get(r.sequence_id, place[r.doc_id]), place[r.doc_id])
    assert all(first[r.sequence_id] == (r.first_slot, r.first_offset) for r in packed)


def test_run_gives_the_last_stage(spark):
    got = C.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "sequence_id", "offset", "first_slot"} <= set(got.columns) and got.count() > 0

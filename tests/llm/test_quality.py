import re

from pyspark.sql import functions as F

from tests.llm import cases
from tidewatch.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.append(line)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    counts = {g: grams.count(g) for g in set(grams)} if len(grams) < 3000 else None
    if counts is None:
        from collections import Counter
        counts = Counter(grams)
    marked = set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            marked |= set(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked),
            len(w) < 20 or 100 * len(marked) > 30 * len(w))


def test_counts_equal_brute_force(spark):
    rep = spark.createDataFrame([(900, "a b c d e f g h " * 5), (901, "x y " * 30), (902, "#a *b\n#a *b\n\n \n \n|<>|"),
                                 (903, " ".join(map(str, range(40))) + " 0 1 2 3 4 5 6 7 8")], "doc_id long, text string")
    docs = cases.documents(spark).unionByName(rep, allowMissingColumns=True)
    got = Q.score_quality(docs, Q.QualityModel(None)).collect()
    assert sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect()) == sorted(
        str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    hold = F.pmod(F.xxhash64("doc_id", F.lit("t")), F.lit(3)) == 0
    model = Q.train_quality(docs, labels.where(~hold), per_class=400)
    test = docs.join(labels.where(hold), "doc_id")
    got = Q.score_quality(test.select(docs.columns), model).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    junk = [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(junk) / len(junk) < 0.1


def test_carry_returns_kept_rows_as_they_are(spark):
    docs = cases.documents(spark)
    out = Q.score_quality(docs, Q.QualityModel(None), carry=True)
    assert out.schema == docs.schema
    assert sorted(str(tuple(r)) for r in out.collect()) == sorted(str(tuple(r)) for r in docs.collect() if not brute(r.text)[-1])


def test_no_labels_and_empty_tables(spark):
    docs, none = cases.documents(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert Q.train_quality(docs, none).weights is None
    assert Q.train_quality(docs, odd).weights is None
    assert Q.score_quality(cases.empty_documents(spark), Q.QualityModel(None)).collect() == []

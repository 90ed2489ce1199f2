from collections import Counter, defaultdict

from tests.llm import cases
from tidewatch.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, ratio, least):
    pages, seen = Counter(), defaultdict(Counter)
    for source, text in rows:
        pages[source] += 1
        seen[source].update({s.strip(WHITE) for s in (text or "").split("\n")} - {""})
    out = []
    for source, text in rows:
        if text is None:
            out.append((source, None))
            continue
        keep = [s for s in text.split("\n") if not s.strip(WHITE) or not (
            seen[source][s.strip(WHITE)] >= least and seen[source][s.strip(WHITE)] > ratio * pages[source])]
        out.append((source, "\n".join(keep)))
    return out


def test_equal_to_brute_force(spark):
    rows = [("s1", f"head \nbody {i}\n\n foot{i % 3}\r\nhead") for i in range(30)]
    rows += [("s2", "head\nonly"), ("s2", "head\nother"), (None, "n\nx"), (None, "n\ny"), (None, "n"), ("s3", ""), ("s3", None)]
    rows += [("s4", "boiler\n" * 500 + f"own {i}") for i in range(4)] + [("s4", "boiler")] * 2
    df = spark.createDataFrame([(s, t, "k") for s, t in rows], "source string, text string, line string")
    got = [(r.source, r.text) for r in line_dedup.drop_boilerplate(df).collect()]
    assert Counter(got) == Counter(brute(rows, line_dedup.MAX_RATIO, line_dedup.MIN_PAGES))


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.source, r.text) for r in docs.collect()]
    out = line_dedup.drop_boilerplate(docs, chars_col="n_chars")
    got = out.collect()
    assert out.columns == docs.columns and all(r.n_chars == len(r.text) for r in got)
    expect = brute(rows, line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    assert Counter((r.source, r.text) for r in got) == Counter(expect)
    assert expect != rows  # some line was boilerplate


def test_awkward_rows_and_empty_table(spark):
    docs = cases.documents(spark)
    out = line_dedup.drop_boilerplate(docs, chars_col="n_chars", counts=True)
    assert out.columns == docs.columns + ["n_lines", "n_dropped"] and out.count() == docs.count()
    assert line_dedup.drop_boilerplate(cases.empty_documents(spark)).collect() == []

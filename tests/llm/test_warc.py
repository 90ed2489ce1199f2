import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import warc as W

LONG = "<p>é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 5
PAGES = [(5, "http://a/x", LONG), (3, "http://b", LONG), (9, None, LONG), (1, "http://c\r\nX: y", "short"), (2, "", "short"),
         (7, "u", None), (8, "u", ""), (None, "n", LONG), (11, "big", "z" * 300_000), (3, "http://b", LONG)]


def brute(pages):
    first = {}
    for i, _, html in pages:
        h = (html or "").encode()
        if len(h) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, html in pages:
        h = (html or "").encode()
        ref = first.get(h) if first.get(h) != i else None
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if ref is not None else "response", ref))
    return out


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, n int")


def test_round_trip(spark, pages):
    got = [tuple(r) for r in W.archive_round_trip(pages).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(PAGES)))


def test_real_pages_and_payloads(spark, scratch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    path = f"{scratch}/pages"
    W.write_archive(pages, path)
    read = W.read_archive(spark, path).where("record_type = 'response'")
    got = {r.record_id: bytes(r.payload).decode() for r in read.collect()}
    kept = {i: html for (i, _, html), b in zip([(r.page_id, r.url, r.html) for r in pages.collect()],
                                               brute([(r.page_id, r.url, r.html) for r in pages.collect()])) if b[3] == "response"}
    assert got == {f"<urn:page:{i}>": html for i, html in kept.items()}


def test_filters_reach_the_reader(spark, pages, scratch):
    path = f"{scratch}/a"
    W.write_archive(pages, path)
    read = W.read_archive(spark, path)
    few = read.where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan.replace("(", " ") and [r.record_id for r in few.collect()] == ["<urn:page:5>"]
    assert read.where("payload_bytes > 1000").count() == 1
    assert read.where("refers_to is null and payload is not null").count() == 7
    assert read.where("not (record_type = 'revisit')").count() == 7
    assert W.read_archive(spark, path, payload=False).where("payload is not null").count() == 0


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        Counting.read_bytes += n
        return super().read(n)


def test_payloads_of_other_records_are_not_read(spark, pages, scratch):
    W.write_archive(pages.coalesce(1), f"{scratch}/b")
    import glob
    (name,) = glob.glob(f"{scratch}/b/part-*")
    data = open(name, "rb").read()
    Counting.read_bytes = 0
    rows = list(W.read_records(Counting(data), len(data), [("record_type", lambda v: v == "revisit")]))
    assert len(rows) == 3 and Counting.read_bytes == 0
    with pytest.raises(ValueError):
        list(W.read_records(Counting(data[:-200_000]), len(data) - 200_000, []))


def test_partitions_are_planned_by_size(spark, pages, scratch):
    W.write_archive(pages.repartition(5), f"{scratch}/c")
    reader = W.WarcReader({"path": f"{scratch}/c", "partitionbytes": "100000"})
    parts = reader.partitions()
    assert len(parts) > 1 and len({p for x in parts for p in x.paths}) == sum(len(x.paths) for x in parts)


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_round_trip(none).collect() == []

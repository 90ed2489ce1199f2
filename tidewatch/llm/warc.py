"""WARC archives: written by Spark, read by a Python data source.

Writing.  A WARC record is a header block, a content block and two line ends.  Spark's text
writer with those two line ends as separator writes exactly that, through Spark's commit
protocol and to any file system Spark can reach.  Of records with equal payloads of at least
``MIN_REVISIT_BYTES`` bytes the one with the smallest id is a ``response``; the others are
``revisit`` records, whose headers name it and keep digest and size but no payload.

Reading.  ``spark.read.format("warc")`` plans partitions of whole files of about equal size.
The reader takes over filters on the record type and the record headers it exposes, parses
each header block first, and seeks past the content of records that the filters rule out
(and of all records with ``payload=false``): no payload is read or decoded unless wanted.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, Not, StringStartsWith)

from tidewatch.llm.shared import materialize, shared_path

MIN_REVISIT_BYTES = 100
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
RECORDS_PER_FILE = 20_000
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, "
          "refers_to string, payload binary")
#: data source column -> WARC header (payload columns apart)
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
ID_PREFIX = "<urn:page:"


def planned_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, digest, refers_to`` per row of ``pages``.

    A null payload is empty.  A null id never is the smallest; rows that repeat the smallest
    id of their payload are responses as well.  Payloads move nowhere: only digests that
    several rows share are joined back.
    """
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("payload"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    repeated = materialize(
        rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy(F.col("digest").alias("same"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null").select("same", "first_id"), "revisits")
    joined = rows.join(repeated, F.col("digest") == F.col("same"), "left")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", refers.alias("refers_to"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> None:
    """Write one record per row as ``.warc`` text under ``path`` (uncompressed, so records can
    be skipped by seeking), at most ``RECORDS_PER_FILE`` records in a file."""
    rows = planned_records(pages, id_col, url_col, payload_col)
    revisit = F.col("refers_to").isNotNull()

    def header(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def record_id(col) -> Column:
        return F.concat(F.lit(ID_PREFIX), F.coalesce(col.cast("string"), F.lit("")), F.lit(">"))

    # no line end of a field may end the header early
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "")
    content = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", record_id(F.col("page_id"))),
        header("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        header("WARC-Target-URI", uri),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(
            header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            header("WARC-Refers-To", record_id(F.col("refers_to"))))).otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http;msgtype=response")),
        header("Content-Length", F.octet_length(content).cast("string")),
        F.lit("\r\n"), content)
    (rows.select(record.alias("value")).write.option("lineSep", RECORD_END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).mode("overwrite").text(path))


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; options: ``payload`` (true), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def header_test(f: Filter):
    """``(column, test)`` for a filter the reader can take over on headers, else None."""
    if isinstance(f, Not):
        inner = header_test(f.child)
        if inner is None or not isinstance(f.child, (EqualTo, In, StringStartsWith, IsNull, IsNotNull)):
            return None
        column, test = inner
        if isinstance(f.child, (IsNull, IsNotNull)):
            return column, lambda v: not test(v)
        return column, lambda v: v is not None and not test(v)
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in (*HEADERS, "payload_bytes"):
        return None
    column = f.attribute[0]
    if isinstance(f, IsNull):
        return column, lambda v: v is None
    if isinstance(f, IsNotNull):
        return column, lambda v: v is not None
    value = f.value
    if isinstance(f, EqualNullSafe):
        return column, lambda v: v == value
    tests = {EqualTo: lambda v: v == value, In: lambda v: v in value, GreaterThan: lambda v: v > value,
             GreaterThanOrEqual: lambda v: v >= value, LessThan: lambda v: v < value,
             LessThanOrEqual: lambda v: v <= value, StringStartsWith: lambda v: v.startswith(value)}
    test = tests.get(type(f))
    return None if test is None else (column, lambda v: v is not None and test(v))


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", 64 << 20)))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if header_test(f) is None:
                yield f  # Spark applies it
            else:
                self.filters.append(f)

    def partitions(self) -> list[Files]:
        """Whole files, largest first, into the partition with the least bytes so far."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(_uri(self.path))
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(((f.size, f.path) for f in found
                        if f.is_file and f.size and not f.base_name.startswith(("_", "."))), reverse=True)
        total = sum(size for size, _ in files)
        bins = [[0, []] for _ in range(min(len(files), max(1, -(-total // self.partition_bytes))))]
        for size, path in files:
            least = min(bins, key=lambda b: b[0])
            least[0] += size
            least[1].append(path)
        return [Files(paths) for _, paths in bins] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        tests = [header_test(f) for f in self.filters]
        system, _ = fs.FileSystem.from_uri(_uri(self.path))
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                for row in read_records(io.BufferedReader(raw, 1 << 18), raw.size(), tests, self.with_payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 200
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def read_records(stream: io.BufferedIOBase, size: int, tests: list, with_payload: bool = True) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` from an open archive of ``size`` bytes, headers first.

    A record whose headers fail a test is skipped by seeking past its content.  A file that
    breaks off inside a record raises ``ValueError``.
    """
    at = 0
    while at < size:
        stream.seek(at)
        if not stream.readline().startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError(f"record at byte {at} breaks off in its headers")
            name, _, value = line.partition(b":")
            headers[name.strip().lower()] = value.strip().decode("utf-8", "replace")
        length = int(headers[b"content-length"])
        body = stream.tell()
        at = body + length + len(RECORD_END)
        if body + length > size:
            raise ValueError(f"record at byte {body} breaks off in its content")
        values = {c: headers.get(h.lower().encode()) for c, h in HEADERS.items()}
        declared = headers.get(b"x-payload-length")
        values["payload_bytes"] = None if declared is None else int(declared)
        if not all(test(values[column]) for column, test in tests):
            continue
        payload = None
        if with_payload and values["record_type"] != "revisit":
            payload = stream.read(length)
            if headers.get(b"content-type", "").startswith("application/http"):
                payload = payload.partition(b"\r\n\r\n")[2]
        yield (values["record_type"], values["record_id"], values["target_uri"], values["payload_digest"],
               values["payload_bytes"], values["refers_to"], payload)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path`` as a table; filters on it reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       payload_col: str = "html", path: str | None = None) -> DataFrame:
    """Write ``pages`` as an archive and read it back: one row per page, from the records.

    A response's digest and size are those of the payload that was read; a revisit's come
    from its headers, which are read without its content.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archive(pages, path, id_col, url_col, payload_col)
    page = F.regexp_extract("record_id", "^<urn:page:(-?[0-9]+)>$", 1)
    target = F.regexp_extract(F.coalesce("refers_to", F.lit("")), "^<urn:page:(-?[0-9]+)>$", 1)

    def rows(records: DataFrame, n_bytes: Column, digest: Column) -> DataFrame:
        return records.select(F.expr("try_cast(page as long)").alias("page_id"), n_bytes.cast("long").alias("payload_bytes"),
                              digest.alias("payload_digest"), "record_type",
                              F.expr("try_cast(target as long)").alias("refers_to"))

    full = read_archive(spark, path).where("record_type = 'response'")
    slim = read_archive(spark, path, payload=False).where("record_type = 'revisit'")
    full, slim = (r.withColumn("page", page).withColumn("target", target) for r in (full, slim))
    return rows(full, F.octet_length("payload"), F.sha2("payload", 256)).unionByName(
        rows(slim, F.col("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "")))

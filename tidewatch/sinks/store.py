"""Versioned Parquet article table: upsert by link, retention, snapshots.

Layout: data files by category, link bucket and effective day, each change in a folder of its
own (``<root>/data/w=<id>/category=<c>/bucket=<b>/day=<d>/part-*.parquet``), and one manifest
per version (``<root>/_manifests/<n>.json``) that lists the version's files with their rows.
Files are never changed.  A change writes new files and then the manifest of the next version,
which refers to them and to all files that it keeps; moving that manifest to its name is the
commit.  The move fails if the name is taken, so of two writers that started from the same
version one wins and the other starts again (on file systems whose rename is atomic, as HDFS's
is).  A reader never sees a half-written table.

An upsert reads the links of the touched buckets and rewrites only the files that hold one of
the batch's links.  Retention drops whole days by leaving their files out and rewrites the
boundary day only.  A snapshot is a manifest; the files that it names outlive their versions.
Rows are sorted by ``effective_time`` within files, which is stored physically so that
recency filters are pushed into the Parquet scan (``coalesce`` itself is not pushable).

Merge rules (one batch, rows in batch order): for a link present in the table, title,
summary, published, entities and collected_at take the batch value (a NULL published
overwrites), category and source keep the stored value; inside a batch the last row wins
for the mutable columns and the first row for category/source.  A NULL in a NOT NULL
column rejects the whole batch before anything is written.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import checkpoint_dir
from tidewatch.sources.bindings import effective_time, ts_lit

NOT_NULL = ("category", "source", "title", "link")
MUTABLE = ("title", "summary", "published", "matched_entities")
STICKY = ("category", "source")
COLUMNS = ("category", "source", "title", "link", "summary", "published", "collected_at",
           "matched_entities")
# Largest batch merged by broadcasting it (no shuffle of the stored table), in rows and in
# measured text bytes; larger batches use a shuffled full outer join.
MAX_BROADCAST_BATCH = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


# ---------------------------------------------------------------------------------------------
# File-system helpers (Hadoop FileSystem through the session, so any shared store works)
# ---------------------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def modified(spark: SparkSession, path: str) -> int:
    """Time of a file's last change, in milliseconds."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


# ---------------------------------------------------------------------------------------------
# Manifests
# ---------------------------------------------------------------------------------------------

BUCKET_BYTES = 256 << 20  # text of a new table that one link bucket is meant for
MAX_FILES = 8            # files of one category, bucket and day before an upsert there joins them
COMMIT_ATTEMPTS = 5


class DataFile(NamedTuple):
    path: str            # below the table's root
    bucket: int
    day: str | None      # effective day of all rows
    rows: int

    @property
    def place(self) -> str:
        """The folder below the change's own: category, bucket and day."""
        return self.path.split("/", 2)[2].rpartition("/")[0]


class Version(NamedTuple):
    root: str
    number: int
    buckets: int
    files: tuple[DataFile, ...]

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files)


class VersionConflict(RuntimeError):
    """Another writer committed the version first."""


def read_lines(spark: SparkSession, path: str) -> list:
    """A manifest's lines, each a JSON value."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [json.loads(line) for line in text.splitlines()]


def write_lines(spark: SparkSession, lines: list, path: str) -> None:
    """Write beside, then move; ``VersionConflict`` if the name is taken."""
    jvm = spark.sparkContext._jvm
    folder, _, name = path.rpartition("/")
    fs, target = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray("\n".join(json.dumps(line) for line in lines).encode("utf-8")))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise VersionConflict(path) from None
        raise


def _read_manifest(spark: SparkSession, path: str) -> Version:
    head, *files = read_lines(spark, path)
    return Version(head["root"], head["number"], head["buckets"], tuple(DataFile(*f) for f in files))


def _write_manifest(spark: SparkSession, version: Version, path: str) -> None:
    head = {"root": version.root, "number": version.number, "buckets": version.buckets}
    write_lines(spark, [head, *version.files], path)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, p = _fs(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    return _numbers(spark, f"{root}/_manifests")


def read_version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The files of a version, of the newest if none is given."""
    known = versions(spark, root)
    if not known:
        return None
    return _read_manifest(spark, f"{root}/_manifests/{known[-1] if number is None else number}.json")


def commit(spark: SparkSession, version: Version) -> Version:
    """Make ``version`` the table's newest; ``VersionConflict`` if its number is taken."""
    _write_manifest(spark, version, f"{version.root}/_manifests/{version.number}.json")
    return version


TABLE_SCHEMA = ("source string, title string, link string, summary string, published timestamp_ntz, "
                "collected_at timestamp_ntz, matched_entities map<string,array<string>>, effective_time timestamp_ntz, "
                "w string, category string, bucket int, day date")


def read_files(spark: SparkSession, root: str, files) -> DataFrame:
    paths = [f"{root}/{f.path}" for f in files]
    if not paths:
        return spark.createDataFrame([], TABLE_SCHEMA).drop("w", "bucket", "day")
    return (spark.read.schema(TABLE_SCHEMA).option("basePath", f"{root}/data").parquet(*paths).drop("w", "bucket", "day"))


def read_articles(spark: SparkSession, root: str, since: dt.datetime | None = None) -> DataFrame | None:
    """The newest version's rows; with ``since`` only the files that may hold rows from then on."""
    version = read_version(spark, root)
    if version is None:
        return None
    files = version.files if since is None else [f for f in version.files if f.day is None or f.day >= since.date().isoformat()]
    return read_files(spark, root, files)


def link_bucket(link: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(buckets)).cast("int")


def write_files(df: DataFrame, root: str, buckets: int) -> tuple[DataFile, ...]:
    """Write rows into a folder of their own; they are in no version yet."""
    spark, change = df.sparkSession, f"data/w={uuid.uuid4().hex}"
    timed = (df.select(*COLUMNS).withColumn("effective_time", effective_time(F.col("published"), F.col("collected_at")))
             .withColumn("bucket", link_bucket(F.col("link"), buckets)).withColumn("day", F.to_date("effective_time")))
    (timed.repartition("category", "bucket", "day").sortWithinPartitions("category", "bucket", "day", "effective_time")
     .write.mode("errorifexists").partitionBy("category", "bucket", "day").parquet(f"{root}/{change}"))
    stored = (spark.read.schema(TABLE_SCHEMA).option("basePath", f"{root}/data").parquet(f"{root}/{change}")
              .groupBy(F.col("_metadata.file_path").alias("path"), "bucket", "day").agg(F.count(F.lit(1)).alias("rows")))
    # a row per file; the path after the change's folder is as Spark wrote it
    return tuple(sorted(DataFile(change + "/" + _decoded(r["path"]).split(f"/{change}/", 1)[1], r["bucket"],
                                 r["day"].isoformat() if r["day"] else None, r["rows"]) for r in stored.collect()))


def _decoded(uri: str) -> str:
    from urllib.parse import unquote, urlsplit
    return unquote(urlsplit(uri).path)


def create_table(df: DataFrame, root: str, buckets: int | None = None) -> Version:
    """A new table of the rows of ``df``, one per link; ``buckets`` by their size if not given."""
    buckets = buckets or measure_batch(df).buckets
    return commit(df.sparkSession, Version(root, 1, buckets, write_files(df, root, buckets)))


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Drop all but the newest ``keep`` versions and the data files that neither they nor a
    snapshot refer to; returns how many versions were dropped.

    Run it while no other writer is at work: files of a change that is not committed yet are
    in no manifest.
    """
    known = versions(spark, root)
    old, kept = (known[:-keep], known[-keep:]) if keep > 0 else (known, [])
    named = {f.path for n in kept for f in read_version(spark, root, n).files}
    for path in snapshot_manifests(spark, root):
        named.update(f.path for f in _read_manifest(spark, path).files)
    for n in old:
        delete(spark, f"{root}/_manifests/{n}.json")
    fs, data = _fs(spark, f"{root}/data")
    if fs.exists(data):
        found = fs.listFiles(data, True)
        while found.hasNext():
            path = found.next().getPath()
            below = path.toUri().getPath().split(f"{_decoded(data.toUri().getPath())}/", 1)[1]
            if f"data/{below}" not in named:
                fs.delete(path, False)
    return len(old)


# ---------------------------------------------------------------------------------------------
# Merge (pure) and upsert (writes)
# ---------------------------------------------------------------------------------------------

def collapse_batch(batch: DataFrame, order: str = "batch_ord") -> DataFrame:
    """One row per link: first category/source, last mutable values (batch order; rows that
    tie in it are ordered by their values, so a retry picks the same one)."""
    plain = [c for c in MUTABLE if c != "matched_entities"]
    entities = F.to_json("matched_entities").alias("entities")  # maps have no order of their own
    sticky = F.min_by(F.struct(*[F.col(c) for c in STICKY]), F.struct(order, *STICKY))
    mutable = F.max_by(F.struct(*[F.col(c) for c in MUTABLE]), F.struct(order, *plain, entities))
    return (batch.groupBy("link").agg(sticky.alias("_s"), mutable.alias("_m"))
            .select("link", *[F.col("_s")[c].alias(c) for c in STICKY],
                    *[F.col("_m")[c].alias(c) for c in MUTABLE]))


def merge_articles(current: DataFrame | None, batch: DataFrame, collected_at: dt.datetime,
                   order: str = "batch_ord", broadcast_batch: bool | None = None) -> DataFrame:
    """Table after upserting ``batch`` (pure function; nothing is written)."""
    b = collapse_batch(batch, order).withColumn("collected_at", ts_lit(collected_at))
    b = b.select(*COLUMNS)
    if current is None:
        return b
    cur = current.select(*COLUMNS)
    if broadcast_batch is None:
        broadcast_batch = False
    if broadcast_batch:
        # small batch: stored rows stream past a broadcast batch; no shuffle of the table
        bb = F.broadcast(b.select(*[F.col(c).alias("n_" + c) for c in COLUMNS]))
        updated = cur.join(bb, cur["link"] == bb["n_link"], "left")
        hit = F.col("n_link").isNotNull()
        kept = updated.select(*[
            (F.col(c) if c in STICKY or c == "link" else F.when(hit, F.col("n_" + c)).otherwise(F.col(c))).alias(c)
            for c in COLUMNS])
        existing = cur.select("link").join(F.broadcast(b.select("link")), "link", "left_semi")
        inserted = b.join(F.broadcast(existing), "link", "left_anti")
        return kept.unionByName(inserted)
    n = b.select(*[F.col(c).alias("n_" + c) for c in COLUMNS])
    j = cur.join(n, cur["link"] == n["n_link"], "full_outer")
    hit, old = F.col("n_link").isNotNull(), F.col("link").isNotNull()

    def pick(c: str) -> Column:
        if c == "link":
            return F.coalesce(F.col("link"), F.col("n_link"))
        if c in STICKY:
            return F.when(old, F.col(c)).otherwise(F.col("n_" + c))
        return F.when(hit, F.col("n_" + c)).otherwise(F.col(c))
    return j.select(*[pick(c).alias(c) for c in COLUMNS])


class BatchSize(NamedTuple):
    rows: int
    text_bytes: int
    nulls: dict[str, int]

    @property
    def small(self) -> bool:
        """Within the limits for broadcasting."""
        return self.rows <= MAX_BROADCAST_BATCH and self.text_bytes <= MAX_BROADCAST_BYTES

    @property
    def buckets(self) -> int:
        return max(1, -(-self.text_bytes // BUCKET_BYTES))


def measure_batch(batch: DataFrame) -> BatchSize:
    """Rows, text bytes and NULLs in NOT NULL columns, in one aggregate pass."""
    text_bytes = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("title", "summary", "link"))
    row = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes).alias("bytes"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL]).first()
    return BatchSize(row["n"], row["bytes"] or 0, {c: row[c] for c in NOT_NULL if row[c]})


def upsert_articles(spark: SparkSession, root: str, batch: DataFrame, collected_at: dt.datetime,
                    order: str = "batch_ord", buckets: int | None = None) -> Version | None:
    """Merge ``batch`` into the table at ``root``; returns the new version (None if the batch is empty).

    A table that does not exist is created with ``buckets`` link buckets, by the batch's size if
    not given; a table that is meant to grow large should be given its number.

    If another writer commits first, the merge is done again on that writer's version.
    """
    checkpoint_dir(spark)
    batch = batch.checkpoint(eager=True)  # computed once, and read for its size, its links and the merge
    size = measure_batch(batch)
    if size.rows == 0:
        return None
    if size.nulls:
        raise ValueError(f"NOT NULL constraint violated, batch rejected: {size.nulls}")
    for attempt in range(COMMIT_ATTEMPTS):
        base = read_version(spark, root) or Version(root, 0, buckets or size.buckets, ())
        try:
            return _merge_into(spark, base, batch, collected_at, order, size.small)
        except VersionConflict:
            if attempt + 1 == COMMIT_ATTEMPTS:
                raise


def _merge_into(spark: SparkSession, base: Version, batch: DataFrame, collected_at: dt.datetime, order: str,
                small: bool) -> Version:
    links = batch.select("link").distinct()
    touched = {r[0] for r in links.select(link_bucket(F.col("link"), base.buckets).alias("b")).distinct().collect()}
    hit = files_with_links(spark, base, [f for f in base.files if f.bucket in touched], links, small)
    places: dict[str, list[DataFile]] = {}
    for f in base.files:
        if f.bucket in touched:
            places.setdefault(f.place, []).append(f)
    crowded = {f.path for fs in places.values() if len(fs) >= MAX_FILES for f in fs}
    rewritten = [f for f in base.files if f.path in hit or f.path in crowded]
    current = read_files(spark, base.root, rewritten) if rewritten else None
    added = write_files(merge_articles(current, batch, collected_at, order, broadcast_batch=small), base.root, base.buckets)
    gone = {f.path for f in rewritten}
    return commit(spark, base._replace(number=base.number + 1, files=tuple(f for f in base.files if f.path not in gone) + added))


def files_with_links(spark: SparkSession, base: Version, files: list[DataFile], links: DataFrame, small: bool) -> set[str]:
    """Paths of the files that hold one of ``links``; only their link columns are read."""
    if not files:
        return set()
    stored = spark.read.schema("link string").parquet(*[f"{base.root}/{f.path}" for f in files]).select(
        "link", F.col("_metadata.file_path").alias("path"))
    found = stored.join(F.broadcast(links) if small else links, "link", "left_semi").select("path").distinct()
    return {"data/w=" + _decoded(r["path"]).rpartition("/data/w=")[2] for r in found.collect()}


def retain_articles(spark: SparkSession, root: str, as_of: dt.datetime, days: int) -> int:
    """Delete rows whose effective time is strictly before ``as_of - days``; returns the count.

    Older days are left out of the next version unread; only the boundary day is rewritten.
    """
    base = read_version(spark, root)
    if base is None:
        return 0
    cutoff = as_of - dt.timedelta(days=days)
    day = cutoff.date().isoformat()
    boundary = [f for f in base.files if f.day == day]
    kept = [f for f in base.files if f.day is None or f.day > day]
    late = ~(F.col("effective_time") < ts_lit(cutoff))
    rest = tuple(boundary)
    if boundary and read_files(spark, root, boundary).filter(~late).limit(1).count():
        rest = write_files(read_files(spark, root, boundary).filter(late), root, base.buckets)
    after = base._replace(number=base.number + 1, files=tuple(kept) + rest)
    if after.files == base.files or after.rows == base.rows:
        return 0
    commit(spark, after)
    return base.rows - after.rows


def expired_rows(articles: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows retention would delete (effective time strictly before the cutoff)."""
    cutoff = ts_lit(as_of - dt.timedelta(days=days))
    return articles.filter(effective_time(F.col("published"), F.col("collected_at")) < cutoff)


def snapshot_articles(spark: SparkSession, root: str, snapshot_root: str,
                      snapshot_date: dt.date) -> str | None:
    """Write the newest version's manifest to ``snapshot_root/snapshot_date=<date>``; None when no table.

    No data file is written.  The table remembers the snapshot's place and keeps its files
    until the snapshot is deleted; a snapshot of the same date is replaced.
    """
    version = read_version(spark, root)
    if version is None:
        return None
    folder = f"{snapshot_root}/snapshot_date={snapshot_date.isoformat()}"
    delete(spark, f"{folder}/manifest.json")
    _write_manifest(spark, version, f"{folder}/manifest.json")
    fs, note = _fs(spark, f"{root}/_snapshots/{uuid.uuid4().hex}")
    if f"{folder}/manifest.json" not in snapshot_manifests(spark, root):
        stream = fs.create(note, False)
        stream.write(bytearray(f"{folder}/manifest.json".encode("utf-8")))
        stream.close()
    return folder


def snapshot_manifests(spark: SparkSession, root: str) -> list[str]:
    """The manifests of the table's snapshots that still exist."""
    fs, folder = _fs(spark, f"{root}/_snapshots")
    out = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        stream = fs.open(status.getPath())
        path = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if exists(spark, path):
            out.append(path)
    return out


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a snapshot, given its folder."""
    version = _read_manifest(spark, f"{path}/manifest.json")
    return read_files(spark, version.root, version.files)


def retain_date_partitions(spark: SparkSession, base: str, keep_days: int, today: dt.date,
                           column: str = "log_date") -> int:
    """Drop ``<column>=YYYY-MM-DD`` directories strictly older than ``today - keep_days``.

    Non-date names are ignored; a negative ``keep_days`` disables the policy.
    """
    if keep_days < 0:
        return 0
    cutoff = today - dt.timedelta(days=keep_days)
    removed = 0
    for name in list_dirs(spark, base):
        value = name.split("=", 1)[1] if name.startswith(column + "=") else name
        try:
            d = dt.date.fromisoformat(value)
        except ValueError:
            continue
        if d < cutoff and delete(spark, f"{base}/{name}"):
            removed += 1
    return removed


def storage_policy(spark: SparkSession, *, root: str, raw_dir: str, snapshot_root: str,
                   keep_raw_days: int, today: dt.date, snapshot: bool) -> dict:
    """Snapshot (optional) + raw-log retention, returning what was done."""
    snap = snapshot_articles(spark, root, snapshot_root, today) if snapshot else None
    raw_removed = retain_date_partitions(spark, raw_dir, keep_raw_days, today)
    return {"snapshot_path": snap, "raw_removed": raw_removed}

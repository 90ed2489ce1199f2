"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import checkpoint_dir


def read_docs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder, removed when the session ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidewatch-llm/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path.getParent())
    fs.deleteOnExit(hadoop_path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, and gives the planner its
    real size, so that a join broadcasts it only below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no input column (of any case) uses."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one value at a time; null is the empty text."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    for i in range(len(column)):
        yield column[i].as_py() or b""


def spread_key(*cols: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as links ``(a, b)`` between longs.

    Returns ``(node, root)`` for every node that has a link to another node; ``root`` is
    the smallest node of its component.  Alternates the two star operations until the
    links stop changing: first every larger neighbour of a node is linked to the node's
    smallest neighbour, then every smaller one.  Each round is written to the shared
    folder.  Null ends and self links are ignored.
    """
    links = (edges.where(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    links = materialize(links, "links")
    state = _signature(links)
    while True:
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        nearest = both.groupBy("x").agg(F.min("y").alias("m"))
        large = (both.where(F.col("y") > F.col("x")).join(nearest, "x")
                 .select(F.col("y").alias("u"), F.least("x", "m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        links = materialize(small, "links")
        after = _signature(links)
        if after == state:
            break
        state = after
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]

"""Small helpers the operators share: table access, storage, batches, components."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.session import checkpoint_dir, ship, stored  # noqa: F401 (stored: for the operators)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder under ``spark.checkpoint.dir`` (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bytes of a batch that is handed to Python, unless the session sets its own bound: rows hold whole texts.
_BATCH_BYTES = 8 << 20
_BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def release_memory() -> None:
    """Give what a Python worker has freed back to the system: workers live on, and their neighbours need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, which give their memory back after each task."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_BYTES_CONF, None) is None:
        spark.conf.set(_BATCH_BYTES_CONF, str(_BATCH_BYTES))

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def slices(batches, rows: int) -> Iterator:
    """Arrow record batches cut to at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``: longs) by alternating stars.

    Returns ``node``, ``root`` (the smallest node reachable) for every node on
    an edge. Each round links every node's larger neighbours to its smallest
    neighbour (large star), then its smaller neighbours (small star), so a
    component of any shape halves its depth per round. All work is grouped
    minima and joins; a hub of many links is pre-aggregated before it is
    shuffled. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    clean = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    cur = stored(clean.where("u <> v").distinct(), name)
    if cur.isEmpty():
        return spark.createDataFrame([], "node long, root long")
    before = None
    while True:
        # Large star: neighbours above u go to u's smallest neighbour (or itself).
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = stored(large, name)
        # Small star: u and its smaller neighbours go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        cur = stored(small, name)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return cur.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now

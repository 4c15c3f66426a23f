"""SparkSession defaults and shared-storage locations.

Every job in the package runs on a session that has these settings:

* ``spark.sql.session.timeZone=UTC``: the stored times are ISO texts with an
  offset; the dashboard cuts the offset and reads wall time, which only agrees
  with the offset-aware parse when the session zone is UTC (SURVEY T7).
* AQE on, with skew-join splitting: the hub airport sits on one end of most
  flights, so a shuffle join keyed on an airport code has one hot key.
* Shuffles are sized by AQE: on a cluster set
  ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` for the largest
  load (100 TB at 128 MB is about 800k) and AQE coalesces what turns out small to
  ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
* ANSI stays at the Spark default (on); every parse that may see bad text
  uses a ``try_`` function instead of relying on ANSI being off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings applied to any session handed to the package.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Size above which a dimension is joined by shuffle instead of broadcast.
BROADCAST_MAX_BYTES_CONF = "flightlens.broadcast.maxBytes"
BROADCAST_MAX_BYTES_DEFAULT = 128 * 1024 * 1024


def build_session(master: str | None = None, app_name: str = "flightlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the pipeline's semantics depend on."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def broadcast_max_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES_DEFAULT)))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests, bench) without one
    gets a fresh folder of its own; a cluster session without the setting is an
    error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="flightlens-ckpt-"))
    return sc.getCheckpointDir()


def scratch_location(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, under the shared checkpoint storage.

    Only a name is made here: the folder is created by whatever writes to it,
    through the file system its scheme names.
    """
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Of what is stored between two steps, and of tables.
COMPRESSION = "zstd"
#: Spark setting by which the shuffle files of a query go when it ends, not when the driver collects its garbage.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of each query go when it ends. Not for queries whose frames are persisted."""
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts lineage: what follows survives lost executors without a recompute.
    The shuffles that led to it are done with once it is written, and their files go.
    """
    spark = df.sparkSession
    path = scratch_location(spark, name)
    with released_shuffles(spark):
        df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files below the checkpoint storage that ``df`` reads, once nothing reads them any more."""
    spark = df.sparkSession
    storage = checkpoint_dir(spark).split(":", 1)[-1].lstrip("/").rstrip("/") + "/"
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(storage):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once for an application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="flightlens-ship-"), "flightlens_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)

"""Run the load jobs as landed batches complete, with Structured Streaming.

The reference runs its jobs from a workflow scheduler. Here the landing zone
itself drives them: the process that lands a batch's pages writes one marker
file when the batch is complete,

    <root>/_batches/dataset=<d>/batch_id=<b>/done

and a file stream over those markers calls the matching load job for each
new (dataset, batch_id) in ``foreachBatch``. Markers, not pages, are watched,
so a batch is never loaded while its pages are still arriving. The stream's
checkpoint records which markers were seen; the jobs' batch ledger makes a
replay after a failure a no-op. ``availableNow`` processes what is there and
stops, which suits a daily pull; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.store import TableStore
from ..plans import jobs
from ..session import apply_defaults, checkpoint_dir

MARKER_DIR = "_batches"
MARKER_SCHEMA = StructType([StructField("value", StringType(), True),
                            StructField("dataset", StringType(), True),
                            StructField("batch_id", StringType(), True)])


def write_marker(root: str, dataset: str, batch_id: str) -> str:
    """Mark a landed batch complete (local or mounted paths)."""
    import os

    path = os.path.join(root, MARKER_DIR, f"dataset={dataset}", f"batch_id={batch_id}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "done"), "w") as fh:
        fh.write("done\n")
    return path


def _run_loads(spark: SparkSession, landing_root: str, store: TableStore):
    loaders = {
        "airports": lambda b: jobs.load_airports(spark, landing_root, store, batch_id=b),
        "flights": lambda b: jobs.load_flights(spark, landing_root, store, batch_id=b),
        "scheduled_flights": lambda b: jobs.load_scheduled(spark, landing_root, store, batch_id=b),
    }
    order = list(loaders)  # airports before the flight loads that look them up

    def process(markers: DataFrame, epoch_id: int) -> None:
        # One row per completed batch in this trigger: a handful, not data rows.
        done = markers.select("dataset", "batch_id").distinct().collect()
        for dataset in order:
            for row in sorted(r.batch_id for r in done if r.dataset == dataset):
                loaders[dataset](row)

    return process


def start(spark: SparkSession, landing_root: str, store: TableStore,
          checkpoint_location: str | None = None, available_now: bool = True,
          processing_time: str = "5 minutes") -> StreamingQuery:
    """Start the marker stream; returns the running query."""
    apply_defaults(spark)
    if checkpoint_location is None:
        checkpoint_location = f"{checkpoint_dir(spark).rstrip('/')}/landing-trigger"
    markers = (spark.readStream.schema(MARKER_SCHEMA)
               .text(f"{landing_root.rstrip('/')}/{MARKER_DIR}"))
    writer = (markers.writeStream.foreachBatch(_run_loads(spark, landing_root, store))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time)
    return writer.start()

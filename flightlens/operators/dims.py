"""Airport dimension (J1/J2 lookup side) and the size-guarded broadcast.

The reference looks each ICAO code up with its own Spark query and takes the
first row found. The airports table is appended on every run, so an id can
repeat; here the dimension is reduced to one row per id before any join, so a
join can never fan out. The country is the smallest non-empty one, which makes
the pick deterministic (SURVEY T2, L2).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import broadcast_max_bytes

# Per-row overhead assumed by the size check on top of the payload bytes
# (UnsafeRow header, null bitmap, offsets, hash-table slot).
_ROW_OVERHEAD_BYTES = 48
_FIXED_WIDTH_BYTES = 8


def airport_dimension(airports: DataFrame) -> DataFrame:
    """One row per airport id: smallest non-empty country, smallest name.

    Rows with an empty or NULL country can never satisfy a lookup (F3), and a
    NULL id never matches an equi-join, so both are removed before the
    aggregation. ``min`` is partially aggregated map-side, so an id repeated
    in a third of all rows is collapsed before the shuffle.
    """
    return (airports
            .where(F.col("id").isNotNull() & (F.col("country_name") != ""))
            .groupBy("id")
            .agg(F.min("country_name").alias("country_name"),
                 F.min("airport_name").alias("airport_name")))


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated in-memory bytes) of ``df``, computed by one aggregate job."""
    size_terms = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            size_terms.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            size_terms.append(F.lit(_FIXED_WIDTH_BYTES))
    row_bytes = size_terms[0]
    for term in size_terms[1:]:
        row_bytes = row_bytes + term
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(row_bytes + _ROW_OVERHEAD_BYTES), F.lit(0)).alias("bytes")).first()
    return int(row["rows"]), int(row["bytes"])


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None,
                       persist: bool = True) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when its measured size is within ``max_bytes``.

    The size is measured, not estimated: the frame is persisted (it is used by
    both the departure and the arrival join) and its exact payload summed.
    Beyond the limit the frame is hinted ``shuffle_hash``: both sides shuffle
    on the key, each task hashes its slice of this (smaller) side and streams
    the other without sorting it, and AQE splits a hot key (the hub airport)
    on the large side into several tasks. AQE only does so where both sides are
    shuffled for the join, and a persisted frame that is already laid out by its
    key is not; so this side is dealt anew first, which moves it once more but
    lets the hot key of the far larger side be split.
    """
    limit = broadcast_max_bytes(df.sparkSession) if max_bytes is None else max_bytes
    if persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _, size = measured_bytes(df)
    if size <= limit:
        return F.broadcast(df), True
    return df.repartition(F.xxhash64(*df.columns)).hint("shuffle_hash"), False

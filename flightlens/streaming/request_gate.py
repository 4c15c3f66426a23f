"""Complete requests found as their pages land, with state per request.

``landing_trigger`` waits for a marker file per batch and then reads the whole
batch. Here the page files themselves are the stream. A small state is kept
per request, which pages of it are readable and which of them end it, and a
request comes out once, in the trigger in which its last missing page lands,
whatever the order of its pages. Page bodies are parsed by Spark's functions
and never enter the state: it holds a number and a flag per page of the
requests that are still open, nothing but a mark for those that are complete.

Requests are dealt by a hash of their key to ``BUCKETS`` buckets, whose requests
share a row of Spark's state, and so a Python call in a trigger. Each request
still has a timeout of its own: the row's is the first of them. The number of
buckets and the form of the state belong to the checkpoint; a stream that is to
go on with others starts with a new checkpoint, and the ledger keeps the loads
from being done twice.

Event time is when a page landed. A request that has had no page for
``give_up_after`` (measured against the newest page of any request) is given
up: it comes out as such with the number of its readable pages, and its state
goes. Its pages are not lost: the load jobs read the landing zone itself, so
``jobs.load_flights(batch_id=...)`` loads it if it is completed after all. The
same holds for a page that is older than the watermark when the stream first
sees it and for a broken page that is landed again under the same path, neither
of which a file stream hands on.

Null request parts and repeated pages: a page without a limit or an offset is
never readable, a page that lands twice counts once. No pages, no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.store import TableStore
from ..plans import jobs
from ..schemas import PAGE_FILES
from ..session import apply_defaults, checkpoint_dir
from ..sources import landing

LANDED_AT = "landed_at"
COMPLETE, GIVEN_UP = "complete", "given up"
GIVEN_UP_TABLE = "given_up_requests"
_OUTPUT = ("dataset string, batch_id string, request_id string, limit int, stop int, outcome string, "
           "readable_pages int")
_STATE = "requests binary"
BUCKETS = 256


def _judge():
    """The state function, made here so that it travels to the executors by value."""
    complete, given_up = COMPLETE, GIVEN_UP
    columns = ["dataset", "batch_id", "request_id", "limit", "stop", "outcome", "readable_pages"]
    whole = {"limit", "stop", "readable_pages"}

    def number(x):
        return None if x is None or x != x else int(x)

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # A request: whether it is done, when it is given up, and the readable pages with whether they end it.
        held = {} if not state.exists else {
            tuple(request): (done, due, dict(zip(offsets, ends)))
            for *request, done, due, offsets, ends in json.loads(zlib.decompress(bytes(state.get[0])))}
        now, seen, out = state.getCurrentWatermarkMs(), {}, []
        for frame in () if state.hasTimedOut else frames:
            # Plain lists: a request has few pages, and there are many requests.
            for dataset, batch_id, request_id, limit, offset, end, readable, landed in zip(*(frame[c].tolist() for c in (
                    "dataset", "batch_id", "request_id", "limit", "offset", "ends", "page_ok", "landed_ms"))):
                request = (dataset, batch_id, request_id, number(limit))
                seen[request] = max(seen.get(request, 0), int(landed))
                pages = held.setdefault(request, (False, 0, {}))[2]
                if readable:
                    pages[int(offset)] = pages.get(int(offset), False) or bool(end)
        for request, latest in seen.items():
            done, _, pages = held[request]
            if not done:
                stop = min((offset for offset, end in pages.items() if end), default=None)
                limit = request[3]
                if stop is not None and stop % limit == 0 and all(o in pages for o in range(0, stop + 1, limit)):
                    done = True
                    out.append((*request, stop, complete, len(pages)))
            held[request] = (done, max(latest, now + 1), {} if done else pages)
        for request in [r for r, (_, due, _) in held.items() if due < now]:
            done, _, pages = held.pop(request)
            if not done:
                out.append((*request, None, given_up, len(pages)))
        if held:
            rows = [(*request, done, due, list(pages), list(pages.values())) for request, (done, due, pages) in held.items()]
            state.update((zlib.compress(json.dumps(rows).encode(), 1),))
            state.setTimeoutTimestamp(max(min(due for _, due, _ in held.values()), now + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({c: pd.array(v, "Int32") if c in whole else list(v) for c, v in zip(columns, zip(*out))})

    return judge


def outcomes(pages: DataFrame, give_up_after: str = "1 day",
             records_must_be_objects: bool | Column = False) -> DataFrame:
    """A row for each request of a stream of pages once it is complete, or given up.

    ``pages`` has the columns of ``PAGE_FILES`` and ``landed_at``. ``stop`` is
    the offset of the request's last page, as in ``landing.request_status``.
    """
    parsed = landing.parse_pages(pages.withWatermark(LANDED_AT, give_up_after), records_must_be_objects)
    seen = parsed.select(
        F.pmod(F.xxhash64(*landing.REQUEST_KEY), F.lit(BUCKETS)).cast("int").alias("bucket"), *landing.REQUEST_KEY, "offset", "page_ok", LANDED_AT, F.unix_millis(LANDED_AT).alias("landed_ms"),
        F.coalesce(F.col("offset") + F.col("limit") >= F.col("total"), F.lit(False)).alias("ends"))
    return seen.groupBy("bucket").applyInPandasWithState(
        _judge(), _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def page_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed page files as a stream, with the time each landed."""
    reader = spark.readStream.schema(PAGE_FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (reader.text(landing_root, wholetext=True)
            .select("*", F.col("_metadata.file_modification_time").alias(LANDED_AT)))


def _load(spark: SparkSession, landing_root: str, store: TableStore, found_root: str):
    loaders = {"airports": jobs.load_airports, "flights": jobs.load_flights}

    def process(found: DataFrame, epoch_id: int) -> None:
        # A stream runs in a session of its own, whose table listings are apart from those of the caller's. So what
        # it found is written, and loaded from there by the caller's session; a trigger run again writes the same.
        place = f"{found_root}/{epoch_id}"
        found.write.mode("overwrite").parquet(place)
        found = spark.read.schema(_OUTPUT).parquet(place)
        done = found.where(F.col("outcome") == COMPLETE)
        # A row for each batch that has a request completed in this trigger.
        batches = done.select("dataset", "batch_id").distinct().collect()
        for dataset, load in loaders.items():  # airports first: the flight loads look them up
            for batch_id in sorted(r.batch_id for r in batches if r.dataset == dataset):
                mine = done.where((F.col("dataset") == dataset) & (F.col("batch_id") == batch_id))
                load(spark, landing_root, store, batch_id=batch_id, requests=mine)
        lost = found.where((F.col("outcome") == GIVEN_UP) & F.col("dataset").isin(*loaders)).select(
            *landing.REQUEST_KEY, "readable_pages")
        for table in (jobs.LEDGER_TABLE, GIVEN_UP_TABLE):  # loaded by a job since; noted by this trigger before it failed
            if store.exists(table):
                known = store.read(table)
                known = known.where("state = 'loaded'") if table == jobs.LEDGER_TABLE else known
                lost = lost.join(known.select(*landing.REQUEST_KEY).distinct(), landing.REQUEST_KEY, "left_anti")
        if not lost.isEmpty():
            store.append(lost, GIVEN_UP_TABLE)

    return process


def start(spark: SparkSession, landing_root: str, store: TableStore, checkpoint_location: str | None = None,
          give_up_after: str = "1 day", available_now: bool = True, processing_time: str = "5 minutes",
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Load airports and landed flights request by request as their pages land; returns the running query.

    Today's table is replaced as a whole by a whole pull, so it stays with ``landing_trigger``. The jobs'
    ledger makes a trigger that is run again after a failure load nothing twice. Requests given up go to
    the table ``given_up_requests``.
    """
    apply_defaults(spark)
    if checkpoint_location is None:
        checkpoint_location = f"{checkpoint_dir(spark).rstrip('/')}/request-gate"
    pages = page_stream(spark, landing_root.rstrip("/"), max_files_per_trigger).where(
        F.col("dataset").isin("airports", "flights"))
    # A page of airports with a record that is no object fails its request; flights only lose the record.
    found = outcomes(pages, give_up_after, F.col("dataset") == "airports")
    writer = (found.writeStream.foreachBatch(_load(spark, landing_root, store, f"{checkpoint_location.rstrip('/')}-found"))
              .outputMode("append").option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()

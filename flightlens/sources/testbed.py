"""Flight-shaped tables over the driver's TPC-H-like parquet files.

The reference ships no data. Its tables are derived here from the test
tables with one rule set, the same one the DuckDB oracle SQL uses
(``flightlens.plans.oracle.ADAPTER_SQL``):

* airports: suppliers (``S<suppkey>``) and customers (``C<custkey>``) with their
  nation as country; some suppliers are left out (unknown airports), some get
  an empty country, some are listed twice (the repeated-append case);
* flights: one per lineitem; departs from its supplier, arrives at the order's
  customer; landed when ``l_linestatus='F'``, scheduled when ``'O'``; the
  schedule, lateness and delay are functions of the line's columns.

Nothing is sampled or capped: every line of ``lineitem`` becomes a flight.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dims import airport_dimension, broadcast_if_small
from ..operators.enrich import with_countries
from ..schemas import FLIGHTS, PAGE_FILES, SCHEDULED_FLIGHTS
from ..session import COMPRESSION, discard, released_shuffles, stored
from . import landing

# Fixed values of the adapter (must equal the oracle SQL's):
# supplier ids divisible by 17 are unknown airports, by 13 have an empty
# country, and ids with remainder 1 mod 10 are listed twice.
UNKNOWN_AIRPORT_MOD = 17
EMPTY_COUNTRY_MOD = 13
REPEAT_MOD, REPEAT_REMAINDER = 10, 1
LANDED, SCHEDULED = "F", "O"


# Parquet schemas already read, by path: a table is read several times per
# query, and each schema inference is a job of its own.
_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(path)


def _str(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The appended airports table: (id, airport_name, country_name), with repeats."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = (read_table(spark, sf_dir, "supplier")
                .select("s_suppkey", "s_name", "s_nationkey")
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    key = F.col("s_suppkey")
    known = supplier.where(key % UNKNOWN_AIRPORT_MOD != 0).select(
        F.concat(F.lit("S"), _str(key)).alias("id"),
        F.col("s_name").alias("airport_name"),
        F.when(key % EMPTY_COUNTRY_MOD == 0, F.lit("")).otherwise(F.col("n_name")).alias("country_name"))
    repeated = supplier.where((key % REPEAT_MOD == REPEAT_REMAINDER)
                              & (key % EMPTY_COUNTRY_MOD != 0)
                              & (key % UNKNOWN_AIRPORT_MOD != 0)).select(
        F.concat(F.lit("S"), _str(key)).alias("id"),
        F.col("s_name").alias("airport_name"),
        F.col("n_name").alias("country_name"))
    customers = (read_table(spark, sf_dir, "customer")
                 .select("c_custkey", "c_name", "c_nationkey")
                 .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .select(F.concat(F.lit("C"), _str("c_custkey")).alias("id"),
                         F.col("c_name").alias("airport_name"),
                         F.col("n_name").alias("country_name")))
    return known.unionByName(repeated).unionByName(customers)


def airports_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airport_dimension(airports_raw(spark, sf_dir))


# The dimension as last persisted, and its join side after the size check,
# per (session, test-data folder). A query that reads landed and scheduled
# flights enriches both from one copy, measured once.
_DIMENSIONS: dict[tuple[int, str], tuple[DataFrame, DataFrame]] = {}


def persisted_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``airports_dim``, persisted and size-checked once, reused while it stays cached.

    Returns the join side: broadcast when the measured size is within the
    limit, hinted for a shuffled hash join otherwise.
    """
    key = (id(spark), sf_dir)
    held = _DIMENSIONS.get(key)
    # new, from another session that got the same id, or released by clearCache
    if held is None or held[0].sparkSession is not spark or held[0].storageLevel == StorageLevel.NONE:
        persisted = airports_dim(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        side, _ = broadcast_if_small(persisted, persist=False)
        held = _DIMENSIONS[key] = (persisted, side)
    return held[1]


def flight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem joined to its order and customer, with the raw line columns."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # Orders grow with lineitem, so this join is a shuffle join on the order
    # key at any scale (never a broadcast of a fact table). It is also what
    # spreads the lines over tasks: the scan of a file with few row groups
    # yields few partitions, the shuffle yields spark.sql.shuffle.partitions.
    return (lineitem
            .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey")))


def _iso(ts: Column) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss+00:00`` (the API's text form)."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def flight_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the flights API would return for every line, before enrichment.

    Columns: id, status, flight_date, airline_name, dep_icao, arr_icao, the four
    time texts (actual ones only for landed flights), raw ``delay`` (NULL for
    ``l_returnflag='N'``), and the line's ``l_orderkey``, ``l_discount``, ``l_tax``.
    """
    lines = flight_lines(spark, sf_dir)
    quantity = F.col("l_quantity").cast("int")
    dep_sched = F.timestamp_add("HOUR", (F.col("l_partkey") % 24).cast("int"), F.col("o_orderdate"))
    arr_sched = F.timestamp_add("HOUR", (1 + F.col("l_partkey") % 9).cast("int"), dep_sched)
    dep_actual = F.timestamp_add("MINUTE", quantity - 10 + 5 * (F.col("l_suppkey") % 4).cast("int"), dep_sched)
    arr_actual = F.timestamp_add("MINUTE", quantity - 15, arr_sched)
    landed = F.col("l_linestatus") == LANDED
    flight_id = F.concat_ws(
        "-", _str("l_orderkey"), _str("l_linenumber"), _str("l_partkey"), _str("l_suppkey"),
        _str(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        _str(F.col("l_shipdate").cast("date")))
    return lines.select(
        flight_id.alias("id"),
        F.col("l_linestatus").alias("status"),
        _str(dep_sched.cast("date")).alias("flight_date"),
        F.col("c_mktsegment").alias("airline_name"),
        F.concat(F.lit("S"), _str("l_suppkey")).alias("dep_icao"),
        F.concat(F.lit("C"), _str("o_custkey")).alias("arr_icao"),
        F.lit("UTC").alias("departure_timezone"),
        _iso(dep_sched).alias("departure_scheduled_time"),
        F.when(landed, _iso(dep_actual)).alias("departure_actual_time"),
        F.lit("UTC").alias("arrival_timezone"),
        _iso(arr_sched).alias("arrival_scheduled_time"),
        F.when(landed, _iso(arr_actual)).alias("arrival_actual_time"),
        F.when(F.col("l_returnflag") != "N", quantity).alias("delay"),
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


def enriched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights with both countries found; keeps ``status`` for splitting."""
    records = flight_records(spark, sf_dir)
    joined = with_countries(records, persisted_dimension(spark, sf_dir),
                            airport_names_from_dimension=True, size_checked=True)
    return joined.withColumn("delay_time", F.coalesce(F.col("delay"), F.lit(0)))


def landed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``flights`` table (ground truth): 14 columns."""
    return enriched_flights(spark, sf_dir).where(F.col("status") == LANDED).to(FLIGHTS)


def scheduled_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``scheduled_flights`` table as loaded: 11 columns."""
    return enriched_flights(spark, sf_dir).where(F.col("status") == SCHEDULED).to(SCHEDULED_FLIGHTS)


# Fixed values of the landed-page fixture (must equal the oracle SQL's): one
# request per order, its lines as records, page size 2, a line's page chosen by
# its line number. A page whose lines include a 10 % discount lands as an HTML
# error body; one with an 8 % tax lands with ``"data": null``.
PAGE_LIMIT = 2
PAGE_BATCH_ID = "testbed"
BROKEN_PAGE_MIN_DISCOUNT = 0.095
NULL_DATA_MIN_TAX = 0.075
BROKEN_PAGE_BODY = "<html>502 Bad Gateway</html>"


def api_pages(spark: SparkSession, sf_dir: str, status: str = LANDED) -> DataFrame:
    """Landed page bodies (``PAGE_FILES`` schema) as the flights API would send them.

    Every flight of the given status is a record of its order's request. Line
    numbers may repeat or skip within an order, so some pages hold more than
    ``PAGE_LIMIT`` records and some offsets are missing (incomplete requests).
    A page groups the lines of one order that share a line-number pair, so its
    size is bounded by the order's size, not by the table's.
    """
    recs = flight_records(spark, sf_dir).where(F.col("status") == status)
    record = F.struct(
        F.col("flight_date"),
        F.struct(F.col("id").alias("icao")).alias("flight"),
        F.struct(F.col("airline_name").alias("name")).alias("airline"),
        F.struct(F.col("dep_icao").alias("icao"), F.col("departure_timezone").alias("timezone"),
                 F.col("departure_scheduled_time").alias("scheduled"),
                 F.col("departure_actual_time").alias("actual"),
                 F.col("delay").alias("delay")).alias("departure"),
        F.struct(F.col("arr_icao").alias("icao"), F.col("arrival_timezone").alias("timezone"),
                 F.col("arrival_scheduled_time").alias("scheduled"),
                 F.col("arrival_actual_time").alias("actual")).alias("arrival"))
    # The order's total is counted before its lines are grouped to pages: both by the order, so its lines move once,
    # and as columns; their JSON is made where the page is.
    lines = recs.select(
        "l_orderkey",
        (F.floor((F.col("l_linenumber") - 1) / PAGE_LIMIT) * PAGE_LIMIT).cast("int").alias("offset"),
        F.struct(F.col("id"), record.alias("record")).alias("item"),
        (F.col("l_discount") >= BROKEN_PAGE_MIN_DISCOUNT).alias("broken"),
        (F.col("l_tax") >= NULL_DATA_MIN_TAX).alias("null_data"),
        F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")).alias("total"))
    json = F.transform(F.collect_list("item"), lambda x: F.struct(x["id"], F.to_json(x["record"]).alias("json")))
    pages = lines.groupBy("l_orderkey", "offset").agg(
        F.sort_array(json).alias("items"), F.max("broken").alias("broken"), F.max("null_data").alias("null_data"),
        F.max("total").alias("total"))
    head = F.concat(F.lit('{"pagination":{"total":'), F.col("total").cast("string"), F.lit('},"data":'))
    body = (F.when(F.col("broken"), F.lit(BROKEN_PAGE_BODY))
            .when(F.col("null_data"), F.concat(head, F.lit("null}")))
            .otherwise(F.concat(head, F.lit("["),
                                F.array_join(F.transform("items", lambda x: x["json"]), ","),
                                F.lit("]}"))))
    return pages.select(
        body.alias("value"), F.lit("flights").alias("dataset"), F.lit(PAGE_BATCH_ID).alias("batch_id"),
        F.col("l_orderkey").cast("string").alias("request_id"),
        F.lit(PAGE_LIMIT).alias("limit"), F.col("offset")).to(PAGE_FILES)


# The pages of the streamed-requests fixture land in this many parts, one after the other.
PAGE_PARTS = 3


def page_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """``api_pages`` dealt to parts by a hash of request and offset, so a request's pages land apart and in any order."""
    pages = stored(api_pages(spark, sf_dir).withColumn(
        "part", F.pmod(F.xxhash64("request_id", "offset"), F.lit(PAGE_PARTS))), "api-pages")
    return [pages.where(F.col("part") == n).drop("part") for n in range(PAGE_PARTS)]


# Fixed values of the landed-load fixture (must equal the oracle SQL's): arrivals and departures of one
# country are requested per year, in pages of 100 flights (900 airports). Records of one line number have an
# empty departure code, of another a null airline; the first page of one request never lands.
LOAD_BATCH_ID = "landed-load"
FLIGHT_PAGE_LIMIT = 100
AIRPORT_PAGE_LIMIT = 900
EMPTY_CODE_LINE = 5
NULL_AIRLINE_LINE = 6
LOST_REQUEST = "dep-1993"


# Hub airports of the request-parameter fixture (must equal the oracle SQL's): two depart, the others arrive.
HUB_CODES = ("S1", "S2", "C1", "C2", "C4", "C5")


def _numbered(records: DataFrame, json_options: dict[str, str]) -> DataFrame:
    """``records`` with ``place``, 0, 1, ... within each request in the order of ``sort``, and the request's ``total``.

    The rows are sorted by (request, sort) over ranges; a row's place is its
    number in its range plus the request's rows in earlier ranges. So a request
    of any size is numbered by all tasks. What is added up and broadcast is a
    row for each request and range.
    """
    order = ["request_id", "sort"]
    ranged = stored(records.repartitionByRange(*order).sortWithinPartitions(*order, F.to_json("record", json_options))
                    .withColumn("at", F.monotonically_increasing_id()), "numbered")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    runs = ranged.groupBy("part", "request_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = runs.select(F.col("part").alias("before"), "request_id", F.col("n").alias("rows"))
    starts = (runs.join(earlier, "request_id").where("before <= part").groupBy("part", "request_id", "first")
              .agg((F.sum("rows") - F.max(F.when(F.col("before") == F.col("part"), F.col("n")))).alias("start")))
    totals = runs.groupBy("request_id").agg(F.sum("n").alias("total"))
    return (ranged.join(F.broadcast(starts.join(totals, "request_id")), ["part", "request_id"])
            .withColumn("place", (F.col("at") - F.col("first") + F.col("start")).cast("int"))
            .drop("at", "part", "first", "start"))


def _land(pages: DataFrame, dataset: str, batch_id: str, limit: int, root: str) -> None:
    """Append ``pages`` (value, request_id, offset) to the bundled pages of a batch."""
    keys = {"dataset": F.lit(dataset), "batch_id": F.lit(batch_id), "limit": F.lit(limit)}
    with released_shuffles(pages.sparkSession):
        (pages.select("value", "request_id", "offset").withColumns(keys).write.mode("append").option("compression", COMPRESSION)
         .partitionBy("dataset", "batch_id").parquet(f"{root.rstrip('/')}/{landing.BUNDLES}"))


def _write_pages(records: DataFrame, dataset: str, limit: int, root: str, batch_id: str = LOAD_BATCH_ID,
                 broken: bool = False, **json_options: str) -> None:
    """Land ``records`` (request_id, sort, record) as pages of ``limit`` records' JSON each, bundled.

    Records move as columns; the JSON is made in their page. With ``broken``
    every page lands as the error body of a failed call.
    """
    numbered = _numbered(records, json_options)
    pages = (numbered.groupBy("request_id", (F.floor(F.col("place") / limit) * limit).cast("int").alias("offset"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "record"))).alias("items"), F.max("total").alias("total"))
             .where((F.col("request_id") != LOST_REQUEST) | (F.col("offset") > 0)))
    good = F.concat(F.lit('{"pagination":{"total":'), F.col("total").cast("string"), F.lit('},"data":['),
                    F.array_join(F.transform("items", lambda x: F.to_json(x["record"], json_options)), ","), F.lit("]}"))
    body = F.lit(BROKEN_PAGE_BODY) if broken else good
    _land(pages.select(body.alias("value"), "request_id", "offset"), dataset, batch_id, limit, root)
    discard(numbered)


# Fixed values of the reload fixture (must equal the oracle SQL's): today's table is pulled three times, arrivals
# at the hub country of one year, then a pull whose pages all fail, then departures from it of another year.
PULLS = [("pull-1", "arrival_country", "1997", False), ("pull-2", "arrival_country", "1996", True),
         ("pull-3", "departure_country", "1998", False)]


def land_scheduled_pull(spark: SparkSession, sf_dir: str, root: str, hub_country: str, batch_id: str,
                        hub_side: str, year: str, broken: bool) -> None:
    """Page files of one pull of scheduled flights: one request."""
    flights = enriched_flights(spark, sf_dir).where(
        (F.col("status") == SCHEDULED) & (F.col(hub_side) == hub_country) & F.col("flight_date").startswith(year))
    departure = F.struct(
        F.col("dep_icao").alias("icao"), F.col("departure_airport").alias("airport"),
        F.col("departure_timezone").alias("timezone"), F.col("departure_scheduled_time").alias("scheduled"))
    arrival = F.struct(
        F.col("arr_icao").alias("icao"), F.col("arrival_airport").alias("airport"),
        F.col("arrival_timezone").alias("timezone"), F.col("arrival_scheduled_time").alias("scheduled"))
    record = F.struct(F.col("flight_date"), F.struct(F.col("airline_name").alias("name")).alias("airline"),
                      departure.alias("departure"), arrival.alias("arrival"))
    request = f"{hub_side}-{year}"
    requests = flights.select(F.lit(request).alias("request_id"), F.col("id").alias("sort"), record.alias("record"))
    if requests.isEmpty():  # the API answers with one empty page
        body = BROKEN_PAGE_BODY if broken else '{"pagination":{"total":0},"data":[]}'
        _land(spark.range(1).select(F.lit(body).alias("value"), F.lit(request).alias("request_id"), F.lit(0).alias("offset")),
              "scheduled_flights", batch_id, FLIGHT_PAGE_LIMIT, root)
        return
    _write_pages(requests, "scheduled_flights", FLIGHT_PAGE_LIMIT, root, batch_id, broken)


def land_yearly_pages(spark: SparkSession, sf_dir: str, root: str, every_status: bool = False) -> None:
    """Page files of all landed flights, unknown airports included: a request for each year, with malformed records.

    With ``every_status`` the scheduled flights are among them, as in a pull without request parameters.
    """
    flights = flight_records(spark, sf_dir)
    if not every_status:
        flights = flights.where(F.col("status") == LANDED)
    departure = F.struct(
        F.when(F.col("l_linenumber") == EMPTY_CODE_LINE, F.lit("")).otherwise(F.col("dep_icao")).alias("icao"),
        F.col("departure_scheduled_time").alias("scheduled"), F.col("departure_actual_time").alias("actual"),
        F.col("delay").alias("delay"))
    arrival = F.struct(
        F.col("arr_icao").alias("icao"), F.col("arrival_scheduled_time").alias("scheduled"),
        F.col("arrival_actual_time").alias("actual"))
    airline = F.when(F.col("l_linenumber") != NULL_AIRLINE_LINE, F.struct(F.col("airline_name").alias("name")))
    status = F.when(F.col("status") == LANDED, F.lit("landed")).otherwise(F.lit("scheduled"))
    record = F.struct(F.col("flight_date"), status.alias("flight_status"), F.struct(F.col("id").alias("icao")).alias("flight"),
                      airline.alias("airline"), departure.alias("departure"), arrival.alias("arrival"))
    requests = flights.select(F.concat(F.lit("year-"), F.substring("flight_date", 1, 4)).alias("request_id"),
                              F.col("id").alias("sort"), record.alias("record"))
    _write_pages(requests, "flights", FLIGHT_PAGE_LIMIT, root, ignoreNullFields="false")


# Fixed values of the time-text fixture (must equal the oracle SQL's): the suffixes a scheduled time ends with,
# by order key; the fifth kind is no time, the sixth NULL. Orders of another remainder have no actual arrival.
TIME_SUFFIXES = ["+00:00", "Z", "-06:00", ".5+00:00"]
NO_TIME = "soon"
NO_ACTUAL_MOD = 11


def with_time_texts(flights: DataFrame, *columns: str) -> DataFrame:
    """``flights`` with the texts of ``columns`` in all the forms a time may come in."""
    kind = F.col("l_orderkey") % (len(TIME_SUFFIXES) + 2)

    def text(name: str) -> Column:
        out = F.when(kind == len(TIME_SUFFIXES), F.lit(NO_TIME))
        for k, suffix in enumerate(TIME_SUFFIXES):
            out = out.when(kind == k, F.concat(F.substring(name, 1, 19), F.lit(suffix)))
        return out

    return flights.withColumns({name: text(name) for name in columns})


def land_airport_pages(spark: SparkSession, sf_dir: str, root: str) -> None:
    airports = airports_raw(spark, sf_dir).select(
        F.substring("id", 1, 1).alias("request_id"), F.col("id").alias("sort"),
        F.struct(F.col("id").alias("icao_code"), "airport_name", "country_name").alias("record"))
    _write_pages(airports, "airports", AIRPORT_PAGE_LIMIT, root)


def land_hub_pages(spark: SparkSession, sf_dir: str, root: str, hub_country: str) -> None:
    """Page files of the airports and of the hub country's landed flights, as the API would send them."""
    land_airport_pages(spark, sf_dir, root)
    flights = enriched_flights(spark, sf_dir).where(F.col("status") == LANDED)
    year = F.substring("flight_date", 1, 4)
    tags = F.array_compact(F.array(
        F.when(F.col("arrival_country") == hub_country, F.concat(F.lit("arr-"), year)),
        F.when(F.col("departure_country") == hub_country, F.concat(F.lit("dep-"), year))))
    departure = F.struct(
        F.when(F.col("l_linenumber") == EMPTY_CODE_LINE, F.lit("")).otherwise(F.col("dep_icao")).alias("icao"),
        F.col("departure_airport").alias("airport"), F.col("departure_timezone").alias("timezone"),
        F.col("departure_scheduled_time").alias("scheduled"), F.col("departure_actual_time").alias("actual"),
        F.col("delay").alias("delay"))
    arrival = F.struct(
        F.col("arr_icao").alias("icao"), F.col("arrival_airport").alias("airport"),
        F.col("arrival_timezone").alias("timezone"), F.col("arrival_scheduled_time").alias("scheduled"),
        F.col("arrival_actual_time").alias("actual"))
    airline = F.when(F.col("l_linenumber") != NULL_AIRLINE_LINE, F.struct(F.col("airline_name").alias("name")))
    record = F.struct(F.col("flight_date"), airline.alias("airline"), departure.alias("departure"), arrival.alias("arrival"))
    requests = flights.select(F.explode(tags).alias("request_id"), F.col("id").alias("sort"), record.alias("record"))
    _write_pages(requests, "flights", FLIGHT_PAGE_LIMIT, root, ignoreNullFields="false")

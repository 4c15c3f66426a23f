"""Pages that land bundled: as many rows as pages, in a number of files that does not grow with them."""

import json

from pyspark.sql import functions as F

from flightlens.sources import landing, testbed
from pages import flight, page, write_page


def _records(spark, n):
    return spark.range(n).select(F.lit("r").alias("request_id"), F.format_string("%06d", "id").alias("sort"),
                                 F.struct(F.col("id").alias("code"), F.lit(None).cast("string").alias("none")).alias("record"))


def test_files_do_not_grow_with_pages(spark, tmp_dir):
    testbed._write_pages(_records(spark, 600), "flights", 2, tmp_dir, "b1", ignoreNullFields="false")
    pages = landing.read_pages(spark, tmp_dir, "flights", "b1")
    assert len(pages.inputFiles()) < 50                        # 300 pages
    rows = sorted(pages.collect(), key=lambda r: r.offset)
    assert [r.offset for r in rows] == list(range(0, 600, 2))
    assert [json.loads(r.value) for r in rows] == [
        {"pagination": {"total": 600}, "data": [{"code": k, "none": None}, {"code": k + 1, "none": None}]}
        for k in range(0, 600, 2)]
    assert landing.records(pages, status=landing.stored_status(pages).where("complete")).count() == 600


def test_single_pages_and_bundles_of_one_batch(spark, tmp_dir):
    testbed._write_pages(_records(spark, 5), "flights", 2, tmp_dir, "b1")
    write_page(tmp_dir, "flights", "b1", "single", 2, 0, page([flight()], 1))
    write_page(tmp_dir, "flights", "b2", "other", 2, 0, page([flight()], 1))
    counts = {r.request_id: r["count"] for r in landing.read_pages(spark, tmp_dir, "flights", "b1").groupBy("request_id").count().collect()}
    assert counts == {"r": 3, "single": 1}
    assert landing.read_pages(spark, tmp_dir).count() == 5
    assert landing.read_pages(spark, tmp_dir, "flights", "b2").count() == 1


def test_pages_of_an_order_are_whole(spark, tmp_dir):
    """Totals and order of records in ``api_pages``, for an order whose line numbers repeat."""
    table = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date",
                     [(1, p, 1, n, 1.0, 1.0, 0.0, 0.0, "N", "F", None) for p, n in ((3, 1), (1, 2), (2, 2), (4, 3))]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(1, 1, None)]),
        "customer": ("c_custkey long, c_mktsegment string", [(1, "A")])}
    for name, (schema, rows) in table.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    pages = {r.offset: json.loads(r.value) for r in testbed.api_pages(spark, tmp_dir).collect()}
    assert {o: p["pagination"]["total"] for o, p in pages.items()} == {0: 4, 2: 4}
    codes = [r["flight"]["icao"] for r in pages[0]["data"]]
    assert len(codes) == 3 and codes == sorted(codes)

"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Fingerprints: each text is lower-cased in A-Z, its words are cut into shingles,
every shingle (repeats included) is hashed by XXH64 with seed 42, and a bit of
the fingerprint is 1 if it is set in over half of the hashes.

Links: the distinct fingerprints are dealt into tiles by their population
count. Two fingerprints within ``radius`` bits have counts that differ by at
most ``radius``, so only such tile pairs meet; a pair of tiles is compared
whole by numpy exclusive-or and bit counts. A tile pair returns links that span
its near groups (at most one per fingerprint), never all pairs. Tiles travel
as one binary row each. Components of the links are found by joins.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer words than a shingle count as one
shingle; texts of equal fingerprint are one class whatever their number;
repeated rows each give their row; rows with a null id take part in no link
(their component is null); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import components, map_arrow, slices, stored

SEED = 42
TILE = 1 << 15
#: Fingerprints compared at once: 2^22 pairs are 32 MB of exclusive-ors.
_STRIP = 1 << 22


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):  # bits of a strip of hashes at a time: bounded memory for any text
        part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, shingle: int, text_col: str = "text", column: str = "fingerprint",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``column``: the fingerprint's 64 bits as a long."""
    inner = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join(f"{a} {df.schema[c].dataType.simpleString()}" for a, c in zip(inner, keep)) + ", fp long"

    def run(batches):
        for batch in slices(batches, 1000):
            values = np.array([fingerprint(t, shingle) for t in batch.column(len(inner)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(inner)], pa.array(values.view(np.int64))], [*inner, "fp"])

    chosen = df.select(*(F.col(c).alias(a) for a, c in zip(inner, keep)), F.col(text_col).alias("text"))
    return map_arrow(chosen, run, schema).toDF(*keep, column)


def spanning_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprints) that connect what is near within ``a`` and ``b`` taken together.

    All pairs across the tiles (within the tile if ``same``) are compared; of
    the near ones a forest of at most ``len(a) + len(b)`` links is returned,
    which has the same components. Links come strip by strip and are folded
    into the forest at once, so a large near group needs no room for its pairs.
    """
    nodes = a if same else np.concatenate([a, b])
    offset = 0 if same else len(a)
    parent = np.arange(len(nodes))

    def roots(x):
        while True:
            up = parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    step = max(1, _STRIP // max(1, len(b)))
    for at in range(0, len(a), step):
        strip = a[at:at + step]
        other = b[at:] if same else b
        i, j = np.nonzero(np.bitwise_count(strip[:, None] ^ other[None, :]) <= radius)
        i, j = i + at, j + (at if same else offset)
        apart = i != j
        i, j = i[apart], j[apart]
        while len(i):  # hook larger roots onto smaller ones until the strip's links are inside trees
            ri, rj = roots(i), roots(j)
            cross = ri != rj
            i, j, ri, rj = i[cross], j[cross], ri[cross], rj[cross]
            if len(i):
                np.minimum.at(parent, np.maximum(ri, rj), np.minimum(ri, rj))
    top = roots(np.arange(len(nodes)))
    linked = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[linked], nodes[top[linked]]


def tile_links(classes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints (column ``fp``) within ``radius`` bits.

    The number of tiles of a population count follows the count of its
    fingerprints (at most 65 rows reach the driver), so tiles stay near
    ``tile`` rows at any size.
    """
    spark = classes.sparkSession
    counted = classes.select("fp", F.bit_count("fp").cast("int").alias("ones"))
    sizes = {r["ones"]: -(-r["n"] // tile) for r in counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "a long, b long")
    parts = F.element_at(F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)), F.col("ones"))
    dealt = counted.withColumn("part", F.pmod(F.xxhash64("fp"), parts.cast("long")).cast("int"))
    blobs = dealt.groupBy("ones", "part").agg(F.array_sort(F.collect_list("fp")).alias("fps"))

    # Pairs of tiles whose population counts are within the radius: few numbers for each tile, made by Spark.
    counts = spark.createDataFrame([(o, n) for o, n in sizes.items()], "ones int, parts int")
    tiles = counts.select("ones", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = tiles.toDF("ones_b", "part_b")
    near = other.select("ones_b", "part_b", F.explode(F.expr(f"sequence(ones_b - {radius}, ones_b)")).alias("ones"))
    pairs = (near.join(tiles, "ones")
             .where("ones < ones_b or (ones = ones_b and part <= part_b)"))
    blobs = stored(blobs, "simhash-tiles")  # read twice below
    left = blobs.select("ones", "part", F.col("fps").alias("a"))
    right = blobs.select(F.col("ones").alias("ones_b"), F.col("part").alias("part_b"), F.col("fps").alias("b"))
    met = pairs.join(left, ["ones", "part"]).join(right, ["ones_b", "part_b"])

    def run(batches):
        for batch in slices(batches, 1):
            ones, part, ones_b, part_b = (batch.column(i)[0].as_py() for i in range(4))
            a, b = (batch.column(i)[0].values.to_numpy(zero_copy_only=False).view(np.uint64) for i in (4, 5))
            x, y = spanning_links(a, b, radius, (ones, part) == (ones_b, part_b))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    met = met.select("ones", "part", "ones_b", "part_b", "a", "b")
    return map_arrow(met.repartition(many, F.xxhash64("ones", "part", "ones_b", "part_b")), run, "a long, b long")


def _grouped(df: DataFrame, shingle: int, radius: int, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns (an id first), ``fingerprint``, ``top`` (the component's key) and ``component_id``."""
    rows = stored(fingerprints(df, shingle, text_col, "fingerprint", keep), "simhash-rows")
    classes = stored(rows.groupBy("fingerprint").agg(F.min(keep[0]).alias("first")), "simhash-classes")
    linked = components(tile_links(classes.select(F.col("fingerprint").alias("fp")), radius), "simhash-components")
    grouped = (classes.join(linked.toDF("fingerprint", "top"), "fingerprint", "left")
               .withColumn("top", F.coalesce("top", "fingerprint")))
    smallest = grouped.groupBy("top").agg(F.min("first").alias("component_id"))
    return rows.join(grouped.join(smallest, "top").select("fingerprint", "top", "component_id"), "fingerprint")


def near_duplicates(df: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (its bits as a long) and component_id (the component's smallest id) for each row."""
    found = _grouped(df, shingle, radius, text_col, (id_col,)).withColumnRenamed(id_col, "doc_id")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.select("doc_id", "fingerprint", own.alias("component_id"))


def one_of_each(df: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``df`` with one row of every component: that of the smallest id, then of the smallest hash of its text.

    A row is known by its id and the hash of its text, so rows that repeat an
    id with other texts are judged each on their own. Of rows that repeat both,
    the first in order of all columns (as JSON) stays.
    """
    key = F.xxhash64(F.col(text_col))
    chosen = df.select(F.col(id_col).alias("id__"), key.alias("key__"), F.col(text_col).alias("text__"))
    found = stored(_grouped(chosen.where("id__ is not null"), shingle, radius, "text__", ("id__", "key__"))
                   .select("top", "id__", "key__"), "simhash-found")
    first = found.groupBy("top").agg(F.min(F.struct("id__", "key__")).alias("first__"))
    gone = (found.join(first, "top").where("id__ <> first__.id__ or key__ <> first__.key__")
            .select(F.col("id__").alias("gone__"), F.col("key__").alias("gone_key__")).distinct())
    kept = df.join(gone, (F.col(id_col) == F.col("gone__")) & (key == F.col("gone_key__")), "left_anti")
    repeated = stored(found.groupBy("id__", "key__").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select("id__", "key__"), "simhash-repeated")
    if repeated.isEmpty():
        return kept
    same = (F.col(id_col) == F.col("id__")) & (key == F.col("key__"))
    row = F.struct(*(F.col(c) for c in df.columns))
    single = (kept.join(repeated, same).groupBy("id__", "key__")
              .agg(F.min_by(row, F.to_json(row)).alias("row__")).select("row__.*"))
    return kept.join(repeated, same, "left_anti").union(single)


def report(df: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint in 16 hexadecimal digits, component_id."""
    found = near_duplicates(df, shingle, radius)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")

"""Approximate nearest neighbours by a forest of hash prefixes.

Every vector has a long hash string in each of ``TREES`` trees: ``DIGITS``
digits, each the largest coordinate (with its sign) of ``BLOCK`` random
projections, so near vectors share long prefixes. A tree is the array of all
strings in sorted order, dealt over tasks by ranges.

A query descends all trees at once: in a sorted array its longest prefix match
is with a neighbour, so one pass gives its depth in every tree. It starts at
the deepest level at which ``START`` trees still match and is compared with all
vectors that share its prefix of that length in any tree, by their cosine in
double precision. Then it ascends in all trees together: if a vector as near
as the last of its results so far may have been missed with a probability over
``MISS`` (no tree in which the prefix of that length agrees; the agreement of a
digit at a given cosine is calibrated by simulation, without the data), it
moves up to the deepest level where that is no longer so. The top level is the
whole table. So a query among near vectors stays deep, one without near
neighbours reads a large part of the table, and no bucket or candidate list is cut.

Equal vectors are one class, with its ``k + 1`` smallest ids, before anything is
hashed. Vectors that share a prefix are cut into tiles and their queries into
blocks; a tile and a block are a unit of work, multiplied as matrices, which
returns ``k + 1`` classes a query. Vectors are sent to units after these are sized.

Defined results: vectors that are null, empty or zero or hold null or
non-finite components, and rows with a null id, take no part; only vectors of
equal length are compared; rows that repeat an id and a vector count once, rows
that repeat an id with another vector are searched each on their own, and no
row of the query's own id is a result; ties go to the smaller id; an empty
table or one without queries gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, ship, slices, stored

TREES = 20
DIGITS = 8
BLOCK = 16
#: Trees that still match at a query's first level.
START = 10
MISS = 0.1
TILE = 2048
QUERY_TILE = 1024
SEED = 12_007
_BITS = (2 * BLOCK - 1).bit_length()
#: Rows of a Python call: units of few rows share one.
_GROUP_ROWS = 16_384
#: Units up to which their sizes are broadcast. Nothing else of a level is: Spark sizes the rows of a vector in all trees
#: as it sizes the vector, and stored units by their bytes on disk, and would broadcast many times as much.
BROADCAST_UNITS = 20_000
_UNIT = ["dim", "tree", "level", "prefix"]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square of a component over- or underflows; exact."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def strings(x: np.ndarray) -> np.ndarray:
    """Hash strings of the rows as numbers: (rows, trees); the first digit stands in the highest bits."""
    n, dim = x.shape
    axes = np.random.default_rng([SEED, dim]).normal(size=(dim, TREES * DIGITS * BLOCK)).astype(np.float32)
    spread = (scaled(x).astype(np.float32) @ axes).reshape(n, TREES, DIGITS, BLOCK)
    best = np.abs(spread).argmax(3)
    digit = 2 * best + (np.take_along_axis(spread, best[..., None], 3)[..., 0] < 0)
    return (digit.astype(np.int64) << (_BITS * np.arange(DIGITS - 1, -1, -1))).sum(2)


def level_cosines(trees: int = TREES, miss: float = MISS) -> list[float]:
    """For each level from 1: the least cosine at which a vector shares no prefix of that length with probability <= ``miss``."""
    rng = np.random.default_rng(SEED)
    x, z = rng.normal(size=(2, 20_000, BLOCK))
    grid = np.linspace(0, 1, 101)

    def digit(v):
        best = np.abs(v).argmax(1)
        return 2 * best + (v[np.arange(len(v)), best] < 0)

    agree = np.maximum.accumulate([np.mean(digit(x) == digit(c * x + np.sqrt(1 - c * c) * z)) for c in grid])
    out = []
    for level in range(1, DIGITS + 1):
        enough = np.flatnonzero((1 - agree ** level) ** trees <= miss)
        out.append(float(grid[enough[0]]))  # at cosine 1 all agree
    return out


def _keyed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vec and key (16 bytes of the vector) of the rows that take part."""
    def run(batches):
        for batch in slices(batches, 2000):
            at, keys = [], []
            for i, vector in enumerate(batch.column(1).to_pylist()):
                if vector and None not in vector:
                    x = np.array(vector, np.float64) + 0.0
                    if np.isfinite(x).all() and x.any():
                        at.append(i)
                        keys.append(xxhash.xxh3_128_digest(x.tobytes()))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.binary())], ["id", "vec", "key"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec")).where("id is not null")
    return map_arrow(rows, run, f"id long, vec {df.schema[vector_col].dataType.simpleString()}, key binary")


def _hashed(classes: DataFrame) -> DataFrame:
    """``classes`` with dim and codes (a hash string for each tree)."""
    def run(batches):
        for batch in slices(batches, 1000):
            vectors = [np.array(v, np.float64) for v in batch.column(batch.schema.names.index("vec")).to_pylist()]
            codes = np.zeros((len(vectors), TREES), np.int64)
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                codes[at] = strings(np.stack([vectors[i] for i in at]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * TREES), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims.astype(np.int32)), lists],
                                             [*batch.schema.names, "dim", "codes"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return map_arrow(classes, run, f"{fields}, dim int, codes array<long>")


def _depths(batches):
    """Rows of the sorted arrays -> query, depth: digits shared with the neighbours in the array."""
    def matched(a, b):
        bits = np.frexp((a[:, 2] ^ b[:, 2]).astype(np.float64))[1]
        return np.where((a[:, :2] == b[:, :2]).all(1), (_BITS * DIGITS - bits) // _BITS, 0)

    def rows(held, before):
        """``held`` without its last row, which waits for the next batch; ``before``: the row before it."""
        padded = held if before is None else np.concatenate((before, held))
        shared = matched(padded[:-1], padded[1:])
        left = shared if before is not None else np.concatenate(([0], shared))
        right = np.append(left[1:], 0)
        return np.maximum(left, right)

    held, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)])
        held = new if held is None else np.concatenate((held, new))
        depth, here = rows(held, before)[:-1], held[:-1]
        query = here[:, 4] == 1
        yield pa.RecordBatch.from_arrays([pa.array(here[query, 3]), pa.array(depth[query].astype(np.int32))], ["cid", "depth"])
        before, held = (held[-2:-1] if len(held) > 1 else before), held[-1:]
    if held is not None and held[0, 4] == 1:
        yield pa.RecordBatch.from_arrays(
            [pa.array(held[:, 3]), pa.array(rows(held, before).astype(np.int32))], ["cid", "depth"])


def descend(classes: DataFrame) -> DataFrame:
    """cid, level: where each query begins."""
    trees = classes.select("dim", F.posexplode("codes").alias("tree", "code"), "cid", "query")
    order = ["dim", "tree", "code", "cid"]
    sorted_ = trees.select(*order, "query").repartitionByRange(*order).sortWithinPartitions(*order)
    found = map_arrow(sorted_, _depths, "cid long, depth int").groupBy("cid").agg(F.collect_list("depth").alias("all"))
    return found.select("cid", F.element_at(F.sort_array("all", asc=False), START).alias("level"))


def _work(keep: int):
    def work(table: pa.Table) -> pa.Table:
        marks = np.column_stack([table[c].to_numpy().astype(np.int64) for c in (*_UNIT, "tile", "block", "query", "cid")])
        order = np.lexsort(marks.T[::-1])
        marks = marks[order]
        vectors = table["vec"].combine_chunks().take(pa.array(order))
        low = table["low"].to_numpy()[order]
        starts = np.flatnonzero(np.concatenate(([True], (marks[1:, :6] != marks[:-1, :6]).any(1))))
        out: list[list] = [[], [], [], []]
        for s, e in zip(starts, np.append(starts[1:], len(marks))):
            n = int(np.searchsorted(marks[s:e, 6], 1))  # vectors first, then the queries
            if n == 0 or n == e - s:
                continue
            x = scaled(vectors.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                       .reshape(e - s, marks[s, 0]))
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            unit = x / norm[:, None]
            cosine = unit[n:] @ unit[:n].T
            at = min(keep, n) - 1
            least = np.partition(cosine, n - 1 - at, axis=1)[:, n - 1 - at]
            q, c = np.nonzero(cosine >= least[:, None] - 1e-9)
            exact = np.einsum("ij,ij->i", x[n + q], x[c]) / (norm[n + q] * norm[c])
            by = np.lexsort((marks[s + c, 7], low[s + c], -exact, q))
            q, c, exact = q[by], c[by], exact[by]
            few = np.arange(len(q)) - np.searchsorted(q, q) < keep
            for column, values in zip(out, (marks[s + n + q[few], 7], marks[s + c[few], 7], low[s + c[few]], exact[few])):
                column.append(values)
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table({name: np.concatenate([np.zeros(0, kind), *part])
                         for name, kind, part in zip(("qid", "cid", "low", "score"), kinds, out)})

    return work


def _prefixes(rows: DataFrame, levels) -> DataFrame:
    """A row for each tree and each of the ``levels`` (a column of arrays); level 0 is one unit for all trees."""
    each = rows.withColumn("level", F.explode(levels)).select("*", F.posexplode("codes").alias("tree", "code"))
    each = each.where("level > 0 or tree = 0")
    return each.withColumn("prefix", F.expr(f"shiftright(code, {_BITS} * ({DIGITS} - level))")).drop("codes", "code")


def compare(classes: DataFrame, active: DataFrame, keep: int) -> DataFrame:
    """qid, cid, low, score: of each query's candidates at its level, the ``keep`` nearest of every unit."""
    levels = sorted(r["level"] for r in active.select("level").distinct().collect())  # at most DIGITS + 1
    queries = _prefixes(classes.select("cid", "dim", "codes").join(active.select("cid", F.array("level").alias("at")), "cid"),
                        F.col("at")).select(*_UNIT, "cid")
    index = _prefixes(classes.select("cid", "dim", "codes"), F.array(*(F.lit(x) for x in levels))).select(*_UNIT, "cid")
    wanted = queries.groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("queries"))
    sizes = index.hint("merge").join(wanted, _UNIT).groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("n"), F.first("queries").alias("queries"))
    sizes = stored(sizes.select(*_UNIT, F.ceil(F.col("n") / TILE).alias("tiles"),
                                F.ceil(F.col("queries") / QUERY_TILE).alias("blocks"), "n", "queries"), "forest-units")
    n_units, total = sizes.agg(F.count(F.lit(1)), F.sum(F.col("n") * F.col("blocks") + F.col("queries") * F.col("tiles"))).first()
    counted = F.broadcast(sizes) if n_units <= BROADCAST_UNITS else sizes.hint("merge")

    def spread(rows, own, other, query):
        """Rows of a side: one of its own parts by a hash, every part of the other side."""
        mine = F.pmod(F.xxhash64("cid"), F.col(f"{own}s")).cast("int")
        rest = F.explode(F.sequence(F.lit(0), (F.col(f"{other}s") - 1).cast("int")))
        return rows.join(counted, _UNIT).select(*_UNIT, mine.alias(own), rest.alias(other), F.lit(query).alias("query"), "cid")

    units = spread(index, "tile", "block", 0).unionByName(spread(queries, "block", "tile", 1))
    groups = F.lit(max(1, (total or 0) // _GROUP_ROWS))
    dealt = (units.hint("merge").join(classes.select("cid", "vec", F.element_at("ids", 1).alias("low")), "cid")
             .withColumn("group", F.pmod(F.xxhash64(*_UNIT, "tile", "block"), groups)))
    ship(classes.sparkSession)
    return dealt.groupBy("group").applyInArrow(_work(keep), "qid long, cid long, low long, score double")


def _nearest(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest different classes of each query; a class met in several trees has one score."""
    by = Window.partitionBy("qid").orderBy(F.desc("score"), "low", "cid")
    return found.withColumn("place", F.dense_rank().over(by)).where(F.col("place") <= keep).distinct()


def search(df: DataFrame, query_every: int = 50, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id ``query_every`` divides."""
    keyed = stored(_keyed(df, id_col, vector_col), "forest-keys")
    ids = keyed.select("key", "id").distinct()
    asks = F.pmod("id", F.lit(query_every)) == 0
    few = ids.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("place") <= k + 1)
    classes = (keyed.groupBy("key").agg(F.first("vec").alias("vec"), F.max(asks).alias("query"))
               .join(few.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids")), "key")
               .select(F.monotonically_increasing_id().alias("cid"), "key", "vec", "query", "ids"))
    classes = stored(_hashed(stored(classes, "forest-classes")), "forest-strings")

    limits = level_cosines()
    wanted = F.lit(0)
    for level, cosine in enumerate(limits, 1):
        wanted = F.when(F.col("kth") >= cosine, level).otherwise(wanted)
    active = stored(descend(classes), "forest-active")
    parts: list[DataFrame] = []
    while not active.isEmpty():
        new = compare(classes, active, k + 1)
        parts.append(stored(_nearest(new, k + 1), "forest-found"))
        met = parts[-1]
        for part in parts[:-1]:
            met = met.unionByName(part)
        met = _nearest(met.drop("place"), k + 1).where("cid <> qid")
        kth = met.groupBy("qid").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
        kth = kth.select(F.col("qid").alias("cid"), F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
        up = active.where("level > 0").join(kth, "cid", "left").withColumn("next", wanted)
        active = stored(up.where("next < level").select("cid", F.col("next").alias("level")), "forest-active")

    spark = df.sparkSession
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # The k + 1 nearest rows of each query class are enough: a query leaves out at most itself.
    rows = (_nearest(found.drop("place"), k + 1).join(classes.select("cid", "ids"), "cid")
            .select("qid", "score", F.explode("ids").alias("vec_id")))
    by = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    rows = stored(rows.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k + 1).drop("place"), "forest-rows")
    queries = ids.where(asks).join(classes.select("key", F.col("cid").alias("qid")), "key").select("qid", F.col("id").alias("query_id"))
    by = Window.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id")
    return (queries.join(rows, "qid").where("vec_id <> query_id").withColumn("rank", F.row_number().over(by))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

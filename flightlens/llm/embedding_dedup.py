"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a fast Walsh-Hadamard
transform; a vector's code is the signed axis nearest to its rotation. A table
joins the codes of ``k`` rotations. Every vector is filed under its code in
each table and also probes the next likely codes (its second and third
largest coordinates). Vectors that meet in a bucket, one of them filed there,
are candidates, and candidates are verified by their cosine in double precision.

Equal vectors are one class before anything is hashed, whatever their number. A
class has a number of its own; ids come back in at the end.
Buckets of more than ``TILE`` rows are cut into tiles and every pair of tiles
is a unit of work, so a hot bucket is spread over tasks and loses nothing. A
unit multiplies its vectors as matrices and returns sums and a spanning forest
of its links, at most a few rows per vector, never its pairs. A pair that meets
in several buckets counts only in the first.

Links are between vectors with equal, non-null label, equal dimension and a
cosine of at least the threshold. Defined results: a vector that is null, zero
or empty, or holds a null or non-finite component, or whose label is null,
links with nothing; rows that repeat a vec_id each give a row, and count as
different vectors; a row with a null vec_id gives a row that links with nothing,
whose component is null, and is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import components, map_arrow, ship, slices, stored

THRESHOLD = 0.93
#: Tables up to three rotations a code, and as many more for each further rotation.
TABLES = 10
PROBES = 3
TILE = 2048
SEED = 20_011
#: Rows of a unit group: units of few rows share a Python call.
_GROUP_ROWS = 16_384
#: Vectors wanted in a bucket when the number of rotations per table is chosen.
_BUCKET = 128


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (their length a power of two), scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


def tables_for(k: int) -> int:
    """Tables for codes of ``k`` rotations: longer codes part near vectors more often."""
    return TABLES * max(1, k - 2)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square of a component over- or underflows; exact."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def codes(unit: np.ndarray, k: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers of each row: (rows, tables, probes), the row's own bucket first.

    A probe replaces the code of one rotation by that rotation's next best
    axis; probes are taken in order of what the replacement loses.
    """
    n, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    out = np.empty((n, tables, probes), np.int64)
    depth = min(probes, 2 * width)
    rows = np.arange(n)
    for t in range(tables):
        axes = np.empty((n, k, depth), np.int64)
        lost = np.empty((n, k, depth))
        for r in range(k):
            rng = np.random.default_rng([SEED, width, t, r])
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice((-1.0, 1.0), width))
            signed = np.concatenate((x, -x), axis=1)
            top = np.argsort(-signed, axis=1, kind="stable")[:, :depth]
            axes[:, r] = top
            values = np.take_along_axis(signed, top, 1)
            lost[:, r] = values[:, :1] - values
        base = np.zeros(n, np.int64)
        for r in range(k):
            base = base * (2 * width) + axes[:, r, 0]
        out[:, t, 0] = base
        options = lost[:, :, 1:].reshape(n, -1)
        best = np.argsort(options, axis=1, kind="stable")[:, :probes - 1]
        for p in range(probes - 1):
            r, place = best[:, p] // (depth - 1), best[:, p] % (depth - 1) + 1
            weight = (2 * width) ** (k - 1 - r)
            out[:, t, p + 1] = base + (axes[rows, r, place] - axes[rows, r, 0]) * weight
    return out


def _keyed(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, key (16 bytes of label and vector; null where the vector links with nothing)."""
    def run(batches):
        for batch in slices(batches, 2000):
            keys = []
            ids = batch.column(0).is_valid().to_pylist()
            for known, label, vector in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key = None
                if known and label is not None and vector and None not in vector:
                    x = np.array(vector, np.float64) + 0.0
                    if np.isfinite(x).all() and x.any():
                        key = xxhash.xxh3_128_digest(repr(label).encode() + b"\0" + x.tobytes())
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()),
                 batch.column(1).cast(pa.string())], ["vec_id", "vec", "key", "label"])

    kind = df.schema[vector_col].dataType.simpleString()
    chosen = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vector_col).alias("vec"))
    return map_arrow(chosen, run, f"vec_id long, vec {kind}, key binary, label string")


def _coded(classes: DataFrame, k: int) -> DataFrame:
    """``classes`` with dim and codes: their bucket in each table and for each probe, their own first."""
    tables = tables_for(k)

    def run(batches):
        for batch in slices(batches, 500):
            vectors = [np.array(v, np.float64) for v in batch.column(batch.schema.names.index("vec")).to_pylist()]
            dims = np.array([len(v) for v in vectors])
            found = np.zeros((len(vectors), tables * PROBES), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = scaled(np.stack([vectors[i] for i in at]))
                found[at] = codes(x / np.abs(x).max(1, keepdims=True), k, tables).reshape(len(at), -1)
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * (tables * PROBES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))],
                [*batch.schema.names, "dim", "codes"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return map_arrow(classes, run, f"{fields}, dim int, codes array<long>")


def _counts_here(codes_, ids, a, b, tab, bucket):
    """Which of the pairs (rows ``a``, ``b``) meet in this bucket first.

    Earlier tables are looked at one after the other and only for the pairs
    left, so pairs that meet early cost little in later tables.
    """
    left = np.arange(len(a))
    for t in range(tab):
        x, y = codes_[a[left], t], codes_[b[left], t]
        met = (y == x[:, :1]).any(1) | (x == y[:, :1]).any(1)
        left = left[~met]
        if not len(left):
            return left
    i, j = a[left], b[left]
    # Of the two possible buckets of a table, the one of the smaller id goes first.
    low, high = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
    own, other = codes_[low, tab], codes_[high, tab]
    at_low = (other == own[:, :1]).any(1)
    at_high = (own == other[:, :1]).any(1)
    place = np.where(at_low, own[:, 0], other[:, 0])
    return left[(at_low | at_high) & (place == bucket)]


def unit_links(ids, sizes, unit, all_codes, own, tile, tab, bucket, pair, threshold):
    """Links of one unit: per-vector sums of linked vectors, and a forest of the links.

    ``tile`` says which of the unit's two tiles a row is of; ``pair`` is False
    where the unit is a single tile with itself.
    """
    n = len(ids)
    sums, parent = np.zeros(n, np.int64), np.arange(n)

    def roots(x):
        while True:
            up = parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    left = np.flatnonzero(tile == 0) if pair else np.arange(n)
    right = np.flatnonzero(tile == 1) if pair else np.arange(n)
    for at in range(0, len(left), 512):
        part = left[at:at + 512]
        cosine = unit[part] @ unit[right].T
        i, j = np.nonzero(cosine >= threshold - 1e-9)
        near = cosine[i, j]
        i, j = part[i], right[j]
        keep = (own[i] | own[j]) & (ids[i] != ids[j])
        if not pair:
            keep &= i < j
        i, j, near = i[keep], j[keep], near[keep]
        edge = np.flatnonzero(near < threshold + 1e-9)  # the matrix product's last digits do not decide
        if len(edge):
            short = np.einsum("ij,ij->i", unit[i[edge]], unit[j[edge]]) < threshold
            i, j = np.delete(i, edge[short]), np.delete(j, edge[short])
        for s in range(0, len(i), 1 << 18):
            first = _counts_here(all_codes, ids, i[s:s + (1 << 18)], j[s:s + (1 << 18)], tab, bucket) + s
            a, b = i[first], j[first]
            if not len(a):
                continue
            sums += np.bincount(a, sizes[b], n).astype(np.int64) + np.bincount(b, sizes[a], n).astype(np.int64)
            while len(a):
                ra, rb = roots(a), roots(b)
                cross = ra != rb
                a, b, ra, rb = a[cross], b[cross], ra[cross], rb[cross]
                if len(a):
                    np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
    return sums, roots(np.arange(n))


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = df.sparkSession
    ship(spark)
    keyed = stored(_keyed(df, id_col, vector_col, label_col), "vector-keys")
    classes = stored(keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("size"), F.first("label").alias("label"),
        F.first("vec").alias("vec")).withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).agg(
        F.max("n"), F.max("dim")).first()
    if largest[0] is None:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    axes = 2 << max(1, (largest[1] - 1).bit_length())
    k = max(1, math.ceil(math.log(max(1.0, largest[0] / _BUCKET)) / math.log(axes)))
    tables = tables_for(k)
    classes = stored(_coded(classes, k), "vector-codes")
    buckets = ["label", "dim", "tab", "bucket"]
    # Only numbers are dealt and counted; vectors follow once the units are known.
    filed = stored(classes.select("label", "dim", "id", F.posexplode("codes").alias("at", "bucket")).select(
        "label", "dim", F.expr(f"at div {PROBES}").cast("int").alias("tab"), "bucket",
        (F.col("at") % PROBES == 0).alias("own"), "id"), "vector-buckets")

    # A row of a large bucket goes to every pair that its tile is in; others are a unit with one tile. Single rows meet nothing.
    counts = filed.groupBy(*buckets).agg(F.count(F.lit(1)).alias("n"))
    tiled = stored(counts.where("n > 1").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "bucket-tiles")
    total = tiled.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0
    cut = filed.join(tiled.drop("n"), buckets)
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("tiles").cast("long")).cast("int"))
    units = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    units = units.select(*buckets, F.least("mine", "other").alias("t1"), F.greatest("mine", "other").alias("t2"),
                         "mine", "own", "id")
    groups = max(1, total // _GROUP_ROWS)
    keys = [*buckets, "t1", "t2"]
    dealt = (units.join(classes.select("id", "size", "vec", "codes"), "id")
             .withColumn("group", F.pmod(F.xxhash64(*keys), F.lit(groups))))

    def work(table):
        order = table.sort_by([(c, "ascending") for c in [*keys, "id"]])
        table = order.combine_chunks()
        vectors = table["vec"].combine_chunks()
        marks = [table[c].to_pylist() for c in keys]
        ids, sizes = table["id"].to_numpy(), table["size"].to_numpy()
        own, mine = table["own"].to_numpy(zero_copy_only=False), table["mine"].to_numpy()
        all_codes = table["codes"].combine_chunks().flatten().to_numpy().reshape(-1, tables, PROBES)
        row_keys = list(zip(*marks))
        starts = [i for i in range(len(row_keys)) if i == 0 or row_keys[i] != row_keys[i - 1]] + [len(row_keys)]
        out_id, out_root, out_sum = [], [], []
        for s, e in zip(starts[:-1], starts[1:]):
            if e - s < 2:
                continue
            _, dim, tab, bucket, t1, t2 = row_keys[s]
            x = vectors.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            x = scaled(x)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            sums, root = unit_links(ids[s:e], sizes[s:e], x, all_codes[s:e], own[s:e], (mine[s:e] != t1).astype(int),
                                    tab, bucket, t1 != t2, threshold)
            hit = np.flatnonzero((sums > 0) | (root != np.arange(e - s)))
            out_id.append(ids[s:e][hit])
            out_root.append(ids[s:e][root[hit]])
            out_sum.append(sums[hit])
        if not out_id:
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "root", "links")})
        return pa.table({"id": np.concatenate(out_id), "root": np.concatenate(out_root),
                         "links": np.concatenate(out_sum)})

    found = stored(dealt.groupBy("group").applyInArrow(work, "id long, root long, links long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    tops = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    joined = (classes.select("key", "id", "low", "size").join(links, "id", "left")
              .join(tops.toDF("id", "top"), "id", "left").withColumn("top", F.coalesce("top", "id")))
    smallest = joined.groupBy("top").agg(F.min("low").alias("smallest"))
    named = joined.join(smallest, "top").select(
        "key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "smallest")
    out = keyed.select("vec_id", "key").join(named, "key", "left")
    component = F.coalesce("smallest", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

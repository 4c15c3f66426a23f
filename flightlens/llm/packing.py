"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

Documents are tokenised whole, longer ones cut into pieces of the sequence
length. Pieces are dealt by a hash of their key into blocks of about
``BLOCK_PIECES``. Every block is evolved on ``ISLANDS`` islands: each island
keeps a population of packings, a crossover injects well-filled whole bins of
one parent into the other, removes the bins that hold the same pieces, and
best-fits the displaced pieces, longest first. After an epoch every island's
elites migrate to the next island of the block (through a shuffle), and a last
epoch starts from them. The block's packing with the fewest sequences stays.

Islands of a block work on the same pieces and blocks are independent, so the
work is linear in the number of pieces, no task holds more than a block, and
what a block cannot fill is less than one sequence in thousands.

Defined results: null and empty texts are documents of the end id alone; full
pieces are sequences of their own; repeated rows are packed each; null ids are
kept; an empty table gives no rows; further columns are ignored. Everything is
seeded by block and island, so a lost task repeats with the same result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, ship, slices, stored
from flightlens.llm.library_tokens import ids_bytes

BLOCK_PIECES = 16_384
ISLANDS = 3
POPULATION = 4
GENERATIONS = 8
_PACKING = "block long, island long, fitness double, keys array<long>, lengths array<int>, bins array<int>"


def pieces(df: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece: key (unique), doc_id, piece, start, length, ids_crc32."""
    schema = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 2000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), ids_bytes(texts, tokenizer_path, True, specials=True)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((key, doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    key += 1
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    ["key", "doc_id", "piece", "start", "length", "ids_crc32"])

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(texts, run, schema)


def best_fit(lengths: np.ndarray, bins: np.ndarray, capacity: int, order: np.ndarray | None = None) -> np.ndarray:
    """``bins`` with every piece marked -1 put into the fullest bin that has room, longest first (or in ``order``)."""
    bins = bins.copy()
    loose = np.flatnonzero(bins < 0) if order is None else order
    if order is None:
        loose = loose[np.argsort(-lengths[loose], kind="stable")]
    placed = bins >= 0
    n = int(bins.max(initial=-1)) + 1
    free = (capacity - np.bincount(bins[placed], weights=lengths[placed], minlength=n)).astype(np.int64).tolist()
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r is set where a bin with r free places exists
    for b, r in enumerate(free):
        rooms[r].append(b)
        some |= 1 << r
    target = []
    for size in lengths[loose].tolist():
        fits = some >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = rooms[r].pop()
            if not rooms[r]:
                some ^= 1 << r
            r -= size
        else:
            b, r = n, capacity - size
            n += 1
        rooms[r].append(b)
        some |= 1 << r
        target.append(b)
    bins[loose] = target
    return bins


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then the mean square of how full they are (fuller and emptier beats even)."""
    fill = np.bincount(bins, weights=lengths) / capacity
    return float(-len(fill) + np.mean(fill * fill))


def _renumbered(bins: np.ndarray) -> np.ndarray:
    _, out = np.unique(bins, return_inverse=True)
    return out.astype(np.int32)


def crossover(lengths: np.ndarray, one: np.ndarray, other: np.ndarray, capacity: int,
              rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``other`` injected into ``one``; displaced pieces best-fitted.

    Bins of ``one`` that share a piece with an injected bin are dissolved, and
    so are its emptiest bins, whose pieces get a chance elsewhere.
    """
    fill = np.bincount(other, weights=lengths)
    full = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = rng.choice(full, max(1, len(full) // 5), replace=False)
    injected = np.isin(other, chosen)
    own_fill = np.bincount(one, weights=lengths)
    gone = np.zeros(len(own_fill), bool)
    gone[one[injected]] = True
    gone[np.argsort(own_fill, kind="stable")[:max(1, len(own_fill) // 50)]] = True
    child = np.where(gone[one], -1, one)
    child[injected] = other[injected] + len(own_fill)
    kept = child >= 0
    child[kept] = _renumbered(child[kept])
    return best_fit(lengths, child, capacity)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
           rng: np.random.Generator) -> list[np.ndarray]:
    """Steady-state evolution; returns the population, fittest first.

    Stops early when the number of bins meets its lower bound.
    """
    bound = -(-int(lengths.sum()) // capacity)
    scored = sorted(((fitness(lengths, p, capacity), i, p) for i, p in enumerate(population)), key=lambda x: -x[0])
    serial = len(scored)
    for _ in range(generations):
        if len(scored) < 2 or int(scored[0][2].max()) + 1 <= bound:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        for first, second in ((a, b), (b, a)):
            child = crossover(lengths, scored[first][2], scored[second][2], capacity, rng)
            score = fitness(lengths, child, capacity)
            if score > scored[-1][0] and all(score != s for s, _, _ in scored):
                scored[-1] = (score, serial, child)
                serial += 1
        scored.sort(key=lambda x: -x[0])
    return [p for _, _, p in scored]


def _founders(lengths: np.ndarray, capacity: int, island: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit of the longest first, and best fits of slightly shuffled orders."""
    empty = np.full(len(lengths), -1, np.int32)
    out = []
    for k in range(POPULATION):
        noise = 0 if (k == 0 and island == 0) else 0.02 * (1 + k)
        order = np.argsort(-lengths * (1 + noise * rng.standard_normal(len(lengths))), kind="stable")
        out.append(best_fit(lengths, empty, capacity, order))
    return out


def _rows(block: int, island: int, keys, lengths, packings, capacity: int) -> pa.Table:
    return pa.table({
        "block": pa.array([block] * len(packings), pa.int64()),
        "island": pa.array([island] * len(packings), pa.int64()),
        "fitness": pa.array([fitness(lengths, p, capacity) for p in packings], pa.float64()),
        "keys": pa.array([keys] * len(packings), pa.list_(pa.int64())),
        "lengths": pa.array([lengths.astype(np.int32)] * len(packings), pa.list_(pa.int32())),
        "bins": pa.array([p.astype(np.int32) for p in packings], pa.list_(pa.int32())),
    })


def pack(items: DataFrame, capacity: int, name: str = "packing") -> DataFrame:
    """``key`` and ``length`` (1 to ``capacity``) of pieces -> key, sequence_id, offset."""
    spark = items.sparkSession
    ship(spark)
    small = items.where(F.col("length") < capacity).select("key", F.col("length").cast("int").alias("length"))
    blocks = max(1, -(-small.count() // BLOCK_PIECES))
    dealt = small.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    dealt = dealt.withColumn("island", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ISLANDS - 1).cast("long"))))

    def first(key, table):
        block, island = (k.as_py() for k in key)
        keys = table["key"].to_numpy()
        lengths = table["length"].to_numpy().astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, lengths = keys[order], lengths[order]
        rng = np.random.default_rng([block, island, 0])
        found = evolve(lengths, _founders(lengths, capacity, island, rng), capacity, GENERATIONS, rng)
        return _rows(block, island, keys, lengths, found[:2], capacity)

    def second(key, table):
        block, island = (k.as_py() for k in key)
        rng = np.random.default_rng([block, island, 1])
        table = table.sort_by([("fitness", "descending"), ("home", "ascending")])
        keys = table["keys"][0].values.to_numpy()
        lengths = table["lengths"][0].values.to_numpy().astype(np.int64)
        found = [table["bins"][i].values.to_numpy() for i in range(table.num_rows)]
        return _rows(block, island, keys, lengths, evolve(lengths, found, capacity, GENERATIONS, rng)[:1], capacity)

    elites = stored(dealt.groupBy("block", "island").applyInArrow(first, _PACKING), f"{name}-elites")
    # Ring migration: elites stay at home and move to the next island.
    moved = elites.withColumn("home", F.col("island")).withColumn(
        "island", F.explode(F.array("island", (F.col("island") + 1) % ISLANDS)))
    final = stored(moved.groupBy("block", "island").applyInArrow(second, _PACKING), f"{name}-final")
    order = Window.partitionBy("block").orderBy(F.desc("fitness"), "island")
    best = (final.select("block", "island", "fitness").withColumn("place", F.row_number().over(order))
            .where("place = 1").select("block", "island"))
    chosen = final.join(best, ["block", "island"]).select("block", "keys", "lengths", "bins")

    def spread(batches):
        for batch in slices(batches, 1):
            block = batch.column(0)[0].as_py()
            keys, lengths, bins = (batch.column(i)[0].values.to_numpy() for i in (1, 2, 3))
            order = np.argsort(bins, kind="stable")
            sizes, owner = lengths[order].astype(np.int64), bins[order].astype(np.int64)
            ends = np.cumsum(sizes)
            first_of = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            base = np.repeat((ends - sizes)[first_of], np.diff(np.append(first_of, len(owner))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[order]), pa.array((block << 32) + owner), pa.array(ends - sizes - base)],
                ["key", "sequence_id", "offset"])

    placed = map_arrow(chosen, spread, "key long, sequence_id long, offset long")
    whole = items.where(F.col("length") == capacity).select(
        "key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.union(whole)


def pack_documents(df: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    found = stored(pieces(df, tokenizer_path, end_id, capacity, id_col, text_col), "packing-pieces")
    return (found.join(pack(found.select("key", "length"), capacity), "key")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))

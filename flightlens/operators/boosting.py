"""Boosted regression trees over category values and numbers, one Spark job a tree level (M4-M6).

The trees are those of Spark's ``GBTRegressor`` on one-hot categories: a split
is "is this one category" or "is at most this number", chosen by the largest
reduction of variance; squared loss, step 0.1, the first tree at full weight.
Spark's learner keeps one number for each one-hot slot of each row, which is
the number of airports. Here a level is sums by (node, column, value):

* Rows are written once and held as blocks of arrays. Of frequent categories
  (more than 1 in ``FREQUENT`` rows, so fewer than that many a column) and of
  numbers a row has a small code each, several columns in one
  (``_grouped``), so a pass adds up few and short arrays. A rarer category is
  a key of 64 bits; that no two of a column share one is checked.
  Sums of numbers and frequent categories are made in every block
  and added up on the driver in block order: a few hundred sums a node,
  whatever the number of rows and airports.
* Rows of rarer categories are held again, sorted by that category, so a block
  has all rows of its categories and answers with the best of them for each
  node. No category's rows, and no list of categories, are in one place, and
  none is joined or broadcast.

All labels are fitted side by side: a level of all of them is one job, which
reads the codes once. A block holds what each label has left to fit; the trees since
``SETTLED_ROUNDS`` are taken off when it is read.

The driver holds the trees, with the categories that they split on.

Bins follow Spark's rule, over the values of all rows (Spark draws some ten
thousand). The number columns are whole minutes, hours, days and months.
Equal gains go to the first column, the more frequent category (then the
lesser value), the lesser number.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, released_shuffles, ship, stored

# Spark's step of every tree but the first.
STEP = 0.1
# A category is frequent when more than one of this many rows has it.
FREQUENT = 256
# Rows of a task, and fewest before tasks are made only to use more cores. Rows of a block, of which a task holds one at
# a time; more where a category has more.
BLOCK_ROWS, SMALL_BLOCK_ROWS, CHUNK_ROWS = 1_000_000, 4_000, 62_500
# Codes of the columns that are coded together.
GROUP_CODES = 1024
# Rounds after which the predictions so far are taken off the labels in the blocks.
SETTLED_ROUNDS = 3
# Times that a fit makes its blocks again before a failed pass fails the fit.
RETRIES = 2
# Gains of later trees that differ by less than this share of the node's mean square are equal: their sums are
# rounded. The first tree's labels are whole minutes, whose sums are exact.
SLACK = 1e-12
# Spark's limit below which a node counts as pure.
_PURE = 2.2e-16

_NODES = ("tree int, position long, column_no int, value string, threshold double, gain double, prediction double, "
          "rows long, weight double")


class Node(NamedTuple):
    """A node of a tree. Inner nodes have a column and a category (equal goes right) or a cut (greater goes right)."""
    column: int | None
    value: str | int | None
    cut: float | None
    gain: float | None
    prediction: float
    rows: int


#: A tree: nodes by position; the children of k are 2k + 1 and 2k + 2.
Tree = dict[int, Node]


def _places(splits: dict[int, tuple], side: Callable[[tuple], np.ndarray], n: int) -> np.ndarray:
    """The position of each row's leaf; ``side`` tells which rows a split sends right."""
    kind = np.uint8 if max(splits, default=0) < 127 else np.int64
    at = np.zeros(n, kind)
    for k in sorted(splits):
        inside = at == k
        at += inside.view(np.uint8) * kind(k + 1)
        at += (inside & side(splits[k])).view(np.uint8)
    return at


@dataclass
class GBTRegressionModel:
    """Trees and their weights over ``categories`` followed by ``numbers``."""
    trees: list[Tree]
    weights: list[float]

    def prediction(self, categories: list[str], numbers: list[str]) -> Column:
        """The predicted label of a row, by its category and number columns. A category not split on is just another."""
        ship(SparkSession.active())
        known: list[dict] = [{} for _ in categories]
        trees = []
        for weight, tree in zip(self.weights, self.trees):
            splits, outputs = {}, np.zeros(max(tree) + 1)
            for k, node in tree.items():
                outputs[k] = node.prediction
                if node.column is not None:
                    codes = known[node.column] if node.cut is None else None
                    splits[k] = (node.column, node.cut if codes is None else codes.setdefault(node.value, len(codes)))
            trees.append((weight, splits, outputs))

        @F.pandas_udf("double")
        def predict(*given: pd.Series) -> pd.Series:
            n = len(given[0])
            columns = [s.map(codes).fillna(-1).to_numpy(np.int16 if len(codes) < 2 ** 15 else np.int64) if codes else None
                       for s, codes in zip(given, known)]
            columns += [s.to_numpy(np.float64) for s in given[len(known):]]
            sides: dict[tuple, np.ndarray] = {}

            def side(split):
                if split not in sides:
                    column, at = split
                    sides[split] = columns[column] == at if column < len(known) else columns[column] > at
                return sides[split]

            total = np.zeros(n)
            for weight, splits, outputs in trees:
                total += weight * outputs[_places(splits, side, n)]
            return pd.Series(total)

        return predict(*[F.col(c).cast("string") for c in categories], *[F.col(c).cast("double") for c in numbers])

    def node_rows(self) -> list[tuple]:
        return [(t, k, node.column, node.value, node.cut, node.gain, node.prediction, node.rows, weight)
                for t, (tree, weight) in enumerate(zip(self.trees, self.weights)) for k, node in sorted(tree.items())]

    def write(self):
        """A writer of the model's nodes, one row each."""
        return SparkSession.active().createDataFrame(self.node_rows(), _NODES).coalesce(1).write

    @classmethod
    def load(cls, path: str) -> GBTRegressionModel:
        trees, weights = {}, {}
        for r in SparkSession.active().read.schema(_NODES).parquet(path).collect():
            trees.setdefault(r.tree, {})[r.position] = Node(r.column_no, r.value, r.threshold, r.gain, r.prediction, r.rows)
            weights[r.tree] = r.weight
        return cls([trees[t] for t in sorted(trees)], [weights[t] for t in sorted(trees)])


# --- training rows ----------------------------------------------------------------

def cuts(counts: list[tuple[float, int]], rows: int, max_bins: int) -> list[float]:
    """Spark's candidate thresholds of a number column by the counts of its sorted values."""
    most = min(max_bins, rows) - 1
    middle = [(a[0] + b[0]) / 2 for a, b in zip(counts, counts[1:])]
    if len(middle) <= most:
        return middle
    stride = rows / (most + 1)
    out, seen, target = [], counts[0][1], stride
    for (_, n), between in zip(counts[1:], middle):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            out.append(between)
            target += stride
    return out


@dataclass(frozen=True)
class _Layout:
    """How the columns of the training rows are held: v0, v1, ... the categories, x0, ... the numbers, y0, ... the labels."""
    #: The frequent categories of each column.
    frequent: list[list[str]]
    cuts: list[list[float]]
    n_labels: int
    #: Columns with rarer categories, whose rows are held again.
    rare: list[int]
    #: Columns that are coded together; categories that are not frequent have the code after the last.
    groups: list[list[int]]

    def width(self, column: int) -> int:
        n_cats = len(self.frequent)
        return len(self.frequent[column]) + 1 if column < n_cats else len(self.cuts[column - n_cats]) + 1

    def widths(self, group: int) -> list[int]:
        return [self.width(c) for c in self.groups[group]]

    def fields(self) -> list[tuple[str, str]]:
        binary = [*(f"g{i}" for i in range(len(self.groups))), *(f"c{c}" for g in self.groups for c in g),
                  *(f"h{c}" for c in self.rare), "names", "keys", "runs", "counts",
                  *(f"y{i}" for i in range(self.n_labels)), "answer"]
        return [("part", "int"), ("block", "long"), ("n", "long"), ("own", "long"), ("clash", "int"),
                *((c, "binary") for c in binary), ("named", "array<string>")]


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def _ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


def _arrow(fields: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])


def _grouped(widths: dict[int, int]) -> list[list[int]]:
    """Columns dealt to groups whose codes are ``GROUP_CODES`` at most, if a column alone has not more."""
    groups: list[list[int]] = []
    for c in sorted(widths, key=lambda c: (-widths[c], c)):
        fits = (g for g in groups if math.prod(widths[x] for x in g) * widths[c] <= GROUP_CODES)
        group = next(fits, None)
        if group is None:
            groups.append([c])
        else:
            group.append(c)
    return groups


@dataclass
class Blocks:
    """Training rows as blocks of arrays, and what the driver knows of them."""
    frame: DataFrame
    layout: _Layout
    frequent: list[list[tuple[str, int]]]
    labels: list[str]
    #: Categories of each column.
    sizes: list[int]
    rows: DataFrame
    make: Callable[[], DataFrame]

    def again(self) -> None:
        """Make the blocks again, after some were lost."""
        _release(self.frame)
        self.frame = self.make()

    def done(self) -> None:
        _release(self.frame)
        discard(self.rows)


def _release(frame: DataFrame) -> None:
    """Give up a frame that ``localCheckpoint`` holds."""
    frame._jdf.queryExecution().logical().rdd().unpersist(False)


def _packed(names: pa.Array) -> bytes:
    out = pa.BufferOutputStream()
    batch = pa.record_batch([names], ["name"])
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _names(packed) -> pa.Array:
    return pa.ipc.open_stream(packed).read_next_batch().column(0)


def _starts(values: pa.ChunkedArray) -> np.ndarray:
    """Where the runs of equal values begin."""
    flat = values.combine_chunks()
    changed = pc.not_equal(flat.slice(1), flat.slice(0, max(0, len(flat) - 1)))
    return np.concatenate(([0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1))


def _chunks(batches, column: str | None, rows: int):
    """Tables of about ``rows`` rows each; no run of equal values of ``column`` is cut."""
    held, n = [], 0
    for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        end = n if column is None else int(_starts(table.column(column))[-1])
        if end:
            yield table.slice(0, end)
            held, n = table.slice(end).to_batches(), n - end
    if n:
        yield pa.Table.from_batches(held)


def _block(table: pa.Table, layout: _Layout, copy: int, number: int, clash: int) -> pa.RecordBatch:
    """Rows as a block: those that lack a number are counted in their categories and left out."""
    n_cats = len(layout.frequent)
    fit = table.column("fit").to_numpy()
    row: dict = {name: b"" if kind == "binary" else 0 for name, kind in layout.fields()}
    row |= dict(part=copy, block=number, n=int(fit.sum()), clash=clash, named=[])

    def code(column: int) -> np.ndarray:
        if column >= n_cats:
            x = table.column(f"x{column - n_cats}").to_numpy()[fit]
            return np.searchsorted(np.array(layout.cuts[column - n_cats]), x)
        known = pa.array(layout.frequent[column], pa.string())
        return pc.fill_null(pc.index_in(table.column(f"v{column}"), known), len(known)).to_numpy().astype(np.int64)[fit]

    for i, group in enumerate(layout.groups):
        codes = np.zeros(row["n"], np.int64)
        for c in group:
            one = code(c)
            codes = codes * layout.width(c) + one
            row[f"c{c}"] = one.astype(_code_type(layout.width(c))).tobytes()
        if copy < 0:
            row[f"g{i}"] = codes.astype(_code_type(math.prod(layout.widths(i)))).tobytes()
    for c in layout.rare:
        if c != copy:
            row[f"h{c}"] = table.column(f"h{c}").to_numpy()[fit].tobytes()
    if copy >= 0:
        starts = _starts(table.column(f"v{copy}"))
        counts = np.diff(np.append(starts, len(fit)))
        row |= dict(own=len(starts), names=_packed(table.column(f"v{copy}").combine_chunks().take(pa.array(starts))),
                    keys=table.column(f"h{copy}").to_numpy()[starts].tobytes(), counts=counts.astype(np.int64).tobytes(),
                    runs=np.add.reduceat(fit.astype(np.int64), starts).tobytes())
    for i in range(layout.n_labels):
        row[f"y{i}"] = table.column(f"y{i}").to_numpy()[fit].tobytes()
    return pa.RecordBatch.from_pylist([row], _arrow(layout.fields()))


def _code_type(codes: int):
    return np.uint8 if codes <= 2 ** 8 else np.uint16 if codes <= 2 ** 16 else np.uint32


def _blocks_of(layout: _Layout, copy: int):
    """The blocks of a partition, which is sorted by the category where ``copy`` is a column of categories."""
    rows = min(CHUNK_ROWS, BLOCK_ROWS)

    def make(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), set()
        for i, table in enumerate(_chunks(batches, None if copy < 0 else f"v{copy}", rows)):
            clash = 0
            if copy >= 0:
                keys = table.column(f"h{copy}").to_numpy()[_starts(table.column(f"v{copy}"))].tolist()
                clash = int(len(set(keys)) < len(keys) or not seen.isdisjoint(keys))
                seen.update(keys)
            yield _block(table, layout, copy, (task << 24) + i, clash)
    return make


def _counted(rows: DataFrame, n_cats: int, n_nums: int, whole: int, total: int, max_bins: int):
    """The frequent categories of each column with their rows (most first, then by value), and the cuts of each number column."""
    none = F.lit(None)
    counted = [rows.where(F.col(f"v{c}").isNotNull()).groupBy(f"v{c}").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") * FREQUENT > whole).select(F.lit(c).alias("no"), F.col(f"v{c}").alias("value"), none.cast("double").alias("x"), "n")
               for c in range(n_cats)]
    counted += [rows.where("fit").groupBy(f"x{i}").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(i).alias("no"), none.cast("string").alias("value"), F.col(f"x{i}").alias("x"), "n") for i in range(n_nums)]
    with released_shuffles(rows.sparkSession):
        found = reduce(DataFrame.unionAll, counted).collect()
    frequent = [sorted(((r.value, r.n) for r in found if r.value is not None and r.no == c), key=lambda v: (-v[1], v[0]))
                for c in range(n_cats)]
    at = [cuts(sorted((r.x, r.n) for r in found if r.value is None and r.no == i), total, max_bins) for i in range(n_nums)]
    return frequent, at


def make_blocks(training: DataFrame, categories: list[str], numbers: list[str], labels: list[str],
                max_bins: int) -> Blocks:
    """The training rows as blocks held on the executors; rows with a null number are left out, null categories are none of them."""
    spark = training.sparkSession
    ship(spark)
    n_cats, n_nums = len(categories), len(numbers)
    fit = F.lit(True)
    for c in numbers:
        fit = fit & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))

    def label(c):
        y = F.col(c).cast("double")
        bad = y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))
        return F.when(fit & bad, F.raise_error(F.lit(f"{c} must be a number in every training row"))).otherwise(y)

    rows = stored(training.select(*[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(categories)],
                                  *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numbers)],
                                  *[label(c).alias(f"y{i}") for i, c in enumerate(labels)],
                                  F.coalesce(fit, F.lit(False)).alias("fit")), "training-rows")
    whole, total, *some = rows.agg(F.count(F.lit(1)), F.count_if("fit"), *[F.count(f"v{i}") for i in range(n_cats)]).first()
    if total == 0:
        raise ValueError("there are no rows to train on")
    frequent, at = _counted(rows, n_cats, n_nums, whole, total, max_bins)
    rare = {i: n - sum(k for _, k in f) for i, (n, f) in enumerate(zip(some, frequent)) if n > sum(k for _, k in f)}
    widths = {i: len(f) + 1 for i, f in enumerate(frequent) if f} | {n_cats + i: len(c) + 1 for i, c in enumerate(at)}
    layout = _Layout([[v for v, _ in f] for f in frequent], at, len(labels), list(rare), _grouped(widths))

    def parts(n):
        cores = spark.sparkContext.defaultParallelism
        return max(1, math.ceil(n / BLOCK_ROWS), min(cores, math.ceil(n / SMALL_BLOCK_ROWS)))

    coded = [*(f"v{i}" for i, f in enumerate(frequent) if f), *(f"x{i}" for i in range(n_nums)),
             *(f"y{i}" for i in range(len(labels))), "fit"]

    def made(seed: int) -> DataFrame:
        """The blocks; a row's place in them depends on the rows alone. A key of 0 is no rare category."""
        def key(i):
            named = F.when(F.col(f"v{i}").isNull() | F.col(f"v{i}").isin(layout.frequent[i]), 0)
            return named.otherwise(F.coalesce(F.nullif(F.xxhash64(F.lit(seed), f"v{i}"), F.lit(0)), F.lit(1))).alias(f"h{i}")

        keyed = rows.select(*rows.columns, *[key(i) for i in layout.rare], F.xxhash64(*rows.columns).alias("mark"))
        kept = [*coded, *(f"h{i}" for i in layout.rare)]
        frame = (keyed.select(*kept, "mark").repartition(parts(whole)).sortWithinPartitions("mark").select(*kept)
                 .mapInArrow(_blocks_of(layout, -1), _ddl(layout.fields())))
        for i, n in rare.items():
            own = (keyed.where(F.col(f"h{i}") != 0).select(*dict.fromkeys([*kept, f"v{i}"]), "mark")
                   .repartition(parts(n), f"h{i}").sortWithinPartitions(f"v{i}", "mark").drop("mark"))
            frame = frame.union(own.mapInArrow(_blocks_of(layout, i), _ddl(layout.fields())))
        with released_shuffles(spark):  # held without them: blocks that are lost are made again
            return frame.localCheckpoint(True, StorageLevel.MEMORY_AND_DISK)

    seed, clash = 0, True
    while clash:  # two names with one key of 64 bits: with another seed they part
        frame = made(seed)
        facts = frame.groupBy("part").agg(F.sum("own"), F.max("clash")).collect()
        clash = any(r[2] for r in facts)
        if clash:
            _release(frame)
            seed += 1
    own = {r[0]: r[1] for r in facts}
    return Blocks(frame, layout, frequent, labels, [len(f) + own.get(i, 0) for i, f in enumerate(frequent)], rows,
                  lambda: made(seed))


# --- one tree ---------------------------------------------------------------------

class Sums(NamedTuple):
    """Rows, sum and sum of squares of the labels of a node or of one side of a split (numbers or arrays)."""
    n: float
    s: float
    q: float

    def less(self, other: Sums) -> Sums:
        return Sums(self.n - other.n, self.s - other.s, self.q - other.q)

    def impurity(self):
        return (self.q - self.s * self.s / self.n) / self.n


def gains(whole: Sums, left: Sums, right: Sums, by_mean: bool = False) -> np.ndarray:
    """Reduction of variance of each split; minus infinity where a side is empty.

    ``by_mean``: the side of the lesser mean is subtracted first, as Spark does for categories; it is a matter of rounding.
    """
    ok = (left.n >= 1) & (right.n >= 1)
    l, r = (Sums(np.where(ok, x.n, 1.0), x.s, x.q) for x in (left, right))
    if by_mean:
        turned = r.s / r.n < l.s / l.n
        l, r = (Sums(*(np.where(turned, b, a) for a, b in zip(x, y))) for x, y in ((l, r), (r, l)))
    gain = whole.impurity() - l.n / whole.n * l.impurity() - r.n / whole.n * r.impurity()
    return np.where(ok, gain, -np.inf)


def _rough_gains(whole: Sums, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """``gains`` but for rounding, by the rows and sums of the right sides; zero where there are none."""
    rest, left = whole.s - s, np.maximum(whole.n - n, 1.0)
    return (s * s / np.maximum(n, 1.0) + rest * rest / left - whole.s * whole.s / whole.n) / whole.n


def _slack(whole: Sums, exact: bool) -> float:
    return 0.0 if exact else SLACK * whole.q / whole.n


def _first_best(gain: np.ndarray, slack: float) -> int:
    """The first place whose gain is the largest, or as good."""
    return int(np.argmax(gain >= gain.max() - slack))


@dataclass(frozen=True)
class _Ask:
    """What a pass is to find for a label: the best splits of the ``frontier`` of a tree with ``splits``.

    A split is (column, code, key): rows of that category's code or, for a rarer category, of its key, or of a greater
    code of a number, go right. ``behind``: trees that are to be taken off the label first, as splits, what each position takes off,
    and whether the label is doubled before.
    """
    target: int
    behind: list[tuple[dict[int, tuple], np.ndarray, bool]]
    splits: dict[int, tuple]
    frontier: list[int]
    wholes: list[Sums]
    first: bool

    def columns(self) -> set[str]:
        """The columns of codes and of keys that its splits read."""
        return {f"c{s[0]}" if s[2] is None else f"h{s[0]}"
                for splits in (self.splits, *(b[0] for b in self.behind)) for s in splits.values()}


class _Chunk:
    """A block's arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int, layout: _Layout):
        self.batch, self.i, self.layout = batch, i, layout
        self.part, self.block, self.n = (batch.column(c)[i].as_py() for c in ("part", "block", "n"))
        self.sides: dict[tuple, np.ndarray] = {}

    def raw(self, name: str):
        return self.batch.column(name)[self.i].as_buffer()

    def array(self, name: str, dtype) -> np.ndarray:
        raw = self.raw(name)
        return np.frombuffer(raw, dtype) if raw.size else np.zeros(0, dtype)

    def group(self, i: int) -> np.ndarray:
        return self.array(f"g{i}", _code_type(math.prod(self.layout.widths(i))))

    def code(self, column: int) -> np.ndarray:
        return self.array(f"c{column}", _code_type(self.layout.width(column)))

    def side(self, split: tuple) -> np.ndarray:
        if split not in self.sides:
            column, code, key = split
            if key is None:
                self.sides[split] = self.code(column) == code if column < len(self.layout.frequent) else self.code(column) > code
            elif column == self.part:
                self.sides[split] = np.repeat(self.array("keys", np.int64) == key, self.array("runs", np.int64))
            else:
                self.sides[split] = self.array(f"h{column}", np.int64) == key
        return self.sides[split]

    def left_to_fit(self, ask: _Ask) -> np.ndarray:
        r = self.array(f"y{ask.target}", np.float64)
        for splits, off, doubled in ask.behind:
            r = (2.0 * r if doubled else r) - off[_places(splits, self.side, self.n)]
        return r

    def answer(self, ask: _Ask, r: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Of all rows the sums by node and code, each column's in turn; of a column's rarer categories the best for each node."""
        nodes, layout = len(ask.frontier), self.layout
        at, base, slots, ends = None, 0, 1, [0]
        if ask.splits:  # the frontier is of one depth; rows in leaves above it are added up after its last place
            at = _places(ask.splits, self.side, self.n)
            base = (1 << (ask.frontier[0] + 1).bit_length() - 1) - 1
            slots, ends = base + 2, [k - base for k in ask.frontier]
            at = np.minimum(at - at.dtype.type(base), at.dtype.type(slots - 1)) if at.dtype == np.uint8 else np.where(at < base, slots - 1, at - base)
        r2 = r * r

        def tables(key: np.ndarray, width: int) -> np.ndarray:
            """(3, width): rows, sums and sums of squares by code."""
            key = key.astype(np.intp)
            return np.stack([np.bincount(key, minlength=width).astype(np.float64), np.bincount(key, r, width),
                             np.bincount(key, r2, width)])

        if self.part < 0:
            by_column: dict[int, np.ndarray] = {}
            for i, group in enumerate(layout.groups):
                widths = layout.widths(i)
                codes = math.prod(widths)
                kind = _code_type(slots * codes)
                key = self.group(i) if at is None else at.astype(kind) * kind(codes) + self.group(i)
                sums = tables(key, slots * codes).reshape(3, slots, codes)[:, ends].reshape(3, nodes, *widths)
                for j, c in enumerate(group):
                    one = sums.sum(axis=tuple(2 + k for k in range(len(group)) if k != j))
                    by_column[c] = (one[:, :, :-1] if c < len(layout.frequent) else one).ravel()
            return np.concatenate([by_column[c] for c in sorted(by_column)]), []
        runs, counts = self.array("runs", np.int64), self.array("counts", np.int64)
        key = np.repeat(np.arange(0, slots * len(runs), slots), runs)
        sums = tables(key if at is None else key + at, slots * len(runs)).reshape(3, len(runs), slots)[:, :, ends]
        best, found = np.zeros((nodes, 5)), []
        rough = _rough_gains(Sums(*(np.array(x, np.float64) for x in zip(*ask.wholes))), sums[0], sums[1])
        near = rough >= rough.max(axis=0) - [1e-9 * whole.q / whole.n for whole in ask.wholes]
        for k, whole in enumerate(ask.wholes):
            few = np.flatnonzero(near[:, k])
            right = Sums(*sums[:, few, k])
            gain = gains(whole, whole.less(right), right, by_mean=True)
            as_good = np.flatnonzero(gain >= gain.max() - _slack(whole, ask.first))
            j = as_good[np.argmax(counts[few[as_good]])]
            i = int(few[j])
            best[k] = gain[j], counts[i], *sums[:, i, k]
            found.append(i)
        names = _names(self.raw("names"))
        return (np.concatenate([best.ravel(), self.array("keys", np.int64)[found].view(np.float64)]),
                [names[i].as_py() for i in found])


_ANSWER = [("part", "int"), ("block", "long"), ("target", "int"), ("answer", "binary"), ("named", "array<string>")]


def _passed(layout: _Layout, asks: list[_Ask]):
    """A pass over a task's blocks; the sums of all of them are added up where that is what they answer."""
    def run(batches):
        added: dict[int, np.ndarray] = {}
        first = 0

        def row(block, target, sums, named, part=-1):
            return pa.RecordBatch.from_pylist([dict(part=part, block=block, target=target, answer=sums.tobytes(), named=named)], _arrow(_ANSWER))

        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch, i, layout)
                for ask in asks:
                    sums, named = chunk.answer(ask, chunk.left_to_fit(ask))
                    if chunk.part >= 0:
                        yield row(chunk.block, ask.target, sums, named, chunk.part)
                    elif ask.target in added:
                        added[ask.target] += sums
                    else:
                        added[ask.target], first = sums, chunk.block
        for target, sums in added.items():
            yield row(first, target, sums, [])
    return run


def _settled(layout: _Layout, asks: list[_Ask]):
    """The blocks with the trees behind taken off, and each block's answer for the root of the next tree of every label."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, new, sums, named = _Chunk(batch, i, layout), {}, [], []
                for ask in asks:
                    r = chunk.left_to_fit(ask)
                    new[f"y{ask.target}"] = r.tobytes()
                    found, names = chunk.answer(ask, r)
                    sums.append(found)
                    named += names
                new["answer"], new["named"] = np.concatenate(sums).tobytes(), named
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new[f.name]], f.type) if f.name in new else batch.column(f.name).slice(i, 1) for f in batch.schema],
                    schema=batch.schema)
    return run


@dataclass
class _Growing:
    """The trees of a label so far, and the tree that grows: its nodes, splits, and the sums of its open ends."""
    target: int
    whole: Sums
    trees: list[Tree]
    #: Of each tree what it takes off the label, and of those that the blocks do not know yet.
    steps: list[tuple[dict[int, tuple], np.ndarray, bool]]
    behind: list[tuple[dict[int, tuple], np.ndarray, bool]]
    tree: Tree
    splits: dict[int, tuple]
    ends: dict[int, Sums]
    frontier: list[int]

    def plant(self) -> None:
        self.tree, self.splits, self.ends, self.frontier = {0: _leaf(self.whole)}, {}, {0: self.whole}, [0]

    def ask(self) -> _Ask:
        return _Ask(self.target, self.behind, self.splits, self.frontier, [self.ends[k] for k in self.frontier], not self.trees)

    def grow(self, found: list[tuple | None], blocks: Blocks) -> None:
        """Split the frontier; the children that are not pure are the next one."""
        after = []
        for k, split in zip(self.frontier, found):
            if split is None:
                continue
            gain, column, _, at, left, right, key = split
            named = column < len(blocks.frequent)
            code = at if not named or key is not None else blocks.layout.frequent[column].index(at)
            self.splits[k] = (column, -1 if key is not None else int(code), key)
            cut = None if named else blocks.layout.cuts[column - len(blocks.frequent)][int(at)]
            self.tree[k] = self.tree[k]._replace(column=column, value=at if named else None, cut=cut, gain=float(gain))
            del self.ends[k]
            for child, x in ((2 * k + 1, left), (2 * k + 2, right)):
                self.tree[child], self.ends[child] = _leaf(x), x
                if abs(x.impurity()) >= _PURE:
                    after.append(child)
        self.frontier = after

    def fell(self) -> None:
        """The tree is done: what the label has left is each leaf's less what it now predicts, twice the label's distance."""
        first = not self.trees
        weight = 1.0 if first else STEP
        scale = 2.0 if first else 1.0
        parts = [Sums(x.n, scale * x.s, scale * scale * x.q) for x in self.ends.values()]
        moves = [2.0 * weight * x.s / x.n for x in self.ends.values()]
        self.whole = Sums(sum(x.n for x in parts), sum(x.s - x.n * d for x, d in zip(parts, moves)),
                          sum(x.q - 2 * d * x.s + x.n * d * d for x, d in zip(parts, moves)))
        off = np.zeros(max(self.tree) + 1)
        for k, node in self.tree.items():
            off[k] = 2.0 * weight * node.prediction
        self.steps.append((self.splits, off, first))
        self.behind = [*self.behind, self.steps[-1]]
        self.trees.append(self.tree)


def _leaf(x: Sums) -> Node:
    return Node(None, None, None, None, x.s / x.n, int(x.n))


class _Fit:
    """Boosting of all labels of ``Blocks``, side by side."""

    def __init__(self, blocks: Blocks, max_iter: int, max_depth: int):
        self.blocks, self.layout, self.max_iter, self.max_depth = blocks, blocks.layout, max_iter, max_depth
        self.frame, self.failed = blocks.frame, 0

    def _columns(self, asks: list[_Ask]) -> list[str]:
        read = {"part", "block", "n", "names", "keys", "runs", "counts"} | {f"g{i}" for i in range(len(self.layout.groups))}
        read = read.union(*(ask.columns() for ask in asks), (f"y{ask.target}" for ask in asks))
        return [c for c in self.frame.columns if c in read]

    def _wholes(self) -> list[Sums]:
        """The sums of each label over all rows, in block order."""
        n = self.layout.n_labels

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.column("block")[i].as_py()
                    for t in range(n):
                        y = np.frombuffer(batch.column(f"y{t}")[i].as_py(), np.float64)
                        yield pa.RecordBatch.from_pylist([dict(part=-1, block=block, target=t, named=[], answer=np.array(
                            [len(y), y.sum(), (y * y).sum()]).tobytes())], _arrow(_ANSWER))

        rows = self.frame.where("part < 0").select("block", *(f"y{t}" for t in range(n))).mapInArrow(run, _ddl(_ANSWER)).collect()
        rows.sort(key=lambda r: r.block)
        return [Sums(*sum(np.frombuffer(r.answer) for r in rows if r.target == t).tolist()) for t in range(n)]

    def _asked(self, asks: list[_Ask]) -> dict[int, list]:
        """The answers to each ask, by part and block."""
        frame = self.frame.select(*self._columns(asks)).mapInArrow(_passed(self.layout, asks), _ddl(_ANSWER))
        rows = sorted(frame.collect(), key=lambda r: (r.part, r.block))
        return {ask.target: [(r.part, np.frombuffer(r.answer), r.named) for r in rows if r.target == ask.target] for ask in asks}

    def _hold(self, frame: DataFrame) -> DataFrame:
        """``frame`` as the blocks from now on. It is kept on the executors, without the plans of all the trees before it."""
        before, self.frame = self.frame, frame.localCheckpoint(False, StorageLevel.MEMORY_AND_DISK)
        return before

    def _release(self, frame: DataFrame) -> None:
        if frame is not self.blocks.frame:
            _release(frame)

    def _settle(self, asks: list[_Ask]) -> dict[int, list]:
        """``_asked`` for the roots of the next trees, in the pass that takes the trees so far off the labels in the blocks."""
        before = self._hold(self.frame.mapInArrow(_settled(self.layout, asks), self.frame.schema))
        rows = sorted(self.frame.select("part", "block", "answer", "named").collect(), key=lambda r: (r.part, r.block))
        self._release(before)
        out: dict[int, list] = {ask.target: [] for ask in asks}
        for r in rows:
            answers = np.split(np.frombuffer(r.answer), len(asks))  # a root each, so of one length
            for i, (ask, answer) in enumerate(zip(asks, answers)):
                out[ask.target].append((r.part, answer, r.named[i:i + 1]))
        return out

    def _answers(self, growing: list[_Growing], settle: bool) -> dict[int, list]:
        """A pass, which settles where that is asked. Blocks that went with an executor are made again, from the rows and all
        trees so far."""
        try:
            if not settle:
                return self._asked([g.ask() for g in growing])
            found = self._settle([g.ask() for g in growing])
        except Exception:
            if self.failed == RETRIES:
                raise
            self.failed += 1
            self._release(self.frame)
            self.blocks.again()
            self.frame = self.blocks.frame
            for g in growing:
                g.behind = list(g.steps)
            return self._asked([g.ask() for g in growing])
        for g in growing:
            g.behind = []
        return found

    def _best_splits(self, ask: _Ask, answers: list) -> list[tuple | None]:
        """For each frontier node the best split: (gain, column, less the rows of the category, category or cut number, left sums,
        right sums, key of a rarer category)."""
        n_cats, nodes, first = len(self.blocks.frequent), len(ask.frontier), ask.first
        main = sum(a for part, a, _ in answers if part < 0)
        candidates: list[list] = [[] for _ in range(nodes)]
        start = 0
        for c in sorted(c for group in self.layout.groups for c in group):
            width = self.layout.width(c) - (c < n_cats)
            sums = main[start:start + 3 * nodes * width].reshape(3, nodes, width)
            start += 3 * nodes * width
            for k, whole in enumerate(ask.wholes):
                if c < n_cats:
                    right = Sums(*sums[:, k])
                    left = whole.less(right)
                else:
                    left = Sums(*np.cumsum(sums[:, k, :-1], axis=1))
                    right = whole.less(left)
                gain = gains(whole, left, right, by_mean=c < n_cats)
                if len(gain):
                    i = _first_best(gain, _slack(whole, first))
                    value, n = self.blocks.frequent[c][i] if c < n_cats else (i, 0)
                    candidates[k].append((gain[i], c, -n, value, Sums(*(float(x[i]) for x in left)),
                                          Sums(*(float(x[i]) for x in right)), None))
        for part, a, names in answers:
            if part >= 0:
                keys = a[5 * nodes:].view(np.int64).tolist()
                for k, (gain, n, *sums) in enumerate(a[:5 * nodes].reshape(nodes, 5).tolist()):
                    candidates[k].append((gain, part, -n, names[k], ask.wholes[k].less(Sums(*sums)), Sums(*sums), keys[k]))
        out = []
        for found, whole in zip(candidates, ask.wholes):
            slack = _slack(whole, first)
            most = max((c[0] for c in found), default=-math.inf)
            as_good = [c for c in found if c[0] >= most - slack]
            out.append(min(as_good, key=lambda c: c[1:4]) if most > slack else None)
        return out

    def run(self) -> list[GBTRegressionModel]:
        growing = [_Growing(t, whole, [], [], [], {}, {}, {}, []) for t, whole in enumerate(self._wholes())]
        try:
            for _ in range(self.max_iter):
                for g in growing:
                    g.plant()
                settle = len(growing[0].behind) >= SETTLED_ROUNDS
                for _ in range(self.max_depth):
                    open_ = [g for g in growing if g.frontier]
                    if not open_:
                        break
                    answers = self._answers(open_, settle)
                    settle = False
                    for g in open_:
                        g.grow(self._best_splits(g.ask(), answers[g.target]), self.blocks)
                for g in growing:
                    g.fell()
        finally:
            self._release(self.frame)
        weights = [1.0] + [STEP] * (self.max_iter - 1)
        return [GBTRegressionModel(g.trees, weights[:len(g.trees)]) for g in growing]


def fit(blocks: Blocks, max_iter: int, max_depth: int) -> dict[str, GBTRegressionModel]:
    """Boosted trees for each of the labels of ``blocks``."""
    return dict(zip(blocks.labels, _Fit(blocks, max_iter, max_depth).run()))

"""Target-distribution importance resampling with hashed n-grams.

Documents are drawn from a raw corpus so that their hashed n-gram counts
resemble a target's. One 256-byte table lower-cases A-Z and turns every ASCII
byte that is no letter or digit into a blank; UTF-8 bytes of other characters
stay. ``bytes.split`` then yields the words. The crc32 of a word is the seed of
the crc32 of the blank and the word after it, so runs of one to ``ORDER``
words are hashed by extending shorter runs; a feature's bucket is its crc32
modulo ``BUCKETS``.

A first pass counts features per bucket in each task with a ``Counter``; Spark
adds the counts (at most ``BUCKETS`` numbers reach the driver). A bucket's gain
is floor(1000 ln(p / q)) with add-one smoothed shares p in the target and q in
the raw corpus. A second pass adds the gains of every document's features
(its weight) and Gumbel noise from a hash of the id, so that the documents of
highest score are a draw without replacement by importance. The rank is a
position in one sort of all documents by (drawable, score, id): partitions of
a range sort are counted and numbered, no document goes through the driver.

Defined results: a null or empty text has no word, weight 0 and is not drawn; a
null id hashes as an empty one and comes after others at equal score; rows that
repeat an id are drawn apart (equal ones in any order, with ranks of their
own); an empty corpus gives no rows; an empty target has add-one shares only;
extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices, stored

ORDER = 3
BUCKETS = 10_000
MIN_WORDS = 20
SEED = 42
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                    for c in range(256))


def runs(text: bytes, order: int = ORDER) -> list[list[int]]:
    """crc32 of every run of 1, 2, ... ``order`` consecutive words of ``text``, a list for each length."""
    words = text.translate(_WORD_BYTES).split()
    out = [list(map(zlib.crc32, words))]
    after = [b" " + w for w in words]
    for length in range(1, order):
        out.append(list(map(zlib.crc32, after[length:], out[-1])))
    return out


def bucket_counts(df: DataFrame, text_col: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features of the whole of ``df`` by bucket."""
    def run(batches):
        total: Counter = Counter()
        for batch in slices(batches, 200):
            seen: Counter = Counter()
            for text in batch.column(0).cast(pa.binary()).drop_null().to_pylist():
                seen.update(chain.from_iterable(runs(text, order)))
            for feature, n in seen.items():
                total[feature % buckets] += n
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    counted = map_arrow(df.select(F.col(text_col).alias("text")), run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p / q)) per bucket, p and q the add-one smoothed shares in target and raw corpus."""
    n, s, t = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n))))
                     for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          order: int = ORDER, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score (weight with Gumbel noise) of every row."""
    held = df.sparkSession.sparkContext.broadcast(gain)  # a number per bucket

    def run(batches):
        gain = held.value
        for batch in slices(batches, 200):
            words, features, weights = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = runs(text or b"", order)
                flat = np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))
                words.append(len(found[0]))
                features.append(len(flat))
                weights.append(int(gain[flat % len(gain)].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                 pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    weighed = map_arrow(texts, run, "doc_id long, n_words long, n_features long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise)


def ranked(scored: DataFrame, percent: int, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the drawn ``percent`` of the rows of at least ``min_words`` words."""
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = (scored.withColumn("able", F.col("n_words") >= min_words).repartitionByRange(*order)
             .sortWithinPartitions(*order, "weight", "n_features").withColumn("at", F.monotonically_increasing_id()))
    placed = stored(dealt, "resampling-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if("able").alias("able"))
    sizes = sorted(sizes.collect())  # a row per partition
    drawn = percent * sum(r["able"] for r in sizes) // 100
    # Partitions come in the order of the sort: rows before each of those that have drawn rows, one map of constants.
    before, starts = 0, {}
    for row in sizes:
        if before < drawn:
            starts[row["part"]] = before
        before += row["n"]
    table = scored.sparkSession.createDataFrame(list(starts.items()), "part long, before long")
    numbered = placed.withColumn("part", part).join(F.broadcast(table), "part", "left")
    rank = F.col("before") + place + 1
    return numbered.select(*scored.columns, F.when(F.col("able") & (rank <= drawn), rank).alias("rank"))


def resample(raw: DataFrame, target: DataFrame, percent: int, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every row of ``raw``."""
    gain = gains(bucket_counts(raw, text_col), bucket_counts(target, target_text_col))
    return ranked(weigh(raw, gain, id_col, text_col), percent)

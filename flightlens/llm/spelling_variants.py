"""Spelling variants of a corpus vocabulary by permuterm rotations.

A word with a terminator ``$`` has a rotation for each of its places. A
replaced, inserted or deleted code point can be turned to the end of a
rotation: words that differ in it alone share the rotation up to there, which
is a prefix range of the sorted rotations. So every rotation is sorted by its
prefix without the last code point, then by that code point; the shorter word
of an insertion stands in the same range as the rotation that ends at the
prefix. A scan over the sorted ranges reads each once.

A range has at most one word for each letter and the shorter word, whatever the
corpus holds. The scan emits for every word of a range how many others are
near by it and the best of them (largest count, then smallest word), never
pairs; a shorter word that is reached by several places of a run of equal
letters counts at the first one only. A word's rows are then added up.

Words come from maximal letter runs, A-Z lower-cased. A run is thinned by one
code point where a hash of document and run says so (as in the contract of the
query; ``drop_every=None`` leaves runs as they are). ``form`` is the near word
of largest count if it is at least ``RATIO`` times as frequent; ``root`` follows
forms to the end (counts double at every step, so there is no cycle and the
chain is short; pointers are doubled by joins).

Defined results: null and empty texts have no word; a null document id hashes
as an empty one; repeated rows count again; ties go to the smallest word in
code-point order; an empty table or one without such words gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices, stored

MIN_LENGTH = 5
MIN_COUNT = 3
DROP_EVERY = 97
RATIO = 2
#: Distinct words a task counts before it hands the counts on.
_COUNTED = 300_000
#: Latin-1 bytes of the letters A-Z, a-z (lower-cased) and U+00C0 to U+00FF; others part words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs of letters of ``text``, A-Z lower-cased, in Latin-1 (characters beyond it part runs)."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, drop_every: int | None = DROP_EVERY) -> DataFrame:
    """word, n: the words of at least ``min_length`` code points that occur ``min_count`` times over all texts."""
    def run(batches):
        def rows():
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total]),
                                               pa.array(list(total.values()), pa.int64())], ["word", "n"])

        total: Counter = Counter()
        for batch in slices(batches, 500):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(letter_runs(text or ""))
                if drop_every is None:
                    total.update(found)
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if h % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= min_length:
                        total[word] += n
            if len(total) > _COUNTED:
                yield rows()
                total.clear()
        if total:
            yield rows()

    texts = df.select(F.col(id_col), F.col(text_col))
    return (map_arrow(texts, run, "word string, n long").where(F.length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """For every place of a word: ``key``, the rotation's prefix, and ``last``, the code point that was turned
    to its end (empty where nothing is skipped, for the word as the shorter one)."""
    place = words.select("n", "word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    before = F.expr("left(word, i)")
    whole = F.struct(F.concat(F.expr("substring(word, i + 1)"), F.lit("$"), before).alias("key"), F.lit("").alias("last"))
    skip = F.struct(F.concat(F.expr("substring(word, i + 2)"), F.lit("$"), before).alias("key"),
                    F.expr("substring(word, i + 1, 1)").alias("last"))
    places = F.when(F.col("i") < F.length("word"), F.array(whole, skip)).otherwise(F.array(whole))
    return place.select("n", F.explode(places).alias("r")).select("r.key", "r.last", "n")


def _scan(batches):
    """Sorted (key, last, n) -> per word of a range of two or more: its near words there and the best of them."""
    names = ["word", "n_near", "form_n", "form"]

    def ranges(table):
        out = [[], [], [], []]
        key = table.column(0)
        more = pc.equal(key.slice(1), key.slice(0, len(key) - 1))
        yes = pa.array([False])
        inside = pc.or_(pa.chunked_array([yes, *more.chunks]).combine_chunks(),
                        pa.chunked_array([*more.chunks, yes]).combine_chunks())
        table = table.filter(inside)
        keys, lasts, counts = (table.column(k).to_pylist() for k in range(3))
        s = 0
        while s < len(keys):
            e = s + 1
            while e < len(keys) and keys[e] == keys[s]:
                e += 1
            after, _, before = keys[s].rpartition("$")
            # (minus count, word, has the edited code point, is where a shorter word meets it first)
            group = [(-counts[k], before + lasts[k] + after, lasts[k] != "", not before.endswith(lasts[k] or "$"))
                     for k in range(s, e)]
            longer = sorted(g for g in group if g[2])
            shorter = [g for g in group if not g[2]]
            for g in longer:
                near = len(longer) - 1
                best = longer[longer[0] is g] if near else None
                if shorter and g[3]:
                    near += 1
                    best = shorter[0] if best is None else min(best, shorter[0])
                if near:
                    for column, x in zip(out, (g[1], near, -best[0], best[1])):
                        column.append(x)
            first = [g for g in longer if g[3]]
            if shorter and first:
                for column, x in zip(out, (shorter[0][1], len(first), -first[0][0], first[0][1])):
                    column.append(x)
            s = e
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                           pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], names)

    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carry is None else pa.concat_tables([carry, table])
        if not len(table):
            continue
        keys, at = table.column(0), len(table) - 1
        while at > 0 and keys[at - 1].as_py() == keys[at].as_py():  # a range has few rows
            at -= 1
        carry = table.slice(at).combine_chunks()
        if at:
            yield ranges(table.slice(0, at).combine_chunks())
    if carry is not None:
        yield ranges(carry)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and the near word of largest count (``best``) with its count (``best_n``), for words with any."""
    dealt = rotations(words).repartition("key").sortWithinPartitions("key", "last")
    found = map_arrow(dealt, _scan, "word string, n_near long, form_n long, form string")
    return (found.groupBy("word")
            .agg(F.sum("n_near").alias("n_near"),
                 F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form").alias("form"))).alias("best"))
            .select("word", "n_near", F.col("best.form").alias("best"), (-F.col("best.minus")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): forms are followed to the last by doubling the pointers."""
    up = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        both = stored(up.join(nxt, "root", "left"), "spelling-roots")
        up = both.select("word", F.coalesce("above", "root").alias("root"))
        if both.where("above is not null").isEmpty():
            return up


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, drop_every: int | None = DROP_EVERY, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary of ``df``."""
    words = stored(vocabulary(df, id_col, text_col, min_length, min_count, drop_every), "spelling-words")
    near = near_words(words)
    joined = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *(F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c)).alias(a) for c, a in (("best", "form"), ("best_n", "form_n")))),
        "spelling-forms")
    top = roots(joined.where("form is not null"))
    return joined.join(top, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

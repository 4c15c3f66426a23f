"""Line deduplication by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased). Two lines match when their
sets have a Jaccard similarity of at least 0.8, and a line that matches an
earlier one (by document id, then line number) is removed.

* Equal sets are one class: its first line stays, found by a rank after each task
  has set aside its own repeats.
* The words of a line are ordered by rarity (their counts over the whole
  corpus in ``RARITY_BUCKETS`` hash buckets, as one byte each on a logarithmic
  scale; any common order is exact). Two matching lines share a word within
  the prefix of n - ceil(0.8 n) + 1 rarest words, so prefix words are shuffled
  with the line, its size, the position and a parity of the set's words (64
  bits, 128 for long lines). A word that occurs once in the corpus meets nothing and is left out.
* Lines that share a prefix word are candidates if the length filter, the
  positional filter and the parity (its differing bits are at most the words
  in which the sets differ) let them reach the overlap ceil(4/9 (n + m)).
* Candidates are verified by the overlap of their full sets, taken again from the
  texts for the lines in question only.
* Postings are dealt and sorted by word; those of a very frequent word are
  spread by a salt. A task gives each line the ``FIRSTS`` candidates of a word
  whose parity differs least (in a group of over ``LARGE_GROUP`` lines: of the
  group's first ones). The nearest of a line's candidates is verified first, the
  others if that one is too far. Where more candidates are possible (further
  ones, large groups, other salts), lines that are unmatched so far go on: they
  meet once more among themselves, and all that this leaves unmatched are joined with
  every earlier line of their words, matched ones included. So no match is lost and no
  group is paired out.

Words are compared by 64-bit hashes. Lines of one to three words can only
match equal sets. Lines without a word are never removed.

Defined results: null and empty texts have no line to remove; a row with a
null id keeps all lines and matches nothing; rows that repeat an id count as
one document (equal lines at one place are the same line; decisions are for
the id and line number); ties cannot occur, as places are ordered; an empty
table gives no rows; columns of any other name pass through ``remove_lines``.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, slices, stored

RARITY_BUCKETS = 1 << 22
FIRSTS = 4
LARGE_GROUP = 512
#: No longer read: unmatched lines meet once more among themselves whatever their number.
MEET_AGAIN = 1_000_000
#: Occurrences of a word (beyond eight times the mean of the hash buckets) for each salt of its postings.
ROWS_PER_SALT = 500_000
#: Bits of a word in a posting; the salt stands above them.
_WORD_BITS = 40
#: Buckets whose counts travel together.
_RANGE = 1 << 10
#: Sets a task keeps by heart before it starts anew.
_KNOWN = 150_000
#: Words from which a line has a second word of parity.
_LONG = 24
#: Postings a task looks at together.
_ROWS = 1 << 16
_MASK = np.uint64(RARITY_BUCKETS - 1)
#: Bits of the map of candidate lines (2 MB), and bits of one of its rows.
_MARKS, _MARK_ROW = 1 << 24, 32_768
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Word hashes are polynomials modulo 2**64 over a random number for each byte value.
_BYTES = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(0, np.uint64), np.ones(0, np.uint64)]
#: Bytes of text that are hashed together; a longer text is taken alone.
_PIECE = 1 << 19


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hashes with every bit depending on every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salts(codes: np.ndarray, rows_per_salt: int) -> np.ndarray:
    """How many salts the words of each value of a rarity byte are spread over (1: none)."""
    step = np.arange(256)
    count = np.where(step < 128, step, 128 * 2 ** ((step - 127) / 4))
    mean = float((np.bincount(codes, minlength=256) * count).sum()) / len(codes)
    return np.ceil(np.maximum(1, count / (rows_per_salt + 8 * mean))).astype(np.int64)


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``text``, and how many of them are on each of its lines."""
    data = np.frombuffer(b"\n" + text.lower() + b"\n", np.uint8)
    powers = _powers
    if len(data) > len(powers[0]):
        size = max(len(data), _PIECE + 2)
        powers = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, base, np.uint64))))
                  for base in (_BASE, pow(_BASE, -1, 1 << 64))]
        if size == _PIECE + 2:  # those of a longer text are not kept
            _powers[:] = powers
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    sums = np.cumsum(_BYTES[data] * powers[0][:len(data)], dtype=np.uint64)
    hashes = _mixed((sums[ends - 1] - sums[starts - 1]) * powers[1][starts])
    return hashes, np.diff(np.searchsorted(starts, np.flatnonzero(data == 10)))


def _pieces(batches, column: int = 0):
    """Arrow batches cut so that the texts of each have at most about ``_PIECE`` bytes, with the texts (null: empty)."""
    for batch in slices(batches, 2000):
        texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
        ends = np.cumsum([len(t) + 1 for t in texts])
        at = 0
        while at < len(texts):
            end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right"))
            end = max(at + 1, end)
            yield batch.slice(at, end - at), texts[at:end]
            at = end


def rarity(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """How frequent the words of each hash bucket are in the whole corpus: a byte per bucket, growing with the count.

    The bytes are the count below 128, then four steps per doubling. 1 means
    that the bucket's only word occurs once.
    """
    def run(batches):
        total = np.zeros(RARITY_BUCKETS, np.int64)
        for _, texts in _pieces(batches):
            hashes, _ = _words(b"\n".join(texts))
            np.add.at(total, (hashes & _MASK).astype(np.int64), 1)
        # Packed by ranges of buckets, so that a count travels in a few bytes.
        buckets = np.flatnonzero(total)
        offsets = np.searchsorted(buckets, np.arange(0, RARITY_BUCKETS + 1, _RANGE)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(offsets) - 1, dtype=np.int32)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array((buckets % _RANGE).astype(np.int16))),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(total[buckets]))], ["part", "bucket", "n"])

    packed = map_arrow(df.select(F.col(text_col).alias("text")), run, "part int, bucket array<short>, n array<long>")
    counted = (packed.where("size(n) > 0").withColumn("n", F.expr("transform(n, x -> cast(x as int))"))
               .repartition("part").select("part", F.inline(F.arrays_zip("bucket", "n")))
               .groupBy("part", "bucket").agg(F.sum("n").alias("n"))
               .select((F.col("part") * _RANGE + F.col("bucket")).alias("bucket"), "n").toArrow())  # at most a row per bucket
    out = np.zeros(RARITY_BUCKETS, np.uint8)
    n = counted["n"].to_numpy()
    steps = 128 + np.minimum(127, np.floor(4 * np.log2(np.maximum(n, 128) / 128)))
    out[counted["bucket"].to_numpy()] = np.where(n < 128, n, steps).astype(np.uint8)
    return out


def _sets(hashes, sizes, counts):
    """Each line's distinct words, rarest first: (line, word) arrays; lines without a word have none."""
    line = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    bits = len(sizes).bit_length()
    order = np.argsort((line << np.uint64(64 - bits)) | (counts[hashes & _MASK].astype(np.uint64) << np.uint64(56 - bits))
                       | (hashes >> np.uint64(8 + bits)))
    line, hashes = line[order], hashes[order]
    new = np.ones(len(line), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
    return line[new].astype(np.int64), hashes[new]


def line_sets(df: DataFrame, counts: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with words: doc, line, place, n (distinct words), again, h1 and h2 (hash of the set) and its prefix.

    ``again`` tells that an equal set was met at an earlier place in the same task.

    ``sig`` and, for long lines, ``sig2`` (parity of the words), ``pre_word``
    (40 bits of the word's hash, and its salt) and ``pre_pos`` (the prefix, without words that
    occur once) are null where the line cannot match an unequal set (n < 4) or
    an equal set was met earlier in the same task.
    """
    held = df.sparkSession.sparkContext.broadcast(counts.tobytes())  # RARITY_BUCKETS bytes
    salts = _salts(counts, ROWS_PER_SALT)

    def run(batches):
        counts = np.frombuffer(held.value, np.uint8)
        first: dict[tuple, list] = {}
        for batch, texts in _pieces(batches, 1):
            per_doc = np.array([t.count(b"\n") + 1 for t in texts])
            doc = np.repeat(batch.column(0).to_numpy(), per_doc)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            owner, values = _sets(*_words(b"\n".join(texts)), counts)
            if not len(values):
                continue
            n = np.bincount(owner, minlength=len(doc))
            filled = np.flatnonzero(n)
            doc, place, n = doc[filled], place[filled], n[filled]
            owner = np.repeat(np.arange(len(n)), n)
            begins = np.cumsum(n) - n
            bit = values >> np.uint64(57)
            one = np.uint64(1) << (bit & np.uint64(63))
            # Lines of at most _LONG words use all 64 bits of the first word; longer ones half of their words in each.
            second = (n > _LONG)[owner] & (bit > np.uint64(63))
            sig, sig2 = (np.bitwise_xor.reduceat(np.where(x, one, np.uint64(0)), begins).view(np.int64)
                         for x in (~second, second))
            h1, h2 = (np.add.reduceat(_mixed(values ^ np.uint64(k)), begins).view(np.int64) for k in (1, 2))
            again = np.zeros(len(n), bool)
            for i, (a, b, *at) in enumerate(zip(*(c.tolist() for c in (h1, h2, doc, place)))):
                if first.get((a, b), at) < at:
                    again[i] = True
                else:
                    first[a, b] = at
            wanted = (n >= 4) & ~again
            if len(first) > _KNOWN:
                first.clear()  # only spares postings; equal sets are settled by their hash
            pos = np.arange(len(values)) - np.repeat(begins, n)
            prefix = wanted[owner] & (pos < (n - (4 * n + 4) // 5 + 1)[owner]) & (counts[values & _MASK] > 1)
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[prefix], minlength=len(n))))).astype(np.int32))
            none = pa.array(~wanted)
            values, owner, pos = values[prefix], owner[prefix], pos[prefix]
            word = (values >> np.uint64(64 - _WORD_BITS)).view(np.int64)
            spread = salts[counts[values & _MASK]]
            word |= np.where(spread > 1, 1 + _place(doc, place)[owner] % spread, 0) << _WORD_BITS
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(place.astype(np.int32)), pa.array(_place(doc, place).astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(again), pa.array(h1),
                 pa.array(h2), pa.array(sig, mask=~wanted), pa.array(sig2, mask=~wanted),
                 pa.ListArray.from_arrays(offsets, pa.array(word), mask=none),
                 pa.ListArray.from_arrays(offsets, pa.array(pos.astype(np.int32)), mask=none)],
                ["doc", "line", "place", "n", "again", "h1", "h2", "sig", "sig2", "pre_word", "pre_pos"])

    texts = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"),
                                                       F.col(text_col).alias("text"))
    return map_arrow(texts, run, "doc long, line int, place int, n int, again boolean, h1 long, h2 long, sig long, sig2 long, "
                                 "pre_word array<long>, pre_pos array<int>")


PAIR = ["doc", "line", "doc2", "line2"]
POSTING = ["word", "doc", "line", "n", "pos", "sig", "sig2"]
_POSTING_TYPES = "word long, doc long, line int, n int, pos int, sig long, sig2 long"
_NEAR_SQL = f"""(a.doc < b.doc or (a.doc = b.doc and a.line < b.line))
    and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
    and 9 * least(a.n - a.pos, b.n - b.pos) >= 4 * (a.n + b.n)
    and ((a.n > {_LONG}) <> (b.n > {_LONG}) or 9 * (bit_count(a.sig ^ b.sig) + bit_count(a.sig2 ^ b.sig2)) <= a.n + b.n)"""


def _candidates(rows, i, j):
    """The pairs of postings of one word that pass all filters, as (earlier, later, differing bits of parity)."""
    na, nb = rows[i, 3], rows[j, 3]
    keep = np.flatnonzero((9 * np.minimum(na - rows[i, 4], nb - rows[j, 4]) >= 4 * (na + nb))
                          & (5 * np.minimum(na, nb) >= 4 * np.maximum(na, nb)))
    i, j, na, nb = i[keep], j[keep], na[keep], nb[keep]
    differing = np.bitwise_count((rows[i, 5:] ^ rows[j, 5:]).view(np.uint64)).sum(1, dtype=np.int64)
    near = (9 * differing <= na + nb) | ((na > _LONG) != (nb > _LONG))
    earlier = (rows[i, 1] < rows[j, 1]) | ((rows[i, 1] == rows[j, 1]) & (rows[i, 2] < rows[j, 2]))
    apart = (rows[i, 1] != rows[j, 1]) | (rows[i, 2] != rows[j, 2])
    i, j = np.where(earlier, i, j), np.where(earlier, j, i)
    near &= apart
    return i[near], j[near], differing[near]


def _meet(batches, firsts=FIRSTS, large_group=LARGE_GROUP, together=_ROWS):
    """Postings sorted by word -> pairs (later line, earlier line) and postings that may have more.

    A pair is a row with ``doc2``, ``line2`` and ``differing``; where these are null
    the posting is one whose line, if it is not matched yet, may have further candidates.
    """
    names = [*POSTING, "doc2", "line2", "differing"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
             pa.int64(), pa.int32(), pa.int32()]

    def emit(rows, other=None, differing=None):
        def some(values, kinds):
            return [pa.array(v).cast(t) for v, t in zip(values.T, kinds)]

        def none(kinds):
            return [pa.nulls(len(rows), t) for t in kinds]

        columns = some(rows, types[:7]) + none(types[7:]) if other is None else [
            *none(types[:1]), *some(rows[:, 1:3], types[1:3]), *none(types[3:7]), *some(other[:, 1:3], types[7:9]),
            pa.array(differing).cast(pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names)

    def out(rows, i, j, differing, more):
        """The nearest candidates of each row; ``more`` marks the rows that are open in any case."""
        order = np.lexsort((i, differing, j))
        i, j, differing = i[order], j[order], differing[order]
        place = np.arange(len(j)) - np.searchsorted(j, j)
        more[j[place >= firsts]] = True
        chosen = place < firsts
        if chosen.any():
            yield emit(rows[j[chosen]], rows[i[chosen]], differing[chosen])
        if more.any():
            yield emit(rows[more])

    def bounds(rows):
        starts = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
        return starts, np.diff(np.append(starts, len(rows)))

    def pairs(rows):
        """Candidates within the groups of ``rows``, of at most ``large_group`` rows each."""
        starts, sizes = bounds(rows)
        end = np.repeat(starts + sizes, sizes)
        found, at = [[np.zeros(0, np.int64)] * 3], np.arange(len(rows))
        for apart in range(1, large_group):
            at = at[at + apart < end[at]]
            if not len(at):
                break
            found.append(_candidates(rows, at, at + apart))
        return [np.concatenate([f[k] for f in found]) for k in range(3)]

    def against(heads, rows):
        """Rows of a large group with the first ones that came; all of them stay open."""
        for at in range(0, len(rows), 2048):
            both = np.concatenate((heads, rows[at:at + 2048]))
            h, n = len(heads), len(both) - len(heads)
            yield from out(both, *_candidates(both, np.tile(np.arange(h), n), np.repeat(np.arange(h, h + n), h)),
                           np.arange(len(both)) >= (h if at else 0))

    def groups(rows):
        """Whole groups; rows of salted words are open, as other salts have more of them."""
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        starts, sizes = bounds(rows)
        place = np.arange(len(rows)) - np.repeat(starts, sizes)
        head = rows[place < large_group]
        yield from out(head, *pairs(head), head[:, 0] >> _WORD_BITS > 0)
        for s, n in zip(starts[sizes > large_group].tolist(), sizes[sizes > large_group].tolist()):
            yield from against(rows[s:s + large_group], rows[s + large_group:s + n])

    waiting, held, heads = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in range(7)])
        if heads is not None:  # a large group that goes on
            goes_on = rows[:, 0] == heads[0, 0]
            yield from against(heads, rows[goes_on])
            rows = rows[~goes_on]
            if not len(rows):
                continue
            heads = None
        waiting.append(rows)
        held += len(rows)
        if held < together:
            continue
        rows = np.concatenate(waiting)
        last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        if last:
            yield from groups(rows[:last])
        rest = rows[last:]
        if len(rest) > large_group:
            yield from groups(rest)
            heads, rest = rest[np.lexsort((rest[:, 2], rest[:, 1]))[:large_group]], rest[:0]
        waiting, held = [rest], len(rest)
    if held:
        yield from groups(np.concatenate(waiting))


def _place(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A line's bit in the map of candidate lines."""
    mixed = _mixed(_mixed(doc.astype(np.int64).view(np.uint64)) ^ line.astype(np.uint64))
    return (mixed & np.uint64(_MARKS - 1)).astype(np.int64)


def _marks(places: DataFrame) -> np.ndarray:
    """A map of ``_MARKS`` bits (a fixed size), as bytes, with those of the column ``place`` set."""
    rows = (places.groupBy(F.expr(f"place div {_MARK_ROW}").alias("mark_row"))
            .agg(F.bitmap_construct_agg(F.col("place") % _MARK_ROW).alias("mark_bits")).collect())
    out = np.zeros((_MARKS // _MARK_ROW, _MARK_ROW // 8), np.uint8)
    for row in rows:
        out[row["mark_row"]] = np.frombuffer(row["mark_bits"], np.uint8)[:_MARK_ROW // 8]
    return out.reshape(-1)


def _hit(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _with_places(lines: DataFrame) -> DataFrame:
    """``place`` of the lines (doc, line)."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_place(batch.column(0).to_numpy(), batch.column(1).to_numpy()))], ["place"])

    return map_arrow(lines, run, "place long")


def _split_by_marks(df: DataFrame, marks: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``place`` is marked, and the others; the map (of a fixed size) is broadcast."""
    bits = np.unpackbits(marks, bitorder="little").reshape(-1, 64)
    longs = np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1, _MARK_ROW // 64)
    table = pa.table({"mark_row": pa.array(np.arange(len(longs), dtype=np.int32)), "mark_bits": pa.array(list(longs))})
    known = F.broadcast(df.sparkSession.createDataFrame(table))
    both = df.withColumn("mark_row", F.expr(f"place div {_MARK_ROW}").cast("int")).join(known, "mark_row")
    hit = F.expr(f"bit_get(mark_bits[cast(place % {_MARK_ROW} div 64 as int)], place % 64) = 1")
    return both.where(hit).select(*df.columns), both.where(~hit).select(*df.columns)


def _marked_sets(df: DataFrame, later: np.ndarray, earlier: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc, line, words of the lines whose bit is set in either map, and in which."""
    held = df.sparkSession.sparkContext.broadcast((later.tobytes(), earlier.tobytes()))

    def run(batches):
        maps = [np.frombuffer(m, np.uint8) for m in held.value]
        for batch, texts in _pieces(batches, 1):
            per_doc = np.array([t.count(b"\n") + 1 for t in texts])
            doc = np.repeat(batch.column(0).to_numpy(), per_doc)
            line = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            is_later, is_earlier = (_hit(m, _place(doc, line)) for m in maps)
            chosen = np.flatnonzero(is_later | is_earlier)
            if not len(chosen):
                continue
            lines = b"\n".join(texts).split(b"\n")
            hashes, sizes = _words(b"\n".join([lines[k] for k in chosen.tolist()]))
            owner, values = _sets(hashes, sizes, np.zeros(RARITY_BUCKETS, np.uint8))
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(chosen))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[chosen]), pa.array(line[chosen].astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))),
                 pa.array(is_later[chosen]), pa.array(is_earlier[chosen])],
                ["doc", "line", "words", "later", "earlier"])

    texts = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"),
                                                       F.col(text_col).alias("text"))
    return map_arrow(texts, run, "doc long, line int, words array<long>, later boolean, earlier boolean")


def _verified(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The later lines (doc, line) of those ``pairs`` whose sets have a Jaccard similarity of at least 0.8.

    Only lines in pairs (and a few more that share their bits) are read again
    from the texts; the pairs, not the sets of all lines, are shuffled.
    """
    maps = [_marks(_with_places(pairs.select(*PAIR[k:k + 2]))) for k in (0, 2)]
    known = stored(_marked_sets(df, *maps, id_col, text_col), "line-words")
    later = pairs.join(known.where("later").select("doc", "line", "words"), ["doc", "line"])
    both = later.join(known.where("earlier").select("doc", "line", "words").toDF("doc2", "line2", "words2"),
                      ["doc2", "line2"])
    return stored(both.where("9 * size(array_intersect(words, words2)) >= 4 * (size(words) + size(words2))")
                  .select("doc", "line").distinct(), "line-matches")


def removed_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``line`` (from 0) of every line that matches an earlier one."""
    spark = df.sparkSession
    sets = stored(line_sets(df, rarity(df, text_col), id_col, text_col), "line-sets")
    # Of equal lines all but the first go. Repeats within a task are known; a class has at most a row per task beside them.
    by = Window.partitionBy("h1", "h2").orderBy("doc", "line")
    lines = sets.where("not again").select("doc", "line", "h1", "h2").withColumn("rank", F.rank().over(by))
    others = stored(lines.where("rank > 1").select("doc", "line"), "line-equal")
    equal = others.union(sets.where("again").select("doc", "line"))

    # Only a class's first line has postings. Repeats within a task have none already; the
    # others are taken out by a join, for which a map of them leaves few rows.
    filled = sets.where("size(pre_word) > 0").select("doc", "line", "place", "n", "sig", "sig2", "pre_word", "pre_pos")
    maybe, single = _split_by_marks(filled, _marks(_with_places(others)))
    maybe = stored(maybe, "line-maybe")  # else the join would be planned below the look at the map
    filled = single.union(stored(maybe.join(others, ["doc", "line"], "left_anti").select(*filled.columns), "line-single"))
    prefix = F.arrays_zip(F.col("pre_word").alias("word"), F.col("pre_pos").alias("pos"))
    postings = filled.select("doc", "line", "n", "sig", "sig2", F.inline(prefix)).select(*POSTING)

    rest, near, rows = [], [], postings
    unsalted = F.col("word").bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).alias("word")
    for again in (False, True):
        dealt = rows.repartition("word").sortWithinPartitions("word")
        met = stored(map_arrow(dealt, partial(_meet, firsts=FIRSTS, large_group=LARGE_GROUP, together=_ROWS),
                               f"{_POSTING_TYPES}, doc2 long, line2 int, differing int"), "line-candidates")
        pairs = stored(met.where("doc2 is not null").select(*PAIR, "differing").distinct(), "line-pairs")
        best = pairs.groupBy("doc", "line").agg(F.min(F.struct("differing", "doc2", "line2")).alias("best"))
        best = stored(best.select("doc", "line", "best.doc2", "best.line2"), "line-best")
        near.append(_verified(best, df, id_col, text_col))
        rest.append(pairs.select(*PAIR).join(near[-1], ["doc", "line"], "left_anti").select(*PAIR)
                    .join(best, PAIR, "left_anti"))
        # The second time only open lines meet: one that meets few of them may still match an earlier line that is
        # not open. So all that were open before stay so until they are matched.
        still = rows if again else met.where("doc2 is null").select(unsalted, *POSTING[1:])
        rows = stored(still.join(near[-1], ["doc", "line"], "left_anti").select(*POSTING), "line-open")

    # What is still open meets every earlier line of its words; a map of the words spares the others the shuffle.
    words = spark.sparkContext.broadcast(_marks(
        rows.select(F.col("word").bitwiseAND(F.lit(_MARKS - 1)).alias("place"))).tobytes())

    def of_open_words(batches):
        marks = np.frombuffer(words.value, np.uint8)
        for batch in batches:
            lists, pos = batch.column(5), batch.column(6).flatten()
            word = lists.flatten().to_numpy() & ((1 << _WORD_BITS) - 1)
            chosen = np.flatnonzero(_hit(marks, word & (_MARKS - 1)))
            row = pa.array(np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())[chosen])
            doc, line, n, sig, sig2 = (batch.column(k).take(row) for k in range(5))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[chosen]), doc, line, n, pos.take(pa.array(chosen)), sig, sig2], POSTING)

    earlier = map_arrow(filled.select("doc", "line", "n", "sig", "sig2", "pre_word", "pre_pos"),
                        of_open_words, _POSTING_TYPES).alias("a")
    more = rows.alias("b").join(earlier, F.expr(f"a.word = b.word and {_NEAR_SQL}")).select(
        "b.doc", "b.line", F.col("a.doc").alias("doc2"), F.col("a.line").alias("line2"))
    for pairs in rest:
        more = more.union(pairs)
    more = stored(more.distinct(), "line-more-pairs")
    out = equal
    for part in near if more.isEmpty() else [*near, _verified(more, df, id_col, text_col)]:
        out = out.union(part)
    return out.repartition("doc").distinct()


def report(df: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the numbers of the removed lines (joined by commas), for every document."""
    removed = removed_lines(df).groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("gone"))
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    size = F.coalesce(breaks + 1, F.lit(0)).cast("long")
    docs = df.select("doc_id", size.alias("n_lines"))
    return (docs.join(removed, docs["doc_id"] == removed["doc"], "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed_lines")))


def remove_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the removed lines taken out of its texts; all its rows and columns stay."""
    removed = (removed_lines(df, id_col, text_col).groupBy(F.col("doc").alias("doc__"))
               .agg(F.collect_list("line").alias("gone__")))
    joined = df.join(removed, F.col(id_col) == F.col("doc__"), "left").drop("doc__")
    at = df.columns.index(text_col)
    names = [f"c{i}" for i in range(len(df.columns))]

    def run(batches):
        for batch in slices(batches, 1000):
            texts = batch.column(at).to_pylist()
            for i, gone in enumerate(batch.column(len(names)).to_pylist()):
                if gone and texts[i] is not None:
                    gone = set(gone)
                    texts[i] = "\n".join(t for k, t in enumerate(texts[i].split("\n")) if k not in gone)
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"{a} {f.dataType.simpleString()}" for a, f in zip(names, df.schema))
    return map_arrow(joined.toDF(*names, "gone"), run, schema).toDF(*df.columns)


#: The same rows in DuckDB: every pair of lines with a common word, by definition.
ORACLE_SQL = """
WITH docs AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS t, unnest(range(len(l))) AS line FROM docs WHERE doc_id IS NOT NULL),
sets AS (
  SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all(
           translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'))) AS s
  FROM lines
),
classes AS (
  SELECT s, len(s) AS n, row_number() OVER () AS id, min((doc_id, line)) AS first
  FROM sets WHERE len(s) > 0 GROUP BY s
),
words AS (SELECT id, n, unnest(s) AS w FROM classes),
frequency AS (SELECT w, count(*) AS f FROM words GROUP BY w),
placed AS (SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY f, w) AS pos FROM words JOIN frequency USING (w)),
prefix AS (SELECT id, n, w FROM placed WHERE pos <= n - (4 * n + 4) // 5 + 1),
candidates AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM prefix a JOIN prefix b ON a.w = b.w AND a.id < b.id
  AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
),
matches AS (
  SELECT x, y FROM candidates JOIN classes a ON a.id = x JOIN classes b ON b.id = y
  WHERE 9 * len(list_intersect(a.s, b.s)) >= 4 * (a.n + b.n)
),
linked AS (
  SELECT id, min(first) AS earliest FROM (
    SELECT id, first FROM classes
    UNION ALL SELECT x, b.first FROM matches JOIN classes b ON b.id = y
    UNION ALL SELECT y, a.first FROM matches JOIN classes a ON a.id = x
  ) GROUP BY id
),
removed AS (
  SELECT DISTINCT doc_id, line FROM sets JOIN classes USING (s) JOIN linked USING (id)
  WHERE (doc_id, line) > earliest
),
gone AS (SELECT doc_id, count(*) AS n, string_agg(line::VARCHAR, ',' ORDER BY line) AS g FROM removed GROUP BY doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(g, '') AS removed_lines
FROM docs d LEFT JOIN gone USING (doc_id)
"""

"""Token ids as files of directly addressable codes.

Each id is split into 8-bit chunks, lowest first. Level k of a segment holds,
one after the other, the k-th chunks of the ids that have one, and a bitmap
that says for each of them whether the id goes on at level k+1. A rank
directory with the count of set bits before every 512th bit makes the place of
an id's next chunk a directory entry plus at most 64 bytes of bit counts, so
any single token is read without decoding its neighbours.

A file is a run of segments, each a header, a document directory (ids and
first token of every document) and the levels. A Parquet manifest has one row
per segment (file, place, number of documents and tokens). Documents are
range-partitioned and sorted by id, so files and segments are in ascending
order. A task writes to a file name of its own attempt and reports it through
the manifest, which Spark commits: files of lost attempts are never read.

Defined results: null and empty texts are documents of the end id alone; a
null document id sorts first; rows that repeat an id are kept, in order of
their text; an empty table gives an empty manifest; further input columns are
ignored. Segments close at ``SEGMENT_TOKENS`` tokens; a longer document is a
segment of its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightlens.llm.common import map_arrow, shared_folder, slices
from flightlens.llm.library_tokens import ids_bytes

SEGMENT_TOKENS = 1 << 20
BLOCK_BITS = 512
_HEADER = struct.Struct("<4sIQQ")  # magic, levels, documents, tokens
_LEVEL = struct.Struct("<QQQ")  # bytes of chunks, of bitmap, of directory
_MAGIC = b"DAC1"
MANIFEST = "file string, part long, segment long, at long, bytes long, n_docs long, n_tokens long"


def encode_levels(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """(chunks, continuation bitmap, rank directory) for each level."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        high = rest >> np.uint32(8)
        more = high > 0
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK_BITS // 8)))
        counts = np.bitwise_count(bitmap).reshape(-1, BLOCK_BITS // 8).sum(1)
        ranks = np.concatenate(([0], np.cumsum(counts)[:-1])).astype("<u4")
        levels.append(((rest & np.uint32(255)).astype(np.uint8).tobytes(), bitmap.tobytes(), ranks.tobytes()))
        rest = high[more]
    return levels


def pack_segment(doc_ids: list, doc_ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: header, level sizes, document directory, levels."""
    levels = encode_levels(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    starts = np.concatenate(([0], doc_ends[:-1])).astype("<u8")
    return b"".join([
        _HEADER.pack(_MAGIC, len(levels), len(doc_ids), len(ids)),
        *(_LEVEL.pack(*map(len, level)) for level in levels),
        numbers.tobytes(), known.tobytes(), starts.tobytes(),
        *(part for level in levels for part in level),
    ])


class Segment:
    """Reader of one segment through ``read(at, size) -> bytes``, offsets from the segment's start.

    ``token(i)`` reads a few bytes; ``ids()`` decodes everything.
    """

    def __init__(self, read):
        self.read = read
        magic, n_levels, self.n_docs, self.n_tokens = _HEADER.unpack(read(0, _HEADER.size))
        if magic != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        sizes = [_LEVEL.unpack(read(_HEADER.size + k * _LEVEL.size, _LEVEL.size)) for k in range(n_levels)]
        self.docs_at = _HEADER.size + n_levels * _LEVEL.size
        at, self.levels = self.docs_at + 17 * self.n_docs, []
        for chunks, bitmap, ranks in sizes:
            self.levels.append((at, chunks, at + chunks, bitmap, at + chunks + bitmap, ranks))
            at += chunks + bitmap + ranks

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids (None where null) and the place of each one's first token."""
        n = self.n_docs
        raw = self.read(self.docs_at, 17 * n)
        numbers, known = np.frombuffer(raw[:8 * n], "<i8").tolist(), raw[8 * n:9 * n]
        return [x if k else None for x, k in zip(numbers, known)], np.frombuffer(raw[9 * n:], "<u8").astype(np.int64)

    def token(self, i: int) -> int:
        """Id at place ``i`` of the segment, without decoding any other."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks_at, _, bits_at, _, ranks_at, _ in self.levels:
            value |= self.read(chunks_at + i, 1)[0] << shift
            block = i // BLOCK_BITS
            bits = int.from_bytes(self.read(bits_at + block * (BLOCK_BITS // 8), BLOCK_BITS // 8), "little")
            inside = i % BLOCK_BITS
            if not bits >> inside & 1:
                break
            before = int.from_bytes(self.read(ranks_at + 4 * block, 4), "little")
            i, shift = before + (bits & ((1 << inside) - 1)).bit_count(), shift + 8
        return value

    def ids(self) -> np.ndarray:
        out = np.zeros(self.n_tokens, np.uint32)
        place = np.arange(self.n_tokens)
        for k, (chunks_at, size, bits_at, n_bits, _, _) in enumerate(self.levels):
            out[place] |= np.frombuffer(self.read(chunks_at, size), np.uint8).astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(np.frombuffer(self.read(bits_at, n_bits), np.uint8), bitorder="little")[:size]
            place = place[more.astype(bool)]
        return out


def file_segment(uri: str, at: int) -> Segment:
    """A segment in a file, read by seeking."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    source = fs.open_input_file(path)

    def read(offset: int, size: int) -> bytes:
        source.seek(at + offset)
        return source.read(size)

    return Segment(read)


def write(df: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Encode each whole text, append ``end_id``, write code files and their manifest to ``folder``.

    ``folder`` is a URI that driver and executors share. One shuffle: texts by
    ranges of their id.
    """
    local_fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    local_fs.create_dir(f"{root}/codes", recursive=True)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part = TaskContext.get().partitionId()
        uri = f"{folder}/codes/part-{part:06d}-{uuid.uuid4().hex}.dac"
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        sink, at, segment = None, 0, 0
        docs, ends, pieces, n = [], [], [], 0

        def close():
            nonlocal sink, at, segment, docs, ends, pieces, n
            sink = sink or fs.open_output_stream(path)
            blob = pack_segment(docs, np.array(ends, np.int64), np.frombuffer(b"".join(pieces), "<u4"))
            sink.write(blob)
            row = (uri, part, segment, at, len(blob), len(docs), n)
            at, segment, docs, ends, pieces, n = at + len(blob), segment + 1, [], [], [], 0
            return row

        rows = []
        for batch in slices(batches, 2000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), ids_bytes(texts, tokenizer_path, False, specials=True)):
                size = len(ids) // 4 + 1
                if docs and n + size > SEGMENT_TOKENS:
                    rows.append(close())
                docs.append(doc)
                pieces += (ids, end)
                n += size
                ends.append(n)
        if docs:
            rows.append(close())
        if sink:
            sink.close()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows)], ["file", "part", "segment", "at", "bytes", "n_docs", "n_tokens"])

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.repartitionByRange("id").sortWithinPartitions("id", "text")
    map_arrow(texts, run, MANIFEST).write.parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The segments with ``start``: the tokens of all files and segments before.

    Prefix sums in two levels: over the files (one row per write task), then
    within each file.
    """
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    files = files.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment")
    return (rows.withColumn("within", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
            .join(files, "part").withColumn("start", F.col("before") + F.col("within"))
            .drop("before", "within"))


#: Bytes of code files that a task reads.
_READ_BYTES = 16 << 20

def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start, n_tokens, ids_crc32 (and with ``with_ids`` the ids)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches):
        for batch in batches:
            for file, at, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = pyarrow.fs.FileSystem.from_uri(file)
                with fs.open_input_file(path) as source:
                    source.seek(at)
                    blob = memoryview(source.read(size))
                segment = Segment(lambda offset, n, blob=blob: bytes(blob[offset:offset + n]))
                docs, first = segment.documents()
                ids = segment.ids().astype("<u4")
                bounds = np.append(first, segment.n_tokens)
                raw = ids.tobytes()
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                columns = [pa.array(docs, pa.int64()), pa.array(first + start, pa.int64()),
                           pa.array(np.diff(bounds), pa.int64()),
                           pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in spans], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(np.int64) for a, b in spans], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    segments = manifest(spark, folder).select("file", "at", "bytes", "start")
    # By what the segments hold: a manifest row is small, so AQE would leave all of them to a few tasks.
    held = segments.agg(F.sum("bytes")).first()[0] or 0
    return map_arrow(segments.repartition(1 + held // _READ_BYTES, "file", "at"), run, schema)


def token_at(spark: SparkSession, folder: str, place: int) -> int:
    """The id at one place of the whole corpus: one manifest row, then a few bytes of one file."""
    row = (manifest(spark, folder).where((F.col("start") <= place) & (F.col("start") + F.col("n_tokens") > place))
           .select("file", "at", "start").first())
    if row is None:
        raise IndexError(place)
    return file_segment(row["file"], row["at"]).token(place - row["start"])


def round_trip(df: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``df``'s documents as code files to the shared folder and read them back."""
    spark = df.sparkSession
    folder = shared_folder(spark, "token-codes")
    write(df, tokenizer_path, end_id, folder)
    return read(spark, folder)

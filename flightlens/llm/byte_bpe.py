"""Byte-level BPE encoding and decoding on length-bucketed padded numpy matrices.

A batch's distinct pretokens (matches of the split pattern) go into matrices by
byte length, one row each. Every round each row merges its leftmost pair of
minimum rank, found by a hashed pair lookup; rows without a pair left are
compacted away. Pretokens that are a vocabulary entry themselves take its id
at once, as the tiktoken library does.

Defined results: a null or empty text has no ids (``n_tokens`` 0) and the
digests of empty strings; repeated rows each give their row; an empty table
gives no rows; further input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.chunks import ChunkCodes
from flightlens.llm.common import map_arrow, slices

_NO_RANK = np.int32(2**31 - 1)
_BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128, 256)


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id of its merge."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        values = np.array(merged, np.int32)
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NO_RANK, np.int32)
        slot, self.probes = self._slot(keys), 0
        while len(keys):  # insert in rounds: the first claimant of a free slot stays
            self.probes += 1
            free = self.keys[slot] == -1
            first = np.unique(np.where(free, slot, -1), return_index=True)[1]
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the merge for each pair, ``_NO_RANK`` where there is none (or an id is negative)."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        shape, keys = keys.shape, keys.ravel()
        out = np.full(keys.shape, _NO_RANK, np.int32)
        open_ = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        slot = self._slot(keys[open_])
        for _ in range(self.probes):
            if not len(open_):
                break
            found = self.keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (found != -1)
            open_, slot = open_[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out.reshape(shape)


class ByteBpe:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in ranks.values()}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        return cls(ranks, pattern)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pretoken (bytes), as little-endian int32 bytes."""
        out: list = [None] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            else:
                width = next((w for w in _BUCKETS if len(piece) <= w), 0)
                if width:
                    rows.setdefault(width, []).append(i)
                else:
                    out[i] = self._merge_long(self.single[np.frombuffer(piece, np.uint8)]).astype("<i4").tobytes()
        for width, members in rows.items():
            for at in range(0, len(members), 1 << 15):
                part = members[at:at + (1 << 15)]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        size = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < size[:, None], self.single[raw], np.int32(-1))
        rank = np.full((n, width), _NO_RANK, np.int32)
        rank[:, :-1] = self.pairs.merged(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(n), [None] * n
        while len(row):
            at = rank.argmin(axis=1)  # leftmost of the minimum
            here = np.arange(len(row))
            best = rank[here, at]
            done = best == _NO_RANK
            if done.any():  # compaction: finished rows leave the matrix
                sizes = size.tolist()
                raw = ids[done].astype("<i4").tobytes()
                for k, r in enumerate(row[done].tolist()):
                    out[r] = raw[4 * width * k:4 * (width * k + sizes[r])]
                keep = ~done
                ids, rank, row, at, best = ids[keep], rank[keep], row[keep], at[keep], best[keep]
                if not len(row):
                    break
                here = np.arange(len(row))
            ids[here, at] = best
            source = np.arange(ids.shape[1]) + (np.arange(ids.shape[1]) > at[:, None])
            source[:, -1] = ids.shape[1] - 1
            shifted = np.take_along_axis(ids, source, 1)
            moved = np.take_along_axis(rank, source, 1)
            shifted[:, -1], moved[:, -1] = -1, _NO_RANK
            # Entries right of the merged one came from one place further on.
            ids, rank = shifted, moved
            size[row] -= 1
            after = np.minimum(at + 1, ids.shape[1] - 1)
            rank[here, at] = np.where(at + 1 < ids.shape[1], self.pairs.merged(ids[here, at], ids[here, after]), _NO_RANK)
            before = np.maximum(at - 1, 0)
            rank[here, before] = np.where(at > 0, self.pairs.merged(ids[here, before], ids[here, at]), rank[here, before])
        return out

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """A pretoken of any length: all occurrences of the minimum rank in one round.

        Merging them together equals merging them one by one from the left as
        long as no pair that this makes has a lower rank; where one does, only
        the leftmost occurrence is merged.
        """
        rank = self.pairs.merged(ids[:-1], ids[1:])
        while len(rank) and (low := rank.min()) != _NO_RANK:
            spots = np.flatnonzero(rank == low)
            run = np.concatenate(([True], np.diff(spots) > 1))  # of neighbours, every second one
            first = np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))
            spots = spots[(np.arange(len(spots)) - first) % 2 == 0]
            merged, changed = self._apply(ids, rank, spots, low)
            if len(spots) > 1 and (changed < low).any():
                merged, _ = self._apply(ids, rank, spots[:1], low)
            ids = merged
            rank = self.pairs.merged(ids[:-1], ids[1:])
        return ids

    def _apply(self, ids, rank, spots, low):
        out = ids.copy()
        out[spots] = low
        out = np.delete(out, spots + 1)
        new = np.flatnonzero(out == low)
        around = np.concatenate([new[new > 0] - 1, new[new < len(out) - 1]])
        return out, self.pairs.merged(out[around], out[around + 1])

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian int32 bytes."""
        split = [self.pattern.findall(c) for c in chunks]
        distinct = list({p for pieces in split for p in pieces})
        code = dict(zip(distinct, self.encode_pieces([p.encode() for p in distinct])))
        return [code[p[0]] if len(p) == 1 else b"".join([code[x] for x in p]) for p in split]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> tuple[ByteBpe, ChunkCodes]:
    bpe = ByteBpe.from_file(path, pattern)
    return bpe, ChunkCodes(bpe.encode_chunks)


def encode_texts(texts: list[str], path: str, pattern: str) -> list[np.ndarray]:
    """Ids of each text."""
    _, codes = _codec(path, pattern)
    return [np.frombuffer(ids, "<i4") for ids in codes.codes(texts)]


def encode_decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Encode each text by the rank file at ``path``, decode the ids again.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by one
    blank), ``decoded_sha256`` (decoded bytes); with ``with_ids`` also ``ids``.
    ``path`` must be readable on every executor (it is part of the
    installation, not of the data).
    """
    schema = f"id {df.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        bpe, _ = _codec(path, pattern)
        for batch in slices(batches, 1000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            count, digest, decoded, kept = [], [], [], []
            for ids in encode_texts(texts, path, pattern):
                ids = ids.tolist()
                count.append(len(ids))
                digest.append(hashlib.sha256(" ".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids)
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                       pa.array(decoded, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(texts, run, schema).withColumnRenamed("id", id_col)

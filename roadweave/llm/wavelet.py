"""Operator 4: token ids in wavelet-matrix shards.

A shard holds a run of documents in ascending ``doc_id`` order and is one value of a Parquet table in the shared folder, so
that any store works; Parquet's codec compresses it. Layout, little-endian:
``WMX1``, documents (u32), tokens (u32), bit planes (u8), document ids (i64 each), document lengths (u32 each), then for
each plane from the highest bit down: number of zeros (u32), a rank directory (u32 before each block of 2048 bits) and
the packed bits. Each plane stores one bit a token in the order that stable partitions by the higher bits leave, so
``access``, ``rank``, ``select`` and ``occurrences`` work on the file's bytes without decoding it.

Edge cases: a null text is an empty document (one token, the end id); a very long text is never cut and may make a shard of
its own size; a null ``doc_id`` sorts first and is stored as the least 64-bit integer, which no document may have for an id;
repeated ids keep any order among themselves; an empty table makes no shard and no row; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from roadweave.llm.common import map_slices, schema, slices, table, texts
from roadweave.llm.words import END_ID, encoder
from roadweave.runtime import discard, stored

SHARD_TOKENS = 1 << 19
BLOCK = 2048  # bits between two entries of a rank directory
NULL_ID = -(1 << 63)
_HEAD = struct.Struct("<4sIIB")
SHARDS = schema("part int, shard int, start long, n_tokens long, n_docs long, payload binary")
READ = schema("part int, doc_id long, offset long, n_tokens long, ids_crc32 long, n_end_ids long")


def build(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    """The bytes of one shard."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    out = [_HEAD.pack(b"WMX1", len(doc_ids), len(ids), bits), np.asarray(doc_ids, "<i8").tobytes(), np.asarray(lengths, "<u4").tobytes()]
    blocks = -(-max(len(x), 1) // BLOCK)
    for b in range(bits - 1, -1, -1):
        one = (x >> x.dtype.type(b)).astype(np.uint8) & np.uint8(1)
        packed = np.packbits(one, bitorder="little")
        padded = np.zeros(blocks * BLOCK // 8, np.uint8)
        padded[: len(packed)] = packed
        ranks = np.zeros(blocks, "<u4")
        np.cumsum(np.bitwise_count(padded.view("<u8")).reshape(blocks, -1).sum(1, dtype=np.uint32)[:-1], out=ranks[1:])
        high = np.flatnonzero(one)
        out += [struct.pack("<I", len(x) - len(high)), ranks.tobytes(), padded.tobytes()]
        x = np.concatenate([x[np.flatnonzero(one == 0)], x[high]])
    return b"".join(out)


class Shard:
    """Queries on the bytes of one shard."""

    def __init__(self, data: bytes):
        magic, docs, self.n, self.bits = _HEAD.unpack_from(data)
        if magic != b"WMX1":
            raise ValueError("not a wavelet shard")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.lengths = np.frombuffer(data, "<u4", docs, at + 8 * docs)
        at += 12 * docs
        blocks = -(-max(self.n, 1) // BLOCK)
        self.zeros, self.ranks, self.planes = [], [], []
        for _ in range(self.bits):
            self.zeros.append(struct.unpack_from("<I", data, at)[0])
            self.ranks.append(np.frombuffer(data, "<u4", blocks, at + 4))
            self.planes.append(np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at + 4 + 4 * blocks))
            at += 4 + 4 * blocks + blocks * BLOCK // 8

    def _ones(self, level: int, i: int) -> int:
        """Set bits before position ``i`` of a plane."""
        block, rest = divmod(i, BLOCK)
        if not rest:
            return int(self.ranks[level][block]) if block < len(self.ranks[level]) else self.n - self.zeros[level]
        first = block * BLOCK // 8
        got = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][first : first + rest // 8]).sum())
        return got + (int(self.planes[level][first + rest // 8]) & ((1 << rest % 8) - 1)).bit_count()

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            one = self.planes[level][i >> 3] >> (i & 7) & 1
            value = value << 1 | int(one)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if one else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the first ``i`` tokens' occurrences of ``token`` lie after the last plane."""
        low = 0
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, i)
            low, i = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (low - a, i - b)
        return low, i

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` tokens."""
        low, high = self._range(token, i) if token < 1 << self.bits else (0, 0)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The position of the ``k``-th (from 0) such bit of a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def select(self, token: int, k: int) -> int:
        """The position of the ``k``-th (from 0) occurrence of ``token``."""
        low, high = self._range(token, self.n) if token < 1 << self.bits else (0, 0)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def _ones_at(self, level: int, places: np.ndarray) -> np.ndarray:
        """Set bits before each of many positions of a plane."""
        ranks, plane = np.append(self.ranks[level], self.n - self.zeros[level]).astype(np.int64), self.planes[level].view("<u8")
        words = np.append(np.cumsum(np.bitwise_count(plane).reshape(len(ranks) - 1, -1), axis=1, dtype=np.int64).ravel(), 0)
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        inside = np.where(word % (BLOCK // 64) > 0, words[word - 1], 0)
        part = np.bitwise_count(np.append(plane, np.uint64(0))[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        return ranks[places // BLOCK] + inside + part

    def ranks_of(self, token: int, places: np.ndarray) -> np.ndarray:
        """``rank`` of ``token`` at many positions at once."""
        if token >= 1 << self.bits or not self.n:
            return np.zeros(len(places), np.int64)
        at = np.append(places, 0).astype(np.int64)  # the last one is the range's start
        for level in range(self.bits):
            ones = self._ones_at(level, at)
            at = self.zeros[level] + ones if token >> (self.bits - 1 - level) & 1 else at - ones
        return at[:-1] - at[-1]

    def decode(self) -> np.ndarray:
        """All tokens, by undoing the partitions from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            z, up = self.zeros[level], np.empty(self.n, kind)
            up[np.flatnonzero(one == 0)] = x[:z]
            up[np.flatnonzero(one)] = x[z:] | kind(1 << (self.bits - 1 - level))
            x = up
        return x


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``row`` (its place in the table) and the ids with the end id, in the narrowest type that holds them."""

    def make():
        words = encoder(vocabulary)

        def work(cols: dict) -> dict:
            ids = [np.append(x, END_ID).astype(words.width).tobytes() for x in words.encode_all(cols["text"])]
            return {"doc_id": cols["doc_id"], "row": cols["row"], "ids": ids}

        return work

    return map_slices(texts(docs, F.monotonically_increasing_id().alias("row")), make, schema("doc_id long, row long, ids binary"))


def write_shards(ids: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row a shard, from the rows of ``encoded``; ``part`` and ``shard`` give the order, ``start`` the ids before it in
    its part.

    Ids, not texts, are dealt once, by ranges of ``doc_id`` (and of rows within one, as an id may hold a third of them); each
    task takes its range in order and closes a shard at ``shard_tokens``, so memory holds one shard (a document is never cut,
    so that a longer one makes a shard of its size).
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ids.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, width = to_arrow_schema(SHARDS), np.dtype(encoder(vocabulary).width)
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0

        def closed() -> pa.RecordBatch:
            x = np.frombuffer(b"".join(parts), width)
            row = [part, shard, start, len(x), len(names), build(names, [len(p) // width.itemsize for p in parts], x)]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, fields, strict=True)], schema=fields)

        for cols in slices(batches, "ids"):
            for doc_id, data in zip(cols["doc_id"], cols["ids"], strict=True):
                names.append(NULL_ID if doc_id is None else doc_id)
                parts.append(data)
                held += len(data) // width.itemsize
                if held >= shard_tokens:
                    yield closed()
                    shard, start, held = shard + 1, start + held, 0
                    names, parts = [], []
        if names:
            yield closed()

    return dealt.mapInArrow(run, SHARDS)


def read_shards(shards: DataFrame) -> DataFrame:
    """A row a document, from the shards' bytes: place in its part, length, checksum of its ids, and how often the end id is
    among them (1 unless the text itself names it), by ``rank`` at the document's ends."""

    def make():
        def work(cols: dict) -> dict:
            out: dict[str, list] = {f: [] for f in READ.names}
            for part, start, payload in zip(cols["part"], cols["start"], cols["payload"], strict=True):
                shard = Shard(payload)
                ids, ends = shard.decode(), np.cumsum(shard.lengths, dtype=np.int64)
                stops = np.diff(shard.ranks_of(END_ID, np.concatenate([[0], ends])))
                for doc_id, n, end, stop in zip(shard.doc_ids.tolist(), shard.lengths.tolist(), ends.tolist(), stops.tolist(), strict=True):
                    row = (part, None if doc_id == NULL_ID else doc_id, start + end - n, n, zlib.crc32(ids[end - n : end].astype("<u4")), stop)
                    for f, v in zip(out, row, strict=True):
                        out[f].append(v)
            return out

        return work

    return map_slices(shards.select("part", "start", "payload"), make, READ, text="payload")


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes the shards to the shared folder, reads them back and adds each document's global ``start``.

    A part's total is one row; their running sum has as many rows as the shuffle has partitions.
    """
    ids = stored(encoded(docs, vocabulary), "ids")
    shards = stored(write_shards(ids, vocabulary), "wavelet")
    discard(ids)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    read = read_shards(shards).join(parts, "part")
    return read.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "n_end_ids")


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark, table(spark, sf_dir, "documents"))

"""Operator 8: best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into groups of about ``GROUP``, each is packed by
best-fit decreasing, and dual feasible functions give a lower bound for its bin count. Bins with more room than ``OPEN`` go
on to the next round, where they are dealt into groups of ``FAN_IN`` times the size, so that left-over documents of many
groups meet and are packed again; the old bins stay if the new count is not lower. From then on a group that meets its
bound is certified and keeps its bins, those with gaps exchange further. Of certified groups, and of all after
``EXCHANGES`` rounds, only bins under half full go on (about one a group, so a round has a fraction of the last one's
pieces), until one group is left or ``ROUNDS`` are done. No group grows with the table, also where no length fits another.

Edge cases: null text is empty (one token, the end id); null ids are packed as any other; repeated rows are packed each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, schema, table, texts
from roadweave.llm.words import END_ID, encoder
from roadweave.runtime import stored

CAPACITY = 4096
GROUP = 10_000  # pieces a group
FAN_IN = 16  # first groups' worth of pieces in a group of later rounds
OPEN = 1 / 64  # of the capacity: bins with more room than this go on
EXCHANGES, ROUNDS = 3, 16
PIECES = schema("doc_id long, piece int, start long, length long, ids_crc32 long")
PACKED = schema("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, settled boolean, certified boolean")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of two families of dual feasible functions, over all their parameters (the first) and k to 20."""
    if not len(lengths):
        return 0
    x = np.asarray(lengths, np.int64)
    count = np.bincount(x, minlength=capacity + 1)
    n, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    small = np.arange(0, capacity // 2 + 1)  # sizes under it count nothing, sizes over capacity minus it a whole bin
    big = n[-1] - n[capacity - small]
    mid = total[capacity - small] - np.where(small > 0, total[np.maximum(small - 1, 0)], 0)
    best = int((big + -(-mid // capacity)).max())
    for k in range(1, 21):
        y = (k + 1) * x
        whole = y % capacity == 0
        scaled = np.where(whole, x * k, y // capacity * capacity).sum()  # f(x) * k
        best = max(best, -(-int(scaled) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the room of each bin; ``rooms`` has a bit for each room that an open bin has."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        free[b] = left
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(b)
    return bins, offsets, np.asarray(free, np.int64)


def cut(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents."""

    def make():
        words = encoder(vocabulary)

        def work(cols: dict) -> dict:
            out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, found in zip(cols["doc_id"], words.encode_all(cols["text"]), strict=True):
                ids = np.append(found, END_ID).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for c, v in zip(out, (doc_id, k, at, len(part), zlib.crc32(part)), strict=True):
                        out[c].append(v)
            return out

        return work

    return map_slices(texts(docs), make, PIECES)


def pack_group(rows: pd.DataFrame, capacity: int, exchange: bool, last: bool) -> pd.DataFrame:
    """One group. ``sequence_id`` has its number above 32 bits; rows of bins that go on are not settled."""
    rows = rows.sort_values(["doc_id", "piece", "length", "ids_crc32"], kind="stable", ignore_index=True)
    bins, offsets, free = best_fit_decreasing(rows["length"].to_numpy(), capacity)
    certified = len(free) == lower_bound(rows["length"].to_numpy(), capacity)
    if "sequence_id" in rows and rows["sequence_id"].nunique() <= len(free):  # the old bins are as good
        out = rows[["sequence_id", "offset"]]
        room = capacity - rows.groupby("sequence_id")["length"].transform("sum")
    else:
        out = pd.DataFrame({"sequence_id": rows["stamp"].iloc[0] + bins if len(rows) else bins, "offset": offsets})
        room = pd.Series(free[bins] if len(rows) else bins)
    settled = last | (room.to_numpy() <= (capacity * OPEN if exchange and not (certified and "sequence_id" in rows) else capacity / 2))
    return rows[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=out["sequence_id"].to_numpy(), offset=out["offset"].to_numpy(), settled=settled, certified=certified)


def _packer(capacity: int, exchange: bool, last: bool):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_group(rows, capacity, exchange, last)

    return packed


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """All pieces with ``sequence_id`` and ``offset``; ``pieces`` is read more than once."""
    done, todo, level = [], pieces, 0
    while True:
        parts = max(1, -(-todo.count() // (group * FAN_IN if level else group)))
        last = parts == 1 or level == ROUNDS
        # Rows are dealt by their places at first, as one id may hold a third of them, then by bins.
        key = F.xxhash64("sequence_id", F.lit(level)) if level else F.xxhash64(F.monotonically_increasing_id())
        dealt = todo.withColumn("dealt", F.pmod(key, F.lit(parts)).cast("long"))
        dealt = dealt.withColumn("stamp", F.lit(level).cast("long") * F.lit(1 << 56) + F.col("dealt") * F.lit(1 << 32))
        got = stored(dealt.groupBy("dealt").applyInPandas(_packer(capacity, level < EXCHANGES, last), PACKED), "packed")
        done.append(got.where("settled"))
        if last:
            return reduce(DataFrame.unionByName, done).drop("settled")
        todo, level = got.where("not settled").drop("settled", "certified"), level + 1


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(stored(cut(table(spark, sf_dir, "documents")), "pieces"))

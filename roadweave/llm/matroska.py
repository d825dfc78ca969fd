"""Operator 6: Matroska bytes as packet tables.

``parse`` walks EBML elements (variable-length ids and sizes, unknown sizes too), clusters, simple blocks and block
groups, undoes Xiph, EBML and fixed-size lacing, reads cues and tracks, and gives a row a frame: track, cluster, timestamp,
byte range. The frames of a lace follow each other by their track's default duration, where it has one; a block group's
frames are key frames unless the group refers to another block, wherever in the group that is said. ``mux`` writes a file of
one PCM track. The query writes each text's bytes, padded with blanks to frames of 192, as 8-bit samples in such files to a
table in the shared folder, reads the files back, parses them and works on what the packet table points at.

Edge cases: a null or empty text is one frame of blanks; a very long text is one file, in one row; elements that the parser
does not know are skipped; a damaged file raises ``ValueError``, which ``packets`` turns into a row with ``error`` (null if
none) and no packet; repeated rows give repeated results; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, schema, table, texts
from roadweave.runtime import stored

FRAME = 192  # samples
RATE = 8000  # samples a second
LACE = 8  # frames a block
CLUSTER_BLOCKS = 32
SCALE = 1_000_000  # nanoseconds a tick
PACKETS = schema("doc_id long, packet long, track int, cluster int, timestamp_ns long, keyframe boolean, lacing int, byte_start long, byte_end long, error string")
OUT = schema("doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")

# Element ids of the public format.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, TRACK_ENTRY, TRACK_NUMBER, CODEC_ID, DEFAULT_DURATION = 0x2AD7B1, 0xAE, 0xD7, 0x86, 0x23E383
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
_PARENTS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS}
_TOP = {INFO, TRACKS, CLUSTER, CUES}


def element_id(data: bytes, at: int) -> tuple[int, int]:
    """The id at ``at``, marker bit kept, and the place after it."""
    n = 9 - data[at].bit_length()
    if n > 4:
        raise ValueError(f"no element id at {at}")
    return int.from_bytes(data[at : at + n], "big"), at + n


def size(data: bytes, at: int) -> tuple[int | None, int]:
    """The variable-length integer at ``at``, ``None`` if unknown (all ones), and the place after it."""
    n = 9 - data[at].bit_length()
    if n > 8 or at + n > len(data):
        raise ValueError(f"no size at {at}")
    value = int.from_bytes(data[at : at + n], "big") & ((1 << 7 * n) - 1)
    return (None if value == (1 << 7 * n) - 1 else value), at + n


def signed(data: bytes, at: int) -> tuple[int, int]:
    """A difference of sizes in EBML lacing."""
    n = 9 - data[at].bit_length()
    if n > 8:
        raise ValueError(f"no size at {at}")
    return (int.from_bytes(data[at : at + n], "big") & ((1 << 7 * n) - 1)) - ((1 << 7 * n - 1) - 1), at + n


def laces(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames; ``lacing`` is 0 none, 1 Xiph, 2 fixed size, 3 EBML."""
    if not lacing:
        return [(at, end)]
    count, at = data[at] + 1, at + 1
    if lacing == 2:
        each, odd = divmod(end - at, count)
        if odd:
            raise ValueError("frames of unequal size in fixed-size lacing")
        return [(at + k * each, at + (k + 1) * each) for k in range(count)]
    sizes: list[int] = []
    for k in range(count - 1):
        if lacing == 1:
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            n, at = n + data[at], at + 1
        elif k == 0:
            first, at = size(data, at)
            n = first or 0
        else:
            change, at = signed(data, at)
            n = sizes[-1] + change
        sizes.append(n)
    out = []
    for n in [*sizes, end - at - sum(sizes)]:
        if n < 0 or at + n > end:
            raise ValueError("a frame reaches past its block")
        out.append((at, at + n))
        at += n
    return out


@dataclass
class Media:
    """Packets are ``(track, cluster, timestamp in nanoseconds, keyframe, lacing, start, end)``."""

    scale: int = SCALE
    tracks: list[int] = field(default_factory=list)
    codecs: list[str] = field(default_factory=list)
    durations: dict[int, int] = field(default_factory=dict)  # nanoseconds of a frame, by track
    clusters: list[int] = field(default_factory=list)  # their places
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster's place from the segment's start
    segment: int = 0
    packets: list[tuple[int, int, int, bool, int, int, int]] = field(default_factory=list)


def parse(data: bytes) -> Media:
    out, base = Media(), 0
    cue, entry = [0, 0], [0, 0]  # time and track of a cue; number and default duration of a track
    blocks: list[list] = []  # track, cluster, ticks, keyframe, lacing, ranges
    group = [0, False]  # the blocks before a group, and whether it refers to another block
    top, after = element_id(data, 0) if data else (0, 0)
    if top != EBML:
        raise ValueError("no EBML header")
    head, after = size(data, after)
    todo = [(after + (head or 0), len(data), 0)]  # place, end, parent

    def closed(kind: int) -> None:
        if kind == BLOCK_GROUP and group[1]:
            for block in blocks[group[0] :]:
                block[3] = False
        elif kind == TRACK_ENTRY:
            out.tracks.append(entry[0])
            if entry[1]:
                out.durations[entry[0]] = entry[1]

    try:
        while todo:
            at, stop, parent = todo.pop()
            while at < stop:
                began = at
                kind, at = element_id(data, at)
                length, at = size(data, at)
                if length is None:  # the element ends where one of its parent's level starts
                    end = stop
                elif at + length > stop:
                    raise ValueError(f"element at {began} reaches past its parent")
                else:
                    end = at + length
                if kind in _PARENTS:
                    if kind == SEGMENT:
                        out.segment = at
                    elif kind == CLUSTER:
                        out.clusters.append(began)
                    elif kind == BLOCK_GROUP:
                        group = [len(blocks), False]
                    elif kind == TRACK_ENTRY:
                        entry = [0, 0]
                    if parent == CLUSTER and kind in _TOP:  # ends a cluster of unknown size
                        parent = SEGMENT
                    todo.append((end, stop, parent))
                    stop, parent = end, kind
                    continue
                value = int.from_bytes(data[at:end], "big") if end - at <= 8 else 0
                if kind in (SIMPLE_BLOCK, BLOCK):
                    track, p = size(data, at)
                    flags = data[p + 2]
                    lacing = flags >> 1 & 3
                    ticks = base + int.from_bytes(data[p : p + 2], "big", signed=True)
                    key = bool(flags & 0x80) if kind == SIMPLE_BLOCK else True
                    blocks.append([track or 0, len(out.clusters) - 1, ticks, key, lacing, laces(data, p + 3, end, lacing)])
                elif kind == CLUSTER_TIMESTAMP:
                    base = value
                elif kind == REFERENCE:
                    group[1] = True
                elif kind == TIMESTAMP_SCALE:
                    out.scale = value
                elif kind == TRACK_NUMBER:
                    entry[0] = value
                elif kind == DEFAULT_DURATION:
                    entry[1] = value
                elif kind == CODEC_ID:
                    out.codecs.append(data[at:end].rstrip(b"\0").decode("ascii", "replace"))
                elif kind == CUE_TIME:
                    cue[0] = value
                elif kind == CUE_TRACK:
                    cue[1] = value
                elif kind == CUE_CLUSTER:
                    out.cues.append((cue[0], cue[1], value))
                at = end
            closed(parent)
    except IndexError:
        raise ValueError("the file ends inside an element") from None
    for track, cluster, ticks, key, lacing, ranges in blocks:
        step = out.durations.get(track, 0)
        out.packets += [(track, cluster, ticks * out.scale + k * step, key, lacing, a, b) for k, (a, b) in enumerate(ranges)]
    return out


def element(kind: int, body: bytes) -> bytes:
    n = next(k for k in range(1, 9) if len(body) < (1 << 7 * k) - 1)
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + (len(body) | 1 << 7 * n).to_bytes(n, "big") + body


def number(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _laced(frames: list[bytes], lacing: int) -> bytes:
    if not lacing or lacing == 2:
        return (bytes([len(frames) - 1]) if lacing else b"") + b"".join(frames)
    sizes = [len(f) for f in frames]
    head = bytes([len(frames) - 1])
    if lacing == 1:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif len(sizes) > 1:
        head += (sizes[0] | 1 << 28).to_bytes(4, "big")
        head += b"".join((b - a + (1 << 27) - 1 | 1 << 28).to_bytes(4, "big") for a, b in zip(sizes, sizes[1:-1], strict=False))
    return head + b"".join(frames)


def mux(payload: bytes, lacing: int = 2, frame: int = FRAME) -> bytes:
    """One track of 8-bit samples: blocks of ``LACE`` frames, clusters of ``CLUSTER_BLOCKS`` blocks, a cue a cluster."""
    audio = element(0xE1, element(0xB5, struct.pack(">d", RATE)) + number(0x9F, 1) + number(0x6264, 8))
    entry = element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(0x73C5, 1) + number(0x83, 2) + number(DEFAULT_DURATION, frame * 10**9 // RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio)
    parts = [element(INFO, number(TIMESTAMP_SCALE, SCALE)), element(TRACKS, entry)]
    at, cues, block = sum(map(len, parts)), [], frame * (LACE if lacing else 1)
    for c in range(0, len(payload), block * CLUSTER_BLOCKS):
        time = c * 1000 // RATE
        blocks = []
        for p in range(c, min(len(payload), c + block * CLUSTER_BLOCKS), block):
            body = payload[p : p + block]
            count = -(-len(body) // frame)
            if lacing == 2 and len(body) == count * frame:
                body = bytes([count - 1]) + body
            else:
                body = _laced([body[k : k + frame] for k in range(0, len(body), frame)], lacing)
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + (p * 1000 // RATE - time).to_bytes(2, "big", signed=True) + bytes([0x80 | lacing << 1]) + body))
        parts.append(element(CLUSTER, number(CLUSTER_TIMESTAMP, time) + b"".join(blocks)))
        cues.append(element(CUE_POINT, number(CUE_TIME, time) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    header = element(EBML, number(0x4286, 1) + number(0x42F7, 1) + number(0x42F2, 4) + number(0x42F3, 8) + element(0x4282, b"matroska") + number(0x4287, 4) + number(0x4285, 2))
    return header + element(SEGMENT, b"".join(parts))


def packets(media: DataFrame, column: str = "media") -> DataFrame:
    """A row a packet of each file in the binary ``column``; ranges are places in the file."""

    def make():
        def work(cols: dict) -> dict:
            out: dict[str, list] = {f: [] for f in PACKETS.names}
            for doc_id, data in zip(cols["doc_id"], cols["media"], strict=True):
                try:
                    m = parse(data or b"")
                    rows = [(doc_id, k, *packet, None) for k, packet in enumerate(m.packets)]
                except ValueError as e:
                    rows = [(doc_id, *[None] * 8, str(e))]
                for row in rows:
                    for f, v in zip(PACKETS.names, row, strict=True):
                        out[f].append(v)
            return out

        return work

    return map_slices(media.select(F.col("doc_id").cast("long"), F.col(column).alias("media")), make, PACKETS, text="media")


def media(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of a text's bytes and the file that holds them."""

    def make():
        def work(cols: dict) -> dict:
            raw = [text.encode() for text in cols["text"]]
            files = [mux(x.ljust(max(1, -(-len(x) // FRAME)) * FRAME)) for x in raw]
            return {"doc_id": cols["doc_id"], "n_bytes": [len(x) for x in raw], "media": files}

        return work

    return map_slices(texts(docs), make, schema("doc_id long, n_bytes long, media binary"))


def features(files: DataFrame) -> DataFrame:
    """The payload that each file's packets point at, and ``feature``: packets, clusters, cues, last timestamp in ms, least
    and greatest sample."""

    def make():
        def work(cols: dict) -> dict:
            out: dict[str, list] = {f: [] for f in OUT.names}
            for doc_id, n, data in zip(cols["doc_id"], cols["n_bytes"], cols["media"], strict=True):
                m = parse(data)
                back = b"".join([data[a:b] for *_, a, b in m.packets])
                feature = f"packets={len(m.packets)};clusters={len(m.clusters)};cues={len(m.cues)};last_ms={m.packets[-1][2] // 1_000_000};min={min(back)};max={max(back)}"
                row = (doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature)
                for f, v in zip(OUT.names, row, strict=True):
                    out[f].append(v)
            return out

        return work

    return map_slices(files, make, OUT, text="media")


def op6_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(stored(media(table(spark, sf_dir, "documents")), "media"))

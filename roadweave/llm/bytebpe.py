"""Operator 9: byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation works on arrays of code points. A table gives each code point its class; a look at the neighbours (one
before, two after) refines it, so that a piece's start is known from the class and the automaton's state before it.
Each position is then a transition function on states, and an associative scan composes them: functions that are
constant end the scan at their place at once, the others (apostrophes and the letters after them) double their reach
until they are constant too. The slices between the boundaries feed pair merging behind a cache.

Edge cases: a null or empty text has no tokens and decodes to no bytes; other columns are ignored; repeated rows give
repeated results; a very long piece is merged with a heap instead of rescans; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from roadweave.llm.common import Bounded, map_slices, schema, table, texts

CACHE_ENTRIES = 250_000
LONG_PIECE = 200  # bytes; longer ones are merged with a heap
OUT = schema("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

# Classes of code points.
OTHER, LETTER, NUMBER, BLANK, WHITE, QUOTE = range(6)
# States: what the piece before a position is, as far as it matters for the next position.
S_WORD, S_OTHER, S_JOIN, S_ONE, S_TWO, S_END = range(6)  # JOIN: a blank that the next piece takes; ONE, TWO: letters of a contraction to come
_ONE_LETTER, _TWO_LETTERS = "stmd", ("re", "ve", "ll")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@cache
def classes() -> np.ndarray:
    """The class of each code point, by its general category; white space is the White_Space property."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        first = unicodedata.category(chr(c))[0]
        if first in "LN":
            kinds[c] = LETTER if first == "L" else NUMBER
    for a, b in ((0x9, 0xD), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        kinds[a : b + 1] = WHITE
    kinds[0x20], kinds[0x27] = BLANK, QUOTE
    return kinds


def _shifted(x: np.ndarray, by: int, fill: int) -> np.ndarray:
    out = np.full_like(x, fill)
    if by > 0:
        out[by:] = x[:-by]
    else:
        out[:by] = x[-by:]
    return out


def scan_states(constant: np.ndarray, where: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The state after each position: ``constant`` where a function is, else found by composing ``functions`` at ``where``.

    ``functions[i, s]`` is the state after ``where[i]`` if the state before it is ``s``. An associative scan: in each
    round a composite joins the one that ends right before it, and leaves the scan once that is a constant.
    """
    state = constant.copy()
    span = np.ones(len(where), np.int64)
    slot = np.full(len(constant), -1, np.int64)
    slot[where] = np.arange(len(where))
    active = np.arange(len(where))
    while len(active):
        before = where[active] - span[active]
        known = slot[before] < 0
        ready = active[known]
        state[where[ready]] = functions[ready, state[before[known]]]
        rest, other = active[~known], slot[before[~known]]
        functions[rest], span[rest] = np.take_along_axis(functions[rest], functions[other], 1), span[rest] + span[other]
        slot[where[ready]] = -1
        active = rest
    return state


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces start; ``first`` marks the first code point of each text (a text ends where the next starts)."""
    n = len(points)
    kind = classes()[points]
    nxt = _shifted(kind, -1, OTHER)
    ends = _shifted(first, -1, True)
    white = (kind == BLANK) | (kind == WHITE)
    stays = white & (ends | (nxt == BLANK) | (nxt == WHITE))  # white space before white space or the text's end
    prior_white = _shifted(white, 1, False) & ~first
    p1, p2 = _shifted(points, -1, 0), _shifted(points, -2, 0)
    ends2 = ends | _shifted(ends, -1, True)
    quote = np.flatnonzero((kind == QUOTE) & ~ends)
    a, b = p1[quote], p2[quote]
    one = np.isin(a, [ord(c) for c in _ONE_LETTER])
    two = np.zeros(len(quote), bool)
    for x, y in _TWO_LETTERS:
        two |= (a == ord(x)) & (b == ord(y))
    two &= ~ends2[quote]
    constant = np.full(n, S_WORD, np.int8)
    constant[(kind == OTHER) | (kind == QUOTE)] = S_OTHER
    constant[(kind == BLANK) & ~stays] = S_JOIN
    # Not constant: a quote that may open a contraction, and the letters that it would take.
    opener = np.concatenate([quote[one], quote[two]])
    takes = np.concatenate([np.full(one.sum(), S_ONE, np.int8), np.full(two.sum(), S_TWO, np.int8)])
    functions = np.repeat(np.arange(6, dtype=np.int8)[None], 0, 0)
    where = np.zeros(0, np.int64)
    if len(opener):
        opens = np.repeat(takes[:, None], 6, 1)
        opens[:, [S_OTHER, S_JOIN]] = S_OTHER
        opens[first[opener]] = takes[first[opener]][:, None]
        letters = np.concatenate([quote[one] + 1, quote[two] + 1, quote[two] + 2])
        eats = np.tile(np.asarray([S_WORD] * 3 + [S_END, S_ONE, S_WORD], np.int8), (len(letters), 1))
        where = np.concatenate([opener, letters])
        functions = np.concatenate([opens, eats])
        head = first[where]
        where, functions = where[~head], functions[~head]
        constant[opener[first[opener]]] = takes[first[opener]]
    state = scan_states(constant, where, functions) if len(where) else constant
    before = _shifted(state, 1, S_END)
    same = kind == _shifted(kind, 1, OTHER)
    is_other = (kind == OTHER) | (kind == QUOTE)
    inside = np.where(white, stays & prior_white, np.where(is_other, (before == S_OTHER) | (before == S_JOIN), (same & (before == S_WORD)) | (before == S_JOIN)))
    inside |= (before == S_ONE) | (before == S_TWO)
    return np.flatnonzero(~inside | first)


class ByteEncoder:
    def __init__(self, path: str | None = None):
        with open(path or default_ranks(), "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for token, rank in self.ranks.items():
            words[rank] = token
        self.lengths = np.fromiter(map(len, words), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.pieces = Bounded(self._ids, CACHE_ENTRIES)

    def _ids(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        if rank is not None:
            return rank.to_bytes(4, "little")
        return np.asarray(self.merge(data) if len(data) <= LONG_PIECE else self.merge_long(data), "<u4").tobytes()

    def merge(self, data: bytes) -> list[int]:
        """Joins the leftmost pair of least rank until no pair has one."""
        get, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        pairs = [get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            least = min(pairs)
            if least == 1 << 30:
                break
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 30)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], 1 << 30)
        return [self.ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same result with a heap of pairs over a linked list."""
        n, get = len(data), self.ranks.get
        end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = nxt[i] if end[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], nxt[i], end[j] = stop, nxt[j], 0
            if nxt[j] < n:
                prev[nxt[j]] = i
                if (r := get(data[i : end[nxt[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[nxt[i]]))
            if (k := prev[i]) >= 0 and (r := get(data[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = nxt[i]
        return out

    def encode_all(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        joined = "".join(batch)
        if not joined:
            return [b""] * len(batch)
        sizes = np.fromiter(map(len, batch), np.int64, len(batch))
        at = np.cumsum(sizes) - sizes
        first = np.zeros(len(joined), bool)
        first[at[sizes > 0]] = True
        starts = boundaries(np.frombuffer(joined.encode("utf-32-le"), np.uint32), first)
        cuts = [*starts.tolist(), len(joined)]
        ids = list(map(self.pieces.__getitem__, [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]))
        bounds = np.searchsorted(starts, np.append(at, len(joined))).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def decode(self, ids: bytes) -> tuple[bytes, np.ndarray]:
        """The bytes, and the offset of each token among them."""
        tokens = np.frombuffer(ids, "<u4")
        sizes = self.lengths[tokens]
        offsets = np.cumsum(sizes) - sizes
        return self.bytes[np.repeat(self.starts[tokens] - offsets, sizes) + np.arange(int(sizes.sum()))].tobytes(), offsets


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id``, the ids (bytes of little-endian unsigned 32-bit integers) and each token's byte offset."""

    def make():
        encoder = ByteEncoder(ranks)

        def work(cols: dict) -> dict:
            ids = encoder.encode_all(cols["text"])
            return {"doc_id": cols["doc_id"], "ids": ids, "offsets": [encoder.decode(x)[1].tolist() for x in ids]}

        return work

    return map_slices(texts(docs), make, schema("doc_id long, ids binary, offsets array<long>"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and digests of ids and decoded bytes of all documents."""

    def make():
        encoder = ByteEncoder()

        def work(cols: dict) -> dict:
            ids = encoder.encode_all(cols["text"])
            return {
                "doc_id": cols["doc_id"],
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(encoder.decode(x)[0]).hexdigest() for x in ids],
            }

        return work

    return map_slices(texts(table(spark, sf_dir, "documents")), make, OUT)

"""Ids of the word-level BPE vocabulary, by the tokenizers library, looked up for all pieces of many texts at once.

The tokenizer's pattern never crosses a space or a line feed, its special tokens hold neither, and its normaliser
composes nothing across them, so a text's ids are those of its chunks between these two characters, in order. Texts of
Latin-1 characters (which NFC leaves alone) are lower-cased and cut here as the tokenizer's pattern does, as arrays over
all texts of a slice; each piece is looked up by two 64-bit hashes in a table of the pieces met so far, and the library's
model gives the ids of those that are new. Texts with other characters go through the whole library, chunk by chunk.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np

from roadweave.llm.common import Bounded

END_ID = 1  # appended to each document
MOST_PIECES = 1 << 20  # of a worker's table (about 45 bytes each), which is emptied when full
LONGEST = 64  # characters of a piece that is kept in it
_SLOT_BITS = 21
_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _classes() -> np.ndarray:
    """The tokenizer's classes of Latin-1 characters, in lower case."""
    out = np.full(256, _OTHER, np.uint8)
    for c in map(chr, range(256)):
        if c.isspace() and not "\x1c" <= c <= "\x1f":
            out[ord(c)] = _SPACE
        elif c.isnumeric():
            out[ord(c)] = _DIGIT
        elif c.isalpha():
            out[ord(c)] = _LETTER
    return out


def _byte_characters() -> dict[int, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {b: b for b in same} | {b: 0x100 + k for k, b in enumerate(rest)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(code: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes: runs of letters, runs of other signs, single digits, and an apostrophe with s t m d re ve ll."""
    kind = classes[code]
    start = np.empty(len(code), bool)
    start[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == _DIGIT
    quote = np.flatnonzero((code == 0x27) & start)
    if len(quote):
        padded = np.concatenate([code, np.zeros(3, code.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + size
        after = after[after < len(code)]
        start[after[kind[after] == _LETTER]] = True
    at = np.flatnonzero(start)
    sizes = np.diff(np.append(at, len(code)))
    real = kind[at] != _SPACE
    return at[real], sizes[real]


class WordEncoder:
    """Ids as unsigned 32-bit arrays, without the end id."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or default_vocabulary())
        self.model, self.alphabet, self.classes = self.library.model, _byte_characters(), _classes()
        self.chunks = Bounded(self._chunk, MOST_PIECES // 10)
        self._empty()

    def _empty(self) -> None:
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.keys = np.zeros((MOST_PIECES, 2), np.uint64)
        self.first, self.count = np.zeros(MOST_PIECES, np.int32), np.zeros(MOST_PIECES, np.int32)
        self.flat, self.n, self.used = np.zeros(MOST_PIECES, np.uint32), 0, 0

    def _chunk(self, chunk: str) -> list[int]:
        return self.library.encode(chunk, add_special_tokens=False).ids

    def _piece(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        if not text.isascii() or not text.isprintable():
            text = text.encode().decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.model.tokenize(text)]

    def _add(self, h: np.ndarray, g: np.ndarray, ids: list[list[int]]) -> np.ndarray:
        """Places of new pieces, by their hashes and ids."""
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        n, used, more = self.n, self.used, int(sizes.sum())
        if used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), more), np.uint32)])
        self.flat[used : used + more] = np.fromiter(chain.from_iterable(ids), np.uint32, more)
        places = np.arange(n, n + len(ids))
        self.keys[places, 0], self.keys[places, 1] = h, g
        self.count[places], self.first[places] = sizes, used + np.cumsum(sizes) - sizes
        self.n, self.used = n + len(ids), used + more
        slot, todo = (h >> _U(64 - _SLOT_BITS)).astype(np.int64), np.arange(len(ids))
        while len(todo):  # of pieces that want one slot the first gets it, the others look on
            free = todo[self.slots[slot[todo]] < 0]
            winner = free[np.unique(slot[free], return_index=True)[1]]
            self.slots[slot[winner]] = places[winner]
            todo = np.setdiff1d(todo, winner, assume_unique=True)
            slot[todo] = (slot[todo] + 1) % len(self.slots)
        return places

    def _find(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Places in the table, -1 for pieces that it lacks."""
        slot, out, todo = (h >> _U(64 - _SLOT_BITS)).astype(np.int64), np.full(len(h), -1, np.int64), np.arange(len(h))
        while len(todo):
            k = self.slots[slot[todo]]
            hit = (k >= 0) & (self.keys[k, 0] == h[todo]) & (self.keys[k, 1] == g[todo])
            out[todo[hit]] = k[hit]
            todo = todo[(k >= 0) & ~hit]
            slot[todo] = (slot[todo] + 1) % len(self.slots)
        return out

    def _latin(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of lower-cased Latin-1 text, and the places of its pieces with the number of ids of each."""
        code = np.frombuffer(data, np.uint8)
        at, sizes = pieces(code, self.classes)
        if not len(at):
            return np.zeros(0, np.uint32), at, sizes
        begin = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
        letters = code[place + np.repeat(at, sizes)].astype(np.uint64) + _U(1)
        hashes = []
        for base in _BASES:
            powers = np.cumprod(np.full(int(sizes.max()), base))
            h = np.add.reduceat(letters * powers[place], begin)
            h = (h ^ (h >> _U(29))) * _BASES[1]
            hashes.append(h ^ (h >> _U(32)))
        h, g = hashes
        found = self._find(h, g)
        lost = np.flatnonzero(found < 0)
        if self.n + len(lost) > MOST_PIECES:
            self._empty()
            found = np.full(len(h), -1, np.int64)
            lost = np.arange(len(h))
        whole = lambda k: data[at[k] : at[k] + sizes[k]]
        _, one, which = np.unique(h[lost], return_index=True, return_inverse=True)
        one = lost[one]
        kept = (g[lost] == g[one][which]) & (sizes[lost] <= LONGEST)
        if len(one) and len(one) <= MOST_PIECES:
            fresh = sizes[one] <= LONGEST
            places = np.full(len(one), -1, np.int64)
            places[fresh] = self._add(h[one[fresh]], g[one[fresh]], [self._piece(whole(k)) for k in one[fresh].tolist()])
            found[lost[kept]] = places[which[kept]]
        own = {k: self._piece(whole(k)) for k in np.flatnonzero(found < 0).tolist()}  # such as very long ones
        n, first = self.count[found].astype(np.int64), self.first[found].astype(np.int64)
        flat = self.flat
        if own:
            rows = sorted(own)
            extra = np.fromiter((x for i in rows for x in own[i]), np.uint32)
            n[rows] = [len(own[i]) for i in rows]
            first[rows] = len(flat) + np.cumsum(n[rows]) - n[rows]
            flat = np.concatenate([flat, extra])
        done = np.cumsum(n) - n
        return flat[np.arange(int(n.sum())) + np.repeat(first - done, n)], at, n

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if "<|" not in text:
                try:
                    plain.append((k, text.lower().encode("latin-1")))
                    continue
                except UnicodeEncodeError:
                    pass
            out[k] = np.frombuffer(array("I", [i for c in text.replace("\n", " ").split(" ") for i in self.chunks[c]]), np.uint32)
        if plain:
            ids, at, n = self._latin(b"\n".join([data for _, data in plain]))
            ends = np.cumsum([len(data) + 1 for _, data in plain])
            total = np.concatenate([[0], np.cumsum(n)])
            for (k, _), part in zip(plain, np.split(ids, total[np.searchsorted(at, ends[:-1])]), strict=True):
                out[k] = part
        return out

    def encode(self, text: str) -> bytes:
        """One text's ids as little-endian bytes."""
        return self.encode_all([text])[0].astype("<u4").tobytes()

    @property
    def width(self) -> str:
        """The narrowest type that holds all ids."""
        return "<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


@lru_cache(maxsize=1)
def encoder(path: str | None = None) -> WordEncoder:
    """A worker process has one, whose table lasts over its tasks."""
    return WordEncoder(path)

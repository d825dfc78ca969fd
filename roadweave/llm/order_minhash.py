"""Operator 1: near duplicates by Order MinHash and banded alignment.

A document is the sequence of its words (runs of word characters, lower-cased). Its k-mers are five words (fewer than five
words make one), each labelled by its occurrence. An entry of the sketch takes the two least labelled k-mers under one hash
function and keeps them in text order, so that it agrees where texts agree in content and in order. ``ENTRIES`` entries are
kept; two texts are candidates if at least ``AGREE`` of them are equal. Of texts in which a tenth of the words is replaced,
about 94 % are candidates of each other, of those with a fifteenth replaced 99 %; the tests measure it.

Candidates are verified by a banded alignment of the two word sequences: with ``c`` aligned words of ``n`` and ``m``, the
similarity is ``c / (n + m - c)``, and 0.8 or more is a link. The band is the exact one for that threshold.

Equal word sequences are one node, so different texts of one id are nodes of their own. The search is whole, without caps:

1. In each bucket of equal entries every member is held against the bucket's leader (the member that meets most others), if
   they meet twice. That is one pair a member, and it joins groups of copies without expanding them into pairs.
2. Buckets that then still hold several components: each member outside the largest one is held against all members of
   other components. Members travel in blocks of ``BLOCK`` rows of one size (entries and word counts by ``BINS`` classes, no
   text); a pair goes on if enough entries agree and its common words, by an upper bound, can be enough for a link.

Word sequences travel as 32-bit hashes, one text in a row and never in arrays of texts; a worker holds one leader and the
partner at hand. Step 2 compares entries with the square of what a bucket holds outside its largest component.

Result: a row a document, ``class_id`` is the least ``doc_id`` of its component. An id with several texts may be the least of
several components, and one of rows without an id has none: ``class_key`` (the least row's text, as its SHA-256) and
``class_id`` together are one component's alone, and ``text_key`` tells the rows of one id apart. ``copies`` counts the rows
of the same word sequence, ``links`` the other word sequences it was verified to be linked with (a class is held together by
such links; pairs that are in one class already are not tried). Edge cases: texts without words (null and empty ones too)
are copies of each other; rows with a null ``doc_id`` take part, their ``class_id`` is null if the whole component has no
id; repeated rows share their class; a very long text is one row throughout; an empty table gives no rows; other columns are
ignored, whatever their names (``dedup`` keeps them).
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, schema, small_batches, table, texts
from roadweave.llm.components import components
from roadweave.runtime import discard, stored

WORDS = 5
SIMILARITY = 0.8
ENTRIES, AGREE = 24, 2
BINS = 256  # classes of words whose counts bound what two texts can have in common
PARTNERS = 64  # texts that travel with one copy of a leader
BLOCK = 256  # members of a bucket that travel together
SALTS = 16
STEPS = 24  # differences that are looked for along diagonals before whole rows are worked through
CHUNK = 1 << 15  # k-mers that are sketched at once
_U = np.uint64
_GOLD, _P, _Q = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_PAD = 0x2545F4914F6CDD1D


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit generator: a bijection that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _P
    x = (x ^ (x >> _U(27))) * _Q
    return x ^ (x >> _U(31))


def _multipliers(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _GOLD) | _U(1)


def word_hashes(lowered: str) -> tuple[np.ndarray, np.ndarray]:
    """Of every word of a lower-cased text: its 64-bit hash and where it starts."""
    code = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.concatenate([[False], _word_table()[code], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.cumprod(np.concatenate([[_U(1)], np.full(int(sizes.max()) - 1, _P)]))
    letters = (code[inside[1:-1]].astype(np.uint64) + _U(1)) * powers[place]
    return _mixed(np.add.reduceat(letters, first) + sizes.astype(np.uint64) * _GOLD), starts


@cache
def _word_table() -> np.ndarray:
    """Which code points belong to words, by the rule of the pattern ``\\w``."""
    return np.fromiter((chr(i).isalnum() or i == 0x5F for i in range(0x110000)), bool, 0x110000)


class Shingler:
    """Word hashes and sketches of whole texts; a text without words has none."""

    def words(self, texts: list[str]) -> list[np.ndarray]:
        """The 64-bit hashes of each text's words, in order."""
        lowered = [t.lower() for t in texts]
        h, starts = word_hashes("\n".join(lowered))
        ends = np.cumsum([len(t) + 1 for t in lowered])
        return np.split(h, np.searchsorted(starts, ends[:-1]))

    def flat(self, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-mers of texts that have words, and the number of each."""
        padded = [np.concatenate([w, np.full(WORDS - len(w), _PAD, np.uint64)]) if len(w) < WORDS else w for w in lists]
        x = np.concatenate(padded)
        h = x.copy()
        for j in range(1, WORDS):
            h[: len(x) - j] = _mixed(h[: len(x) - j]) + x[j:]
        sizes = np.asarray([len(p) for p in padded])
        ends = np.cumsum(sizes)
        keep = np.ones(len(x), bool)
        for j in range(1, WORDS):
            keep[ends - j] = False
        return _mixed(h[keep]), sizes - (WORDS - 1)

    def labelled(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Hashes that tell a k-mer's occurrences within a document apart: the first keeps its own."""
        x = _mixed(h + doc.astype(np.uint64) * _GOLD)
        s = np.sort(x)
        again = s[1:][s[1:] == s[:-1]]
        if not len(again):
            return h
        at = np.flatnonzero(np.isin(x, again))
        order = at[np.argsort(x[at], kind="stable")]
        same, place = np.zeros(len(order), bool), np.arange(len(order))
        same[1:] = x[order[1:]] == x[order[:-1]]
        rank = place - np.maximum.accumulate(np.where(same, 0, place))
        out = h.copy()
        out[order] = np.where(rank > 0, _mixed(h[order] + rank.astype(np.uint64) * _GOLD), h[order])
        return out

    def _entries(self, lists: list[np.ndarray], entries: int) -> np.ndarray:
        h, sizes = self.flat(lists)
        doc, starts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
        x = self.labelled(h, doc)
        low = _U((1 << int(sizes.max()).bit_length()) - 1)  # the low bits of a hash make room for its place
        place, top = (np.arange(len(h)) - starts[doc]).astype(np.uint64), _U(0xFFFFFFFFFFFFFFFF)
        out = np.empty((len(sizes), entries), np.uint64)
        for e, (a, salt) in enumerate(zip(_multipliers(entries), np.arange(1, entries + 1, dtype=np.uint64) * _GOLD, strict=True)):
            v = ((x * a) | low) ^ low | place
            one = starts + (np.minimum.reduceat(v, starts) & low).astype(np.int64)
            v[one] = top
            two = np.where(sizes > 1, starts + (np.minimum.reduceat(v, starts) & low).astype(np.int64), one)
            out[:, e] = _mixed(_mixed(_mixed(x[np.minimum(one, two)]) + x[np.maximum(one, two)]) + salt)
        return out

    def sketches(self, lists: list[np.ndarray], entries: int = ENTRIES) -> np.ndarray:
        """The entries of texts that have words, a row each."""
        parts, held, n = [], [], 0
        for w in lists:
            held.append(w)
            n += len(w)
            if n >= CHUNK:
                parts.append(self._entries(held, entries))
                held, n = [], 0
        if held:
            parts.append(self._entries(held, entries))
        return np.concatenate(parts).view(np.int64)


def profile(words: np.ndarray) -> bytes:
    """Counts by class up to 255 and what is above it, for the bound on common words."""
    n = np.bincount(words % BINS, minlength=BINS)
    return np.minimum(n, 255).astype(np.uint8).tobytes() + int(np.maximum(n - 255, 0).sum()).to_bytes(4, "little")


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most words that texts of these profiles (rows) can have in common."""
    over = lambda p: np.ascontiguousarray(p[:, BINS:]).view("<u4")[:, 0].astype(np.int64)
    return np.minimum(a[:, :BINS], b[:, :BINS]).sum(1, dtype=np.int64) + np.minimum(over(a), over(b))


def needed(n: int | np.ndarray, m: int | np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The fewest aligned words of a link."""
    return np.ceil(similarity * (np.asarray(n) + m) / (1 + similarity) - 1e-9).astype(np.int64)


def _run(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """Equal items from ``a[x]`` and ``b[y]`` on."""
    total, step = 0, 16
    while True:
        k = min(step, len(a) - x, len(b) - y)
        if k <= 0:
            return total
        differs = a[x : x + k] != b[y : y + k]
        first = int(differs.argmax())
        if differs[first]:
            return total + first
        total, x, y, step = total + k, x + k, y + k, step * 4


def _along_diagonals(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Common items if at most ``width`` are left out in all, else -1: furthest points, one difference more in each step."""
    n, m = len(a), len(b)
    far = np.full(2 * width + 5, -1, np.int64)
    mid = width + 2
    far[mid + 1] = 0
    for d in range(width + 1):
        ks = np.arange(-d, d + 1, 2)
        ks = ks[(ks >= -m) & (ks <= n)]
        down, right = far[mid + ks + 1], far[mid + ks - 1] + 1
        xs = np.where((ks == -d) | ((ks != d) & (right <= down)), down, right)
        ys = xs - ks
        live = (xs >= 0) & (xs < n) & (ys >= 0) & (ys < m)
        for i in np.flatnonzero(live)[a[xs[live]] == b[ys[live]]].tolist():
            xs[i] += _run(a, b, int(xs[i]), int(xs[i] - ks[i]))
        far[mid + ks] = np.where((xs <= n) & (xs - ks <= m), xs, -2)
        if ((xs == n) & (xs - ks == m)).any():
            return (n + m - d) // 2
    return -1


def _by_rows(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Common items of the alignments within the band, a row of the table as the bits of one number.

    A cleared bit is a place of ``a`` where the row's count goes up. Rows are worked through in runs, each with the bits
    that the band of its rows can reach; below them all is settled, above them nothing is aligned yet.
    """
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    n, other = len(a), b.tolist()
    whole, run = (1 << n) - 1, max(512, width)
    row = whole
    for j in range(0, len(other), run):
        low, high = max(0, j - width), min(n, j + run + width)
        if low >= n:
            break
        reach = (1 << high - low) - 1
        part = row >> low & reach
        for mask in map(at.__getitem__, other[j : j + run]):
            met = part & mask >> low
            if met:
                part = part + met | part - met
        row = row & ~(reach << low) | (part & reach) << low
    return n - row.bit_count()


def aligned(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """The most items in a common subsequence if at most ``width`` items are left out in all, else -1."""
    head = _run(a, b, 0, 0)
    a, b = a[head:], b[head:]
    tail = _run(a[::-1], b[::-1], 0, 0)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m, same = len(a), len(b), head + tail
    if abs(n - m) > width:
        return -1
    if not n or not m:
        return same
    if width <= STEPS or min(n, m) > 40 * STEPS:
        few = _along_diagonals(a, b, min(width, STEPS))
        if few >= 0 or width <= STEPS:
            return same + few if few >= 0 else -1
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]  # no others can be aligned
    width -= n - len(a) + m - len(b)
    if width < abs(len(a) - len(b)):
        return -1
    c = _by_rows(a, b, width)
    return same + c if len(a) + len(b) - 2 * c <= width else -1


def linked(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two word sequences are near copies."""
    n, m = len(a), len(b)
    if not n or not m:
        return n == m
    least = int(needed(n, m, similarity))
    return min(n, m) >= least and aligned(a, b, n + m - 2 * least) >= least


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, the text's SHA-256 and the row's number (``__row``, where the table has been numbered)."""
    row = F.col("__row") if "__row" in docs.columns else F.monotonically_increasing_id()
    return texts(docs, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_key"), row.alias("row"))


SKETCH = schema("row long, doc_id long, text_key binary, digest binary, entries array<long>, card binary, words binary")
CARD = 8 * ENTRIES + BINS + 4 + 4  # bytes: entries, profile, number of words


def sketched(docs: DataFrame) -> DataFrame:
    """Of each row: a digest of its words, the entries (none without words), the words, and a card of one size.

    The card holds the entries again, the profile and the number of words.
    """

    def make():
        shingler = Shingler()

        def work(cols: dict) -> dict:
            words = shingler.words(cols["text"])
            having = [k for k, w in enumerate(words) if len(w)]
            entries: list[list[int]] = [[] for _ in words]
            packed = [b""] * len(words)
            if having:
                for k, row in zip(having, shingler.sketches([words[k] for k in having]), strict=True):
                    entries[k], packed[k] = row.tolist(), row.tobytes()
            short = [w.astype("<u4") for w in words]
            cards = [e and e + profile(w) + len(w).to_bytes(4, "little") for e, w in zip(packed, short, strict=True)]
            digests = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
            return {"row": cols["row"], "doc_id": cols["doc_id"], "text_key": cols["text_key"], "digest": digests, "entries": entries, "card": cards, "words": [w.tobytes() for w in short]}

        return work

    return map_slices(keyed(docs), make, SKETCH, give_back=True)


class Roots(dict):
    """Union-find over integers: the least one of a set stands for it."""

    def root(self, x: int) -> int:
        while x in self:
            up = self[x]
            if up in self:
                self[x] = self[up]
            x = up
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.root(x), self.root(y)))
        if x != y:
            self[y] = x


def verified(pairs: DataFrame, held: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs that are linked, of ``a``, ``b`` and their labels ``la``, ``lb``; ``held`` has ``id`` and ``words``.

    A leader (``a``) travels once for about ``PARTNERS`` partners and is followed by them, a row each, so that a worker
    holds two texts. Labels that a task has joined already are not tried again in it.
    """
    # A leader may have a third of all texts as partners, so its pairs are counted, and meet their number, in SALTS places.
    dealt = pairs.withColumn("place", F.pmod(F.xxhash64("b", F.lit(1)), F.lit(SALTS)))
    parts = dealt.groupBy("a", "place").agg(F.count(F.lit(1)).alias("n"))
    many = parts.groupBy("a").agg(F.sum("n").alias("n"), F.collect_list("place").alias("places"))
    many = many.select("a", "n", F.explode("places").alias("place"))
    salted = dealt.join(many, ["a", "place"]).withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / PARTNERS))).drop("n", "place")
    columns = ["a", "salt", "la", "b", "lb", "words"]
    partner = salted.join(held.select(F.col("id").alias("b"), "words"), "b").select(*columns)
    none = F.lit(None).cast("long")
    leader = salted.select("a", "salt", "la").distinct().join(held.select(F.col("id").alias("a"), "words"), "a")
    leader = leader.select("a", "salt", "la", none.alias("b"), none.alias("lb"), "words")
    rows = leader.unionByName(partner).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def make():
        roots, lead = Roots(), [np.zeros(0, np.uint32)]

        def work(cols: dict) -> dict:
            out: dict[str, list] = {c: [] for c in ("a", "b", "la", "lb")}
            for a, la, b, lb, data in zip(cols["a"], cols["la"], cols["b"], cols["lb"], cols["words"], strict=True):
                words = np.frombuffer(data, "<u4")
                if b is None:
                    lead[0] = words
                elif roots.root(la) != roots.root(lb) and linked(lead[0], words, similarity):
                    roots.join(la, lb)
                    for c, v in zip(out, (a, b, la, lb), strict=True):
                        out[c].append(v)
            return out

        return work

    return map_slices(rows, make, schema("a long, b long, la long, lb long"), text="words", give_back=True)


def _cards(members: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, entries, profiles and numbers of words of a block."""
    data = np.frombuffer(b"".join([m["card"] for m in members]), np.uint8).reshape(len(members), CARD)
    at = 8 * ENTRIES
    n = np.ascontiguousarray(data[:, at + BINS + 4 :]).view("<u4")[:, 0].astype(np.int64)
    ids, labels = (np.fromiter((m[c] for m in members), np.int64, len(members)) for c in ("id", "label"))
    return ids, labels, np.ascontiguousarray(data[:, :at]).view("<i8"), data[:, at : at + BINS + 4], n


def met(left: list[dict], right: list[dict], key: int, largest: int, similarity: float) -> tuple[np.ndarray, ...]:
    """Pairs of two blocks of the bucket ``key`` that may be links: ids and labels.

    A pair belongs to its first common bucket; one that lies outside the largest component on both sides is in the blocks
    twice and counts with the lesser id on the left.
    """
    ia, la, ea, pa, na = _cards(left)
    ib, lb, eb, pb, nb = _cards(right)
    agree, here = np.zeros((len(ia), len(ib)), np.uint8), la[:, None] != lb[None]
    here &= (lb == largest)[None] | (ia[:, None] < ib[None])
    place = int(np.flatnonzero(ea[0] == key)[0])
    for e in range(ENTRIES):
        same = ea[:, e, None] == eb[None, :, e]
        if e < place:
            here &= ~same
        agree += same
    i, j = np.nonzero(here & (agree >= AGREE))
    least = needed(na[i], nb[j], similarity)
    fits = np.minimum(na[i], nb[j]) >= least
    i, j, least = i[fits], j[fits], least[fits]
    kept = [np.zeros(0, bool)]
    for k in range(0, len(i), 4096):
        kept.append(common(pa[i[k : k + 4096]], pb[j[k : k + 4096]]) >= least[k : k + 4096])
    fits = np.concatenate(kept)
    i, j = i[fits], j[fits]
    return ia[i], ib[j], la[i], lb[j]


def between(placed: DataFrame, held: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (``a``, ``b``, ``la``, ``lb``) that may be links between components: in every bucket of several components each
    member outside its largest one is held against all members of others. ``held`` has ``id`` and ``card``."""
    by_label = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    by_key = by_label.groupBy("key").agg(F.max(F.struct("n", "label")).alias("x"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    by_key = by_key.select("key", F.col("x.label").alias("largest"), blocks(F.col("n")).alias("all_blocks"), blocks(F.col("n") - F.col("x.n")).alias("out_blocks"))
    rows = placed.join(by_key, "key").join(held.select("id", "card"), "id")
    one = F.struct("id", "label", "card")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    right = rows.groupBy("key", block("all_blocks").alias("at")).agg(F.collect_list(one).alias("right"))
    left = rows.where("label <> largest").groupBy("key", "largest", "all_blocks", block("out_blocks").alias("block")).agg(F.collect_list(one).alias("left"))
    left = left.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)))
    ready = left.select("key", "largest", "at", "left").join(right, ["key", "at"]).select("key", "largest", "left", "right")

    def make():
        def work(cols: dict) -> dict:
            found = [met(x, y, key, largest, similarity) for key, largest, x, y in zip(cols["key"], cols["largest"], cols["left"], cols["right"], strict=True)]
            return {c: np.concatenate([f[k] for f in found]) for k, c in enumerate(("a", "b", "la", "lb"))}

        return work

    return map_slices(ready, make, schema("a long, b long, la long, lb long"), text="right", give_back=True)


def _grouped(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``row``, ``doc_id``, ``text_key`` and ``digest`` of every row; ``digest`` with its class's least row (``head``) and counts."""
    sketches = stored(sketched(docs), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "text_key", "row")).alias("x")
    nodes = sketches.groupBy("digest").agg(least, F.min("row").alias("id"), F.first("entries").alias("entries"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes, "nodes")
    buckets = nodes.select("id", F.explode("entries").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(buckets.join(shared, "key"), "members")  # texts that meet another in a bucket
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("meets")).where(F.col("meets") >= AGREE)
    held = sketches.select(F.col("row").alias("id"), "card", "words").join(weight.select("id"), "id", "left_semi")
    held = stored(held, "held")
    leaders = members.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", -F.col("id"))).alias("x")).select("key", (-F.col("x.col2")).alias("a"))
    first = members.join(leaders, "key").where("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= AGREE)
    first = stored(first.select("a", "b", F.col("a").alias("la"), F.col("b").alias("lb")), "pairs")
    with small_batches(docs.sparkSession):
        links = stored(verified(first, held, similarity), "links")
    labels = components(links)

    placed = members.select("key", "id").join(weight.select("id"), "id").join(labels, "id", "left")
    placed = stored(placed.select("key", "id", F.coalesce("label", "id").alias("label")), "placed")
    with small_batches(docs.sparkSession):
        later = stored(between(placed, held, similarity), "between")
        late = stored(verified(later, held, similarity), "late")
    joined = components(late.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("label").alias("joined"), F.col("id").alias("label"))

    both = links.unionByName(late)
    ends = both.select(F.col("a").alias("id")).unionByName(both.select(F.col("b").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    whole = nodes.select("digest", "id", "copies", F.col("x").alias("least")).join(labels, "id", "left").join(ends, "id", "left")
    whole = whole.withColumn("label", F.coalesce("label", "id")).join(joined, "label", "left").withColumn("class", F.coalesce("joined", "label"))
    classes = stored(whole.select("digest", "class", "least", "copies", F.coalesce("links", F.lit(0).cast("long")).alias("links")), "classes")
    discard(nodes, members, held, first, links, placed, later, late)
    # A class may hold a third of all texts, so its head goes to SALTS places; a text that is a class alone is its own head.
    heads = classes.groupBy("class").agg(F.min("least").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = classes.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).join(heads, ["class", "salt"], "left")
    return sketches.select("row", "doc_id", "text_key", "digest"), salted.select("digest", "copies", "links", F.coalesce("head", "least").alias("head"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``class_id``, ``representative`` (a row like the one of its class that a filter would keep), counts and keys."""
    rows, heads = _grouped(docs, similarity)
    out = rows.join(heads, "digest").select("doc_id", F.col("head.doc_id").alias("class_id"), "text_key", F.col("head.text_key").alias("class_key"), "copies", "links")
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))
    return out.select("doc_id", "class_id", first.alias("representative"), "copies", "links", F.lower(F.hex("text_key")).alias("text_key"), F.lower(F.hex("class_key")).alias("class_key"))


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they were. The rows are numbered in a stored table, by which they are chosen."""
    names = [f"__c{k}" for k in range(len(docs.columns))]  # the numbers may clash with the table's own names
    own = dict(zip(docs.columns, names, strict=True))
    numbered = stored(docs.toDF(*names).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    heads = _grouped(numbered.select(F.col(own["doc_id"]).alias("doc_id"), F.col(own["text"]).cast("string").alias("text"), "__row"), similarity)[1]
    chosen = heads.select(F.col("head.row").alias("__row")).distinct()
    return numbered.join(chosen, "__row", "left_semi").select(*names).toDF(*docs.columns)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

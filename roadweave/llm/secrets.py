"""Operator 2: secret scans by grammar inference.

The base patterns find spans in every whole text. Those of all documents are the labelled credentials. They are dealt into
formats, by kind and by the character classes that a string has; formats of fewer than ``LEAST`` strings join one of the same
kind that has all their classes, or are left out. In a format, heads that many strings share (such as a vendor's letters)
stay literal, signs stay literal, and all other characters are one symbol, "member". The strings, as sequences of these
symbols, make a prefix tree whose states are merged where their frequencies of symbols and ends are compatible (ALERGIA, a
Hoeffding bound, on pairs that both have been seen ``EVIDENCE`` times at least), which gives a probabilistic automaton with
the format's lengths and the places of its signs. A member's character has the format's own frequencies.

The background is the frequency of character pairs in all text that is no candidate. Every candidate in every text (base
spans, and every run of 16 or more credential characters) is scored by its log-likelihood under the best format less that
under the background, per character. Runs outside base spans become spans of kind ``inferred`` above ``MARGIN``; base spans
always stay. Spans are those of whole matches.

``scores`` has a score for each of ``spans``, ``best_score`` is the highest (null without spans), ``n_candidates`` counts
what was scored. Bounds: ``FIT_STRINGS`` distinct strings of a format are fitted, chosen by hash, of at most
``MOST_LENGTH`` characters (longer ones stay base spans and are scored, but give no automaton).

Edge cases: a null or empty text has no spans; without credentials nothing is inferred and base scores are null; repeated
rows give repeated results and count once in the fit; an empty table gives no rows; other columns are ignored, whatever
their names. Scans are linear in the text, also on very long ones.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, schema, table, texts
from roadweave.runtime import stored

FIT_STRINGS = 400  # of each format
LEAST = 20  # strings of a format
EVIDENCE = 10  # visits of either state that a test for merging needs
HEAD_SHARE = 0.1  # of a format's strings
MOST_LENGTH = 256
CONFIDENCE = 0.05  # of the test
MARGIN = 1.0  # nats a character
SMOOTH, UNSEEN = 0.1, 8  # a state's share for symbols it lacks, and how many they may be
UNIFORM = 0.1  # of the background, over all credential characters, so that no pair is too unlikely
KINDS = ("assign", "access", "hex", "inferred")
OUT = schema("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_inferred long, n_candidates long, scores string, best_score double")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_CLASSES = {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "H": "ABCDEF", "u": "GHIJKLMNOPQRSTUVWXYZ"}
_CLASS = {c: k for k, members in _CLASSES.items() for c in members}
_SIGNS = "+/_=-."
_PLACE = np.zeros(128, np.int64)  # of a credential character; 0 is the edge of a run
_PLACE[[ord(c) for c in "".join(_CLASSES.values()) + _SIGNS]] = np.arange(1, 69)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind's place, end, credential)`` by start, then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def signature(x: str) -> str:
    """The character classes of a string, signs apart."""
    found = {_CLASS.get(c) for c in x}
    return "".join(k for k in _CLASSES if k in found)


class Automaton:
    """A probabilistic automaton over sequences of symbols: counts of transitions and ends, smoothed when scored."""

    def __init__(self, strings: list[list[str]], confidence: float = CONFIDENCE):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [defaultdict(int)]  # by symbol, "" for the end
        for s in strings:
            at = 0
            for c in s:
                self.seen[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.seen.append(defaultdict(int))
                at = self.next[at][c]
            self.seen[at][""] += 1
        self.spread = math.sqrt(0.5 * math.log(2 / confidence))
        self._infer()
        choices = len({c for seen in self.seen for c in seen} | {""}) + 1
        total = [sum(seen.values()) + SMOOTH * choices for seen in self.seen]
        self.log = [{c: math.log((n + SMOOTH) / t) for c, n in seen.items()} | {None: math.log(SMOOTH / UNSEEN / t)} for seen, t in zip(self.seen, total, strict=True)]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two states, and those that equal symbols lead to, have like frequencies. Without a pair that has been seen
        often enough, only a state that does nothing new is compatible."""
        todo, tested, new = [(a, b)], False, False
        while todo:
            a, b = todo.pop()
            n, m = sum(self.seen[a].values()), sum(self.seen[b].values())
            if min(n, m) >= EVIDENCE:
                tested = True
                bound = self.spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                if any(abs(self.seen[a].get(c, 0) / n - self.seen[b].get(c, 0) / m) > bound for c in {*self.seen[a], *self.seen[b]}):
                    return False
            new |= not self.seen[b].keys() <= self.seen[a].keys()
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
        return tested or not new

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for c, n in self.seen[b].items():
                self.seen[a][c] += n
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _infer(self) -> None:
        """Red states are kept; each blue child of one joins the first compatible red state or becomes red."""
        red = [0]
        kept = {0}
        blue = [(0, c) for c in sorted(self.next[0])]
        while blue:
            parent, c = blue.pop(0)
            child = self.next[parent][c]
            if child in kept:
                continue
            for r in red:
                if self._compatible(r, child):
                    self.next[parent][c] = r
                    self._fold(r, child)
                    break
            else:
                red.append(child)
                kept.add(child)
            blue = [(r, x) for r in red for x in sorted(self.next[r]) if self.next[r][x] not in kept]
        place = {s: i for i, s in enumerate(red)}
        self.next = [{c: place[t] for c, t in self.next[s].items()} for s in red]
        self.seen = [self.seen[s] for s in red]

    def score(self, symbols: list[str]) -> float:
        """Log-likelihood; a symbol without a transition stays in the state at the smoothed cost."""
        at, total, log, nxt = 0, 0.0, self.log, self.next
        for c in symbols:
            row = log[at]
            total += row.get(c, row[None])
            at = nxt[at].get(c, at)
        return total + log[at].get("", log[at][None])


class Format:
    """The automaton of one format's strings, its heads and its characters."""

    def __init__(self, strings: list[str]):
        self.members = set().union(*(_CLASSES[k] for k in signature("".join(strings))))
        least = max(LEAST, HEAD_SHARE * len(strings))
        self.heads: list[str] = []
        for n in range(8, 1, -1):
            often = [p for p, k in Counter(s[:n] for s in strings if len(s) > n).items() if k >= least]
            self.heads += [p for p in sorted(often) if not any(h.startswith(p) for h in self.heads)]
        self.automaton = Automaton([self.symbols(s) for s in strings])
        seen = Counter(c for s in strings for c in s[len(self.head(s)) :] if c in self.members)
        total = sum(seen.values()) + 0.5 * len(self.members)
        self.log = {c: math.log((seen[c] + 0.5) / total) for c in self.members}

    def head(self, x: str) -> str:
        return next((h for h in self.heads if x.startswith(h)), "")

    def symbols(self, x: str) -> list[str]:
        n = len(self.head(x))
        return [*x[:n], *("member" if c in self.members else c for c in x[n:])]

    def score(self, x: str) -> float:
        unknown = math.log(1 / len(_PLACE))
        tail = x[len(self.head(x)) :]
        return self.automaton.score(self.symbols(x)) + math.fsum(self.log.get(c, 0.0 if c in _SIGNS else unknown) for c in tail)


class Background:
    """Pairs of characters within runs of credential characters, with a run's edges, from counts over all text."""

    def __init__(self, pairs: np.ndarray):
        single = pairs.sum(0) + 0.5
        single = single / single.sum()
        seen = (pairs + 5 * single) / (pairs.sum(1, keepdims=True) + 5)
        self.log = np.log((1 - UNIFORM) * seen + UNIFORM / len(pairs))

    def score(self, x: str) -> float:
        at = np.concatenate([[0], _PLACE[np.frombuffer(x.encode(), np.uint8)], [0]])
        return float(self.log[at[:-1], at[1:]].sum())


def pair_counts(text: str) -> np.ndarray:
    """Counts of neighbours in a text, as places of credential characters."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    at = np.concatenate([[0], _PLACE[np.where(code < 128, code, 0)], [0]])
    return np.bincount(at[:-1] * 69 + at[1:], minlength=69 * 69)


Models = tuple[list[Format], Background]


def fit(docs: DataFrame, strings: int = FIT_STRINGS) -> Models:
    """The formats of the credentials that all documents have, and the background of all text that is no candidate."""

    def make():
        def work(cols: dict) -> dict:
            rows: set[tuple[str, str]] = set()
            ordinary: list[str] = []
            for text in cols["text"]:
                done = 0
                base = base_spans(text)
                rows.update((KINDS[k], x) for _, k, _, x in base)
                for a, b in sorted([(a, b) for a, _, b, _ in base] + [m.span() for m in _CANDIDATE.finditer(text)]):
                    ordinary.append(text[done:a])
                    done = max(done, b)
                ordinary.append(text[done:])
            pairs = pair_counts(" ".join(ordinary))
            pairs[0] = 0  # between runs
            at = np.flatnonzero(pairs)
            kind, value = (list(x) for x in zip(*sorted(rows), strict=True)) if rows else ([], [])
            return {
                "kind": kind + ["pair"] * len(at),
                "signature": [signature(x) for x in value] + [""] * len(at),
                "value": value + [str(x) for x in at.tolist()],
                "n": [1] * len(value) + pairs[at].tolist(),
            }

        return work

    rows = map_slices(texts(docs), make, schema("kind string, signature string, value string, n long"))
    rows = stored(rows.where(F.length("value") <= MOST_LENGTH).groupBy("kind", "signature", "value").agg(F.sum("n").alias("n")), "credentials")
    pairs = np.zeros(69 * 69, np.int64)
    for r in rows.where("kind = 'pair'").collect():  # at most 69 x 69 rows
        pairs[int(r["value"])] = r["n"]
    found = rows.where("kind <> 'pair'")
    place = F.pmod(F.xxhash64("value"), F.lit(1 << 30))
    few = F.lit(False)  # about twice what is taken; a format is one of three kinds and 32 signatures
    for r in found.groupBy("kind", "signature").agg(F.count(F.lit(1)).alias("n")).collect():
        few |= (F.col("kind") == r["kind"]) & (F.col("signature") == r["signature"]) & (place <= int(min(1.0, 2 * strings / r["n"]) * (1 << 30)))
    by: dict[tuple[str, str], list[str]] = defaultdict(list)
    for r in found.where(few).select("kind", "signature", "value", place.alias("place")).orderBy("place", "value").toLocalIterator():
        if len(by[r["kind"], r["signature"]]) < strings:
            by[r["kind"], r["signature"]].append(r["value"])
    large = {k: v for k, v in by.items() if len(v) >= LEAST}
    for (kind, classes), some in sorted(by.items()):
        if len(some) < LEAST:
            wider = [k for k in large if k[0] == kind and set(classes) <= set(k[1])]
            if wider:
                large[min(wider, key=lambda k: (len(k[1]), k))] += some
    return [Format(large[k]) for k in sorted(large)], Background(pairs.reshape(69, 69))


def likeness(x: str, models: Models) -> float | None:
    """How much likelier a string is as a credential than as ordinary text, in nats a character."""
    formats, background = models
    best = max((f.score(x) for f in formats), default=None)
    return None if best is None else (best - background.score(x)) / max(1, len(x))


def scored(text: str, models: Models) -> tuple[list[tuple[int, int, int, float | None]], int]:
    """``(start, kind's place, end, score)`` of base and inferred spans, and the number of candidates."""
    base = base_spans(text)
    out = [(a, k, b, likeness(x, models)) for a, k, b, x in base]
    tried = len(out)
    for m in _CANDIDATE.finditer(text):
        if not any(a < m.end() and m.start() < b for a, _, b, _ in base):
            value = likeness(m[0], models)
            tried += 1
            if value is not None and value > MARGIN:
                out.append((m.start(), 3, m.end(), value))
    return sorted(out, key=lambda x: x[:3]), tried


def scan(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """Every document's counts, spans and scores."""
    models = models or fit(docs)

    def make():
        def work(cols: dict) -> dict:
            out: dict[str, list] = {f: [] for f in OUT.names}
            for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
                found, tried = scored(text, models)
                say = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)
                base = [x for x in found if x[1] < 3]
                counts = [sum(x[1] == i for x in found) for i in range(4)]
                scores = [x[3] for x in found if x[3] is not None]
                digest = hashlib.sha256(say(base).encode()).hexdigest()
                row = (doc_id, *counts[:3], digest, say(found), counts[3], tried, ",".join(f"{x:.2f}" for x in scores), max(scores, default=None))
                for f, v in zip(OUT.names, row, strict=True):
                    out[f].append(v)
            return out

        return work

    return map_slices(texts(docs), make, OUT)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))

"""Operator 5: personal data by patterns, validators and context.

Patterns propose spans; e-mail, ip (parts to 255), card (Luhn) and phone (8 to 15 digits) are base kinds and always stay
when valid. Two more kinds are added: ``iban`` (mod-97) and ``ssn``, the latter only if words nearby raise its score.
Each span's score starts with its validator's strength and gains from context words within ``REACH`` code points.

Edge cases: a null or empty text has no spans; repeated rows give repeated results; an empty table gives no rows; other
columns are ignored (``mask`` keeps them). Scans are linear in the text, also on long runs without spaces: no pattern tries
more than one way through a run, and an account number is walked by hand for 34 signs at most.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, schema, table, texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
REACH = 40
ACCEPT = 0.6
STRENGTH = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.45}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "konto", "bank", "cuenta", "compte"),
    "ssn": ("ssn", "social security", "taxpayer"),
}
_NEAR = {k: re.compile(rf"\b(?:{'|'.join(words)})") for k, words in CONTEXT.items()}
OUT = schema("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, best_score double")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_IBAN_LENGTHS = (15, 34)
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_DROP = str.maketrans("", "", " -().+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (d if i % 2 == 0 else 2 * d - 9 * (d > 4))
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each ``@`` outwards; no character is visited twice leftwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))
    return out


def _iban_end(text: str, start: int) -> int:
    """The end of the longest valid number from ``start``, or 0; groups are parted by single blanks. At most 34 signs are read."""
    signs, ends, at = [], [], start
    while len(signs) < _IBAN_LENGTHS[1] and at < len(text):
        if text[at] in _IBAN_SIGNS:
            signs.append(text[at])
        elif text[at] != " " or text[at - 1] == " ":
            break
        at += 1
        if text[at - 1] != " " and len(signs) >= _IBAN_LENGTHS[0] and not (at < len(text) and text[at].isascii() and text[at].isalnum()):
            ends.append((at, len(signs)))
    return next((end for end, n in reversed(ends) if mod97("".join(signs[:n]))), 0)


def ibans(text: str) -> list[tuple[int, int]]:
    """Valid account numbers; the search goes on after one, or at the next head if none starts here."""
    out, done = [], 0
    for m in _IBAN_HEAD.finditer(text):
        if m.start() >= done:
            end = _iban_end(text, m.start())
            if end:
                out.append((m.start(), end))
                done = end
    return out


def spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind's place, start, end)`` of all valid matches, by kind, then start."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].translate(_DROP)
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(m[0].translate(_DROP)) <= 15]
    found += [(4, a, b) for a, b in ibans(text)]
    found += [(5, m.start(), m.end()) for m in _SSN.finditer(text)]
    return found


def score(text: str, kind: int, start: int, end: int) -> float:
    name = KINDS[kind]
    near = (text[max(0, start - REACH) : start] + " " + text[end : end + REACH]).lower()
    return min(1.0, STRENGTH[name] + (0.3 if _NEAR[name].search(near) else 0.0))


def detect(text: str) -> list[tuple[int, int, int, float]]:
    """Base spans and those added ones whose score is accepted, with scores."""
    scored = [(k, a, b, score(text, k, a, b)) for k, a, b in spans(text)]
    base = [x for x in scored if x[0] < 4]
    return base + [x for x in scored if x[0] >= 4 and x[3] >= ACCEPT and not any(a < x[2] and x[1] < b for _, a, b, _ in base)]


def find(docs: DataFrame) -> DataFrame:
    """Every document's counts and spans."""

    def make():
        def work(cols: dict) -> dict:
            out: dict[str, list] = {f: [] for f in OUT.names}
            for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
                got = detect(text)
                say = [f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in got]
                base = [k for k, *_ in got if k < 4]
                row = (doc_id, *(base.count(k) for k in range(4)), hashlib.sha256(",".join(say[: len(base)]).encode()).hexdigest(), ",".join(say), len(got) - len(base), max((x[3] for x in got), default=None))
                for f, v in zip(OUT.names, row, strict=True):
                    out[f].append(v)
            return out

        return work

    return map_slices(texts(docs), make, OUT)


def masked(text: str) -> str:
    """Each span, or run of overlapping spans, as the name of its first kind in angle brackets."""
    out, done = [], 0
    for k, a, b, _ in sorted(detect(text), key=lambda x: (x[1], -x[2], x[0])):
        if a >= done:
            out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame) -> DataFrame:
    """All rows and columns, with personal data in ``text`` replaced and ``n_chars``, if any, counted anew."""

    @F.pandas_udf("string")
    def replaced(column):
        return column.map(lambda t: None if t is None else masked(t))

    out = docs.withColumn("text", replaced(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))

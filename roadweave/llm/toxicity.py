"""Operator 3: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled text, each a bounded sample (``FIT_POSITIVE``, ``FIT_UNLABELLED``), give a numpy
logistic classifier on the presence of words and word beginnings. Its risk is the positives' weighted by the class prior
plus the unlabelled's less the positives' share of it, which is held at zero or above; the loss is the sigmoid, bounded, so
that hidden positives cannot drive it below zero by their scores alone. Features are chosen by their frequency among
positives against that among negatives, which is the unlabelled one less the positives' share (at least 0), so that a word
of toxic texts only is chosen however many of the rows are toxic: a feature must stand out by ``LEAST_Z`` and ``LEAST_RATIO``,
the ``MOST_FEATURES`` strongest are taken, and their weights stay at zero or above. The prior is the toxic share of the labels
that may be used, confirmed negatives counted, held between 0.001 and 0.5. Documents of the held-out fold (crc32 of ``doc_id`` as text, modulo 5, is 0) give neither labels nor unlabelled text.

Edge cases: a null or empty text scores by the bias alone; without confirmed examples all scores are 0; a null label is
no label, and with several labels for a document any toxic one confirms it; a null ``doc_id`` is not held out; repeated
rows get equal scores; very long texts are read whole; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import Bounded, map_slices, sampled, schema, table, texts

FIT_POSITIVE, FIT_UNLABELLED = 3000, 6000
PREFIXES = (3, 4, 5, 6)
BITS = 22
LEAST_Z = 4.0  # of a feature's frequency among positives against negatives
LEAST_RATIO = 3.0
MOST_FEATURES = 20_000
EPOCHS, RATE, RIDGE = 300, 0.1, 1e-3
OUT = schema("doc_id long, held_out boolean, score double, predicted int")
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(word: str) -> tuple[int, ...]:
    """The word, and its beginnings where it is longer."""
    data = [b"w" + word.encode(), *(b"p" + word[:n].encode() for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(x) & ((1 << BITS) - 1) for x in data)


def _rows(docs: DataFrame) -> list[np.ndarray]:
    def make():
        known = Bounded(features, 100_000)

        def work(cols: dict) -> dict:
            out = []
            for text in cols["text"]:
                found: set[int] = set()
                for w in set(_WORD.findall(text.lower())):
                    found.update(known[w])
                out.append(np.fromiter(sorted(found), "<u4", len(found)).tobytes())
            return {"doc_id": cols["doc_id"], "x": out}

        return work

    rows = map_slices(texts(docs), make, schema("doc_id long, x binary"))
    got = rows.groupBy("doc_id").agg(F.min("x").alias("x")).toArrow()  # one row an id, as one id may hold a third of all rows
    order = np.argsort(np.asarray(got["doc_id"].fill_null(-1)), kind="stable")
    values = got["x"].to_pylist()
    return [np.frombuffer(values[i], "<u4") for i in order]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[dict[int, float], float]:
    """Weights of the chosen features and the bias."""
    if not positive or not unlabelled:
        return {}, -math.inf
    size = 1 << BITS
    count = lambda rows: np.bincount(np.concatenate(rows), minlength=size)
    p, u = count(positive) / len(positive), count(unlabelled) / len(unlabelled)
    negatives = (1 - prior) * len(unlabelled)
    q = np.clip((u - prior * p) / (1 - prior), 0, 1)
    pooled = (p * len(positive) + q * negatives) / (len(positive) + negatives)
    z = (p - q) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / len(positive) + 1 / negatives))
    chosen = np.flatnonzero((z > LEAST_Z) & (p * len(positive) >= 3) & (p > LEAST_RATIO * (q + 1 / negatives)))
    chosen = chosen[np.argsort(-z[chosen], kind="stable")[:MOST_FEATURES]]
    place = np.full(size, -1, np.int64)
    place[chosen] = np.arange(len(chosen))

    def sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        kept = [place[r][place[r] >= 0] for r in rows]
        return np.concatenate(kept), np.repeat(np.arange(len(rows)), [len(k) for k in kept])

    (pc, pr), (uc, ur) = sparse(positive), sparse(unlabelled)
    w, b = np.full(len(chosen), 1.0), math.log(prior / (1 - prior))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    for step in range(1, EPOCHS + 1):
        sp = sigmoid(np.bincount(pr, w[pc], len(positive)) + b)
        su = sigmoid(np.bincount(ur, w[uc], len(unlabelled)) + b)
        up, uu = sp * (1 - sp), su * (1 - su)  # slopes of the sigmoid loss
        gp, gu = -prior * up / len(positive), np.zeros(len(unlabelled))
        if su.mean() - prior * sp.mean() > 0:  # else the negatives' part of the risk stays at zero
            gp, gu = 2 * gp, uu / len(unlabelled)
        g = np.append(np.bincount(pc, gp[pr], len(w)) + np.bincount(uc, gu[ur], len(w)) + RIDGE * w / len(positive), gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = np.maximum(w - change[:-1], 0), b - change[-1]  # features were chosen for standing with toxicity
    return dict(zip(chosen.tolist(), w.tolist(), strict=True)), float(b)


def fit(docs: DataFrame, labels: DataFrame, positives: int = FIT_POSITIVE, unlabelled: int = FIT_UNLABELLED) -> tuple[dict[int, float], float]:
    usable = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    by = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = by.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
    chosen = by.where("toxic > 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives).select("doc_id")  # bounded, so it may be broadcast
    p = _rows(docs.join(F.broadcast(chosen), "doc_id", "left_semi"))
    u = _rows(sampled(docs.where(~held_out(F.col("doc_id"))), unlabelled))
    return train(p, u, min(max(share, 1e-3), 0.5))


def score(docs: DataFrame, model: tuple[dict[int, float], float]) -> DataFrame:
    weights, bias = model

    def make():
        def chosen(word: str) -> tuple[int, ...]:
            return tuple(f for f in features(word) if f in weights)

        known = Bounded(chosen, 250_000)

        def work(cols: dict) -> dict:
            out = []
            for text in cols["text"]:
                found: set[int] = set()
                for some in filter(None, map(known.__getitem__, set(_WORD.findall(text.lower())))):
                    found.update(some)
                s = bias + math.fsum(weights[f] for f in found)
                out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, s)))) if s > -500 else 0.0)
            held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 0 for d in cols["doc_id"]]
            return {"doc_id": cols["doc_id"], "held_out": held, "score": out, "predicted": [int(s >= 0.5) for s in out]}

        return work

    return map_slices(texts(docs), make, OUT)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))

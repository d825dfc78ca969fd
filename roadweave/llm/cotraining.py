"""Operator 10: a quality classifier by co-training.

Two views of a document have a logistic classifier each: its text's content (shape statistics, none of them its length) and
its page metadata (source, language, recorded length), so that no feature is in both. They start from a bounded sample of labelled documents (``FIT_LABELLED``); in each round
each view labels the unlabelled sample (``FIT_UNLABELLED``) and hands its most confident cases to the other view's
training set. Then each view is calibrated on labelled documents that took no part, and the calibrated log-odds add up
against the base rate. Documents whose probability of being good is under one half are rejected.

Edge cases: a null or empty text has zero shape statistics; null metadata is a value of its own; without labels of both
kinds every document scores the base rate and is kept; null labels are left out, and of several labels for a document
the least counts; repeated rows get equal scores; very long texts are read whole; an empty table gives no rows; other
columns are ignored, whatever their names (``keep`` keeps them).
"""

from __future__ import annotations

import math
import zlib
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import map_slices, sampled, schema, table

FIT_LABELLED, FIT_UNLABELLED = 8000, 8000
ROUNDS, PER_ROUND, CONFIDENT = 5, 200, 0.95
META_BUCKETS = 64
MOST = 3.0  # of a content feature, so that one odd text cannot turn a view
CALIBRATE = 4  # every so many-th labelled document is for calibration alone
OUT = schema("doc_id long, score double, content_score double, metadata_score double, keep boolean")
_VECTOR = "array<double>"


def content(text: str) -> list[float]:
    """Shares and ratios of a text, each about 0 to 1 and ``MOST`` at most; its length is left to the other view."""
    data = text.encode()
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    chars, count = max(1, len(data)), max(1, len(words))
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    lines = [x for x in text.split("\n") if x.strip()]
    known = len(set(words))
    signs = [int(n[ord(c)]) for c in "#*$%&|<>!?.,"]
    symbols = sum(signs[:8])
    adjacent = sum(map(eq, words, words[1:]))
    closed = sum(x.rstrip()[-1] in ".!?:" for x in lines)
    shape = [
        upper / max(1, upper + lower),
        float(upper > lower),
        int(n[48:58].sum()) / chars,
        symbols / count,
        float(symbols * 5 > count),
        signs[5] / count,
        float(signs[5] * 4 > count),
        signs[8] / count,
        float(signs[8] * 4 > count),
        signs[10] / count,
        signs[11] / count,
        known / count,
        1 - known / math.sqrt(count) / max(1.0, math.sqrt(count)),
        adjacent / count,
        float(adjacent * 10 > count),
        len(text) / count / 10,
        closed / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(count / max(1, len(lines))) / 10,
    ]
    return [min(MOST, float(x)) for x in shape]


def metadata(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    """Buckets of the three facts and of source with language."""
    length = -1 if n_chars is None or n_chars < 0 else int(math.log2(n_chars + 1))
    return [zlib.crc32(x.encode()) % META_BUCKETS + k * META_BUCKETS for k, x in enumerate((f"{source}", f"{lang}", f"{length}"))]


def _viewed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, both views and the named columns; missing metadata columns count as null."""
    held = {c.lower() for c in docs.columns}
    of = lambda c, kind: (F.col(c) if c in held else F.lit(None)).cast(kind).alias(c)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), of("source", "string"), of("lang", "string"), of("n_chars", "long"), *more)


def _vectors(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content and metadata matrices and the labels, in the order of a hash of ``doc_id``."""

    def make():
        def work(cols: dict) -> dict:
            return {
                "doc_id": cols["doc_id"],
                "quality": cols["quality"],
                "content": [content(t) for t in cols["text"]],
                "meta": [[float(x) for x in metadata(*m)] for m in zip(cols["source"], cols["lang"], cols["n_chars"], strict=True)],
            }

        return work

    rows = map_slices(rows, make, schema(f"doc_id long, quality int, content {_VECTOR}, meta {_VECTOR}"))
    one = F.min(F.struct("quality", "content", "meta")).alias("x")  # one row an id, as one id may hold a third of all rows
    got = rows.groupBy("doc_id").agg(one).select("doc_id", "x.*").toPandas()
    got = got.sort_values("doc_id", key=lambda ids: ids.map(lambda d: zlib.crc32(str(d).encode())), kind="stable")
    if got.empty:
        return np.zeros((0, len(content("")))), np.zeros((0, 3 * META_BUCKETS)), np.zeros(0)
    wide = np.zeros((len(got), 3 * META_BUCKETS))
    hot = np.stack(got["meta"].to_numpy()).astype(int)
    wide[np.repeat(np.arange(len(got)), hot.shape[1]), hot.ravel()] = 1
    return np.stack(got["content"].to_numpy()), wide, got["quality"].fillna(0).to_numpy(float)


class Logistic:
    """Ridge logistic regression by Newton steps, on standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        self.w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * self.w)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.w[0] + (x - self.mean) / self.scale @ self.w[1:]


class Model:
    def __init__(self, views: tuple[Logistic, Logistic] | None, scales: list[tuple[float, float]], prior: float):
        self.views, self.scales, self.prior = views, scales, prior

    def logits(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated log-odds of either view and of both."""
        if self.views is None:
            flat = np.full(len(x), self.prior)
            return flat, flat, flat
        a, b = (s * v.logit(z) + t for v, z, (s, t) in zip(self.views, (x, m), self.scales, strict=True))
        return a, b, a + b - self.prior


def cotrain(x: np.ndarray, m: np.ndarray, y: np.ndarray, ux: np.ndarray, um: np.ndarray) -> Model:
    """The labelled (``x``, ``m``, ``y``) and unlabelled (``ux``, ``um``) views to a calibrated pair."""
    rate = (y.sum() + 1) / (len(y) + 2)
    prior = math.log(rate / (1 - rate))
    test = np.arange(len(y)) % CALIBRATE == 0
    if min(y[~test].sum(), (1 - y[~test]).sum()) < 2 or min(y[test].sum(), (1 - y[test]).sum()) < 1:
        return Model(None, [], max(prior, 0.0))
    labelled, pool = (x[~test], m[~test]), (ux, um)
    extra: list[dict[int, float]] = [{}, {}]  # rows of the pool that a view has been handed, and their labels
    views: list[Logistic] = []
    for turn in range(ROUNDS + 1):
        views = []
        for v in range(2):
            rows = sorted(extra[v])
            views.append(Logistic(np.concatenate([labelled[v], pool[v][rows]]), np.concatenate([y[~test], [extra[v][r] for r in rows]])))
        if turn == ROUNDS or not len(ux):
            break
        for v in range(2):
            p = 1 / (1 + np.exp(-np.clip(views[v].logit(pool[v]), -30, 30)))
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                most = max(1, round(PER_ROUND * (rate if label else 1 - rate)))
                fresh = [r for r in np.argsort(-sure, kind="stable").tolist() if sure[r] >= CONFIDENT and r not in extra[1 - v]]
                extra[1 - v].update(dict.fromkeys(fresh[:most], label))
    scales = []
    for v, z in enumerate((x[test], m[test])):
        line = Logistic(views[v].logit(z)[:, None], y[test], ridge=0.1)
        slope = float(line.w[1] / line.scale[0])
        scales.append((max(0.0, slope), float(line.w[0] - slope * line.mean[0]) if slope > 0 else prior))
    return Model((views[0], views[1]), scales, prior)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = FIT_LABELLED, unlabelled: int = FIT_UNLABELLED) -> Model:
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id IS NOT NULL AND quality IS NOT NULL")
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)  # bounded, so it may be broadcast
    known = _viewed(docs).join(F.broadcast(chosen), "doc_id")
    x, m, y = _vectors(known)
    ux, um, _ = _vectors(_viewed(sampled(docs, unlabelled)).withColumn("quality", F.lit(None).cast("int")))
    return cotrain(x, m, (y > 0).astype(float), ux, um)


def score(docs: DataFrame, model: Model) -> DataFrame:
    def make():
        def work(cols: dict) -> dict:
            x = np.asarray([content(t) for t in cols["text"]])
            m = np.zeros((len(x), 3 * META_BUCKETS))
            for i, facts in enumerate(zip(cols["source"], cols["lang"], cols["n_chars"], strict=True)):
                m[i, metadata(*facts)] = 1
            a, b, both = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in model.logits(x, m))
            return {"doc_id": cols["doc_id"], "score": both, "content_score": a, "metadata_score": b, "keep": both >= 0.5}

        return work

    return map_slices(_viewed(docs), make, OUT)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, all columns as they were."""
    model = fit(docs, labels)
    held = {c.lower(): c for c in docs.columns}

    @F.pandas_udf("boolean")
    def good(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.Series:
        x = np.asarray([content(t) for t in text])
        m = np.zeros((len(x), 3 * META_BUCKETS))
        for i, (s, g, n) in enumerate(zip(source, lang, n_chars, strict=True)):
            m[i, metadata(s, g, None if pd.isna(n) else int(n))] = 1
        return pd.Series(model.logits(x, m)[2] >= 0 if len(x) else [], dtype=bool)

    of = lambda c, kind: (F.col(held[c]) if c in held else F.lit(None)).cast(kind)
    return docs.where(good(F.coalesce("text", F.lit("")), of("source", "string"), of("lang", "string"), of("n_chars", "long")))


def op10_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))

"""De-duplication: ordered folds within a track, one-to-one assignment across passes, the canonical ledger."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.functions.frenet import LEAST_VARIANCE, mahalanobis2
from roadweave.runtime import stored

GATE = 9.21  # chi-squared, two degrees of freedom, 99 %
STATE = "struct<s:double,t:double,var_s:double,var_t:double,conf:double,n:bigint,confirmed:boolean>"


def _fused(mean: Column, var: Column, seen: Column, seen_var: Column) -> tuple[Column, Column]:
    a, b = 1.0 / F.greatest(var, F.lit(LEAST_VARIANCE)), 1.0 / F.greatest(seen_var, F.lit(LEAST_VARIANCE))
    return (mean * a + seen * b) / (a + b), 1.0 / (a + b)


def updated(state: Column, seen: Column) -> Column:
    """A canonical state after one more observation (``s``, ``t``, ``var_s``, ``var_t``, ``conf``)."""
    s, var_s = _fused(state["s"], state["var_s"], seen["s"], seen["var_s"])
    t, var_t = _fused(state["t"], state["var_t"], seen["t"], seen["var_t"])
    conf, n = F.least(F.greatest(state["conf"], seen["conf"]) + 0.05, F.lit(0.99)), state["n"] + 1
    sure = state["confirmed"] | ((n >= 2) & (conf >= 0.5)) | (n >= 5)
    return F.struct(s.alias("s"), t.alias("t"), var_s.alias("var_s"), var_t.alias("var_t"), conf.alias("conf"), n.alias("n"), sure.alias("confirmed")).cast(STATE)


def level1(observations: DataFrame, order: list[str]) -> DataFrame:
    """One anomaly a track, edge and class; untracked observations (null or negative) stay single.

    The fold runs in ``order``, which must be unique; running variances are clamped before each step, so it is no sum.
    """
    tracked = F.coalesce(F.col("track_id"), F.lit(-1)) >= 0
    conf = F.coalesce(F.col("conf"), F.when(tracked, 0.7).otherwise(0.6))
    alone = F.when(~tracked, F.struct(*order))
    rows = observations.withColumns({"__alone": alone, "__o": F.struct(F.struct(*order).alias("at"), "s", "t", "var_s", "var_t", conf.alias("conf"))})
    grouped = rows.groupBy("edge_id", "class_name", F.when(tracked, F.col("track_id")).alias("track_id"), "__alone").agg(F.sort_array(F.collect_list("__o")).alias("o"))
    head = F.col("o")[0]
    start = F.struct(head["s"], head["t"], head["var_s"], head["var_t"], head["conf"], F.lit(1).cast("bigint"), F.size("o") >= 5).cast(STATE)
    folded = grouped.withColumn("x", F.aggregate(F.slice("o", 2, F.greatest(F.size("o") - 1, F.lit(0))), start, updated))
    name = F.sha2(F.concat_ws("|", "edge_id", "class_name", F.concat_ws("|", *(head["at"][c].cast("string") for c in order))), 256)
    return folded.select(name.alias("anomaly_id"), "edge_id", "class_name", "track_id", "x.s", "x.t", "x.var_s", "x.var_t", F.col("x.conf").alias("confidence"), F.col("x.n").alias("observation_count"), F.when(F.col("x.confirmed"), "CONFIRMED").otherwise("CANDIDATE").alias("state"))


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Most pairs, then least total cost; ``inf`` may not be paired. Shortest augmenting paths, one row at a time."""
    rows, columns = cost.shape
    finite = np.isfinite(cost)
    if not finite.any():
        return []
    dear = (cost[finite].max() + 1.0) * (min(rows, columns) + 1)
    c = np.where(finite, cost, dear)
    flip = rows > columns
    c = c.T if flip else c
    n, m = c.shape
    u, v, owner, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j] = True
            free = ~used[1:]
            reduced = c[owner[j] - 1] - u[owner[j]] - v[1:]
            better = free & (reduced < least[1:])
            least[1:][better], way[1:][better] = reduced[better], j
            step = np.where(free, least[1:], np.inf)
            k = int(step.argmin()) + 1
            delta = step[k - 1]
            u[owner[used]] += delta
            v[used] -= delta
            least[1:][free] -= delta
            j = k
            if not owner[j]:
                break
        while j:
            owner[j] = owner[way[j]]
            j = way[j]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    pairs = [(b, a) if flip else (a, b) for a, b in pairs]
    return sorted(p for p in pairs if finite[p])


def gated_pairs(existing: DataFrame, new: DataFrame, gate: float = GATE) -> DataFrame:
    """Pairs of one edge and class within the gate.

    They meet in cells of ``s`` as wide as the gate lets two places be apart, at the greatest variances that occur.
    """
    most = lambda df: F.coalesce(F.max(F.greatest("var_s", F.lit(LEAST_VARIANCE))), F.lit(LEAST_VARIANCE))
    wide = existing.agg(most(existing).alias("a")).crossJoin(new.agg(most(new).alias("b")))  # one row each
    wide = F.broadcast(wide.select(F.sqrt(gate * (F.col("a") + F.col("b"))).alias("__wide")))
    cell = F.floor(F.col("s") / F.col("__wide"))
    a = existing.crossJoin(wide).withColumn("__cell", cell).alias("a")
    b = new.crossJoin(wide).withColumn("__cell", F.explode(F.array(cell - 1, cell, cell + 1))).alias("b")
    d2 = mahalanobis2(*(F.col(f"a.{c}") for c in ("s", "t", "var_s", "var_t")), *(F.col(f"b.{c}") for c in ("s", "t", "var_s", "var_t")))
    met = a.join(b, (F.col("a.edge_id") == F.col("b.edge_id")) & (F.col("a.class_name") == F.col("b.class_name")) & (F.col("a.__cell") == F.col("b.__cell")))
    return met.select(F.col("a.edge_id").alias("edge_id"), F.col("a.class_name").alias("class_name"), F.col("a.anomaly_id").alias("old_id"), F.col("b.anomaly_id").alias("new_id"), d2.alias("d2")).where(F.col("d2") <= gate)


def _assigned(group: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one edge and class: sets of anomalies that no pair connects are solved apart, so no table is larger than one."""
    old, new = (pd.factorize(group[c])[0] for c in ("old_id", "new_id"))
    new = new + len(group)
    parent = list(range(2 * len(group)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(old.tolist(), new.tolist(), strict=True):
        parent[root(a)] = root(b)
    sets: dict[int, list[int]] = {}
    for i, a in enumerate(old.tolist()):
        sets.setdefault(root(a), []).append(i)
    names, others, costs = (group[c].to_numpy() for c in ("old_id", "new_id", "d2"))
    out: list[tuple[str, str]] = []
    for rows in sets.values():
        if len(rows) == 1:
            out.append((names[rows[0]], others[rows[0]]))
            continue
        olds, news = sorted(set(names[rows])), sorted(set(others[rows]))
        cost = np.full((len(olds), len(news)), np.inf)
        cost[np.searchsorted(olds, names[rows]), np.searchsorted(news, others[rows])] = costs[rows]
        out += [(olds[a], news[b]) for a, b in assign(cost)]
    return pd.DataFrame(out, columns=["old_id", "new_id"])


def level2(existing: DataFrame, new: DataFrame, gate: float = GATE) -> DataFrame:
    """The ledger after a pass: assigned anomalies take one update, all others stay or join. The assignment is stored, as both
    sides of the result read it."""
    pairs = stored(gated_pairs(existing, new, gate).groupBy("edge_id", "class_name").applyInPandas(_assigned, "old_id string, new_id string"), "assigned")
    columns = ["anomaly_id", "edge_id", "class_name", "s", "t", "var_s", "var_t", "confidence", "observation_count", "state"]
    seen = new.select(F.col("anomaly_id").alias("new_id"), F.struct("s", "t", "var_s", "var_t", F.col("confidence").alias("conf")).alias("seen"))
    kept = existing.select(*columns).join(pairs, F.col("anomaly_id") == F.col("old_id"), "left").join(seen, "new_id", "left")
    state = F.struct("s", "t", "var_s", "var_t", "confidence", F.col("observation_count").cast("bigint"), F.col("state") == "CONFIRMED").cast(STATE)
    kept = kept.withColumn("x", F.when(F.col("seen").isNotNull(), updated(state, F.col("seen"))).otherwise(state))
    merged = kept.select("anomaly_id", "edge_id", "class_name", "x.s", "x.t", "x.var_s", "x.var_t", F.col("x.conf").alias("confidence"), F.col("x.n").alias("observation_count"), F.when(F.col("x.confirmed"), "CONFIRMED").otherwise(F.col("state")).alias("state"))
    fresh = new.select(*columns).join(pairs.select(F.col("new_id").alias("anomaly_id")), "anomaly_id", "left_anti")
    return merged.unionByName(fresh)


def upsert(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """By ``anomaly_id``: known ones take the new measures but keep edge, class and creation time."""
    fixed, moving = ["anomaly_id", "edge_id", "class_name", "created_at"], ["s", "t", "var_s", "var_t", "confidence", "observation_count", "state", "updated_at"]
    a, b = ledger.alias("a"), rows.alias("b")
    met = a.join(b, F.col("a.anomaly_id") == F.col("b.anomaly_id"), "full_outer")
    old, new = F.col("a.anomaly_id").isNotNull(), F.col("b.anomaly_id").isNotNull()
    return met.select(*(F.when(old, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in fixed), *(F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in moving))


def confirmed(ledger: DataFrame) -> DataFrame:
    """The export of confirmed anomalies."""
    sigma = lambda v: F.sqrt(F.greatest(F.col(v), F.lit(LEAST_VARIANCE)))
    return ledger.where("state = 'CONFIRMED'").select("anomaly_id", "edge_id", "class_name", "s", "t", sigma("var_s").alias("sigma_s"), sigma("var_t").alias("sigma_t"), "confidence", "observation_count", "state")

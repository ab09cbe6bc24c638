"""Isolation forest.

* sampling (Spark): one hash-based Bernoulli pass keeps a pool of ~1.5·T·ψ rows (all
  rows of a smaller table); each tree draws its own ψ rows from the pool, those with the
  smallest hash of (row, tree), so pool and samples are bounded whatever the table size;
* fitting (``applyInPandas`` by tree): each tree is grown on ≤ ψ rows with numpy;
  the output is a node table (tree, node, feature, threshold, left, right, size);
* scoring (``mapInPandas``): the node tables (≤ T·(2ψ−1) rows, bounded) are
  broadcast; path lengths are computed in Arrow batches for all rows;
* flag: score above its (1 − contamination) quantile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import with_scalars

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, size long")


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append([nid, -1, 0.0, -1, -1, len(idx)])
        if depth >= limit or len(idx) <= 1:
            return nid
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.where(hi > lo)[0]
        if len(cand) == 0:
            return nid
        f = int(rng.choice(cand))
        thr = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < thr]
        right = idx[sub[:, f] >= thr]
        nodes[nid][1], nodes[nid][2] = f, thr
        nodes[nid][3] = build(left, depth + 1)
        nodes[nid][4] = build(right, depth + 1)
        return nid

    build(np.arange(len(x)), 0)
    return nodes


def fit_isolation_forest(df: DataFrame, cols: list[str], id_col: str, trees: int = 300,
                         sample: int = 256, seed: int = 42) -> DataFrame:
    """L9 fit: node tables of ``trees`` isolation trees on ``sample`` rows each (all rows of a smaller table)."""
    n = df.count()
    rate = min(1.0, 1.5 * trees * sample / max(n, 1))
    u = (F.xxhash64(F.col(id_col), F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
    s = df.where(u < rate).select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
    # a tree's draw is twice its rows before the smallest are kept; a pool of under 2ψ rows goes to every tree
    chance = min(1.0, 2.0 * sample / max(1.0, n * rate))
    limit_ = F.lit(int(chance * (1 << 52)))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                     lambda t: F.xxhash64(F.col(id_col), t, F.lit(seed + 1)).bitwiseAND(F.lit((1 << 52) - 1)) < limit_)
    s = s.withColumn("tree", F.explode(drawn)).withColumn("_r", F.xxhash64(F.col(id_col), "tree", F.lit(seed + 2)))
    limit = int(math.ceil(math.log2(max(sample, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_r").head(sample)
        t = int(pdf["tree"].iloc[0])
        x = pdf[cols].to_numpy(dtype=np.float64)
        x = np.nan_to_num(x)
        rng = np.random.default_rng([seed, t])
        nodes = _grow(x, rng, limit)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size"])
        out.insert(0, "tree", t)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int64"})
    return s.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score_isolation_forest(df: DataFrame, nodes: DataFrame, cols: list[str], sample: int = 256,
                           name: str = "anomaly_score") -> DataFrame:
    """L9 score: 2^(−E[h(x)] / c(ψ)) with the node tables broadcast to the executors."""
    spark = df.sparkSession
    pdf = nodes.toPandas()  # bounded: trees × (2ψ − 1) rows
    tables = {}
    for t, g in pdf.groupby("tree"):
        g = g.sort_values("node")
        tables[int(t)] = (g["feature"].to_numpy(), g["threshold"].to_numpy(), g["left"].to_numpy(),
                          g["right"].to_numpy(), g["size"].to_numpy())
    bc = spark.sparkContext.broadcast(tables)
    cpsi = _c(min(sample, max(int(pdf.groupby("tree")["size"].max().max()), 2)))
    from pyspark.sql import types as T
    schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.DoubleType())])

    def run(batches):
        trees = bc.value
        for b in batches:
            x = np.nan_to_num(b[cols].to_numpy(dtype=np.float64))
            total = np.zeros(len(b))
            for feat, thr, left, right, size in trees.values():
                node = np.zeros(len(b), dtype=np.int64)
                depth = np.zeros(len(b))
                active = left[node] >= 0
                while active.any():
                    f = feat[node]
                    go_left = x[np.arange(len(b)), np.maximum(f, 0)] < thr[node]
                    nxt = np.where(go_left, left[node], right[node])
                    node = np.where(active, nxt, node)
                    depth = np.where(active, depth + 1, depth)
                    active = left[node] >= 0
                adj = np.array([_c(s) for s in size])[node]
                total += depth + adj
            mean = total / max(len(trees), 1)
            b[name] = np.power(2.0, -mean / cpsi)
            yield b
    return df.mapInPandas(run, schema)


def flag_top(df: DataFrame, score: str, contamination: float, name: str = "anomaly") -> DataFrame:
    """Flag rows whose score is above the (1 − contamination) quantile."""
    cut = df.agg(F.percentile_approx(score, 1 - contamination, 10000).alias("_cut"))
    return with_scalars(df, cut).withColumn(name, (F.col(score) > F.col("_cut")).cast("int")).drop("_cut")

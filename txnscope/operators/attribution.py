"""L15 for tree models: exact per-row attributions of the model margin.

For one tree and a row x, the expected output given a set S of known features is
taken along the tree (path-dependent form of Tree SHAP, Lundberg et al. 2018):
at a split on a known feature follow x, otherwise average both children by their
training cover.  For a leaf l with value v and unique path features P (|P| = d)
that is the product game  g_l(S) = v · Π_{j∈P} (o_j if j∈S else z_j), where
o_j ∈ {0, 1} says whether x satisfies every condition on j along the path and z_j
is the product of the cover fractions of those branches.  Its Shapley values are

    φ_i = v (o_i − z_i) Σ_k  k!(d−k−1)!/d! · [t^k] Π_{j∈P∖i} (z_j + o_j t)

and the tree's are the sum over leaves (features off the path are null players).
Σ_i φ_i = f(x) − base with base = Σ_l v_l cover_l / cover_root, so the
attributions add up exactly to the margin.

Spark plan: the node tables come from the saved model (size bounded by
trees × 2^(depth+1), not by data) and are broadcast in blocks of leaves whose
attributions are added, for a model of any size; the rows are scored in Arrow
batches by ``mapInPandas`` (numpy, vectorised over the rows of a batch for each
leaf path).  Nothing row-sized passes through the driver.

Scales: gradient-boosted trees → log-odds (Spark's probability is
sigmoid(2 · margin), so each tree is weighted by 2 · treeWeight); random forests
and single trees → probability of class 1.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, GBTClassificationModel,
                                       RandomForestClassificationModel)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from txnscope.session import scratch_path

BLOCK_LEAVES = 20_000    # leaf paths sent to the executors in one broadcast


def _final(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def _saved_trees(model, spark) -> list[tuple[float, list[dict]]]:
    """[(tree weight, node rows)] from the model's saved data files.  The number of
    nodes is bounded by the model parameters (trees × 2^(maxDepth+1)), not by data."""
    path = scratch_path(spark, f"treemodel-{uuid.uuid4().hex[:10]}")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if isinstance(model, DecisionTreeClassificationModel):
        return [(1.0, [r.asDict(recursive=True) for r in data.collect()])]
    meta = spark.read.parquet(f"{path}/treesMetadata")
    # (treeID, metadata, weight); some versions write the tuple with positional names
    tid, wcol = ("treeID", "weights") if "treeID" in meta.columns else (meta.columns[0], meta.columns[2])
    weights = {r[0]: float(r[1]) for r in meta.select(tid, wcol).collect()}
    by_tree: dict[int, list[dict]] = {}
    for r in data.collect():
        by_tree.setdefault(r["treeID"], []).append(r["nodeData"].asDict(recursive=True))
    return [(weights[t], by_tree[t]) for t in sorted(by_tree)]


def _leaf_value(node: dict, kind: str) -> float:
    if kind == "gbt":
        return float(node["prediction"])
    stats = node["impurityStats"]
    tot = float(sum(stats))
    return float(stats[1]) / tot if tot > 0 and len(stats) > 1 else 0.0


def _cover(node: dict, kind: str) -> float:
    stats = node["impurityStats"]
    # regression trees (boosting): [weighted count, sum, sum of squares]; classifiers: class weights
    c = float(stats[0]) if kind == "gbt" else float(sum(stats))
    return c if c > 0 else float(node["rawCount"])


def compile_paths(model) -> dict:
    """Leaf paths of every tree: value (scaled to the output), unique features, their
    cover products z and the branch conditions deciding o.  Also the base value."""
    m = _final(model)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if isinstance(m, GBTClassificationModel):
        kind, scale = "gbt", 2.0
    elif isinstance(m, RandomForestClassificationModel):
        kind, scale = "forest", 1.0 / m.getNumTrees
    elif isinstance(m, DecisionTreeClassificationModel):
        kind, scale = "tree", 1.0
    else:
        raise TypeError(f"tree attributions need a tree classifier, got {type(m).__name__}")
    leaves, base = [], 0.0
    for w, nodes in _saved_trees(m, spark):
        by_id = {n["id"]: n for n in nodes}
        children = {n["leftChild"] for n in nodes} | {n["rightChild"] for n in nodes}
        root = [i for i in by_id if i not in children][0]
        tw = w * scale
        root_cover = _cover(by_id[root], kind)

        def walk(nid, feats):
            n = by_id[nid]
            if n["leftChild"] < 0:
                v = tw * _leaf_value(n, kind)
                leaves.append((v, [(f, z, conds) for f, (z, conds) in feats.items()]))
                return v * _cover(n, kind) / root_cover
            sp = n["split"]
            f = int(sp["featureIndex"])
            cats = None if sp["numCategories"] < 0 else [float(c) for c in sp["leftCategoriesOrThreshold"]]
            test = ("in", cats) if cats is not None else ("le", float(sp["leftCategoriesOrThreshold"][0]))
            pc = _cover(n, kind)
            acc = 0.0
            for child, side in ((n["leftChild"], True), (n["rightChild"], False)):
                frac = _cover(by_id[child], kind) / pc if pc > 0 else 0.5
                z0, c0 = feats.get(f, (1.0, []))
                nf = dict(feats)
                nf[f] = (z0 * frac, c0 + [(test, side)])
                acc += walk(child, nf)
            return acc

        base += walk(root, {})
    return {"leaves": leaves, "base": base}


def plan_blocks(plan: dict, size: int = BLOCK_LEAVES) -> list[list]:
    """The leaf paths in blocks: attributions are a sum over leaves, so blocks add up."""
    return [plan["leaves"][i:i + size] for i in range(0, len(plan["leaves"]), size)]


def _shapley_weights(d: int) -> np.ndarray:
    return np.array([math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)])


def _branch(x: np.ndarray, test, side: bool) -> np.ndarray:
    kind, arg = test
    left = (x <= arg) if kind == "le" else np.isin(x, arg)   # NaN never goes left, as in Spark
    return left if side else ~left


def shap_matrix(X: np.ndarray, plan: dict) -> np.ndarray:
    """φ (rows × features) for a numeric matrix X (columns in model order)."""
    n, p = X.shape
    phi = np.zeros((n, p))
    weights = {}
    for v, feats in plan["leaves"]:
        d = len(feats)
        if d == 0 or v == 0.0:
            continue
        if d not in weights:
            weights[d] = _shapley_weights(d)
        W = weights[d]
        o = np.empty((n, d))
        z = np.empty(d)
        for j, (f, zj, conds) in enumerate(feats):
            ok = np.ones(n, dtype=bool)
            for test, side in conds:
                ok &= _branch(X[:, f], test, side)
            o[:, j] = ok
            z[j] = zj
        for i in range(d):
            # coefficients of Π_{j≠i} (z_j + o_j t), one row per data row
            c = np.zeros((n, d))
            c[:, 0] = 1.0
            deg = 0
            for j in range(d):
                if j == i:
                    continue
                c[:, 1:deg + 2] = c[:, 1:deg + 2] * z[j] + c[:, 0:deg + 1] * o[:, j:j + 1]
                c[:, 0] *= z[j]
                deg += 1
            phi[:, feats[i][0]] += v * (o[:, i] - z[i]) * (c @ W)
    return phi


def tree_contributions(model, df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Per-row attributions of a fitted tree classifier (or pipeline ending in one).

    Returns ``keep`` columns plus ``contributions`` (array<struct<variable,
    contribution>> in model column order), ``base``, ``shap_margin`` = base + Σ
    contributions, and ``margin`` — the model's own output on the same scale
    (2 · rawPrediction[1] for boosting, probability[1] otherwise), for the additivity check.
    """
    spark = df.sparkSession
    plan = compile_paths(model)
    base = plan["base"]
    blocks = [spark.sparkContext.broadcast(block) for block in plan_blocks(plan)]
    m = _final(model)
    scored = model.transform(df)
    own = (2.0 * vector_to_array("rawPrediction")[1]) if isinstance(m, GBTClassificationModel) \
        else vector_to_array("probability")[1]
    feat = [F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]
    src = scored.select(*[F.col(k) for k in keep], own.alias("margin"), *feat)
    out_schema = src.select(*[F.col(k) for k in keep], "margin").schema \
        .add("base", DoubleType()).add("phi", ArrayType(DoubleType()))
    xcols = [f"_x{i}" for i in range(len(cols))]

    def run(batches):
        for b in batches:
            X = b[xcols].to_numpy(dtype=float, na_value=np.nan)
            phi = np.zeros(X.shape)
            for block in blocks:
                phi += shap_matrix(X, {"leaves": block.value})
            out = b.drop(columns=xcols)
            out["base"] = base
            out["phi"] = list(phi)
            yield out

    names = F.array(*[F.lit(c) for c in cols])
    res = src.mapInPandas(run, out_schema)
    contribs = F.transform("phi", lambda v, i: F.struct(F.element_at(names, i + 1).alias("variable"),
                                                       v.alias("contribution")))
    return res.select(*keep, "margin", "base",
                      (F.col("base") + F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)).alias("shap_margin"),
                      contribs.alias("contributions"))


__all__ = ["compile_paths", "plan_blocks", "shap_matrix", "tree_contributions"]

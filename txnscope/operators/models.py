"""Model fit, score, inspection and comparison on Spark ML (L1–L8, L10–L19,
M17–M21).

Learners are Spark ML estimators (distributed fit); this module adds what the
reference computes around them: weights, thresholds, leaf rule tables, linear
attributions, permutation importance, ablations and model choice.
"""

from __future__ import annotations

import json
import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.operators.encode import hash60
from txnscope.operators.metrics import confusion, curve, ranking_summary, best_f1_threshold
from txnscope.operators.split import stratified_kfold
from txnscope.plans.frames import materialize, with_scalars
from txnscope.plans.prefix import prefix_sum
from txnscope.session import scratch_path


def learner(kind: str, features: str = "features", label: str = "y", weight: str | None = None,
            seed: int = 42, **params):
    """A configured Spark ML classifier."""
    common = {"featuresCol": features, "labelCol": label}
    if weight and kind != "tree_unweighted":
        common["weightCol"] = weight
    if kind == "logistic":
        return LogisticRegression(maxIter=params.get("maxIter", 50), regParam=params.get("regParam", 0.0),
                                  elasticNetParam=params.get("elasticNetParam", 0.0), **common)
    if kind == "svm":
        return LinearSVC(maxIter=params.get("maxIter", 50), regParam=params.get("regParam", 0.0), **common)
    if kind in ("tree", "tree_unweighted"):
        common.pop("weightCol", None) if kind == "tree_unweighted" else None
        return DecisionTreeClassifier(maxDepth=params.get("maxDepth", 3),
                                      minInstancesPerNode=params.get("minInstancesPerNode", 100),
                                      impurity=params.get("impurity", "gini"), seed=seed, **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=params.get("numTrees", 50), maxDepth=params.get("maxDepth", 8),
                                      minInstancesPerNode=params.get("minInstancesPerNode", 5),
                                      subsamplingRate=params.get("subsamplingRate", 0.8), seed=seed, **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=params.get("maxIter", 30), stepSize=params.get("stepSize", 0.1),
                             maxDepth=params.get("maxDepth", 4), subsamplingRate=params.get("subsamplingRate", 0.8),
                             featureSubsetStrategy=params.get("featureSubsetStrategy", "all"), seed=seed,
                             **common)
    raise ValueError(kind)


def pipeline(kind: str, cols: list[str], **kw) -> Pipeline:
    """VectorAssembler + learner (J7: anything fitted lives inside the pipeline)."""
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"),
                            learner(kind, **kw)])


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Positive-class score: probability[1], or the raw margin for margin-only models."""
    out = model.transform(df)
    col = "probability" if "probability" in out.columns else "rawPrediction"
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in out.columns]
    return out.withColumn(name, vector_to_array(col)[1]).drop(*drop)


def constant_baseline(df: DataFrame, name: str = "p") -> DataFrame:
    """L1: always predict the majority class (0)."""
    return df.withColumn(name, F.lit(0))


def stratified_random_baseline(df: DataFrame, rate: float, seed: int = 4242, id_col: str = "txn_id",
                               name: str = "p") -> DataFrame:
    """L2: alert with probability = train positive rate (hash-seeded, partition-independent)."""
    u = (hash60(id_col, seed) % 1000000) / 1000000.0
    return df.withColumn(name, (u < rate).cast("int"))


def evaluate(scored: DataFrame, threshold: float | Column, label: str = "y", score_col: str = "score"
             ) -> DataFrame:
    """One row: precision, recall, F1, alert rate at the threshold, ROC AUC and AP."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    c = confusion(scored.withColumn("_p", (F.col(score_col) >= t).cast("int")), "_p", label) \
        .select(F.col("n").alias("rows"), (F.col("tp") + F.col("fn")).alias("positives"), "precision", "recall", "f1", "alert_rate")
    r = ranking_summary(scored, score_col, label).select("roc_auc", "average_precision")
    return with_scalars(c, r)


def chosen_threshold(scored: DataFrame, label: str = "y", score_col: str = "score") -> DataFrame:
    """M5 on a scored set: one row with the F1-optimal threshold."""
    return best_f1_threshold(curve(scored, score_col, label)).select("threshold")


# ------------------------------------------------------------------ L6
def tree_nodes(model, spark) -> list[dict]:
    """Node table of a fitted decision tree (from its saved data files; a depth-limited
    tree has few nodes, so collecting it is bounded)."""
    path = scratch_path(spark, f"tree-{uuid.uuid4().hex[:10]}")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").collect()
    return [r.asDict(recursive=True) for r in rows]


def leaf_rules(tree_model, df: DataFrame, feature_names: list[str], label: str = "y") -> DataFrame:
    """One row per leaf: path text, rows, positives, rate.  The leaf of each row is a
    CASE expression built from the node table (evaluated natively in the executors)."""
    nodes = {n["id"]: n for n in tree_nodes(tree_model, df.sparkSession)}
    paths = {}

    def walk(nid, conds, texts):
        n = nodes[nid]
        if n["leftChild"] < 0:
            paths[nid] = (conds, " AND ".join(texts) or "(all)")
            return
        f = n["split"]["featureIndex"]
        thr = n["split"]["leftCategoriesOrThreshold"][0]
        x = F.col(f"`{feature_names[f]}`")
        walk(n["leftChild"], conds + [x <= thr], texts + [f"{feature_names[f]} <= {thr:.4f}"])
        walk(n["rightChild"], conds + [x > thr], texts + [f"{feature_names[f]} > {thr:.4f}"])

    root = [i for i in nodes if all(nodes[j]["leftChild"] != i and nodes[j]["rightChild"] != i
                                    for j in nodes)][0]
    walk(root, [], [])
    leaf = None
    for nid, (conds, text) in paths.items():
        cond = F.lit(True)
        for c in conds:
            cond = cond & c
        leaf = F.when(cond, F.lit(text)) if leaf is None else leaf.when(cond, F.lit(text))
    g = df.groupBy(leaf.alias("rule")).agg(F.count(F.lit(1)).alias("rows"),
                                           F.sum(label).cast("long").alias("positives"),
                                           F.avg(label).alias("rate"))
    return g


# ------------------------------------------------------------- L13, L15, L16
def importances(model: PipelineModel, cols: list[str]) -> DataFrame:
    """Impurity importances (trees) or coefficients (linear), ranked; share of top 3."""
    m = model.stages[-1]
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
        kind = "importance"
    else:
        vals = m.coefficients.toArray().tolist()
        kind = "coefficient"
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    rows = [(c, float(v), kind) for c, v in zip(cols, vals)]
    df = s.createDataFrame(rows, "variable string, value double, kind string")
    tot = df.agg(F.sum(F.abs("value")).alias("_t"))
    x = with_scalars(df, tot).withColumn("share", F.abs("value") / F.col("_t"))
    top3 = x.orderBy(F.desc(F.abs("value")), "variable").limit(3).agg(F.sum("share").alias("top3_share"))
    return with_scalars(x.drop("_t"), top3)


def linear_contributions(model: PipelineModel, train: DataFrame, df: DataFrame, cols: list[str]
                         ) -> DataFrame:
    """L15 for linear models: exact additive attributions in the margin,
    contribution_j = coef_j · (x_j − mean_train_j); base = intercept + Σ coef_j·mean_j.
    Adds ``contributions`` (array<struct<variable, contribution>>), ``base`` and ``margin``."""
    m = model.stages[-1]
    coefs = m.coefficients.toArray().tolist()
    means = train.agg(*[F.avg(F.col(f"`{c}`")).alias(f"_mu{i}") for i, c in enumerate(cols)])
    x = with_scalars(df, means)
    contribs = F.array(*[F.struct(F.lit(c).alias("variable"),
                                  (F.lit(coefs[i]) * (F.col(f"`{c}`") - F.col(f"_mu{i}"))).alias("contribution"))
                         for i, c in enumerate(cols)])
    base = F.lit(float(m.intercept))
    for i, _ in enumerate(cols):
        base = base + F.lit(coefs[i]) * F.col(f"_mu{i}")
    margin = F.lit(float(m.intercept))
    for i, c in enumerate(cols):
        margin = margin + F.lit(coefs[i]) * F.col(f"`{c}`")
    return x.withColumn("contributions", contribs).withColumn("base", base) \
        .withColumn("margin", margin).drop(*[f"_mu{i}" for i in range(len(cols))])


def global_attribution(df: DataFrame) -> DataFrame:
    """Mean |contribution| per variable and its share (posexplode + one groupBy)."""
    long = df.select(F.explode("contributions").alias("c")).select("c.variable", "c.contribution")
    g = long.groupBy("variable").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    tot = g.agg(F.sum("mean_abs").alias("_t"))
    return with_scalars(g, tot).withColumn("share", F.col("mean_abs") / F.col("_t")).drop("_t")


def permute_columns(df: DataFrame, cols: list[str], id_col: str, seed: int) -> DataFrame:
    """Add ``_perm_<col>``: the columns shuffled across rows.  Rows are ranked by two independent hashes;
    values move from rank r of one order to rank r of the other
    (distributed prefix counts, equi-join on the rank)."""
    a = df.withColumn("_h1", F.xxhash64(id_col, F.lit(seed)).cast("double")).withColumn("_one", F.lit(1))
    a = prefix_sum(a, "_h1", ["_one"], tie=[id_col], hashed=True).withColumnRenamed("_one_cum", "_r").drop("_one", "_h1")
    b = df.select(id_col, *cols).withColumn("_h2", F.xxhash64(id_col, F.lit(seed + 7919)).cast("double")) \
        .withColumn("_one", F.lit(1))
    b = prefix_sum(b, "_h2", ["_one"], tie=[id_col], hashed=True).select(F.col("_one_cum").alias("_r"),
                                                           *[F.col(c).alias(f"_perm_{c}") for c in cols])
    return a.join(b, "_r").drop("_r")


def permutation_importance(model: PipelineModel, df: DataFrame, groups: dict[str, list[str]],
                           id_col: str, repeats: int = 5, label: str = "y") -> DataFrame:
    """AP drop when a group of columns is shuffled (mean over repeats); one shuffle a repeat serves all groups."""
    base = ranking_summary(score(model, df), "score", label).select(F.col("average_precision").alias("_ap0"))
    parts = []
    every = sorted({c for cols in groups.values() for c in cols})
    for r in range(repeats):
        moved = materialize(permute_columns(df, every, id_col, 100 + r), "permuted")
        for g, cols in groups.items():
            x = moved.select(*[F.col(f"`_perm_{c}`").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])
            ap = ranking_summary(score(model, x), "score", label)
            parts.append(ap.select(F.lit(g).alias("group"), F.lit(r).alias("rep"), "average_precision"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = with_scalars(u, base)
    return u.groupBy("group").agg(F.avg(F.col("_ap0") - F.col("average_precision")).alias("ap_drop"),
                                  F.stddev_samp(F.col("_ap0") - F.col("average_precision")).alias("ap_drop_sd"))


# ----------------------------------------------------------------- L10
#: fits of a search that run at the same time
FITS_AT_ONCE = 4


class AveragePrecisionEvaluator(Evaluator):
    """Step average precision (ties grouped) for ``search`` and Spark's own tuners."""

    def __init__(self, label: str = "y", raw: str = "probability"):
        super().__init__()
        self.label, self.raw = label, raw

    def _evaluate(self, dataset):
        s = dataset.withColumn("_s", vector_to_array(self.raw)[1])
        return ranking_summary(s, "_s", self.label).collect()[0]["average_precision"]

    def isLargerBetter(self):
        return True


def drawn_settings(space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """``n`` different settings from the product of the lists (all of them if there are fewer)."""
    total = math.prod(len(v) for v in space.values())
    out = []
    for k in random.Random(seed).sample(range(total), min(n, total)):
        setting = {}
        for name, values in space.items():
            k, i = divmod(k, len(values))
            setting[name] = values[i]
        out.append(setting)
    return out


def search(df: DataFrame, cols: list[str], kind: str, settings: list[dict], k: int = 3, id_col: str = "txn_id",
           weight: str | None = "w", at_once: int = FITS_AT_ONCE) -> DataFrame:
    """AP of each setting on the held-out and on the training part of ``k`` stratified folds:
    (setting, mean_ap, sd_ap, mean_train_ap, sd_train_ap, rank), sd as of a population."""
    # only what a fit reads is dealt to folds
    need = dict.fromkeys([id_col, "y", *([weight] if weight else []), *cols])
    folds = materialize(stratified_kfold(df.select(*need), id_col, k, name="fold"), "search-folds")
    ap = AveragePrecisionEvaluator()

    def fitted(job):
        setting, f = job
        train, held = folds.where(F.col("fold") != f), folds.where(F.col("fold") == f)
        m = pipeline(kind, cols, weight=weight, **setting).fit(train)
        return json.dumps(setting, sort_keys=True), float(ap.evaluate(m.transform(held))), float(ap.evaluate(m.transform(train)))

    # a fit is a chain of short jobs: several fill the executors
    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(fitted, [(setting, f) for setting in settings for f in range(k)]))
    t = df.sparkSession.createDataFrame(rows, "setting string, ap double, train_ap double").groupBy("setting").agg(
        F.avg("ap").alias("mean_ap"), F.stddev_pop("ap").alias("sd_ap"),
        F.avg("train_ap").alias("mean_train_ap"), F.stddev_pop("train_ap").alias("sd_train_ap"))
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_ap"), "setting")))  # a row for each setting


def combine_detectors(df: DataFrame, p1: str, p2: str, label: str = "y") -> DataFrame:
    """Union of two detectors' flags: coverage of positives by each and by the union,
    alert volume, precision; share of the first model's misses rescued by the second."""
    y = F.col(label)
    u = (F.col(p1) == 1) | (F.col(p2) == 1)
    return df.agg(
        F.sum(y).cast("long").alias("positives"),
        (F.sum(F.when((F.col(p1) == 1) & (y == 1), 1).otherwise(0)) / F.sum(y)).alias("coverage_first"),
        (F.sum(F.when(u & (y == 1), 1).otherwise(0)) / F.sum(y)).alias("coverage_union"),
        F.sum(F.col(p1)).cast("long").alias("alerts_first"),
        F.sum(F.when(u, 1).otherwise(0)).cast("long").alias("alerts_union"),
        (F.sum(F.when(u & (y == 1), 1).otherwise(0)) / F.sum(F.when(u, 1).otherwise(0))).alias("precision_union"),
        (F.sum(F.when((F.col(p1) == 0) & (F.col(p2) == 1) & (y == 1), 1).otherwise(0)) /
         F.sum(F.when((F.col(p1) == 0) & (y == 1), 1).otherwise(0))).alias("rescued_share"))


def choose_model(table: DataFrame, metric: str = "average_precision", noise: float = 0.0,
                 complexity: str = "complexity") -> DataFrame:
    """Best by ``metric``; any model within ``noise`` of the best and simpler
    (lower complexity) wins."""
    best = table.agg(F.max(metric).alias("_best"))
    x = with_scalars(table, best).where(F.col(metric) >= F.col("_best") - noise)
    return x.orderBy(F.asc(complexity), F.desc(metric)).limit(1).drop("_best")

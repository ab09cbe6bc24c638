"""Classification metrics, curves and threshold choice.

Ranking metrics are computed on the table of *distinct scores* (one row per
score value with its row and positive counts) and a distributed prefix sum
over it (``plans.prefix``).  No step sorts the row-level table in one task.

Conventions (fixed, as in the reference):
* a row is predicted positive when ``score >= threshold``;
* precision is 0 when there are no alerts; recall is null with no positives;
* average precision is the step sum Σ ΔR·P with tied scores grouped;
* ROC AUC counts tied positive/negative pairs as one half;
* the F1-optimal threshold is the lowest among equal maxima;
* the cost-optimal threshold is the highest among equal minima, and
  "no alerts" (threshold +inf) is a valid answer;
* inside a group of tied scores, a budget of m rows takes negatives first
  (pessimistic), so the count does not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import materialize, with_scalars
from txnscope.plans.prefix import prefix_sum

INF = float("inf")


# ---------------------------------------------------------------- confusion
def confusion(df: DataFrame, pred: str | Column, label: str = "y",
              by: list[str] | None = None) -> DataFrame:
    """M1: confusion counts and derived rates (optionally per group)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    y = F.col(label)
    aggs = [
        F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((p == 0) & (y == 1), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((p == 0) & (y == 0), 1).otherwise(0)).cast("long").alias("tn"),
    ]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return add_rates(g)


def add_rates(g: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return (
        g.withColumn("n", n)
        .withColumn("accuracy", F.when(n > 0, (tp + tn) / n))
        .withColumn("precision", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)))
        .withColumn("recall", F.when(tp + fn > 0, tp / (tp + fn)))
        .withColumn("f1", F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn))
                    .otherwise(F.lit(0.0)))
        .withColumn("alert_rate", F.when(n > 0, (tp + fp) / n))
    )


# ---------------------------------------------------------------- curves
def score_groups(df: DataFrame, score: str = "score", label: str = "y",
                 by: list[str] | None = None) -> DataFrame:
    """Collapse to (by…, score, n, pos, neg); partial aggregation before the shuffle."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*(by or []), F.col(score).cast("double").alias("score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).cast("long").alias("pos"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )


def curve(df: DataFrame, score: str = "score", label: str = "y",
          by: list[str] | None = None) -> DataFrame:
    """M4: ROC / PR points, one row per distinct score (alert when >= score),
    optionally per group ``by`` (one pass, grouped prefix sums)."""
    by = by or []
    # written once: cut points, running sums and totals all read it
    g = materialize(score_groups(df, score, label, by), "score-groups")
    c = prefix_sum(g, "score", ["n", "pos", "neg"], descending=True, by=by)
    if by:
        tot = g.groupBy(*by).agg(F.sum("pos").alias("_pos_all"), F.sum("neg").alias("_neg_all"))
        c = c.join(tot, by)
    else:
        tot = g.agg(F.sum("pos").alias("_pos_all"), F.sum("neg").alias("_neg_all"))
        c = with_scalars(c, tot)
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    return c.select(
        *by, "score", "n", "pos", "neg",
        F.col("n_cum").alias("alerts"), tp.alias("tp"), fp.alias("fp"),
        (F.col("_pos_all") - tp).alias("fn"), (F.col("_neg_all") - fp).alias("tn"),
        F.col("_pos_all").alias("total_pos"), F.col("_neg_all").alias("total_neg"),
        F.when(F.col("n_cum") > 0, tp / F.col("n_cum")).otherwise(F.lit(0.0)).alias("precision"),
        F.when(F.col("_pos_all") > 0, tp / F.col("_pos_all")).alias("recall"),
        F.when(F.col("_neg_all") > 0, fp / F.col("_neg_all")).alias("fpr"),
        F.when(F.col("_pos_all") + F.col("n_cum") > 0, 2 * tp / (F.col("_pos_all") + F.col("n_cum")))
        .otherwise(F.lit(0.0)).alias("f1"),
    )


def grouped_ranking(df: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """AP and ROC AUC per group."""
    c = curve(df, score, label, by)
    num_ap = F.sum(F.col("pos") * F.col("tp") / F.col("alerts"))
    num_auc = F.sum(F.col("pos") * (F.col("total_neg") - F.col("fp") + 0.5 * F.col("neg")))
    return c.groupBy(*by).agg(
        F.when(F.max("total_pos") > 0, num_ap / F.max("total_pos")).alias("average_precision"),
        F.when(F.max("total_pos") * F.max("total_neg") > 0,
               num_auc / (F.max("total_pos") * F.max("total_neg"))).alias("roc_auc"))


def average_precision(c: DataFrame) -> DataFrame:
    """M3 from a curve: Σ pos_s / P · precision_s."""
    return c.agg((F.sum(F.col("pos") * F.col("tp") / F.col("alerts")) / F.max("total_pos"))
                 .alias("average_precision"))


def roc_auc(c: DataFrame) -> DataFrame:
    """M2 from a curve (Mann–Whitney with ties counted one half)."""
    num = F.sum(F.col("pos") * (F.col("total_neg") - F.col("fp") + 0.5 * F.col("neg")))
    return c.agg(F.when(F.max("total_pos") * F.max("total_neg") > 0, num / (F.max("total_pos") * F.max("total_neg")))
                 .alias("roc_auc"))


def ranking_summary(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """AP and AUC in one pass over the curve."""
    c = curve(df, score, label)
    num_ap = F.sum(F.col("pos") * F.col("tp") / F.col("alerts"))
    num_auc = F.sum(F.col("pos") * (F.col("total_neg") - F.col("fp") + 0.5 * F.col("neg")))
    return c.agg(
        (num_ap / F.max("total_pos")).alias("average_precision"),
        F.when(F.max("total_pos") * F.max("total_neg") > 0, num_auc / (F.max("total_pos") * F.max("total_neg"))).alias("roc_auc"),
        F.max("total_pos").alias("positives"), F.max("total_neg").alias("negatives"),
    )


def best_f1_threshold(c: DataFrame) -> DataFrame:
    """M5: threshold of maximum F1; the lowest threshold among ties."""
    best = F.max_by(F.struct("score", "f1", "precision", "recall"),
                    F.struct(F.col("f1"), -F.col("score")))
    return c.agg(best.alias("b")).select(
        F.col("b.score").alias("threshold"), F.col("b.f1").alias("f1"),
        F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"))


def precision_at_recall(c: DataFrame, recalls: list[float]) -> DataFrame:
    """M6: best precision among thresholds whose recall is at least r."""
    aggs = [F.max(F.when(F.col("recall") >= r, F.col("precision"))).alias(f"p{i}")
            for i, r in enumerate(recalls)]
    row = c.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(float(r)).alias("min_recall"), F.col(f"p{i}").alias("best_precision"))
        for i, r in enumerate(recalls)])).alias("s")).select("s.*")


def threshold_sweep(df: DataFrame, thresholds: list[float], score: str = "score",
                    label: str = "y") -> DataFrame:
    """M7: detected, missed, alerts, false alarms, recall, precision per threshold."""
    g = score_groups(df, score, label)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = F.col("score") >= F.lit(float(t))
        aggs += [F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"d{i}"),
                 F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"a{i}")]
    aggs.append(F.sum("pos").alias("P"))
    row = g.agg(*aggs)
    s = row.select("P", F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"d{i}").alias("detected"),
                 F.col(f"a{i}").alias("alerts"))
        for i, t in enumerate(thresholds)])).alias("s")).select("P", "s.*")
    return s.select(
        "threshold", F.col("detected").cast("long").alias("detected"),
        (F.col("P") - F.col("detected")).cast("long").alias("missed"),
        F.col("alerts").cast("long").alias("alerts"),
        (F.col("alerts") - F.col("detected")).cast("long").alias("false_alarms"),
        F.when(F.col("P") > 0, F.col("detected") / F.col("P")).alias("recall"),
        F.when(F.col("alerts") > 0, F.col("detected") / F.col("alerts")).otherwise(F.lit(0.0))
        .alias("precision"),
    )


def _positives_in_top(c: DataFrame, m: Column) -> Column:
    """Positives among the top-m rows (ties: negatives first) as an aggregate."""
    before = F.col("alerts") - F.col("n")
    inside = (before < m) & (m <= F.col("alerts"))
    found = F.col("tp") - F.col("pos") + F.greatest(F.lit(0), m - before - F.col("neg"))
    return F.coalesce(F.max(F.when(inside, found)), F.max("total_pos"))


def review_budget(df: DataFrame, shares: list[float], score: str = "score",
                  label: str = "y") -> DataFrame:
    """M8: review the top ceil(k·n) rows: alerts, positives, recall, precision, lift."""
    c = curve(df, score, label)
    c = c.withColumn("_total", F.col("total_pos") + F.col("total_neg"))
    aggs = [F.max("_total").alias("n_total"), F.max("total_pos").alias("P")]
    for i, k in enumerate(shares):
        m = F.ceil(F.lit(float(k)) * F.col("_total"))
        aggs += [F.max(m).alias(f"m{i}"), _positives_in_top(c, m).alias(f"f{i}")]
    row = c.agg(*aggs)
    s = row.select("n_total", "P", F.explode(F.array(*[
        F.struct(F.lit(float(k)).alias("share"), F.col(f"m{i}").alias("alerts"),
                 F.col(f"f{i}").alias("found")) for i, k in enumerate(shares)])).alias("s")
    ).select("n_total", "P", "s.*")
    prec = F.col("found") / F.col("alerts")
    return s.select(
        "share", F.col("alerts").cast("long").alias("alerts"),
        F.col("found").cast("long").alias("found"),
        F.when(F.col("P") > 0, F.col("found") / F.col("P")).alias("recall"),
        prec.alias("precision"),
        F.when(F.col("P") > 0, prec / (F.col("P") / F.col("n_total"))).alias("lift"),
    )


def precision_at_k_unflagged(df: DataFrame, flagged: str | Column, second_score: str,
                             ks: list[int], label: str = "y") -> DataFrame:
    """precision@k and lift among rows the first model left unflagged,
    ranked by a second score."""
    f = F.col(flagged) if isinstance(flagged, str) else flagged
    rest = df.where(f == 0)
    c = curve(rest, second_score, label)
    aggs = [F.max(F.col("total_pos") + F.col("total_neg")).alias("n_total"),
            F.max("total_pos").alias("P")]
    for i, k in enumerate(ks):
        m = F.least(F.lit(int(k)).cast("long"), F.col("total_pos") + F.col("total_neg"))
        aggs += [F.max(m).alias(f"m{i}"), _positives_in_top(c, m).alias(f"f{i}")]
    row = c.agg(*aggs)
    s = row.select("n_total", "P", F.explode(F.array(*[
        F.struct(F.lit(int(k)).alias("k"), F.col(f"m{i}").alias("reviewed"),
                 F.col(f"f{i}").alias("found")) for i, k in enumerate(ks)])).alias("s")
    ).select("n_total", "P", "s.*")
    prec = F.col("found") / F.col("reviewed")
    return s.select(
        "k", F.col("found").cast("long").alias("found"), prec.alias("precision_at_k"),
        (F.col("P") / F.col("n_total")).alias("base_rate"),
        F.when(F.col("P") > 0, prec / (F.col("P") / F.col("n_total"))).alias("lift"))


def cost_thresholds(fit: DataFrame, test: DataFrame, ratios: list[float],
                    score: str = "score", label: str = "y") -> DataFrame:
    """M9: for each cost ratio r (miss costs r, false alarm costs 1) choose the
    threshold minimising fp + r·fn on ``fit`` (highest threshold on ties,
    +inf = no alerts), then report the cost on ``test`` against the F1
    threshold and against not alerting."""
    c = materialize(curve(fit, score, label), "fit-curve")
    none = c.agg(F.lit(INF).alias("score"), F.lit(0).cast("long").alias("fp"),
                 F.max("total_pos").alias("fn"))
    pts = c.select("score", "fp", "fn").unionByName(none)
    aggs = []
    for i, r in enumerate(ratios):
        cost = F.col("fp") + F.lit(float(r)) * F.col("fn")
        aggs.append(F.min_by("score", F.struct(cost, -F.col("score"))).alias(f"t{i}"))
    thr = pts.agg(*aggs)
    f1t = best_f1_threshold(c).select(F.col("threshold").alias("t_f1"))
    g = score_groups(test, score, label)
    g = with_scalars(with_scalars(g, thr), f1t)
    taggs = [F.sum("pos").alias("P"),
             F.sum(F.when(F.col("score") >= F.col("t_f1"), F.col("pos")).otherwise(0)).alias("tp_f1"),
             F.sum(F.when(F.col("score") >= F.col("t_f1"), F.col("neg")).otherwise(0)).alias("fp_f1")]
    for i, _ in enumerate(ratios):
        hit = F.col("score") >= F.col(f"t{i}")
        taggs += [F.max(f"t{i}").alias(f"t{i}"),
                  F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{i}"),
                  F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    row = g.agg(*taggs)
    s = row.select("P", "tp_f1", "fp_f1", F.explode(F.array(*[
        F.struct(F.lit(float(r)).alias("ratio"), F.col(f"t{i}").alias("threshold"),
                 F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, r in enumerate(ratios)])).alias("s")).select("P", "tp_f1", "fp_f1", "s.*")
    fn = F.col("P") - F.col("tp")
    cost = F.col("fp") + F.col("ratio") * fn
    cost_f1 = F.col("fp_f1") + F.col("ratio") * (F.col("P") - F.col("tp_f1"))
    none_cost = F.col("ratio") * F.col("P")
    return s.select(
        "ratio", "threshold", (F.col("tp") + F.col("fp")).cast("long").alias("alerts"),
        F.col("tp").cast("long").alias("detected"),
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("recall"),
        F.col("fp").cast("long").alias("false_alarms"), cost.alias("cost"),
        cost_f1.alias("cost_f1_threshold"), none_cost.alias("cost_no_model"),
        F.when(none_cost > 0, (1 - cost / none_cost) * 100).alias("saving_pct"),
        F.when(cost_f1 > 0, (1 - cost / cost_f1) * 100).alias("saving_vs_f1_pct"),
    )


def calibration(df: DataFrame, edges: list[float], score: str = "score",
                label: str = "y") -> DataFrame:
    """Left-closed score bins: rows, mean score, observed rate (empty bins dropped)."""
    inner = [float(e) for e in edges]
    idx = F.size(F.filter(F.array(*[F.lit(e) for e in inner[1:]]),
                          lambda e: e <= F.col(score)))
    x = df.where((F.col(score) >= inner[0]) & (F.col(score) < inner[-1])).withColumn("_bin", idx)
    lo = F.element_at(F.array(*[F.lit(e) for e in inner[:-1]]), F.col("_bin") + 1)
    hi = F.element_at(F.array(*[F.lit(e) for e in inner[1:]]), F.col("_bin") + 1)
    return x.groupBy("_bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(label).alias("observed_rate")
    ).select(lo.alias("lo"), hi.alias("hi"), "n", "mean_score", "observed_rate")


def prevalence_sensitivity(conf: DataFrame, prevalences: list[float]) -> DataFrame:
    """Expected precision π·TPR/(π·TPR+(1−π)·FPR), false alarms per hit,
    alerts per 100k rows, for each prevalence π, from a confusion row."""
    base = conf.select((F.col("tp") / (F.col("tp") + F.col("fn"))).alias("tpr"),
                       (F.col("fp") / (F.col("fp") + F.col("tn"))).alias("fpr"))
    s = base.select("tpr", "fpr", F.explode(F.array(*[F.lit(float(p)) for p in prevalences]))
                    .alias("prevalence"))
    hit = F.col("prevalence") * F.col("tpr")
    fa = (1 - F.col("prevalence")) * F.col("fpr")
    return s.select(
        "prevalence", F.when(hit + fa > 0, hit / (hit + fa)).alias("expected_precision"),
        F.when(hit > 0, fa / hit).alias("false_alarms_per_hit"),
        ((hit + fa) * 100000).alias("alerts_per_100k"))

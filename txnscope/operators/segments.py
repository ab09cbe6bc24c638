"""Segment, rule, fairness, exposure and privacy summaries
(M11, M12, M23, M24, B25, P1, P2, P6–P10, X4, X5).

Segment tables are built as: derive one column per cut → ``unpivot`` to
(cut, segment) → one ``groupBy`` with conditional sums; no per-segment loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.operators.metrics import add_rates, grouped_ranking
from txnscope.operators.stats import wilson
from txnscope.plans.frames import with_scalars
from txnscope.plans.quantile import exact_quantiles

# fixed values: segment labels of the segment report
AMOUNT_QUARTILE_LABELS = ["bajo", "medio-bajo", "medio-alto", "alto"]
HISTORY_BANDS = [(50, "<50 trx"), (200, "50-200"), (None, ">200")]
HOUR_BANDS = [(5, "madrugada"), (11, "manana"), (17, "tarde"), (None, "noche")]


def _right_closed(x: Column, bands) -> Column:
    out = None
    for hi, label in bands:
        cond = x <= hi if hi is not None else F.lit(True)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def quantile_labels(df: DataFrame, col: str, labels: list[str], by: list[str] | None = None
                    ) -> DataFrame:
    """qcut-like labels: bins at exact quantiles, right-closed, lowest value included."""
    k = len(labels)
    ps = [i / k for i in range(1, k)]
    cuts = exact_quantiles(df, col, ps, by=by)
    x = df.join(cuts, by, "left") if by else with_scalars(df, cuts)
    idx = F.size(F.filter("_q", lambda e: e < F.col(col)))
    return x.withColumn(f"{col}_band", F.element_at(F.array(*[F.lit(v) for v in labels]), idx + 1)) \
        .drop("_q")


def segment_metrics(df: DataFrame, cuts: dict[str, Column], pred: str = "p",
                    label: str = "y") -> DataFrame:
    """Precision / recall / F1 per (cut, segment); segments without positives dropped."""
    names = list(cuts)
    x = df.select(F.col(pred).alias("_p"), F.col(label).alias("_y"),
                  *[c.cast("string").alias(n) for n, c in cuts.items()])
    long = x.unpivot(["_p", "_y"], names, "cut", "segment").where(F.col("segment").isNotNull())
    g = long.groupBy("cut", "segment").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_y").cast("long").alias("positives"),
        F.sum(F.when((F.col("_p") == 1) & (F.col("_y") == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((F.col("_p") == 1) & (F.col("_y") == 0), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((F.col("_p") == 0) & (F.col("_y") == 1), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((F.col("_p") == 0) & (F.col("_y") == 0), 1).otherwise(0)).cast("long").alias("tn"))
    g = g.where(F.col("positives") > 0)
    return add_rates(g).select("cut", "segment", "rows", "positives", "precision", "recall", "f1")


def segment_metrics_with_ap(df: DataFrame, segment: Column, score: str, pred: str = "p",
                            label: str = "y") -> DataFrame:
    """Rows, positives, alerts, TP, FP, precision, recall, F1 and AP per segment."""
    x = df.withColumn("segment", segment)
    g = x.groupBy("segment").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).cast("long").alias("positives"),
        F.sum(F.col(pred)).cast("long").alias("alerts"),
        F.sum(F.when((F.col(pred) == 1) & (F.col(label) == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((F.col(pred) == 1) & (F.col(label) == 0), 1).otherwise(0)).cast("long").alias("fp"))
    g = g.withColumn("fn", F.col("positives") - F.col("tp")).withColumn(
        "tn", F.col("rows") - F.col("positives") - F.col("fp"))
    g = add_rates(g).drop("n", "accuracy", "alert_rate", "fn", "tn")
    ap = grouped_ranking(x, score, label, ["segment"]).select("segment", "average_precision")
    return g.join(ap, "segment", "left")


def rule_selection(train: DataFrame, test: DataFrame, rules: dict[str, Column],
                   label: str = "y") -> DataFrame:
    """B25 + M24: F1 of each boolean rule on train; the best (highest F1, then name)
    flagged; every rule also evaluated on test."""
    def per_rule(df):
        x = df.select(F.col(label).alias("_y"), *[c.cast("int").alias(n) for n, c in rules.items()])
        long = x.unpivot(["_y"], list(rules), "rule", "_p")
        g = long.groupBy("rule").agg(
            F.sum(F.when((F.col("_p") == 1) & (F.col("_y") == 1), 1).otherwise(0)).cast("long").alias("tp"),
            F.sum(F.when((F.col("_p") == 1) & (F.col("_y") == 0), 1).otherwise(0)).cast("long").alias("fp"),
            F.sum(F.when((F.col("_p") == 0) & (F.col("_y") == 1), 1).otherwise(0)).cast("long").alias("fn"),
            F.sum(F.when((F.col("_p") == 0) & (F.col("_y") == 0), 1).otherwise(0)).cast("long").alias("tn"))
        return add_rates(g)
    tr = per_rule(train).select("rule", F.col("f1").alias("f1_train"))
    best = tr.orderBy(F.desc("f1_train"), F.asc("rule")).limit(1).select(F.col("rule").alias("_best"))
    te = per_rule(test).select("rule", F.col("precision").alias("precision_test"),
                               F.col("recall").alias("recall_test"), F.col("f1").alias("f1_test"))
    return with_scalars(tr.join(te, "rule"), best).withColumn(
        "selected", F.col("rule") == F.col("_best")).drop("_best")


def group_metrics(df: DataFrame, group: str, pred: str = "p", label: str = "y") -> DataFrame:
    """Positive rate, alert rate, recall, FPR and precision per group."""
    p, y = F.col(pred), F.col(label)
    g = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(y).alias("positive_rate"),
        F.avg(p.cast("double")).alias("alert_rate"),
        F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).alias("_tp"),
        F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).alias("_fp"),
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    return g.select(group, "rows", "positive_rate", "alert_rate",
                    F.when(F.col("_pos") > 0, F.col("_tp") / F.col("_pos")).alias("recall"),
                    F.when(F.col("_neg") > 0, F.col("_fp") / F.col("_neg")).alias("fpr"),
                    F.when(F.col("_tp") + F.col("_fp") > 0, F.col("_tp") / (F.col("_tp") + F.col("_fp")))
                    .otherwise(F.lit(0.0)).alias("precision"))


def age_bands_with_fallback(df: DataFrame, age: str, key: str, schemes: dict[str, list],
                            label: str = "y", min_pos: int = 30, min_clients: int = 15
                            ) -> DataFrame:
    """Band rows by the first scheme whose every band has ≥ min_pos positives and
    ≥ min_clients affected clients; the last scheme is the fallback.  Each scheme is a
    list of (upper_bound_inclusive or None, label).  One aggregate over all schemes."""
    names = list(schemes)
    x = df.select(F.col(key).alias("_k"), F.col(label).alias("_y"),
                  *[_right_closed(F.col(age), schemes[n]).alias(n) for n in names])
    long = x.unpivot(["_k", "_y"], names, "scheme", "band")
    g = long.groupBy("scheme", "band").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_y").cast("long").alias("positives"),
        F.count_distinct(F.when(F.col("_y") == 1, F.col("_k"))).alias("affected_clients"))
    ok = g.groupBy("scheme").agg(F.min(((F.col("positives") >= min_pos) &
                                        (F.col("affected_clients") >= min_clients)).cast("int")).alias("_ok"))
    order = F.element_at(F.array(*[F.lit(i) for i in range(len(names))]),
                         F.array_position(F.array(*[F.lit(n) for n in names]), F.col("scheme")).cast("int"))
    ok = ok.withColumn("_ord", order)
    last = len(names) - 1
    chosen = ok.agg(F.min(F.when((F.col("_ok") == 1) | (F.col("_ord") == last), F.col("_ord"))).alias("_c"))
    g = g.withColumn("_ord", order)
    return with_scalars(g, chosen).where(F.col("_ord") == F.col("_c")).drop("_ord", "_c")


def exposure(df: DataFrame, key: str, group: str, pred: str = "p", label: str = "y") -> DataFrame:
    """Per group and in total (rollup): clients with ≥1 false alarm, victims (clients
    with a positive), victims with ≥1 miss, victims never alerted; rates and Wilson CI."""
    per = df.groupBy(group, key).agg(
        F.max(F.when((F.col(pred) == 1) & (F.col(label) == 0), 1).otherwise(0)).alias("_fa"),
        F.max(F.col(label)).alias("_victim"),
        F.max(F.when((F.col(pred) == 0) & (F.col(label) == 1), 1).otherwise(0)).alias("_miss"),
        F.max(F.when((F.col(pred) == 1) & (F.col(label) == 1), 1).otherwise(0)).alias("_caught"))
    r = per.rollup(group).agg(
        F.count(F.lit(1)).alias("clients"), F.sum("_fa").cast("long").alias("clients_false_alarm"),
        F.sum("_victim").cast("long").alias("victims"),
        F.sum(F.col("_victim") * F.col("_miss")).cast("long").alias("victims_missed"),
        F.sum(F.col("_victim") * (1 - F.col("_caught"))).cast("long").alias("victims_never_alerted"))
    r = r.withColumn(group, F.coalesce(F.col(group).cast("string"), F.lit("TOTAL")))
    lo, hi = wilson(F.col("clients_false_alarm"), F.col("clients"))
    return r.withColumn("false_alarm_rate", F.col("clients_false_alarm") / F.col("clients")) \
        .withColumn("false_alarm_ci_lo", lo).withColumn("false_alarm_ci_hi", hi) \
        .withColumn("miss_rate", F.when(F.col("victims") > 0, F.col("victims_missed") / F.col("victims")))


def false_alarm_concentration(df: DataFrame, key: str, pred: str = "p", label: str = "y"
                              ) -> DataFrame:
    """Share of clients with any false alarm, and the maximum per client."""
    per = df.groupBy(key).agg(F.sum(F.when((F.col(pred) == 1) & (F.col(label) == 0), 1)
                                    .otherwise(0)).alias("_fa"))
    return per.agg(F.count(F.lit(1)).alias("clients"),
                   F.avg((F.col("_fa") > 0).cast("double")).alias("share_with_false_alarm"),
                   F.max("_fa").cast("long").alias("max_false_alarms"),
                   F.sum("_fa").cast("long").alias("false_alarms"))


def k_anonymity(df: DataFrame, qi: list[str], k: int = 5) -> DataFrame:
    """Equivalence classes over quasi-identifiers: unique rows, rows in classes
    smaller than k, and their shares."""
    g = df.groupBy(*qi).agg(F.count(F.lit(1)).alias("_m"))
    return g.agg(F.sum("_m").cast("long").alias("rows"), F.count(F.lit(1)).alias("classes"),
                 F.sum(F.when(F.col("_m") == 1, 1).otherwise(0)).cast("long").alias("unique_rows"),
                 F.sum(F.when(F.col("_m") < k, F.col("_m")).otherwise(0)).cast("long").alias("rows_below_k"),
                 F.min("_m").cast("long").alias("min_class")) \
        .withColumn("share_unique", F.col("unique_rows") / F.col("rows")) \
        .withColumn("share_below_k", F.col("rows_below_k") / F.col("rows"))


def attribute_stability(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Composition of an attribute over entities and entities with > 1 value."""
    per = df.groupBy(key).agg(F.count_distinct(attr).alias("_nv"), F.min(attr).alias("_v"))
    comp = per.groupBy(F.col("_v").alias("value")).agg(F.count(F.lit(1)).alias("entities"))
    unstable = per.agg(F.sum(F.when(F.col("_nv") > 1, 1).otherwise(0)).cast("long").alias("entities_multi_value"),
                       F.count(F.lit(1)).alias("_tot"))
    return with_scalars(comp, unstable).withColumn("share", F.col("entities") / F.col("_tot")).drop("_tot")


def period_concentration(df: DataFrame, period: Column, pred: str = "p", label: str = "y"
                         ) -> DataFrame:
    """P10: share of rows, positives and alerts falling in each period."""
    x = df.withColumn("period", period)
    g = x.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("_pos"),
                                F.sum(pred).alias("_al"))
    tot = x.agg(F.count(F.lit(1)).alias("_tr"), F.sum(label).alias("_tp"), F.sum(pred).alias("_ta"))
    return with_scalars(g, tot).select(
        "period", (F.col("rows") / F.col("_tr")).alias("share_rows"),
        F.when(F.col("_tp") > 0, F.col("_pos") / F.col("_tp")).alias("share_positives"),
        F.when(F.col("_ta") > 0, F.col("_al") / F.col("_ta")).alias("share_alerts"))


def extreme_cases(df: DataFrame, id_col: str, score: str, threshold: float,
                  label: str = "y") -> DataFrame:
    """Highest-score alert, highest-score false alarm, alert nearest the threshold
    (ties broken by the id)."""
    alert = F.col(score) >= threshold
    key_hi = F.struct(F.col(score), -F.col(id_col))
    key_lo = F.struct(-F.col(score), -F.col(id_col))
    row = df.agg(F.max_by(F.struct(id_col, score, label), F.when(alert, key_hi)).alias("a"),
                 F.max_by(F.struct(id_col, score, label), F.when(alert & (F.col(label) == 0), key_hi)).alias("b"),
                 F.max_by(F.struct(id_col, score, label), F.when(alert, key_lo)).alias("c"))
    return row.select(F.explode(F.array(
        F.struct(F.lit("highest_alert").alias("case"), F.col("a").alias("r")),
        F.struct(F.lit("highest_false_alarm").alias("case"), F.col("b").alias("r")),
        F.struct(F.lit("nearest_threshold").alias("case"), F.col("c").alias("r")))).alias("s")) \
        .select("s.case", F.col(f"s.r.{id_col}").alias(id_col), F.col(f"s.r.{score}").alias(score),
                F.col(f"s.r.{label}").alias(label))


def top_contributions(contribs: Column, n: int = 5, tiny: float = 1e-6) -> Column:
    """The n entries of an array<struct<variable, contribution>> with largest
    |contribution|, tiny ones dropped, with a direction label."""
    kept = F.filter(contribs, lambda s: F.abs(s["contribution"]) > tiny)
    ordered = F.array_sort(kept, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                           .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                           .otherwise(F.when(a["variable"] < b["variable"], -1)
                                      .when(a["variable"] > b["variable"], 1).otherwise(0)))
    top = F.slice(ordered, 1, n)
    return F.transform(top, lambda s: F.struct(
        s["variable"].alias("variable"), s["contribution"].alias("contribution"),
        F.when(s["contribution"] > 0, F.lit("raises")).otherwise(F.lit("lowers")).alias("direction")))

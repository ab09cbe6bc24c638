"""Evaluation queries on ``scored_lines``.

The oracles compute the same numbers with row-level SQL windows (brute
force); the Spark side uses the distinct-score prefix plan.
"""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.operators import metrics as M
from txnscope.sources import scored_lines

THRESHOLD = 60

CONFUSION_SQL = f"""
SELECT tp, fp, fn, tn, n, r6((tp + tn) / n) AS accuracy,
       r6(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) AS precision,
       r6(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END) AS recall,
       r6(CASE WHEN 2*tp + fp + fn > 0 THEN 2*tp / (2*tp + fp + fn) ELSE 0.0 END) AS f1,
       r6((tp + fp) / n) AS alert_rate
FROM (SELECT CAST(count(*) FILTER (WHERE p = 1 AND y = 1) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE p = 1 AND y = 0) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE p = 0 AND y = 1) AS BIGINT) AS fn,
             CAST(count(*) FILTER (WHERE p = 0 AND y = 0) AS BIGINT) AS tn,
             CAST(count(*) AS BIGINT) AS n
      FROM (SELECT y, CASE WHEN score_i >= {THRESHOLD} THEN 1 ELSE 0 END AS p FROM scored_lines))
"""


@query("m1_confusion_at_threshold", CONFUSION_SQL)
def confusion(spark, sf_dir):
    """M1: confusion counts, accuracy, precision, recall, F1, alert rate."""
    t = scored_lines(spark, sf_dir).withColumn(
        "p", F.when(F.col("score_i") >= THRESHOLD, 1).otherwise(0))
    return M.confusion(t, "p", "y").select("tp", "fp", "fn", "tn", "n", "accuracy",
                                           "precision", "recall", "f1", "alert_rate")


CURVE_CTE = """
g AS (SELECT CAST(score_i AS DOUBLE) AS score, count(*) AS n, sum(y) AS pos
      FROM scored_lines WHERE score_i IS NOT NULL GROUP BY 1),
c AS (SELECT score, n, pos, n - pos AS neg,
             sum(n) OVER (ORDER BY score DESC) AS alerts,
             sum(pos) OVER (ORDER BY score DESC) AS tp,
             sum(n - pos) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () AS total_pos, sum(n - pos) OVER () AS total_neg FROM g)
"""

CURVE_SQL = f"""
WITH {CURVE_CTE}
SELECT score, CAST(n AS BIGINT) AS n, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
       CAST(alerts AS BIGINT) AS alerts, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(total_pos - tp AS BIGINT) AS fn, CAST(total_neg - fp AS BIGINT) AS tn,
       CAST(total_pos AS BIGINT) AS total_pos, CAST(total_neg AS BIGINT) AS total_neg,
       r6(tp / alerts) AS precision, r6(tp / total_pos) AS recall, r6(fp / total_neg) AS fpr,
       r6(2 * tp / (total_pos + alerts)) AS f1
FROM c
"""


@query("m4_roc_pr_curve", CURVE_SQL)
def curve(spark, sf_dir):
    """M4: ROC and PR points at every distinct score."""
    return M.curve(scored_lines(spark, sf_dir), "score_i", "y")


RANKING_SQL = """
WITH r AS (SELECT y, score_i,
                  sum(y) OVER (ORDER BY score_i DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                  count(*) OVER (ORDER BY score_i DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
           FROM scored_lines),
ap AS (SELECT sum(CASE WHEN y = 1 THEN tp / k END) / sum(y) AS average_precision FROM r),
auc AS (SELECT sum(CASE WHEN s_gt THEN n1 * n0 ELSE 0.5 * n1 * n0 END) AS u FROM
          (SELECT a.score_i > b.score_i AS s_gt, a.n1, b.n0 FROM
             (SELECT score_i, count(*) AS n1 FROM scored_lines WHERE y = 1 GROUP BY 1) a JOIN
             (SELECT score_i, count(*) AS n0 FROM scored_lines WHERE y = 0 GROUP BY 1) b
             ON a.score_i >= b.score_i))
SELECT r6(ap.average_precision) AS average_precision,
       r6(auc.u / ((SELECT sum(y) FROM scored_lines) * (SELECT sum(1 - y) FROM scored_lines))) AS roc_auc,
       CAST((SELECT sum(y) FROM scored_lines) AS BIGINT) AS positives,
       CAST((SELECT sum(1 - y) FROM scored_lines) AS BIGINT) AS negatives
FROM ap, auc
"""


@query("m2_m3_average_precision_auc", RANKING_SQL)
def ranking(spark, sf_dir):
    """M2 + M3: ROC AUC (ties one half) and step average precision."""
    return M.ranking_summary(scored_lines(spark, sf_dir), "score_i", "y")


BEST_F1_SQL = f"""
WITH {CURVE_CTE}
SELECT score AS threshold, r6(2 * tp / (total_pos + alerts)) AS f1, r6(tp / alerts) AS precision,
       r6(tp / total_pos) AS recall
FROM c ORDER BY 2 * tp / (total_pos + alerts) DESC, score ASC LIMIT 1
"""


@query("m5_best_f1_threshold", BEST_F1_SQL)
def best_f1(spark, sf_dir):
    """M5: F1-optimal threshold, lowest among ties."""
    return M.best_f1_threshold(M.curve(scored_lines(spark, sf_dir), "score_i", "y"))


RECALLS = [0.1, 0.25, 0.5, 0.75, 0.9]
PREC_AT_RECALL_SQL = f"""
WITH {CURVE_CTE}, rs AS (SELECT unnest({RECALLS}) AS min_recall)
SELECT rs.min_recall, r6(max(tp / alerts)) AS best_precision
FROM rs LEFT JOIN c ON tp / total_pos >= rs.min_recall GROUP BY rs.min_recall
"""


@query("m6_precision_at_recall", PREC_AT_RECALL_SQL)
def prec_at_recall(spark, sf_dir):
    """M6: best precision subject to recall >= r."""
    return M.precision_at_recall(M.curve(scored_lines(spark, sf_dir), "score_i", "y"), RECALLS)


SWEEP = [10, 30, 50, 60, 70, 90]
SWEEP_SQL = f"""
WITH t AS (SELECT CAST(unnest({SWEEP}) AS DOUBLE) AS threshold),
a AS (SELECT threshold, count(s.y) AS alerts, coalesce(sum(s.y), 0) AS detected
      FROM t LEFT JOIN scored_lines s ON s.score_i >= t.threshold GROUP BY threshold),
p AS (SELECT sum(y) AS total_pos FROM scored_lines)
SELECT threshold, CAST(detected AS BIGINT) AS detected, CAST(total_pos - detected AS BIGINT) AS missed,
       CAST(alerts AS BIGINT) AS alerts, CAST(alerts - detected AS BIGINT) AS false_alarms,
       r6(detected / total_pos) AS recall,
       r6(CASE WHEN alerts > 0 THEN detected / alerts ELSE 0.0 END) AS precision
FROM a, p
"""


@query("m7_threshold_sweep", SWEEP_SQL)
def sweep(spark, sf_dir):
    """M7: threshold sweep table."""
    return M.threshold_sweep(scored_lines(spark, sf_dir), SWEEP, "score_i", "y")


BUDGET = [0.0025, 0.005, 0.01, 0.02, 0.05, 0.10]
BUDGET_SQL = f"""
WITH r AS (SELECT y, row_number() OVER (ORDER BY score_i DESC, y ASC) AS rn FROM scored_lines),
c AS (SELECT rn, sum(y) OVER (ORDER BY rn) AS found FROM r),
tot AS (SELECT count(*) AS n_total, sum(y) AS total_pos FROM scored_lines),
k AS (SELECT unnest({BUDGET}) AS share),
m AS (SELECT share, CAST(ceil(share * n_total) AS BIGINT) AS alerts, n_total, total_pos FROM k, tot)
SELECT share, alerts, CAST(found AS BIGINT) AS found, r6(found / total_pos) AS recall,
       r6(found / alerts) AS precision, r6((found / alerts) / (total_pos / n_total)) AS lift
FROM m JOIN c ON c.rn = m.alerts
"""


@query("m8_review_budget", BUDGET_SQL)
def budget(spark, sf_dir):
    """M8: review top k% of rows by score (ties: negatives first)."""
    return M.review_budget(scored_lines(spark, sf_dir), BUDGET, "score_i", "y")


KS = [50, 100, 200]
PREC_AT_K_SQL = f"""
WITH u AS (SELECT * FROM scored_lines WHERE score_i < {THRESHOLD}),
r AS (SELECT y, row_number() OVER (ORDER BY amount DESC, y ASC) AS rn FROM u),
c AS (SELECT rn, sum(y) OVER (ORDER BY rn) AS found FROM r),
tot AS (SELECT count(*) AS n_total, sum(y) AS total_pos FROM u),
k AS (SELECT unnest({KS}) AS k)
SELECT k.k AS k, CAST(found AS BIGINT) AS found, r6(found / k.k) AS precision_at_k,
       r6(total_pos / n_total) AS base_rate, r6((found / k.k) / (total_pos / n_total)) AS lift
FROM k JOIN c ON c.rn = k.k, tot
"""


@query("x3_precision_at_k_unflagged", PREC_AT_K_SQL)
def prec_at_k(spark, sf_dir):
    """precision@k and lift on rows the main rule left unflagged, ranked by amount."""
    t = scored_lines(spark, sf_dir).withColumn(
        "p", F.when(F.col("score_i") >= THRESHOLD, 1).otherwise(0))
    return M.precision_at_k_unflagged(t, "p", "amount", KS, "y")


CUT = "1999-01-01"
RATIOS = [1.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0]
COST_SQL = f"""
WITH fit AS (SELECT * FROM scored_lines WHERE ts < TIMESTAMP '{CUT}'),
tst AS (SELECT * FROM scored_lines WHERE ts >= TIMESTAMP '{CUT}'),
g AS (SELECT CAST(score_i AS DOUBLE) AS score, count(*) AS n, sum(y) AS pos FROM fit GROUP BY 1),
c AS (SELECT score, sum(n - pos) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () - sum(pos) OVER (ORDER BY score DESC) AS fn,
             sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS alerts,
             sum(pos) OVER () AS total_pos FROM g),
pts AS (SELECT score, fp, fn FROM c UNION ALL SELECT 'inf'::DOUBLE, 0, (SELECT sum(pos) FROM g)),
rs AS (SELECT unnest({RATIOS}) AS ratio),
thr AS (SELECT ratio, score AS threshold FROM (
          SELECT ratio, score, row_number() OVER (PARTITION BY ratio ORDER BY fp + ratio * fn, score DESC) AS rk
          FROM rs, pts) WHERE rk = 1),
f1t AS (SELECT score AS t_f1 FROM c ORDER BY 2 * tp / (total_pos + alerts) DESC, score ASC LIMIT 1),
tt AS (SELECT sum(y) AS total_pos,
              sum(CASE WHEN score_i >= (SELECT t_f1 FROM f1t) THEN y ELSE 0 END) AS tp_f1,
              sum(CASE WHEN score_i >= (SELECT t_f1 FROM f1t) THEN 1 - y ELSE 0 END) AS fp_f1 FROM tst),
ev AS (SELECT thr.ratio, thr.threshold,
              sum(CASE WHEN s.score_i >= thr.threshold THEN s.y ELSE 0 END) AS tp,
              sum(CASE WHEN s.score_i >= thr.threshold THEN 1 - s.y ELSE 0 END) AS fp
       FROM thr, tst s GROUP BY thr.ratio, thr.threshold)
SELECT ev.ratio, ev.threshold, CAST(tp + fp AS BIGINT) AS alerts, CAST(tp AS BIGINT) AS detected,
       r6(tp / total_pos) AS recall, CAST(fp AS BIGINT) AS false_alarms,
       r6(fp + ratio * (total_pos - tp)) AS cost,
       r6(fp_f1 + ratio * (total_pos - tp_f1)) AS cost_f1_threshold,
       r6(ratio * total_pos) AS cost_no_model,
       r6((1 - (fp + ratio * (total_pos - tp)) / (ratio * total_pos)) * 100) AS saving_pct,
       r6((1 - (fp + ratio * (total_pos - tp)) / (fp_f1 + ratio * (total_pos - tp_f1))) * 100) AS saving_vs_f1_pct
FROM ev, tt
"""


@query("m9_cost_optimal_threshold", COST_SQL)
def cost(spark, sf_dir):
    """M9: cost-optimal threshold per cost ratio, chosen before the cut, evaluated after."""
    t = scored_lines(spark, sf_dir)
    fit = t.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    tst = t.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return M.cost_thresholds(fit, tst, RATIOS, "score_i", "y")


EDGES = [0, 0.01, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0001]
CALIB_SQL = f"""
WITH e AS (SELECT {EDGES} AS edges),
b AS (SELECT s, y, (SELECT count(*) FROM unnest(edges[2:]) AS t(v) WHERE v <= s) AS bin
      FROM (SELECT score_i / 100.0 AS s, y FROM scored_lines), e
      WHERE s >= {EDGES[0]} AND s < {EDGES[-1]})
SELECT CAST(({EDGES[:-1]})[bin + 1] AS DOUBLE) AS lo, CAST(({EDGES[1:]})[bin + 1] AS DOUBLE) AS hi,
       count(*) AS n, r6(avg(s)) AS mean_score, r6(avg(y)) AS observed_rate
FROM b GROUP BY bin
"""


@query("m10_calibration_table", CALIB_SQL)
def calibration(spark, sf_dir):
    """Calibration by left-closed score bins (score_i / 100 as probability)."""
    t = scored_lines(spark, sf_dir).withColumn("s", F.col("score_i") / 100.0)
    return M.calibration(t, EDGES, "s", "y")


PREVALENCES = [0.001, 0.005, 0.0062, 0.01, 0.05]
PREV_SQL = f"""
WITH c AS (SELECT sum(CASE WHEN score_i >= {THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS tp,
                  sum(CASE WHEN score_i >= {THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS fp,
                  sum(CASE WHEN score_i < {THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS fn,
                  sum(CASE WHEN score_i < {THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS tn FROM scored_lines),
r AS (SELECT tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr FROM c),
p AS (SELECT unnest({PREVALENCES}) AS prevalence)
SELECT prevalence, r6(prevalence * tpr / (prevalence * tpr + (1 - prevalence) * fpr)) AS expected_precision,
       r6((1 - prevalence) * fpr / (prevalence * tpr)) AS false_alarms_per_hit,
       r6((prevalence * tpr + (1 - prevalence) * fpr) * 100000) AS alerts_per_100k
FROM p, r
"""


@query("m22_prevalence_sensitivity", PREV_SQL)
def prevalence(spark, sf_dir):
    """Expected precision, false alarms per hit, alerts per 100k by prevalence."""
    t = scored_lines(spark, sf_dir).withColumn(
        "p", F.when(F.col("score_i") >= THRESHOLD, 1).otherwise(0))
    return M.prevalence_sensitivity(M.confusion(t, "p", "y"), PREVALENCES)

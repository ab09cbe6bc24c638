"""Resampling queries (M13–M16, D10, P3, P4).  Random by construction, so they
are checked by invariants (tests) rather than by an SQL oracle."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.catalog.q_segments import scored_events
from txnscope.operators import resample as B
from txnscope.operators.metrics import confusion, ranking_summary
from txnscope.plans.frames import materialize, with_scalars
from txnscope.sources import scored_lines


def _lines(spark, sf_dir):
    return scored_lines(spark, sf_dir).withColumn("p", (F.col("score_i") >= 60).cast("int")) \
        .withColumn("score_coarse", F.floor(F.col("score_i") / 10).cast("double"))


@query("m13_bootstrap_f1_ci")
def boot_f1(spark, sf_dir):
    """2,000-replicate row bootstrap of F1 from multinomial draws of the confusion
    cells: point F1, 95 % interval, sd, minimum distinguishable difference."""
    s = _lines(spark, sf_dir)
    cells = B.confusion_cells(s, "p")
    draws = B.bootstrap_f1_cells(cells, 2000, seed=0)
    point = confusion(s, "p", "y").select(F.col("f1").alias("f1_point"), "tp", "fn")
    return B.ci_summary(draws, "f1", point)


CELLS_SQL = """c AS (SELECT {by} CAST(count(*) FILTER (WHERE p AND y = 1) AS BIGINT) AS tp, count(*) FILTER (WHERE p AND y = 0) AS fp,
       CAST(count(*) FILTER (WHERE NOT p AND y = 1) AS BIGINT) AS fn FROM ({rows}) {group})"""
F1_FACTS_SQL = "WITH " + CELLS_SQL.format(by="", rows="SELECT score_i >= 60 AS p, y FROM scored_lines", group="") + """
SELECT r6(2 * tp / (2 * tp + fp + fn)) AS f1_point, tp, fn, CAST(2000 AS BIGINT) AS effective_b, true AS contains_point, true AS two_sd FROM c
"""


@query("m13_bootstrap_facts", F1_FACTS_SQL)
def boot_f1_facts(spark, sf_dir):
    """M13, what SQL can state: the point and its cells, the replicates, the interval holds the point, the difference is 2 sd."""
    return boot_f1(spark, sf_dir).select("f1_point", "tp", "fn", "effective_b", F.col("f1_point").between(F.col("ci_lo"), F.col("ci_hi")).alias("contains_point"),
                                         (F.abs(F.col("min_distinguishable") - 2 * F.col("sd")) < 1e-12).alias("two_sd"))


METRICS = ("precision", "recall", "f1", "ap")


@query("m14_m16_paired_ap_bootstrap")
def paired(spark, sf_dir):
    """M14 + M16 + D10: precision, recall, F1 (at 60) and AP of a fine and a coarse score on 1,000 shared Poisson
    resamples; per metric the observed difference, CI, P(fine > coarse), includes-zero flag."""
    s = _lines(spark, sf_dir)
    draws = materialize(B.paired_draws(s, "score_i", "score_coarse", 60, 7, "y", b=1000, seed=1), "paired-draws")
    obs = None
    for m, score, at in (("_a", "score_i", 60), ("_b", "score_coarse", 7)):
        c = confusion(s.withColumn("p", (F.col(score) >= at).cast("int")), "p", "y").select(*[F.col(k).alias(k + m) for k in METRICS[:3]])
        c = with_scalars(c, ranking_summary(s, score, "y").select(F.col("average_precision").alias("ap" + m)))
        obs = c if obs is None else with_scalars(obs, c)
    obs = materialize(obs, "paired-observed")
    rows = [B.paired_difference(draws, k + "_a", k + "_b", obs).withColumn("metric", F.lit(k)) for k in METRICS]
    return reduce(DataFrame.unionByName, rows)


BOTH_SQL = "WITH " + CELLS_SQL.format(by="which,", group="GROUP BY which", rows="""
SELECT 'a' AS which, score_i >= 60 AS p, y FROM scored_lines UNION ALL SELECT 'b', floor(score_i / 10) >= 7, y FROM scored_lines""")
PAIRED_FACTS_SQL = BOTH_SQL + """,
m AS (SELECT which, unnest(['precision', 'recall', 'f1']) AS metric,
             unnest([CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, tp / (tp + fn), 2 * tp / (2 * tp + fp + fn)]) AS v FROM c)
SELECT metric, r6(max(v) FILTER (WHERE which = 'a') - max(v) FILTER (WHERE which = 'b')) AS observed_diff, CAST(1000 AS BIGINT) AS effective_b,
       true AS contains_observed, true AS zero_flag_right FROM m GROUP BY metric
"""


@query("m14_m16_paired_facts", PAIRED_FACTS_SQL)
def paired_facts(spark, sf_dir):
    """M14 + M16 + D10, what SQL can state of precision, recall and F1: the observed difference, the replicates, the interval
    holds the difference and the zero flag follows from it."""
    inside = F.col("observed_diff").between(F.col("ci_lo"), F.col("ci_hi"))
    zero = F.col("includes_zero") == F.lit(0.0).between(F.col("ci_lo"), F.col("ci_hi"))
    return paired(spark, sf_dir).where("metric != 'ap'").select("metric", "observed_diff", "effective_b", inside.alias("contains_observed"), zero.alias("zero_flag_right"))


@query("m15_cluster_bootstrap_f1")
def cluster(spark, sf_dir):
    """Intervals of precision, recall, F1 and AP, 1,000 times resampling whole clients."""
    s = materialize(_lines(spark, sf_dir).select("client_id", "score_i", "p", "y"), "cluster-rows")
    draws = materialize(B.cluster_bootstrap(s, "client_id", b=1000, seed=2, score="score_i"), "cluster-draws")
    point = with_scalars(confusion(s, "p", "y").select(*METRICS[:3]),
                         ranking_summary(s, "score_i", "y").select(F.col("average_precision").alias("ap")))
    point = materialize(point, "cluster-point")
    rows = [B.ci_summary(draws, k, point.select(F.lit(k).alias("metric"), F.col(k).alias("point"))) for k in METRICS]
    return reduce(DataFrame.unionByName, rows)


@query("p3_p4_group_recall_gap_ci")
def group_gap(spark, sf_dir):
    """P3 + P4: precision, recall and false-positive rate per group, 1,000 times resampling clients inside each
    group; max−min gap across groups with CI and a distinguishable flag."""
    e = scored_events(spark, sf_dir).where(F.col("sex").isNotNull())
    draws = materialize(B.cluster_bootstrap(e, "client_id", b=1000, seed=3, group="sex"), "group-draws")
    sums = B.with_cells(e, "p").groupBy("sex").agg(*[F.sum(c).alias(c) for c in B.CELLS])
    obs = materialize(sums.select("sex", *[v.alias(k) for k, v in B.cell_metrics().items()]), "group-observed")
    return reduce(DataFrame.unionByName, [B.group_gap(draws, "sex", k, obs) for k in ("precision", "recall", "fpr")])


@query("o9_weighted_sampling_with_replacement")
def o9_sample(spark, sf_dir):
    """5,000 draws with replacement weighted by amount; drawn rows, distinct rows and
    the sample mean next to the exact weighted mean Σa²/Σa it estimates."""
    from txnscope.sources import txn_events
    e = txn_events(spark, sf_dir)
    s = B.weighted_sample(e, "amount", 5000, "txn_id")
    exp = e.agg((F.sum(F.col("amount") * F.col("amount")) / F.sum("amount")).alias("weighted_mean"))
    got = s.agg(F.count(F.lit(1)).alias("draws"), F.count_distinct("txn_id").alias("distinct_rows"),
                F.avg("amount").alias("sample_mean"))
    return with_scalars(got, exp)


SAMPLE_FACTS_SQL = """
SELECT CAST(5000 AS BIGINT) AS draws, r6(sum(amount * amount) / sum(amount)) AS weighted_mean, true AS mean_near FROM txn_events
"""


@query("o9_weighted_sampling_facts", SAMPLE_FACTS_SQL)
def o9_facts(spark, sf_dir):
    """O9, what SQL can state: the number of draws, the exact weighted mean, and that the sample mean is within a tenth of it."""
    return o9_sample(spark, sf_dir).select("draws", "weighted_mean", (F.abs(F.col("sample_mean") / F.col("weighted_mean") - 1) < 0.1).alias("mean_near"))


MOVE_SQL = """
WITH c AS (SELECT count(*) FILTER (WHERE category = 'view') AS nv FROM txn_events),
m AS (SELECT CAST(round(nv * 0.2) AS BIGINT) AS moved FROM c),
b AS (SELECT category, count(*) AS n FROM txn_events GROUP BY category)
SELECT category, CAST(CASE WHEN category = 'view' THEN n - moved WHEN category = 'purchase' THEN n + moved ELSE n END AS BIGINT) AS rows
FROM b, m
"""


@query("o9_share_limited_move", MOVE_SQL)
def o9_move(spark, sf_dir):
    """Move exactly 20 % of 'view' rows to 'purchase' (hash-rank quota)."""
    from txnscope.sources import txn_events
    e = B.move_share(txn_events(spark, sf_dir), "category", "view", "purchase", 0.2, "txn_id")
    return e.groupBy("category").agg(F.count(F.lit(1)).alias("rows"))

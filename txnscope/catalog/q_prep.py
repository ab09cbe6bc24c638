"""Encoder (J), split (K) and drift (N) queries."""

from pyspark.sql import functions as F

from txnscope.catalog.q_history import history_raw_sql
from txnscope.catalog.registry import query
from txnscope.plans.frames import materialize, materialize_once
from txnscope.operators import drift as N
from txnscope.operators import encode as J
from txnscope.operators import history as H
from txnscope.operators import split as K
from txnscope.operators.metrics import confusion, ranking_summary
from txnscope.plans.frames import with_scalars
from txnscope.sources import scored_lines, txn_events, txn_orders

CUT = "1998-01-01"

FEAT_CTE = f"""feat AS (SELECT o.*, h.gap_hours, h.prior_count, h.prior_mean, h.prior_sd, h.z_amount_abs
                        FROM txn_orders o JOIN ({history_raw_sql('txn_orders')}) h ON o.txn_id = h.txn_id),
tr AS (SELECT * FROM feat WHERE ts < TIMESTAMP '{CUT}'),
te AS (SELECT * FROM feat WHERE ts >= TIMESTAMP '{CUT}')"""


def features(spark, sf_dir):
    return H.history_features(txn_orders(spark, sf_dir), chunk_hours=24 * 90)


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


def train_test(spark, sf_dir):
    f = features(spark, sf_dir)
    return f.where(F.col("ts") < _cut()), f.where(F.col("ts") >= _cut())


MEDIAN_SQL = f"""WITH {FEAT_CTE}
SELECT te.txn_id, r6(coalesce(te.gap_hours, (SELECT quantile_cont(gap_hours, 0.5) FROM tr))) AS gap_hours FROM te
"""


@query("j1_median_imputation_train_only", MEDIAN_SQL)
def median(spark, sf_dir):
    """Gap hours imputed with the train median."""
    tr, te = train_test(spark, sf_dir)
    return J.apply_median(te, "gap_hours", J.fit_median(tr, "gap_hours")).select("txn_id", "gap_hours")


TE_SQL = """WITH {cte},
g AS (SELECT avg(y) AS gr FROM tr),
m AS (SELECT client_id, {expr} AS te FROM tr, g GROUP BY client_id, g.gr)
SELECT te.txn_id, r6(coalesce(m.te, g.gr)) AS client_te FROM te LEFT JOIN m ON te.client_id = m.client_id, g
"""


@query("j2_target_encoding_unsmoothed",
       TE_SQL.format(cte=FEAT_CTE, expr="sum(y) / count(*)"))
def te_plain(spark, sf_dir):
    """Unsmoothed train-only target encoding of the client; unseen → global rate."""
    tr, te = train_test(spark, sf_dir)
    t, g = J.fit_target_encoding(tr, "client_id")
    return J.apply_target_encoding(te, "client_id", t, g, "client_te").select("txn_id", "client_te")


@query("j3_target_encoding_smoothed",
       TE_SQL.format(cte=FEAT_CTE, expr="(sum(y) + 50 * g.gr) / (count(*) + 50)"))
def te_smooth(spark, sf_dir):
    """Smoothed target encoding (sum + m·g)/(n + m), m = 50."""
    tr, te = train_test(spark, sf_dir)
    t, g = J.fit_target_encoding(tr, "client_id", smoothing=50)
    return J.apply_target_encoding(te, "client_id", t, g, "client_te").select("txn_id", "client_te")


MS = [0.0, 10.0, 50.0, 200.0]
SENS_SQL = f"""WITH {FEAT_CTE}, g AS (SELECT avg(y) AS gr FROM tr),
c AS (SELECT segment, count(*) AS n, sum(y) AS s FROM tr GROUP BY segment),
ms AS (SELECT unnest({MS}) AS m)
SELECT segment, n, m, r6((s + m * gr) / (n + m)) AS te FROM c, ms, g
"""


@query("j4_smoothing_sensitivity", SENS_SQL)
def sens(spark, sf_dir):
    """Encoded value per segment for m = 0, 10, 50, 200."""
    tr, _ = train_test(spark, sf_dir)
    return J.smoothing_sensitivity(tr, "segment", MS)


CATS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ONEHOT_SQL = f"""WITH {FEAT_CTE}
SELECT txn_id, {', '.join(f'CAST(category = {c!r} AS DOUBLE) AS "cat_{c}"' for c in CATS[1:])} FROM te
"""


@query("j5_one_hot_drop_first", ONEHOT_SQL)
def onehot(spark, sf_dir):
    """J5 + D9: frozen train categories, first dropped, columns aligned on test."""
    tr, te = train_test(spark, sf_dir)
    cats = J.fit_categories(tr, "category")
    x = J.one_hot_drop_first(te, "category", cats, "cat_")
    return x.select("txn_id", *[F.col(f"`cat_{c}`") for c in cats[1:]])


STD_SQL = f"""WITH {FEAT_CTE}, p AS (SELECT avg(amount) AS mu_a, stddev_pop(amount) AS sd_a,
                                             avg(region) AS mu_r, stddev_pop(region) AS sd_r FROM tr)
SELECT txn_id, r6((amount - mu_a) / sd_a) AS amount, r6((region - mu_r) / sd_r) AS region FROM te, p
"""


@query("j6_standardize_train_params", STD_SQL)
def std(spark, sf_dir):
    """Standardise with train mean and population sd."""
    tr, te = train_test(spark, sf_dir)
    cols = ["amount", "region"]
    p = J.fit_standardizer(tr.withColumn("region", F.col("region").cast("double")), cols)
    te = te.withColumn("region", F.col("region").cast("double"))
    return J.apply_standardizer(te, cols, p).select("txn_id", "amount", "region")


WEIGHTS_SQL = f"""WITH {FEAT_CTE}, g AS (SELECT count(*) AS n, sum(y) AS pos FROM tr)
SELECT CAST(n - pos AS BIGINT) AS negatives, CAST(pos AS BIGINT) AS positives, r6((n - pos) / pos) AS neg_pos_ratio,
       r6(sqrt((n - pos) / pos)) AS sqrt_ratio, r6(n / (2 * pos)) AS w_pos, r6(n / (2 * (n - pos))) AS w_neg FROM g
"""


@query("j9_class_weights", WEIGHTS_SQL)
def weights(spark, sf_dir):
    """neg/pos ratio, square-root ratio, balanced weights."""
    tr, _ = train_test(spark, sf_dir)
    return J.class_weights(tr)


UNDER_SQL = """
WITH c AS (SELECT sum(y) AS p, sum(1 - y) AS n FROM txn_orders)
SELECT 1 AS y, CAST(p AS BIGINT) AS rows FROM c UNION ALL SELECT 0, CAST(least(n, 10 * p) AS BIGINT) FROM c
"""


@query("j10_undersample_exact_quota", UNDER_SQL)
def under(spark, sf_dir):
    """All positives and exactly 10 negatives per positive (hash order)."""
    u = J.undersample(txn_orders(spark, sf_dir), "txn_id", "y", 10.0)
    return u.groupBy("y").agg(F.count(F.lit(1)).alias("rows"))


PREP_SQL = f"""WITH {FEAT_CTE},
q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3,
             quantile_cont(gap_hours, 0.5) AS med, avg(y) AS gr FROM tr),
m AS (SELECT client_id, (sum(y) + 50 * q.gr) / (count(*) + 50) AS te FROM tr, q GROUP BY client_id, q.gr)
SELECT te.txn_id, r6(amount) AS amount, r6(CAST(prior_count AS DOUBLE)) AS prior_count,
       r6(coalesce(gap_hours, q.med)) AS gap_hours,
       r6(CAST(amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1) AS DOUBLE)) AS is_outlier,
       r6(coalesce(m.te, q.gr)) AS key_te,
       {', '.join(f'CAST(category = {c!r} AS DOUBLE) AS "cat_{c}"' for c in CATS[1:])}
FROM te LEFT JOIN m ON te.client_id = m.client_id, q
"""


@query("j13_fit_once_preprocessor", PREP_SQL)
def prep(spark, sf_dir):
    """Outlier limits, median gap, smoothed client encoding and one-hot fitted on
    train once, applied to test; frozen column list (J12)."""
    tr, te = train_test(spark, sf_dir)
    pp = J.fit_preprocessor(tr, "client_id", "category", ["amount", "prior_count", "gap_hours"])
    x = pp.transform(te.withColumn("prior_count", F.col("prior_count").cast("double")))
    return x.select("txn_id", *[F.col(f"`{c}`") for c in pp.columns])


def _quota_sql(shares):
    cum, parts = 0.0, []
    prev = "0"
    for name, s in shares[:-1]:
        cum += s
        cur = f"round(n * {cum})"
        parts.append(f"SELECT '{name}' AS split, y, CAST({cur} - {prev} AS BIGINT) AS rows FROM c")
        prev = cur
    parts.append(f"SELECT '{shares[-1][0]}' AS split, y, CAST(n - {prev} AS BIGINT) AS rows FROM c")
    return "WITH c AS (SELECT y, count(*) AS n FROM txn_orders GROUP BY y) " + " UNION ALL ".join(parts)


SPLIT2 = [("train", 0.8), ("test", 0.2)]
SPLIT3 = [("fit", 0.64), ("validation", 0.16), ("test", 0.2)]


@query("k1_stratified_split", _quota_sql(SPLIT2))
def split2(spark, sf_dir):
    """K1: stratified 80/20 by hash rank within class; exact per-class quotas."""
    s = K.stratified_split(txn_orders(spark, sf_dir), "txn_id", "y", SPLIT2)
    return s.groupBy("split", "y").agg(F.count(F.lit(1)).alias("rows"))


@query("k2_three_way_split", _quota_sql(SPLIT3))
def split3(spark, sf_dir):
    """K2: stratified 64/16/20 with two cut points."""
    s = K.stratified_split(txn_orders(spark, sf_dir), "txn_id", "y", SPLIT3)
    return s.groupBy("split", "y").agg(F.count(F.lit(1)).alias("rows"))


REPORT_SQL = f"""WITH q AS ({_quota_sql(SPLIT3)}),
g AS (SELECT split, sum(rows) AS rows, sum(CASE WHEN y = 1 THEN rows ELSE 0 END) AS positives FROM q GROUP BY split)
SELECT split, CAST(rows AS BIGINT) AS rows, r6(rows / (SELECT sum(rows) FROM g)) AS share,
       CAST(positives AS BIGINT) AS positives, r6(positives / rows) AS rate FROM g
"""


@query("k3_split_report", REPORT_SQL)
def report(spark, sf_dir):
    """K3: rows, share, positives and rate per part of the three-way split."""
    return K.split_report(K.stratified_split(txn_orders(spark, sf_dir), "txn_id", "y", SPLIT3))


TEMP_SQL = """
SELECT txn_id, CASE WHEN strftime(ts, '%Y-%m') <= '1997-12' THEN 'fit'
                    WHEN strftime(ts, '%Y-%m') <= '1999-12' THEN 'recent' ELSE 'future' END AS split
FROM txn_orders
"""


@query("k4_temporal_split", TEMP_SQL)
def temporal(spark, sf_dir):
    """K4: temporal split by month cut-offs (fit / recent / future)."""
    return K.temporal_split(txn_orders(spark, sf_dir), "ts",
                            [("fit", "1997-12"), ("recent", "1999-12")], "future") \
        .select("txn_id", "split")


ROLL_SQL = """
WITH t AS (SELECT strftime(ts, '%Y-%m') AS p, y FROM txn_orders),
f AS (SELECT DISTINCT p AS fold, strftime(CAST(p || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') AS thr
      FROM t WHERE p >= '2001-01')
SELECT fold, CASE WHEN p = fold THEN 'test' WHEN p = thr THEN 'threshold' ELSE 'train' END AS role,
       count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives
FROM t JOIN f ON t.p <= f.fold GROUP BY ALL
"""


@query("k5_rolling_origin_folds", ROLL_SQL)
def rolling(spark, sf_dir):
    """K5: rolling origin folds from 2001-01: train earlier, threshold previous, test month."""
    return K.rolling_origin(txn_orders(spark, sf_dir), "ts", "2001-01")


KF_SQL = """
WITH c AS (SELECT y, count(*) AS n FROM txn_orders GROUP BY y), f AS (SELECT unnest(range(0, 5)) AS fold)
SELECT CAST(fold AS INT) AS fold, y, CAST((n + 5 - 1 - fold) // 5 AS BIGINT) AS rows FROM c, f
"""


@query("k6_stratified_kfold", KF_SQL)
def kfold(spark, sf_dir):
    """K6: stratified 5-fold (hash rank within class modulo k)."""
    k = K.stratified_kfold(txn_orders(spark, sf_dir), "txn_id", 5)
    return k.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("rows"))


GROUP_FOLD_SQL = f"""
WITH ent AS (SELECT client_id, sum(y) AS pos FROM txn_orders GROUP BY client_id),
o AS (SELECT client_id, row_number() OVER (ORDER BY -(CAST(pos AS DOUBLE) * 1e12) + CAST({J.hash60_sql('client_id', 42)} % 1000000 AS DOUBLE),
                                                    client_id) - 1 AS r FROM ent),
f AS (SELECT client_id, CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS fold FROM o)
SELECT CAST(fold AS INT) AS fold, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, count(DISTINCT t.client_id) AS clients,
       CAST(0 AS BIGINT) AS entities_in_several_folds
FROM txn_orders t JOIN f ON t.client_id = f.client_id GROUP BY fold
"""


@query("k7_group_kfold_disjoint", GROUP_FOLD_SQL)
def gkfold(spark, sf_dir):
    """K7: stratified group 5-fold by client: folds, rows, positives, clients; plus the
    number of clients found in several folds (must be 0)."""
    k = K.group_kfold(txn_orders(spark, sf_dir), "client_id", 5)
    per = k.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("positives"),
                                F.count_distinct("client_id").alias("clients"))
    return with_scalars(per, K.fold_disjoint(k, "client_id"))


HOLDOUT_SQL = f"""
SELECT CAST({J.hash60_sql('client_id', 7)} % 1000000 < 250000 AS INT) AS holdout, count(*) AS rows, count(DISTINCT client_id) AS clients
FROM txn_orders WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1
"""


@query("k8_holdout_by_client", HOLDOUT_SQL)
def hold(spark, sf_dir):
    """K8: hold out 25 % of clients (hash) inside train; rows and clients per side."""
    tr, _ = train_test(spark, sf_dir)
    h = K.holdout(tr, "client_id", 0.25)
    return h.groupBy("holdout").agg(F.count(F.lit(1)).alias("rows"),
                                    F.count_distinct("client_id").alias("clients"))


# ------------------------------------------------------------------ drift
DRIFT_COLS = ["amount", "region", "prior_count", "priority"]
REF_YEAR = 1999


def drift_frames(spark, sf_dir):
    # the feature table feeds several branches (reference, batch, KS): written once to
    # the shared checkpoint folder instead of recomputing the windows per branch
    f = materialize_once(spark, ("order-features", sf_dir), lambda: features(spark, sf_dir)).withColumn(
        "priority", F.substring("category", 1, 1).cast("double"))
    for c in DRIFT_COLS:
        f = f.withColumn(c, F.col(c).cast("double"))
    ref = f.where(F.year("ts") <= REF_YEAR)
    new = f.where(F.year("ts") > REF_YEAR)
    return ref, new


LONG_CTE = f"""{FEAT_CTE},
f2 AS (SELECT ts, CAST(amount AS DOUBLE) AS amount, CAST(region AS DOUBLE) AS region,
              CAST(prior_count AS DOUBLE) AS prior_count, CAST(substr(category, 1, 1) AS DOUBLE) AS priority FROM feat),
lr AS (UNPIVOT (SELECT amount, region, prior_count, priority FROM f2 WHERE year(ts) <= {REF_YEAR})
       ON amount, region, prior_count, priority INTO NAME variable VALUE value),
lb AS (UNPIVOT (SELECT amount, region, prior_count, priority FROM f2 WHERE year(ts) > {REF_YEAR})
       ON amount, region, prior_count, priority INTO NAME variable VALUE value),
st AS (SELECT variable, count(*) AS n, avg(value) AS mean, count(DISTINCT value) AS nd,
              list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
       FROM lr GROUP BY variable),
ed AS (SELECT variable, n, mean, ['-inf'::DOUBLE] || e[2:len(e) - 1] || ['inf'::DOUBLE] AS e FROM st
       WHERE nd > 10 AND len(e) >= 3),
ref AS (
  SELECT l.variable, 'categorical' AS kind, l.value AS category, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi,
         count(*) / st.n AS ref_prop, st.mean FROM lr l JOIN st ON l.variable = st.variable
  WHERE st.nd <= 10 GROUP BY l.variable, l.value, st.n, st.mean
  UNION ALL
  SELECT b.variable, 'continuous', CAST(b.bin_id AS DOUBLE), b.e[b.bin_id + 1], b.e[b.bin_id + 2],
         coalesce(c.cnt, 0) / b.n, b.mean
  FROM (SELECT variable, n, mean, e, unnest(range(0, len(e) - 1)) AS bin_id FROM ed) b
  LEFT JOIN (SELECT l.variable, len(list_filter(ed.e[2:len(ed.e) - 1], lambda x: x <= l.value)) AS bin_id, count(*) AS cnt
             FROM lr l JOIN ed ON l.variable = ed.variable GROUP BY ALL) c
    ON b.variable = c.variable AND b.bin_id = c.bin_id)"""

FREEZE_SQL = f"""WITH {LONG_CTE}
SELECT variable, kind, category, lo, hi, r6(ref_prop) AS ref_prop, r6(mean) AS mean FROM ref
"""


@query("n1_freeze_reference", FREEZE_SQL)
def freeze(spark, sf_dir):
    """Frozen train distribution: categorical proportions or decile bins."""
    ref, _ = drift_frames(spark, sf_dir)
    return N.freeze_reference(ref, DRIFT_COLS)


DRIFT_SQL = f"""WITH {LONG_CTE},
nb AS (SELECT variable, count(*) AS nb, avg(value) AS mean_batch FROM lb GROUP BY variable),
cb AS (SELECT l.variable, l.value AS category, count(*) AS c FROM lb l
       WHERE l.variable IN (SELECT variable FROM st WHERE nd <= 10) GROUP BY ALL
       UNION ALL
       SELECT l.variable, CAST(len(list_filter(ed.e[2:len(ed.e) - 1], lambda x: x <= l.value)) AS DOUBLE), count(*)
       FROM lb l JOIN ed ON l.variable = ed.variable GROUP BY ALL),
p AS (SELECT r.variable, r.kind, r.ref_prop, r.mean, nb.mean_batch, coalesce(cb.c, 0) / nb.nb AS new_prop
      FROM ref r LEFT JOIN cb ON r.variable = cb.variable AND r.category = cb.category
      LEFT JOIN nb ON r.variable = nb.variable),
t AS (SELECT variable, first(kind) AS kind,
             sum((greatest(new_prop, 1e-6) - greatest(ref_prop, 1e-6)) * ln(greatest(new_prop, 1e-6) / greatest(ref_prop, 1e-6))) AS psi,
             first(mean) AS mean_train, first(mean_batch) AS mean_batch, 1 - sum(new_prop) AS unseen_share
      FROM p GROUP BY variable),
vals AS (SELECT variable, value FROM lr UNION SELECT variable, value FROM lb),
na AS (SELECT variable, count(*) AS n FROM lr GROUP BY variable),
ca AS (SELECT v.variable, v.value,
              (SELECT count(*) FROM lr WHERE lr.variable = v.variable AND lr.value <= v.value) AS a,
              (SELECT count(*) FROM lb WHERE lb.variable = v.variable AND lb.value <= v.value) AS b FROM vals v),
ks AS (SELECT ca.variable, max(abs(a / na.n - b / nb.nb)) AS d, any_value(na.n) AS n_a, any_value(nb.nb) AS n_b
       FROM ca JOIN na ON ca.variable = na.variable JOIN nb ON ca.variable = nb.variable GROUP BY ca.variable),
kp AS (SELECT variable, sqrt(n_a * n_b / (n_a + n_b)) * d AS z FROM ks)
SELECT t.variable, kind, r6(psi) AS psi, r6(mean_train) AS mean_train, r6(mean_batch) AS mean_batch,
       r6(unseen_share) AS unseen_share,
       CASE WHEN t.variable = 'prior_count' THEN 'structural' WHEN psi >= 0.25 THEN 'severe'
            WHEN psi >= 0.10 THEN 'moderate' ELSE 'stable' END AS state,
       r6(CASE WHEN z <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * z * z))
                                                                          FROM range(1, 101) r(k)))) END) AS ks_pvalue
FROM t JOIN kp ON t.variable = kp.variable
"""


def drift_result(spark, sf_dir):
    ref, new = drift_frames(spark, sf_dir)
    # value counts of both sides and the frozen reference (one row per variable × bin) are
    # written once: every branch below reads these, not the rows
    ref, new = (materialize(N.value_counts(x, DRIFT_COLS), "drift-counts") for x in (ref, new))
    reference = materialize(N.freeze_reference(ref, DRIFT_COLS), "drift-reference")
    return N.drift_table(reference, new, DRIFT_COLS, monotone=["prior_count"], train=ref)


@query("n3_psi_drift_table", DRIFT_SQL)
def drift(spark, sf_dir):
    """N2 + N3: batch binned against the frozen reference; PSI, state (prior count is a
    declared monotone counter → structural), means, unseen share, KS p-value."""
    return drift_result(spark, sf_dir).select("variable", "kind", "psi", "mean_train", "mean_batch",
                                               "unseen_share", "state", "ks_pvalue")


PRED_CUT = "1999-01-01"
PRED_SQL = f"""
WITH a AS (SELECT score_i / 100.0 AS s FROM scored_lines WHERE ts < TIMESTAMP '{PRED_CUT}'),
b AS (SELECT score_i / 100.0 AS s FROM scored_lines WHERE ts >= TIMESTAMP '{PRED_CUT}'),
vals AS (SELECT DISTINCT s FROM (SELECT s FROM a UNION ALL SELECT s FROM b)),
c AS (SELECT vals.s, (SELECT count(*) FROM a WHERE a.s <= vals.s) AS ca, (SELECT count(*) FROM b WHERE b.s <= vals.s) AS cb FROM vals),
n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb),
k AS (SELECT max(abs(ca / na - cb / nb)) AS d, any_value(na) AS na, any_value(nb) AS nb FROM c, n),
z AS (SELECT sqrt(na * nb / (na + nb)) * d AS z FROM k),
r AS (SELECT avg(CAST(s >= 0.6 AS DOUBLE)) AS ar, avg(s) AS mr FROM a),
q AS (SELECT avg(CAST(s >= 0.6 AS DOUBLE)) AS ab, avg(s) AS mb FROM b)
SELECT r6(ar) AS alert_rate_ref, r6(mr) AS mean_score_ref, r6(ab) AS alert_rate_batch, r6(mb) AS mean_score_batch,
       r6(CASE WHEN z <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * z * z))
                                                                          FROM range(1, 101) t(k)))) END) AS ks_pvalue,
       r6(ab / greatest(ar, 1e-9)) AS alert_factor
FROM r, q, z
"""


def pred_frames(spark, sf_dir):
    s = scored_lines(spark, sf_dir).withColumn("s", F.col("score_i") / 100.0)
    c = F.lit(PRED_CUT).cast("timestamp_ntz")
    return s.where(F.col("ts") < c), s.where(F.col("ts") >= c)


@query("n4_prediction_drift", PRED_SQL)
def pred(spark, sf_dir):
    """Alert rates, mean scores, KS p-value and alert factor, reference vs batch."""
    a, b = pred_frames(spark, sf_dir)
    return N.prediction_drift(a, b, "s", 0.6)


TRIG_SQL = f"""WITH d AS ({DRIFT_SQL}), pr AS ({PRED_SQL}),
s AS (SELECT max(CAST(state = 'severe' AS INT)) AS sev,
             sum(CAST(state NOT IN ('stable', 'structural') AS INT)) AS drifting,
             sum(CAST(state = 'structural' AS INT)) AS structural FROM d)
SELECT CAST(drifting AS BIGINT) AS variables_drifting, CAST(structural AS BIGINT) AS variables_structural,
       alert_factor,
       concat_ws(',', CASE WHEN sev = 1 THEN 'psi_severe' END, CASE WHEN drifting >= 3 THEN 'several_moderate' END,
                 CASE WHEN alert_factor >= 2.0 THEN 'alert_factor' END) AS triggers,
       (sev = 1 OR drifting >= 3 OR alert_factor >= 2.0) AS alarm
FROM s, pr
"""


def trigger_row(spark, sf_dir):
    a, b = pred_frames(spark, sf_dir)
    return N.triggers(drift_result(spark, sf_dir), N.prediction_drift(a, b, "s", 0.6))


@query("n5_triggers_and_alarm", TRIG_SQL.replace("WITH ", "WITH ", 1))
def trig(spark, sf_dir):
    """Active triggers (severe PSI, ≥3 drifting, alert factor ≥ 2) and alarm."""
    t = trigger_row(spark, sf_dir)
    return t.select("variables_drifting", "variables_structural", "alert_factor",
                    F.array_join("triggers", ",").alias("triggers"), "alarm")


REPORT_N6_SQL = f"""WITH tr AS ({TRIG_SQL}),
b AS (SELECT score_i / 100.0 AS s, y FROM scored_lines WHERE ts >= TIMESTAMP '{PRED_CUT}'),
f AS (SELECT count(*) FILTER (WHERE s >= 0.6 AND y = 1) AS tp, count(*) FILTER (WHERE s >= 0.6 AND y = 0) AS fp,
             count(*) FILTER (WHERE s < 0.6 AND y = 1) AS fn, count(*) AS n FROM b),
g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY s),
c AS (SELECT pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS q
      FROM g WINDOW w AS (ORDER BY s DESC)),
rk AS (SELECT sum(pos * tp / (tp + fp)) / max(p) AS ap, sum(pos * (q - fp + 0.5 * neg)) / (max(p) * max(q)) AS auc FROM c)
SELECT variables_drifting, variables_structural, r6(alert_factor) AS alert_factor, triggers, alarm, r6(tp / (tp + fp)) AS precision,
       r6(tp / (tp + fn)) AS recall, r6(2 * tp / (2 * tp + fp + fn)) AS f1, r6((tp + fp) / n) AS alert_rate,
       r6(ap) AS average_precision, r6(auc) AS roc_auc
FROM tr, f, rk
"""


@query("n6_monitoring_report", REPORT_N6_SQL)
def report_n6(spark, sf_dir):
    """Monitoring report: drift summary, triggers, and labelled performance of the
    batch at the threshold (precision, recall, F1, ROC AUC, AP)."""
    t = trigger_row(spark, sf_dir)
    _, b = pred_frames(spark, sf_dir)
    perf = confusion(b.withColumn("p", (F.col("s") >= 0.6).cast("int")), "p", "y") \
        .select("precision", "recall", "f1", "alert_rate")
    rank = ranking_summary(b, "s", "y").select("average_precision", "roc_auc")
    return with_scalars(with_scalars(t.withColumn("triggers", F.array_join("triggers", ",")), perf), rank)


OPS_SQL = """
WITH l AS (SELECT ts, txn_id, code / 100.0 AS s, code >= 90 AS alert FROM txn_events),
r AS (SELECT s FROM l ORDER BY ts DESC, txn_id DESC LIMIT 10000)
SELECT count(*) AS total, r6(avg(CAST(alert AS DOUBLE))) AS alert_rate, r6(avg(s)) AS mean_score,
       r6((SELECT quantile_cont(s, 0.95) FROM r)) AS p95_recent FROM l
"""


@query("n7_operational_metrics", OPS_SQL)
def ops(spark, sf_dir):
    """Totals, alert rate, mean score; p95 of the last 10,000 scores by time."""
    e = txn_events(spark, sf_dir).withColumn("s", F.col("code") / 100.0) \
        .withColumn("alert", F.col("code") >= 90)
    return N.operational_metrics(e, "ts", "s", "alert", id_col="txn_id")


WORST_SQL = f"""WITH d AS ({DRIFT_SQL})
SELECT coalesce(max(psi) FILTER (WHERE state NOT IN ('stable', 'structural')), 0.0) AS psi_max,
       arg_max(variable, psi) FILTER (WHERE state NOT IN ('stable', 'structural')) AS worst_variable FROM d
"""


@query("n10_worst_variable", WORST_SQL)
def worst(spark, sf_dir):
    """Maximum PSI among drifting non-structural variables (0 / null when none)."""
    return N.worst_variable(drift_result(spark, sf_dir))


SCHEMA_SQL = """
SELECT v.*, (SELECT count(*) FROM txn_events) AS batch_rows
FROM (VALUES ('segment', 'missing', 'string', NULL), ('region', 'missing', 'int', NULL), ('code', 'unexpected', NULL, 'int')) v("column", issue, expected, found)
"""


@query("n8_schema_check", SCHEMA_SQL)
def n8(spark, sf_dir):
    """The columns of a batch (events) against those a model was trained on (orders): missing, unexpected, other type."""
    batch = txn_events(spark, sf_dir)
    trained_on = [(f.name, f.dataType.simpleString()) for f in txn_orders(spark, sf_dir).schema.fields]
    issues = [(d["column"], d["issue"], d["expected"], d["found"]) for d in N.schema_diff(batch, trained_on)]
    found = spark.createDataFrame(issues, "column string, issue string, expected string, found string")
    return with_scalars(found, batch.agg(F.count(F.lit(1)).alias("batch_rows")))

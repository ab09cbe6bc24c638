"""Monitoring timeline, calendar verification and lifecycle queries."""

from pyspark.sql import functions as F

from txnscope.catalog.q_history import history_raw_sql
from txnscope.catalog.q_prep import features
from txnscope.catalog.registry import query
from txnscope.plans.frames import materialize, materialize_once
from txnscope.functions.calendar import FOUR_BANDS, band
from txnscope.operators import drift as N
from txnscope.operators import lifecycle as O
from txnscope.sources import txn_orders
from txnscope.sources.raw import RAW_TRANSACTIONS_SQL, raw_transactions

COLS = ["amount", "region", "prior_count", "priority"]
REF_END = "1997-12"
THRESHOLD = 0.3
# declared changes (parameter table): name, months, affected variables, expects alert factor, detectable
CALENDAR = [
    ("price_shift", "1998-03", "1998-08", ["amount"], False, True),
    ("regional_campaign", "1999-01", "1999-04", ["region"], True, True),
    ("priority_mix", "2000-05", "2000-09", ["priority"], False, True),
    ("silent_label_change", "2001-01", "2001-04", ["y"], False, False),
]


def timeline_inputs(spark, sf_dir):
    f = materialize_once(spark, ("order-features", sf_dir), lambda: features(spark, sf_dir))
    f = f.withColumn("priority", F.substring("category", 1, 1).cast("double")) \
        .withColumn("period", F.date_format("ts", "yyyy-MM")) \
        .withColumn("score", F.col("z_amount_abs") / 10.0)
    for c in COLS:
        f = f.withColumn(c, F.col(c).cast("double"))
    ref = f.where(F.col("period") <= REF_END)
    batch = f.where(F.col("period") > REF_END)
    return ref, batch


def timeline(spark, sf_dir):
    ref, batch = timeline_inputs(spark, sf_dir)
    reference = materialize(N.freeze_reference(materialize(N.value_counts(ref, COLS), "timeline-counts"), COLS), "timeline-reference")
    rate = ref.agg(F.avg((F.col("score") >= THRESHOLD).cast("double")).alias("alert_rate"))
    return O.monthly_timeline(batch, reference, COLS, rate, "score", THRESHOLD, monotone=["prior_count"])


BASE_CTE = f"""feat AS (SELECT o.*, h.prior_count, h.z_amount_abs FROM txn_orders o
                        JOIN ({history_raw_sql('txn_orders')}) h ON o.txn_id = h.txn_id),
f2 AS (SELECT strftime(ts, '%Y-%m') AS period, y, z_amount_abs / 10.0 AS score, CAST(amount AS DOUBLE) AS amount,
              CAST(region AS DOUBLE) AS region, CAST(prior_count AS DOUBLE) AS prior_count,
              CAST(substr(category, 1, 1) AS DOUBLE) AS priority FROM feat),
lr AS (UNPIVOT (SELECT amount, region, prior_count, priority FROM f2 WHERE period <= '{REF_END}')
       ON amount, region, prior_count, priority INTO NAME variable VALUE value),
lb AS (UNPIVOT (SELECT period, amount, region, prior_count, priority FROM f2 WHERE period > '{REF_END}')
       ON amount, region, prior_count, priority INTO NAME variable VALUE value),
st AS (SELECT variable, count(*) AS n, count(DISTINCT value) AS nd,
              list_sort(list_distinct(quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
       FROM lr GROUP BY variable),
ed AS (SELECT variable, n, ['-inf'::DOUBLE] || e[2:len(e) - 1] || ['inf'::DOUBLE] AS e FROM st WHERE nd > 10 AND len(e) >= 3),
ref AS (
  SELECT l.variable, l.value AS category, count(*) / st.n AS ref_prop FROM lr l JOIN st ON l.variable = st.variable
  WHERE st.nd <= 10 GROUP BY l.variable, l.value, st.n
  UNION ALL
  SELECT b.variable, CAST(b.bin_id AS DOUBLE), coalesce(c.cnt, 0) / b.n
  FROM (SELECT variable, n, e, unnest(range(0, len(e) - 1)) AS bin_id FROM ed) b
  LEFT JOIN (SELECT l.variable, len(list_filter(ed.e[2:len(ed.e) - 1], lambda x: x <= l.value)) AS bin_id, count(*) AS cnt
             FROM lr l JOIN ed ON l.variable = ed.variable GROUP BY ALL) c ON b.variable = c.variable AND b.bin_id = c.bin_id),
nb AS (SELECT period, variable, count(*) AS nb FROM lb GROUP BY ALL),
cb AS (SELECT l.period, l.variable, l.value AS category, count(*) AS c FROM lb l
       WHERE l.variable IN (SELECT variable FROM st WHERE nd <= 10) GROUP BY ALL
       UNION ALL
       SELECT l.period, l.variable, CAST(len(list_filter(ed.e[2:len(ed.e) - 1], lambda x: x <= l.value)) AS DOUBLE), count(*)
       FROM lb l JOIN ed ON l.variable = ed.variable GROUP BY ALL),
pv AS (SELECT nb.period, nb.variable,
              sum((greatest(coalesce(cb.c, 0) / nb.nb, 1e-6) - greatest(ref_prop, 1e-6)) *
                  ln(greatest(coalesce(cb.c, 0) / nb.nb, 1e-6) / greatest(ref_prop, 1e-6))) AS psi
       FROM nb JOIN ref ON nb.variable = ref.variable
       LEFT JOIN cb ON cb.period = nb.period AND cb.variable = nb.variable AND cb.category = ref.category
       GROUP BY nb.period, nb.variable),
ps AS (SELECT *, CASE WHEN variable = 'prior_count' THEN 'structural' WHEN psi >= 0.25 THEN 'severe'
                      WHEN psi >= 0.10 THEN 'moderate' ELSE 'stable' END AS state FROM pv),
per AS (SELECT period, max(psi) FILTER (WHERE state IN ('severe', 'moderate')) AS psi_max,
               coalesce(list_sort(list(variable) FILTER (WHERE state = 'severe')), []) AS severe_vars,
               coalesce(list_sort(list(variable) FILTER (WHERE state IN ('severe', 'moderate'))), []) AS drifting_vars
        FROM ps GROUP BY period),
rr AS (SELECT avg(CAST(score >= {THRESHOLD} AS DOUBLE)) AS rate FROM f2 WHERE period <= '{REF_END}'),
pr AS (SELECT period, count(*) AS rows, avg(CAST(score >= {THRESHOLD} AS DOUBLE)) AS alert_rate,
              sum(CASE WHEN score >= {THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN score >= {THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN score < {THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS fn
       FROM f2 WHERE period > '{REF_END}' GROUP BY period),
tl0 AS (SELECT pr.period, rows, alert_rate, alert_rate / greatest(rr.rate, 1e-9) AS alert_factor,
               coalesce(psi_max, 0.0) AS psi_max, severe_vars, drifting_vars,
               CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_all
        FROM pr LEFT JOIN per ON pr.period = per.period, rr),
tl AS (SELECT *, list_filter([CASE WHEN len(severe_vars) > 0 THEN 'psi_severe' END,
                              CASE WHEN len(drifting_vars) >= 3 THEN 'several_moderate' END,
                              CASE WHEN alert_factor >= 2.0 THEN 'alert_factor' END], lambda x: x IS NOT NULL) AS triggers,
              CASE WHEN period <= strftime(CAST((SELECT max(period) FROM pr) || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m')
                   THEN f1_all END AS f1
       FROM tl0)"""

TIMELINE_SQL = f"""WITH {BASE_CTE}
SELECT period, rows, r6(alert_rate) AS alert_rate, r6(alert_factor) AS alert_factor, r6(psi_max) AS psi_max,
       array_to_string(severe_vars, ',') AS severe_vars, array_to_string(drifting_vars, ',') AS drifting_vars,
       array_to_string(triggers, ',') AS triggers, len(triggers) > 0 AS alarm, r6(f1) AS f1
FROM tl
"""


@query("o3_monthly_monitoring_timeline", TIMELINE_SQL)
def o3(spark, sf_dir):
    """O3: monthly monitoring timeline in one grouped job: PSI per (month, variable)
    against the frozen reference, states, triggers, alert factor, alarm, and F1 of the
    months whose labels have arrived (2-month lag)."""
    t = timeline(spark, sf_dir)
    return t.select("period", "rows", "alert_rate", "alert_factor", "psi_max",
                    F.array_join("severe_vars", ",").alias("severe_vars"),
                    F.array_join("drifting_vars", ",").alias("drifting_vars"),
                    F.array_join("triggers", ",").alias("triggers"), "alarm", "f1")


def _cal_sql():
    rows = []
    for name, a, b, aff, fac, det in CALENDAR:
        rows.append(f"('{name}', '{a}', '{b}', {aff}, {str(fac).upper()}, {str(det).upper()})")
    return ("cal AS (SELECT * FROM (VALUES " + ", ".join(rows) +
            ") v(change, from_period, to_period, affected, expects_factor, detectable))")


VERIFY_SQL = f"""WITH {BASE_CTE}, {_cal_sql()},
a AS (SELECT tl.*, cal.*, len(triggers) > 0 AND (
          (list_contains(triggers, 'psi_severe') AND len(list_intersect(affected, severe_vars)) > 0) OR
          (list_contains(triggers, 'several_moderate') AND len(list_intersect(affected, drifting_vars)) > 0) OR
          (list_contains(triggers, 'alert_factor') AND expects_factor)) AS attributable,
             year(CAST(period || '-01' AS DATE)) * 12 + month(CAST(period || '-01' AS DATE)) AS mi
      FROM tl JOIN cal ON tl.period >= cal.from_period AND tl.period <= cal.to_period)
SELECT change, detectable, count(*) AS months, CAST(sum(CAST(len(triggers) > 0 AS INT)) AS BIGINT) AS months_with_alarm,
       CAST(sum(CAST(attributable AS INT)) AS BIGINT) AS months_attributable, min(period) AS first_month,
       min(period) FILTER (WHERE attributable) AS first_own_alarm,
       CAST(min(mi) FILTER (WHERE attributable) - min(mi) AS INT) AS delay_months,
       sum(CAST(attributable AS INT)) > 0 AS detected,
       sum(CAST(len(triggers) > 0 AS INT)) > 0 AND sum(CAST(attributable AS INT)) = 0 AS foreign_alarm
FROM a GROUP BY change, detectable
"""


@query("o4_o5_calendar_verification", VERIFY_SQL)
def o45(spark, sf_dir):
    """O4 + O5 (+ D7): alarms attributed to declared changes by trigger signature;
    per change: months, alarms, attributable months, detection, first alarm, delay."""
    t = timeline(spark, sf_dir)
    v = O.verify(t, O.calendar_table(spark, CALENDAR))
    return v.select("change", "detectable", "months", F.col("months_with_alarm").cast("long").alias("months_with_alarm"),
                    F.col("months_attributable").cast("long").alias("months_attributable"), "first_month",
                    "first_own_alarm", "delay_months", "detected", "foreign_alarm")


QUIET_SQL = f"""WITH {BASE_CTE}, {_cal_sql()}
SELECT count(*) AS quiet_months, CAST(sum(CAST(len(triggers) > 0 AS INT)) AS BIGINT) AS false_positives
FROM tl WHERE NOT EXISTS (SELECT 1 FROM cal WHERE tl.period >= cal.from_period AND tl.period <= cal.to_period)
"""


@query("o5_quiet_month_false_positives", QUIET_SQL)
def o5q(spark, sf_dir):
    """Alarms in months without any declared change (false positives)."""
    return O.quiet_false_positives(timeline(spark, sf_dir), O.calendar_table(spark, CALENDAR))


DEGR_SQL = f"""WITH {BASE_CTE}, {_cal_sql()},
b AS (SELECT period, list_sort(list_filter(list(f1) OVER (ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
                                             lambda x: x IS NOT NULL)) AS prev FROM tl),
bb AS (SELECT period, CASE WHEN len(prev) > 0 THEN prev[len(prev) // 2 + 1] END AS baseline FROM b),
w AS (SELECT change, min(f1) AS f1_min_in_window, min(tl.period) AS p0 FROM tl
      JOIN cal ON tl.period >= cal.from_period AND tl.period <= cal.to_period GROUP BY change)
SELECT change, r6(f1_min_in_window) AS f1_min_in_window, r6(baseline) AS f1_before,
       r6(CASE WHEN baseline > 0 THEN (baseline - f1_min_in_window) / baseline END) AS relative_drop,
       CASE WHEN baseline > 0 THEN (baseline - f1_min_in_window) / baseline >= 0.30 END AS degraded
FROM w LEFT JOIN bb ON w.p0 = bb.period
"""


@query("o6_degradation_verdict", DEGR_SQL)
def o6(spark, sf_dir):
    """O6 (+ F11): F1 inside each declared window vs the upper-middle F1 of the three
    previous labelled months; degraded when it drops by >= 30 %."""
    return O.degradation(timeline(spark, sf_dir), O.calendar_table(spark, CALENDAR))


SHIFT_SQL = f"""
WITH old AS (SELECT * FROM txn_orders WHERE ts < TIMESTAMP '1999-01-01'),
new AS (SELECT txn_id + 100000000 AS txn_id, client_id, ts + INTERVAL 364 DAY AS ts, amount, category, segment, region, y
        FROM txn_orders WHERE ts >= TIMESTAMP '1999-01-01'),
u AS (SELECT * FROM old UNION ALL SELECT * FROM new),
h AS ({history_raw_sql('u')})
SELECT txn_id, strftime(ts, '%Y-%m') AS period, CAST(isodow(ts) - 1 AS INT) AS weekday, prior_count,
       r6(prior_mean) AS prior_mean, r6(z_amount_abs) AS z_amount_abs FROM h WHERE txn_id >= 100000000
"""


@query("o7_o8_time_shift_and_continued_history", SHIFT_SQL)
def o78(spark, sf_dir):
    """Orders from 1999 on moved by 364 days (weekday kept, period re-derived); O8: history
    features continue across the union of the old table and the shifted rows."""
    t = txn_orders(spark, sf_dir)
    old = t.where(F.col("ts") < F.lit("1999-01-01").cast("timestamp_ntz"))
    new = t.where(F.col("ts") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
        .withColumn("txn_id", F.col("txn_id") + 100000000)
    new = O.time_shift(new, "ts", 364).drop("period")
    h = O.continue_history(old, new, chunk_hours=24 * 90)
    return h.where(F.col("txn_id") >= 100000000).select(
        "txn_id", F.date_format("ts", "yyyy-MM").alias("period"), F.weekday("ts").alias("weekday"),
        "prior_count", "prior_mean", "z_amount_abs")


# fixed values: declared relative-risk factors of the synthetic scenario
RISK_CURRENCY = {2: 2.0, 1: 1.0}
RISK_WEEKEND = {1: 1.5, 0: 1.0}
RISK_BAND = {"madrugada": 3.0, "manana": 1.0, "tarde": 1.2, "noche": 1.8}
RISK_CATEGORY = {"purchase": 2.5, "click": 0.8, "view": 0.7, "signup": 1.3}
RISK_CATEGORY_DEFAULT = 1.0
TARGET_RATE = 0.0062

RISK_SQL = f"""WITH raw AS ({RAW_TRANSACTIONS_SQL}),
r AS (SELECT txn_id,
             (CASE currency WHEN 2 THEN 2.0 ELSE 1.0 END) *
             (CASE WHEN isodow(ts) >= 6 THEN 1.5 ELSE 1.0 END) *
             (CASE WHEN hour(ts) < 6 THEN 3.0 WHEN hour(ts) < 12 THEN 1.0 WHEN hour(ts) < 18 THEN 1.2 ELSE 1.8 END) *
             (CASE category WHEN 'purchase' THEN 2.5 WHEN 'click' THEN 0.8 WHEN 'view' THEN 0.7 WHEN 'signup' THEN 1.3 ELSE 1.0 END)
             AS relative_risk FROM raw)
SELECT txn_id, r6(relative_risk) AS relative_risk,
       r6(least(0.9, relative_risk * {TARGET_RATE} / (SELECT avg(relative_risk) FROM r))) AS risk_prob FROM r
"""


@query("o10_relative_risk_score", RISK_SQL)
def o10(spark, sf_dir):
    """Multiplicative relative risk from declared factor tables, rescaled to a
    target rate and clipped at 0.9."""
    r = raw_transactions(spark, sf_dir)
    factors = {
        "currency": (F.col("currency"), RISK_CURRENCY, 1.0),
        "weekend": ((F.weekday("ts") >= 5).cast("int"), RISK_WEEKEND, 1.0),
        "band": (band(F.hour("ts"), FOUR_BANDS), RISK_BAND, 1.0),
        "category": (F.col("category"), RISK_CATEGORY, RISK_CATEGORY_DEFAULT),
    }
    return O.relative_risk(r, factors, TARGET_RATE).select("txn_id", "relative_risk", "risk_prob")

"""Descriptive (E) and statistics (I) queries."""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.operators import profile as E
from txnscope.operators import stats as S
from txnscope.plans.frames import with_scalars
from txnscope.sources import load, scored_lines, txn_events, txn_orders

CUT = "1998-01-01"


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


VC_SQL = """
SELECT category AS value, count(*) AS n, r6(count(*) / (SELECT count(*) FROM txn_orders)) AS share
FROM txn_orders GROUP BY category
"""


@query("e1_value_counts", VC_SQL)
def value_counts(spark, sf_dir):
    """Value counts with shares."""
    return E.value_counts(txn_orders(spark, sf_dir), "category")


MODE_SQL = """
SELECT value AS mode, r6(n / (SELECT count(*) FROM txn_events WHERE code IS NOT NULL)) AS mode_share
FROM (SELECT code AS value, count(*) AS n FROM txn_events WHERE code IS NOT NULL GROUP BY code)
ORDER BY n DESC, value ASC LIMIT 1
"""


@query("e1_mode_and_share", MODE_SQL)
def mode(spark, sf_dir):
    """Mode (smallest among ties) and its share."""
    return E.mode_share(txn_events(spark, sf_dir), "code")


PROFILE_COLS = ["amount", "code", "y"]
PROFILE_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS variable, count({c}) AS n, r6(avg({c})) AS mean, r6(quantile_cont({c}, 0.5)) AS median,
       r6(stddev_samp({c})) AS sd, r6(var_samp({c})) AS var, r6(min({c})) AS min, r6(max({c})) AS max,
       r6(quantile_cont({c}, 0.25)) AS q1, r6(quantile_cont({c}, 0.75)) AS q3,
       r6(skewness({c})) AS skewness, r6(kurtosis({c})) AS kurtosis FROM txn_events""" for c in PROFILE_COLS)


@query("e2_descriptive_profile", PROFILE_SQL)
def profile(spark, sf_dir):
    """Mean, median, sd, var, min, max, quartiles, bias-adjusted skewness/kurtosis."""
    t = txn_events(spark, sf_dir)
    for c in PROFILE_COLS:
        t = t.withColumn(c, F.col(c).cast("double"))
    return E.profile(t, PROFILE_COLS)


DESCRIBE_SQL = """
SELECT segment, count(amount) AS count, r6(avg(amount)) AS mean, r6(stddev_samp(amount)) AS std,
       r6(min(amount)) AS min, r6(quantile_cont(amount, 0.25)) AS q25, r6(quantile_cont(amount, 0.5)) AS q50,
       r6(quantile_cont(amount, 0.75)) AS q75, r6(max(amount)) AS max
FROM txn_orders GROUP BY segment
"""


@query("e3_describe_by_group", DESCRIBE_SQL)
def describe(spark, sf_dir):
    """Describe of amount per segment."""
    return E.describe_by(txn_orders(spark, sf_dir), "amount", ["segment"])


PS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
PCT_SQL = " UNION ALL ".join(
    f"SELECT {p} AS p, r6(quantile_cont(amount, {p})) AS value FROM txn_orders" for p in PS)


@query("e4_percentiles", PCT_SQL)
def pct(spark, sf_dir):
    """List of exact percentiles (linear interpolation)."""
    return E.percentiles(txn_orders(spark, sf_dir), "amount", PS)


RATE_SQL = """
SELECT segment, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, r6(avg(y)) AS rate
FROM txn_orders WHERE segment IS NOT NULL GROUP BY segment
"""


@query("e5_label_rate_by_category", RATE_SQL)
def rate(spark, sf_dir):
    """E5: rows, positives and label rate per category."""
    return E.label_rate(txn_orders(spark, sf_dir), ["segment"])


TOPK_SQL = """
SELECT client_id, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, r6(avg(y)) AS rate
FROM txn_orders WHERE client_id IS NOT NULL GROUP BY client_id HAVING count(*) >= 15
ORDER BY avg(y) DESC, count(*) DESC, client_id ASC LIMIT 10
"""


@query("e6_label_rate_min_support_topk", TOPK_SQL)
def topk(spark, sf_dir):
    """Label rate with a minimum support of 15 rows, top 10 by rate."""
    return E.label_rate(txn_orders(spark, sf_dir), ["client_id"], min_n=15, top_k=10)


SPEND_SQL = """
SELECT category, count(*) AS n, r6(sum(amount)) AS total_amount, r6(avg(amount)) AS mean_amount
FROM scored_lines GROUP BY category ORDER BY count(*) DESC, category ASC LIMIT 10
"""


@query("e7_group_spend_topk", SPEND_SQL)
def spend(spark, sf_dir):
    """Count, total and mean spend per group; top 10 by frequency."""
    return E.group_spend(scored_lines(spark, sf_dir), "category", "amount", top_k=10)


XTAB_SQL = """
SELECT category, segment, count(*) AS n,
       r6(count(*) / sum(count(*)) OVER (PARTITION BY category)) AS row_share
FROM txn_orders GROUP BY category, segment
"""


@query("e8_e9_crosstab_long", XTAB_SQL)
def xtab(spark, sf_dir):
    """Cross-tabulation counts and row-normalised shares (long form)."""
    return E.crosstab_long(txn_orders(spark, sf_dir), "category", "segment")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
XTAB_WIDE_SQL = "SELECT category, " + ", ".join(
    f"r6(count(*) FILTER (WHERE segment = '{s}') / count(*) FILTER (WHERE segment IN ({', '.join(repr(x) for x in SEGMENTS)}))) AS {s}"
    for s in SEGMENTS) + " FROM txn_orders GROUP BY category"


@query("e9_crosstab_row_normalised_matrix", XTAB_WIDE_SQL)
def xtab_wide(spark, sf_dir):
    """Matrix of row-normalised shares, one column per segment."""
    return E.crosstab(txn_orders(spark, sf_dir), "category", "segment", SEGMENTS, normalize=True)


UPLIFT_SQL = """
SELECT r6(avg(y) FILTER (WHERE region = 0)) AS rate_region0, r6(avg(y) FILTER (WHERE region <> 0)) AS rate_other,
       r6((avg(y) FILTER (WHERE region = 0) / avg(y) FILTER (WHERE region <> 0) - 1) * 100) AS uplift_pct
FROM txn_orders
"""


@query("e10_relative_uplift", UPLIFT_SQL)
def uplift(spark, sf_dir):
    """Relative uplift between two group rates."""
    t = txn_orders(spark, sf_dir)
    r = t.agg(F.avg(F.when(F.col("region") == 0, F.col("y"))).alias("rate_region0"),
              F.avg(F.when(F.col("region") != 0, F.col("y"))).alias("rate_other"))
    return r.withColumn("uplift_pct", E.uplift(F.col("rate_region0"), F.col("rate_other")))


DPG_SQL = """
WITH g AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS d FROM lineitem GROUP BY l_partkey)
SELECT count(*) AS groups, r6(avg(d)) AS mean, r6(stddev_samp(d)) AS std, min(d) AS min,
       r6(quantile_cont(d, 0.5)) AS median, max(d) AS max FROM g
"""


@query("e11_distinct_per_group", DPG_SQL)
def dpg(spark, sf_dir):
    """Distinct suppliers per part and the distribution of that count."""
    return E.distinct_per_group(load(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


MONTHLY_SQL = """
WITH s AS (SELECT strftime(m, '%Y-%m') AS period FROM (SELECT unnest(generate_series(
            date_trunc('month', min(ts)), date_trunc('month', max(ts)), INTERVAL 1 MONTH)) AS m FROM txn_orders)),
g AS (SELECT strftime(ts, '%Y-%m') AS period, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives,
             count(DISTINCT client_id) AS active_clients,
             count(DISTINCT CASE WHEN y = 1 THEN client_id END) AS affected_clients FROM txn_orders GROUP BY 1)
SELECT s.period, coalesce(rows, 0) AS rows, coalesce(positives, 0) AS positives,
       coalesce(active_clients, 0) AS active_clients, coalesce(affected_clients, 0) AS affected_clients,
       r6(CASE WHEN coalesce(rows, 0) > 0 THEN positives / rows END) AS rate,
       r6(CASE WHEN coalesce(affected_clients, 0) > 0 THEN positives / affected_clients END) AS positives_per_affected
FROM s LEFT JOIN g ON s.period = g.period
"""


@query("e12_monthly_summary", MONTHLY_SQL)
def monthly(spark, sf_dir):
    """Monthly rows, positives, active/affected clients, rate; empty months filled."""
    return E.monthly_summary(txn_orders(spark, sf_dir))


FIRST_SQL = """
SELECT period, count(*) AS entities FROM (
  SELECT client_id, strftime(min(ts), '%Y-%m') AS period FROM txn_orders WHERE y = 1 GROUP BY client_id)
GROUP BY period
"""


@query("e13_first_positive_period", FIRST_SQL)
def first(spark, sf_dir):
    """Period of each client's first positive → clients per period."""
    return E.first_period_histogram(txn_orders(spark, sf_dir), "client_id", "ts", "y")


OVL_SQL = """
WITH g AS (SELECT client_id, max(CAST(ts < TIMESTAMP '1998-01-01' AS INT)) AS e,
                  max(CAST(ts >= TIMESTAMP '1998-01-01' AS INT)) AS l FROM txn_orders GROUP BY client_id)
SELECT CAST(sum(CASE WHEN e = 1 AND l = 0 THEN 1 ELSE 0 END) AS BIGINT) AS only_early,
       CAST(sum(CASE WHEN e = 0 AND l = 1 THEN 1 ELSE 0 END) AS BIGINT) AS only_late,
       CAST(sum(CASE WHEN e = 1 AND l = 1 THEN 1 ELSE 0 END) AS BIGINT) AS both FROM g
"""


@query("e13_period_overlap", OVL_SQL)
def overlap(spark, sf_dir):
    """Clients active only early, only late, or in both periods (one pass)."""
    return E.period_overlap(txn_orders(spark, sf_dir), "client_id", "ts", CUT)


EPI_SQL = """
WITH g AS (SELECT client_id, sum(y) AS pos,
                  date_diff('day', CAST(min(CASE WHEN y = 1 THEN ts END) AS DATE),
                            CAST(max(CASE WHEN y = 1 THEN ts END) AS DATE)) AS span
           FROM txn_orders GROUP BY client_id)
SELECT count(*) AS clients, CAST(sum(CASE WHEN pos > 0 THEN 1 ELSE 0 END) AS BIGINT) AS affected_clients,
       r6(sum(CASE WHEN pos > 0 THEN 1 ELSE 0 END) / count(*)) AS share_affected,
       r6(avg(CASE WHEN pos > 0 THEN pos END)) AS positives_per_affected,
       r6(avg(CASE WHEN pos > 0 THEN span END)) AS mean_span_days,
       CAST(max(CASE WHEN pos > 0 THEN span END) AS INT) AS max_span_days,
       r6(avg(CASE WHEN pos > 0 THEN CAST(span <= 30 AS INT) END)) AS share_within_days
FROM g
"""


@query("e14_client_episodes", EPI_SQL)
def episodes(spark, sf_dir):
    """Positives per client, share affected, episode span, share within 30 days."""
    return E.episodes(txn_orders(spark, sf_dir), "client_id", "ts")


PIVOT_SQL = """
WITH l AS (SELECT segment, CASE WHEN month(ts) <= 6 THEN 'H1' ELSE 'H2' END AS half, avg(y) AS rate
           FROM txn_orders GROUP BY ALL)
SELECT segment, r6(max(rate) FILTER (WHERE half = 'H1')) AS H1, r6(max(rate) FILTER (WHERE half = 'H2')) AS H2,
       r6(max(rate) FILTER (WHERE half = 'H2') - max(rate) FILTER (WHERE half = 'H1')) AS gap
FROM l GROUP BY segment
"""


@query("e15_pivot_long_result", PIVOT_SQL)
def pivot(spark, sf_dir):
    """Pivot of a long result (segment × half-year rate) with a gap column."""
    t = txn_orders(spark, sf_dir).withColumn(
        "half", F.when(F.month("ts") <= 6, F.lit("H1")).otherwise(F.lit("H2")))
    long = t.groupBy("segment", "half").agg(F.avg("y").alias("rate"))
    w = long.groupBy("segment").pivot("half", ["H1", "H2"]).agg(F.max("rate"))
    return w.withColumn("gap", F.col("H2") - F.col("H1"))


STRATUM_SQL = """
SELECT segment, r6(avg(y) FILTER (WHERE ts < TIMESTAMP '1998-01-01')) AS rate_a,
       r6(avg(y) FILTER (WHERE ts >= TIMESTAMP '1998-01-01')) AS rate_b,
       count(*) FILTER (WHERE ts < TIMESTAMP '1998-01-01') AS n_a,
       count(*) FILTER (WHERE ts >= TIMESTAMP '1998-01-01') AS n_b,
       r6(avg(y) FILTER (WHERE ts >= TIMESTAMP '1998-01-01') / avg(y) FILTER (WHERE ts < TIMESTAMP '1998-01-01')) AS ratio
FROM txn_orders GROUP BY segment
"""


@query("e16_stratum_compare", STRATUM_SQL)
def stratum(spark, sf_dir):
    """Rate within each stratum in two periods and their ratio."""
    t = txn_orders(spark, sf_dir)
    return E.stratum_compare(t, "segment", (F.col("ts") >= _cut()).cast("int"))


SMD_COLS = ["amount", "code"]
SMD_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS variable, r6(avg({c}) FILTER (WHERE y = 0)) AS mean_neg, r6(avg({c}) FILTER (WHERE y = 1)) AS mean_pos,
       r6((avg({c}) FILTER (WHERE y = 1) - avg({c}) FILTER (WHERE y = 0)) / stddev_samp({c})) AS smd,
       r6(abs((avg({c}) FILTER (WHERE y = 1) - avg({c}) FILTER (WHERE y = 0)) / stddev_samp({c}))) AS abs_smd
FROM txn_events""" for c in SMD_COLS)


@query("e17_standardized_mean_difference", SMD_SQL)
def smd(spark, sf_dir):
    """Standardised mean difference between classes per numeric column."""
    return E.standardized_mean_difference(txn_events(spark, sf_dir), SMD_COLS)


MONEY_SQL = """
SELECT channel, count(*) AS rows, r6(sum(amount)) AS total_amount,
       r6(sum(CASE WHEN y = 1 THEN amount ELSE 0.0 END)) AS positive_amount,
       r6(sum(CASE WHEN y = 1 AND p = 1 THEN amount ELSE 0.0 END)) AS detected_amount,
       r6(sum(CASE WHEN y = 1 AND p = 0 THEN amount ELSE 0.0 END)) AS missed_amount,
       r6(sum(CASE WHEN y = 0 AND p = 1 THEN amount ELSE 0.0 END)) AS false_alarm_amount,
       CAST(sum(y) AS BIGINT) AS positives, CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS detected,
       r6(avg(CASE WHEN y = 1 THEN amount END)) AS mean_positive_amount,
       r6(avg(CASE WHEN y = 0 THEN amount END)) AS mean_negative_amount
FROM (SELECT *, CASE WHEN score_i >= 60 THEN 1 ELSE 0 END AS p FROM scored_lines) GROUP BY channel
"""


@query("e18_money_summary_by_currency", MONEY_SQL)
def money(spark, sf_dir):
    """Money totals detected / missed / false-alarm per currency-like channel."""
    s = scored_lines(spark, sf_dir).withColumn(
        "p", F.when(F.col("score_i") >= 60, 1).otherwise(0))
    return E.money_summary(s, "channel", "amount")


RANGES_SQL = """
WITH per AS (SELECT client_id, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS d FROM txn_events GROUP BY 1)
SELECT strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day,
       CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 AS INT) AS span_days,
       count(DISTINCT CAST(ts AS DATE)) AS days_with_rows, count(*) AS rows,
       (SELECT count(*) FROM per) AS clients, r6((SELECT avg(n) FROM per)) AS rows_per_client,
       r6((SELECT avg(d) FROM per)) AS active_days_per_client
FROM txn_events
"""


@query("e19_date_range_ratios", RANGES_SQL)
def ranges(spark, sf_dir):
    """Date range, days covered, per-client ratios."""
    return E.client_date_ranges(txn_events(spark, sf_dir), "client_id", "ts")


MASKS_SQL = """
WITH t AS (SELECT y, amount > 300000 AS big, region = 0 AS r0, segment = 'BUILDING' AS bld,
                  isodow(ts) >= 6 AS wkend FROM txn_orders),
tot AS (SELECT count(*) AS n, sum(y) AS p FROM t)
SELECT segment, CAST(rows AS BIGINT) AS rows, CAST(positives AS BIGINT) AS positives, r6(positives / rows) AS rate,
       r6(rows / n) AS share_rows, r6(positives / p) AS share_positives FROM (
  SELECT 'big_amount' AS segment, sum(CAST(big AS INT)) AS rows, sum(CASE WHEN big THEN y ELSE 0 END) AS positives FROM t UNION ALL
  SELECT 'region_0', sum(CAST(r0 AS INT)), sum(CASE WHEN r0 THEN y ELSE 0 END) FROM t UNION ALL
  SELECT 'building', sum(CAST(bld AS INT)), sum(CASE WHEN bld THEN y ELSE 0 END) FROM t UNION ALL
  SELECT 'weekend', sum(CAST(wkend AS INT)), sum(CASE WHEN wkend THEN y ELSE 0 END) FROM t), tot
"""


@query("e20_overlapping_segments", MASKS_SQL)
def masks(spark, sf_dir):
    """Rates of overlapping segments, shares of rows and of positives."""
    t = txn_orders(spark, sf_dir)
    return E.overlapping_segments(t, {
        "big_amount": F.col("amount") > 300000, "region_0": F.col("region") == 0,
        "building": F.col("segment") == "BUILDING", "weekend": F.weekday("ts") >= 5})


# ------------------------------------------------------------------ stats
CORR_COLS = ["amount", "code", "y", "hour"]
CORR_SQL = "WITH t AS (SELECT amount, code, y, hour(ts) AS hour FROM txn_events) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, r6(corr({a}, {b})) AS corr, "
    f"CAST(count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS BIGINT) AS n FROM t"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])


@query("i1_pearson_matrix", CORR_SQL)
def pearson(spark, sf_dir):
    """Pairwise-complete Pearson correlations (long matrix)."""
    t = txn_events(spark, sf_dir).withColumn("hour", F.hour("ts"))
    return S.pearson_long(t, CORR_COLS)


SPEARMAN_SQL = """
WITH t AS (SELECT amount, code FROM txn_events WHERE amount IS NOT NULL AND code IS NOT NULL),
r AS (SELECT rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0 AS ra,
             rank() OVER (ORDER BY code) + (count(*) OVER (PARTITION BY code) - 1) / 2.0 AS rb FROM t)
SELECT r6(corr(ra, rb)) AS spearman, count(*) AS n FROM r
"""


@query("i2_spearman", SPEARMAN_SQL)
def spearman(spark, sf_dir):
    """Spearman correlation from distributed average ranks."""
    return S.spearman(txn_events(spark, sf_dir), "amount", "code")


DOC_COLS = ["lang", "source", "quality", "toxic"]


def doc_labels(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = load(spark, sf_dir, "labels")
    return d.join(lab, "doc_id")


def _chi_sql(a, b):
    return f"""SELECT '{a}' AS a, '{b}' AS b, chi2, n, r, k FROM (
  SELECT sum(o * o / (rt * ct)) * sum(o) / 1.0 AS s_, sum(o) AS n,
         count(DISTINCT va) AS r, count(DISTINCT vb) AS k,
         sum(o) * (sum(o * o / (rt * ct)) - 1) AS chi2
  FROM (SELECT va, vb, o, sum(o) OVER (PARTITION BY va) AS rt, sum(o) OVER (PARTITION BY vb) AS ct
        FROM (SELECT CAST({a} AS VARCHAR) AS va, CAST({b} AS VARCHAR) AS vb, count(*) AS o FROM dl
              WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)))"""


CHI_SQL = ("WITH dl AS (SELECT d.doc_id, lang, source, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id), "
           "c AS (" + " UNION ALL ".join(_chi_sql(a, b) for i, a in enumerate(DOC_COLS)
                                          for b in DOC_COLS[i + 1:]) + """)
SELECT a, b, r6(chi2) AS chi2, CAST(n AS BIGINT) AS n, CAST(r AS BIGINT) AS r, CAST(k AS BIGINT) AS k,
       r6(CASE WHEN least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1 > 0
               THEN sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) /
                         (least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1)) END) AS cramers_v,
       CASE WHEN (CASE WHEN least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1 > 0
               THEN sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) /
                         (least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1)) END) >= 0.1
            THEN 'large' ELSE 'small' END AS verdict
FROM c
""")


@query("i3_i4_chi2_cramers_v_all_pairs", CHI_SQL)
def chi(spark, sf_dir):
    """I3 chi-square, I4 bias-corrected Cramér's V for all column pairs (one pass), I7 verdict."""
    cells = S.pair_cells(doc_labels(spark, sf_dir), DOC_COLS)
    v = S.cramers_v(S.chi2_from_cells(cells))
    return v.withColumn("verdict", S.effect_label(F.col("cramers_v")))


MI_SQL = """
WITH l AS (UNPIVOT (SELECT y, coalesce(CAST(amount AS DOUBLE), 0) AS amount, coalesce(CAST(code AS DOUBLE), 0) AS code,
                           coalesce(CAST(hour(ts) AS DOUBLE), 0) AS hour FROM txn_events)
           ON amount, code, hour INTO NAME variable VALUE value),
q AS (SELECT variable, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM l GROUP BY variable),
e AS (SELECT variable, list_distinct([round(x, 9) for x in e]) AS e FROM q),
c AS (SELECT l.variable, len([x for x in e.e if x < l.value]) AS bin, y, CAST(count(*) AS DOUBLE) AS n
      FROM l JOIN e ON l.variable = e.variable GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER (PARTITION BY variable, bin) AS nb, sum(n) OVER (PARTITION BY variable, y) AS ny,
             sum(n) OVER (PARTITION BY variable) AS nt FROM c)
SELECT variable, r6(sum(n / nt * ln(n * nt / (nb * ny)))) AS mutual_info FROM t GROUP BY variable
"""


@query("i5_mutual_information", MI_SQL)
def mi(spark, sf_dir):
    """Plug-in mutual information with the label on quantile bins (ranking use)."""
    return S.mutual_information(txn_events(spark, sf_dir).withColumn("hour", F.hour("ts")),
                                ["amount", "code", "hour"])


def _psi(n: str) -> str:
    x = f"({n} + 10.0)"
    back = " + ".join(f"1.0 / ({n} + {i})" for i in range(10))
    return (f"(ln({x}) - 1 / (2 * {x}) - 1 / (12 * pow({x}, 2)) + 1 / (120 * pow({x}, 4)) - 1 / (252 * pow({x}, 6))"
            f" + 1 / (240 * pow({x}, 8)) - ({back}))")


NEIGHBOUR_SQL = f"""
WITH l AS (UNPIVOT (SELECT y, coalesce(CAST(amount AS DOUBLE), 0) AS amount, coalesce(CAST(code AS DOUBLE), 0) AS code,
                           coalesce(CAST(hour(ts) AS DOUBLE), 0) AS hour FROM txn_events WHERE y IS NOT NULL)
           ON amount, code, hour INTO NAME variable VALUE value),
x AS (SELECT variable, y, CAST(round(value / 1e-6) AS BIGINT) AS x FROM l),
c AS (SELECT *, count(*) OVER (PARTITION BY variable, y) AS ny FROM x),
g AS (SELECT *, count(*) OVER (PARTITION BY variable, y, x) AS same,
             list_sort([d for d in [x - lag(x, 1) OVER w, x - lag(x, 2) OVER w, x - lag(x, 3) OVER w,
                                    lead(x, 1) OVER w - x, lead(x, 2) OVER w - x, lead(x, 3) OVER w - x] if d IS NOT NULL]) AS ds
      FROM c WHERE ny > 1 WINDOW w AS (PARTITION BY variable, y ORDER BY x)),
d AS (SELECT *, ds[least(3, ny - 1)] AS d FROM g),
m AS (SELECT *, count(*) OVER (PARTITION BY variable ORDER BY x RANGE BETWEEN greatest(d - 1, 0) PRECEDING
                               AND greatest(d - 1, 0) FOLLOWING) AS m FROM d),
k AS (SELECT *, CASE WHEN d > 0 THEN least(3, ny - 1) ELSE same END AS k FROM m)
SELECT variable, r6(greatest(0.0, {_psi('count(*)')} + avg({_psi('k')} - {_psi('ny')} - {_psi('m')}))) AS mutual_info
FROM k GROUP BY variable
"""


@query("i5_neighbour_information", NEIGHBOUR_SQL)
def neighbours(spark, sf_dir):
    """Mutual information with the label by the three nearest rows of a class."""
    return S.neighbour_information(txn_events(spark, sf_dir).withColumn("hour", F.hour("ts")), ["amount", "code", "hour"])


KS_SQL = """
WITH a AS (SELECT amount AS v FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01' AND amount IS NOT NULL),
b AS (SELECT amount AS v FROM txn_orders WHERE ts >= TIMESTAMP '1998-01-01' AND amount IS NOT NULL),
vals AS (SELECT v FROM a UNION SELECT v FROM b),
na AS (SELECT count(*) AS n FROM a), nb AS (SELECT count(*) AS n FROM b),
cdf AS (SELECT vals.v, (SELECT count(*) FROM a WHERE a.v <= vals.v) AS ca,
               (SELECT count(*) FROM b WHERE b.v <= vals.v) AS cb FROM vals),
d AS (SELECT max(abs(ca / na.n - cb / nb.n)) AS ks_d, na.n AS n_a, nb.n AS n_b FROM cdf, na, nb GROUP BY na.n, nb.n),
x AS (SELECT *, sqrt(n_a * n_b / (n_a + n_b)) * ks_d AS z FROM d)
SELECT r6(ks_d) AS ks_d, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b,
       r6(CASE WHEN z <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * z * z))
                                                                          FROM range(1, 101) t(k)))) END) AS ks_pvalue,
       CASE WHEN ks_d >= 0.1 THEN 'large' ELSE 'small' END AS verdict
FROM x
"""


@query("i6_ks_two_sample", KS_SQL)
def ks(spark, sf_dir):
    """I6 + I7: two-sample KS statistic (exact), asymptotic p-value and effect-size verdict."""
    t = txn_orders(spark, sf_dir)
    ks = S.ks_two_sample(t.where(F.col("ts") < _cut()), t.where(F.col("ts") >= _cut()), "amount")
    return ks.withColumn("verdict", S.effect_label(F.col("ks_d")))


COHEN_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS variable, d FROM (
  SELECT (avg(v) FILTER (WHERE g = 'BUILDING') - avg(v) FILTER (WHERE g = 'AUTOMOBILE')) /
         sqrt(((count(v) FILTER (WHERE g = 'BUILDING') - 1) * var_samp(v) FILTER (WHERE g = 'BUILDING') +
               (count(v) FILTER (WHERE g = 'AUTOMOBILE') - 1) * var_samp(v) FILTER (WHERE g = 'AUTOMOBILE')) /
              (count(v) FILTER (WHERE g = 'BUILDING') + count(v) FILTER (WHERE g = 'AUTOMOBILE') - 2)) AS d
  FROM (SELECT client_id, min(segment) AS g, avg(CAST({c} AS DOUBLE)) AS v FROM txn_orders GROUP BY client_id))"""
    for c in ["amount", "y", "region"])
COHEN_SQL = f"""SELECT variable, r6(d) AS d,
  CASE WHEN abs(d) < 0.2 THEN 'despreciable' WHEN abs(d) < 0.5 THEN 'chico' WHEN abs(d) < 0.8 THEN 'mediano'
       ELSE 'grande' END AS magnitude FROM ({COHEN_SQL}) WHERE d IS NOT NULL"""


@query("i9_cohens_d_client_level", COHEN_SQL)
def cohen(spark, sf_dir):
    """Cohen's d on client-level means between two segments, magnitude label."""
    return S.cohens_d(txn_orders(spark, sf_dir), "client_id", "segment",
                      ["amount", "y", "region"], "BUILDING", "AUTOMOBILE")


WILSON_SQL = """
SELECT segment, CAST(sum(y) AS BIGINT) AS k, count(*) AS n,
       r6((sum(y) / count(*) + 1.96 * 1.96 / (2 * count(*))) / (1 + 1.96 * 1.96 / count(*))
          - 1.96 * sqrt(sum(y) / count(*) * (1 - sum(y) / count(*)) / count(*) + 1.96 * 1.96 / (4 * count(*) * count(*)))
            / (1 + 1.96 * 1.96 / count(*))) AS lo,
       r6((sum(y) / count(*) + 1.96 * 1.96 / (2 * count(*))) / (1 + 1.96 * 1.96 / count(*))
          + 1.96 * sqrt(sum(y) / count(*) * (1 - sum(y) / count(*)) / count(*) + 1.96 * 1.96 / (4 * count(*) * count(*)))
            / (1 + 1.96 * 1.96 / count(*))) AS hi
FROM txn_orders GROUP BY segment
"""


@query("i10_wilson_interval", WILSON_SQL)
def wilson(spark, sf_dir):
    """Wilson score interval of the label rate per segment."""
    g = txn_orders(spark, sf_dir).groupBy("segment").agg(
        F.sum("y").cast("long").alias("k"), F.count(F.lit(1)).alias("n"))
    lo, hi = S.wilson(F.col("k"), F.col("n"))
    return g.select("segment", "k", "n", lo.alias("lo"), hi.alias("hi"))


IQR_SQL = """
WITH tr AS (SELECT * FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01'),
q AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM tr),
l AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT r6(q1) AS q1, r6(q3) AS q3, r6(iqr) AS iqr, r6(lo) AS lo, r6(hi) AS hi,
       CAST((SELECT sum(CASE WHEN amount < lo OR amount > hi THEN 1 ELSE 0 END) FROM txn_orders) AS BIGINT) AS outliers,
       r6((SELECT avg(CASE WHEN amount < lo OR amount > hi THEN 1 ELSE 0 END) FROM txn_orders)) AS outlier_share
FROM l
"""


@query("i11_iqr_outliers_train_limits", IQR_SQL)
def iqr(spark, sf_dir):
    """IQR limits fitted on the train period, flag and share over all rows."""
    t = txn_orders(spark, sf_dir)
    lim = S.iqr_limits(t.where(F.col("ts") < _cut()), "amount")
    f = S.flag_outliers(t, "amount", lim)
    agg = f.agg(F.sum("is_outlier").cast("long").alias("outliers"),
                F.avg("is_outlier").alias("outlier_share"))
    return with_scalars(lim, agg)


SKEW_SQL = """
SELECT r6(skewness(amount)) AS skew_raw, r6(skewness(ln(1 + amount))) AS skew_log,
       count(DISTINCT category) AS n_category, count(DISTINCT (category, code)) AS n_category_code,
       count(DISTINCT category) = count(DISTINCT (category, code)) AS same_partition
FROM (SELECT amount, category, CASE category WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                                             WHEN 'signup' THEN 4 ELSE 5 END AS code FROM txn_events)
"""


@query("i12_skew_before_after_transform", SKEW_SQL)
def skew(spark, sf_dir):
    """Skewness before/after log1p; distinct-value equality of two encodings."""
    t = txn_events(spark, sf_dir).withColumn(
        "code2", F.when(F.col("category") == "click", 1).when(F.col("category") == "view", 2)
        .when(F.col("category") == "purchase", 3).when(F.col("category") == "signup", 4).otherwise(5))
    n = F.count(F.lit(1))
    g1r = F.skewness("amount")
    g1l = F.skewness(F.log1p("amount"))
    adj = F.sqrt(n * (n - 1)) / (n - 2)
    return t.agg((g1r * adj).alias("skew_raw"), (g1l * adj).alias("skew_log"),
                 F.count_distinct("category").alias("n_category"),
                 F.count_distinct(F.struct("category", "code2")).alias("n_category_code")) \
        .withColumn("same_partition", F.col("n_category") == F.col("n_category_code"))


SCALE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, r6(stddev_samp({c})) AS sd, r6(min({c})) AS min, r6(max({c})) AS max FROM txn_orders"
    for c in ["amount", "region", "y"])


@query("i13_scale_table", SCALE_SQL)
def scale(spark, sf_dir):
    """Sd, min, max per column."""
    return S.scale_table(txn_orders(spark, sf_dir), ["amount", "region", "y"])

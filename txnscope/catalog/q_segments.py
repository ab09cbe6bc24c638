"""Segment, rule, fairness, privacy and order queries
(M11, M12, M23, M24/B25, P1, P2, P5–P10, X1, X2, X4, X5, F7, F10, F11, F12)."""

from pyspark.sql import functions as F

from txnscope.catalog.q_history import history_raw_sql
from txnscope.catalog.registry import query
from txnscope.functions import parse as P
from txnscope.functions.calendar import age_years
from txnscope.operators import history as H
from txnscope.operators import order as O
from txnscope.operators import segments as G
from txnscope.operators.metrics import confusion, ranking_summary
from txnscope.operators.stats import cohens_d
from txnscope.plans.frames import with_scalars
from txnscope.sources import load, scored_lines, txn_orders
from txnscope.sources.raw import RAW_TRANSACTIONS_SQL, raw_transactions
from txnscope.plans.quantile import exact_quantiles

EV_CUT = "2024-01-20"


def scored_events(spark, sf_dir):
    """Events with history features, a score (code / 100), its alert (>= 0.6) and the
    raw-fixture attributes (currency, sex, age)."""
    r = raw_transactions(spark, sf_dir)
    h = H.history_features(r)
    return (h.withColumn("score", F.col("code") / 100.0)
            .withColumn("p", (F.col("code") >= 60).cast("int"))
            .withColumn("hour", F.hour("ts"))
            .withColumn("age", age_years(P.date_ddmmyyyy("birth_txt"))))


EV_CTE = f"""raw AS ({RAW_TRANSACTIONS_SQL}),
ev AS (SELECT r.*, h.gap_hours, h.prior_count, h.z_amount, h.z_amount_abs, r.code / 100.0 AS score,
              CASE WHEN r.code >= 60 THEN 1 ELSE 0 END AS p, hour(r.ts) AS hour,
              CAST(floor(date_diff('day', CAST(strptime(r.birth_txt, '%d/%m/%Y') AS DATE), DATE '2025-01-01') / 365) AS INT) AS age
       FROM raw r JOIN ({history_raw_sql('txn_events')}) h ON r.txn_id = h.txn_id)"""

SEG_SQL = f"""WITH {EV_CTE},
q AS (SELECT quantile_cont(amount, [0.25, 0.5, 0.75]) AS q FROM ev),
c AS (SELECT p, y, category AS canal, CASE WHEN currency = 2 THEN 'dolares' ELSE 'pesos' END AS moneda,
             ['bajo', 'medio-bajo', 'medio-alto', 'alto'][len(list_filter(q.q, lambda e: e < amount)) + 1] AS importe,
             CASE WHEN prior_count <= 50 THEN '<50 trx' WHEN prior_count <= 200 THEN '50-200' ELSE '>200' END AS historial,
             CASE WHEN hour <= 5 THEN 'madrugada' WHEN hour <= 11 THEN 'manana' WHEN hour <= 17 THEN 'tarde' ELSE 'noche' END AS franja
      FROM ev, q),
l AS (UNPIVOT c ON canal, moneda, importe, historial, franja INTO NAME cut VALUE segment),
g AS (SELECT cut, segment, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives,
             sum(CASE WHEN p = 1 AND y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p = 1 AND y = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN p = 0 AND y = 1 THEN 1 ELSE 0 END) AS fn FROM l GROUP BY cut, segment)
SELECT cut, segment, rows, positives, r6(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) AS precision,
       r6(tp / (tp + fn)) AS recall, r6(2 * tp / (2 * tp + fp + fn)) AS f1 FROM g WHERE positives > 0
"""


@query("m11_segment_metrics", SEG_SQL)
def seg(spark, sf_dir):
    """Metrics by channel, currency, amount quartile, history band, time band."""
    e = G.quantile_labels(scored_events(spark, sf_dir), "amount", G.AMOUNT_QUARTILE_LABELS)
    cuts = {
        "canal": F.col("category"),
        "moneda": F.when(F.col("currency") == 2, F.lit("dolares")).otherwise(F.lit("pesos")),
        "importe": F.col("amount_band"),
        "historial": G._right_closed(F.col("prior_count"), G.HISTORY_BANDS),
        "franja": G._right_closed(F.col("hour"), G.HOUR_BANDS),
    }
    return G.segment_metrics(e, cuts)


TERC = ["bajo", "medio", "alto"]
SEG_AP_SQL = f"""WITH {EV_CTE},
tr AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{EV_CUT}'), te AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{EV_CUT}'),
q AS (SELECT currency, quantile_cont(amount, [1 / 3, 2 / 3]) AS q FROM tr GROUP BY currency),
s AS (SELECT te.*, CAST(te.currency AS VARCHAR) || '-' || {TERC}[len(list_filter(q.q, lambda e: e < te.amount)) + 1] AS segment
      FROM te JOIN q ON te.currency = q.currency),
g AS (SELECT segment, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, CAST(sum(p) AS BIGINT) AS alerts,
             CAST(sum(p * y) AS BIGINT) AS tp, CAST(sum(p * (1 - y)) AS BIGINT) AS fp FROM s GROUP BY segment),
r AS (SELECT segment, y, sum(y) OVER (PARTITION BY segment ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
             count(*) OVER (PARTITION BY segment ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM s),
ap AS (SELECT segment, sum(CASE WHEN y = 1 THEN ctp / k END) / nullif(sum(y), 0) AS average_precision FROM r GROUP BY segment)
SELECT g.segment, rows, positives, alerts, tp, fp,
       r6(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) AS precision,
       r6(CASE WHEN positives > 0 THEN tp / positives END) AS recall,
       r6(CASE WHEN tp + positives > 0 THEN 2 * tp / (tp + fp + positives) ELSE 0.0 END) AS f1,
       r6(average_precision) AS average_precision
FROM g JOIN ap ON g.segment = ap.segment
"""


@query("m12_segment_terciles_with_ap", SEG_AP_SQL)
def seg_ap(spark, sf_dir):
    """Amount terciles inside each currency (cut points from train), per-segment
    alerts, TP, FP, precision, recall, F1 and AP on test."""
    e = scored_events(spark, sf_dir)
    cut = F.lit(EV_CUT).cast("timestamp_ntz")
    tr, te = e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)
    q = exact_quantiles(tr, "amount", [1 / 3, 2 / 3], by=["currency"])
    te = te.join(q, "currency")
    idx = F.size(F.filter("_q", lambda v: v < F.col("amount")))
    seg = F.concat(F.col("currency").cast("string"), F.lit("-"),
                   F.element_at(F.array(*[F.lit(t) for t in TERC]), idx + 1))
    return G.segment_metrics_with_ap(te, seg, "score")


COND_SQL = """
WITH s AS (SELECT 'all' AS scope, * FROM scored_lines UNION ALL SELECT 'status_f', * FROM scored_lines WHERE channel = 'F'),
r AS (SELECT scope, y, sum(y) OVER (PARTITION BY scope ORDER BY score_i DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             count(*) OVER (PARTITION BY scope ORDER BY score_i DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM s),
ap AS (SELECT scope, sum(CASE WHEN y = 1 THEN tp / k END) / sum(y) AS ap FROM r GROUP BY scope),
a1 AS (SELECT scope, score_i, count(*) AS n1 FROM s WHERE y = 1 GROUP BY ALL),
a0 AS (SELECT scope, score_i, count(*) AS n0 FROM s WHERE y = 0 GROUP BY ALL),
auc AS (SELECT a1.scope, sum(CASE WHEN a1.score_i > a0.score_i THEN n1 * n0 ELSE 0.5 * n1 * n0 END) AS u
        FROM a1 JOIN a0 ON a1.scope = a0.scope AND a1.score_i >= a0.score_i GROUP BY a1.scope),
c AS (SELECT scope, sum(y) AS P, sum(1 - y) AS N, sum(CASE WHEN score_i >= 60 THEN y ELSE 0 END) AS tp,
             sum(CASE WHEN score_i >= 60 THEN 1 - y ELSE 0 END) AS fp FROM s GROUP BY scope)
SELECT c.scope, r6(u / (P * N)) AS roc_auc, r6(ap.ap) AS average_precision,
       r6(2 * tp / (tp + fp + P)) AS f1, CAST(P AS BIGINT) AS positives FROM c JOIN ap ON c.scope = ap.scope
JOIN auc ON c.scope = auc.scope
"""


@query("m23_conditional_evaluation", COND_SQL)
def cond(spark, sf_dir):
    """AUC, AP, F1 on all rows and on the subset where positives can occur."""
    s = scored_lines(spark, sf_dir).withColumn("p", (F.col("score_i") >= 60).cast("int"))

    def one(df, scope):
        r = ranking_summary(df, "score_i", "y").select("roc_auc", "average_precision", "positives")
        c = confusion(df, "p", "y").select("f1")
        return with_scalars(r, c).withColumn("scope", F.lit(scope))
    return one(s, "all").unionByName(one(s.where(F.col("channel") == "F"), "status_f"))


RULES_SQL = """
WITH t AS (SELECT ts, y, CAST(amount > 50000 AS INT) AS high_amount, CAST(channel = 'F' AS INT) AS status_f,
                  CAST(amount > 50000 OR channel = 'F' AS INT) AS any_of, CAST(amount > 50000 AND channel = 'F' AS INT) AS all_of
           FROM scored_lines),
l AS (UNPIVOT t ON high_amount, status_f, any_of, all_of INTO NAME rule VALUE p),
m AS (SELECT rule, ts < TIMESTAMP '1998-01-01' AS is_train, sum(p * y) AS tp, sum(p * (1 - y)) AS fp, sum((1 - p) * y) AS fn
      FROM l GROUP BY ALL),
f AS (SELECT rule, is_train, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM m),
tr AS (SELECT rule, f1 AS f1_train FROM f WHERE is_train),
te AS (SELECT rule, precision AS precision_test, recall AS recall_test, f1 AS f1_test FROM f WHERE NOT is_train),
b AS (SELECT rule AS best FROM tr ORDER BY f1_train DESC, rule ASC LIMIT 1)
SELECT tr.rule, r6(f1_train) AS f1_train, r6(precision_test) AS precision_test, r6(recall_test) AS recall_test,
       r6(f1_test) AS f1_test, tr.rule = b.best AS selected FROM tr JOIN te ON tr.rule = te.rule, b
"""


@query("m24_b25_rule_selection", RULES_SQL)
def rules(spark, sf_dir):
    """B25 rule predictors (amount, status, OR, AND); M24 best rule on train, all on test."""
    s = scored_lines(spark, sf_dir)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    hi, st = F.col("amount") > 50000, F.col("channel") == "F"
    r = {"high_amount": hi, "status_f": st, "any_of": hi | st, "all_of": hi & st}
    return G.rule_selection(s.where(F.col("ts") < cut), s.where(F.col("ts") >= cut), r)


SCHEMES = {"fine": [(60, "<=60"), (70, "61-70"), (None, ">70")],
           "coarse": [(70, "<=70"), (None, ">70")]}
AGE_SQL = f"""WITH {EV_CTE},
b AS (SELECT client_id, y, CASE WHEN age <= 60 THEN '<=60' WHEN age <= 70 THEN '61-70' ELSE '>70' END AS fine,
             CASE WHEN age <= 70 THEN '<=70' ELSE '>70' END AS coarse FROM ev),
l AS (UNPIVOT b ON fine, coarse INTO NAME scheme VALUE band),
g AS (SELECT scheme, band, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives,
             count(DISTINCT CASE WHEN y = 1 THEN client_id END) AS affected_clients FROM l GROUP BY ALL),
ok AS (SELECT scheme, min(CAST(positives >= 30 AND affected_clients >= 15 AS INT)) AS ok FROM g GROUP BY scheme),
ch AS (SELECT CASE WHEN (SELECT ok FROM ok WHERE scheme = 'fine') = 1 THEN 'fine' ELSE 'coarse' END AS chosen)
SELECT scheme, band, rows, positives, affected_clients FROM g, ch WHERE scheme = chosen
"""


@query("p1_age_bands_with_fallback", AGE_SQL)
def ages(spark, sf_dir):
    """Age bands; fall back to coarser cuts when a band has < 30 positives or
    < 15 affected clients."""
    return G.age_bands_with_fallback(scored_events(spark, sf_dir), "age", "client_id", SCHEMES)


GROUP_SQL = f"""WITH {EV_CTE}
SELECT sex, count(*) AS rows, r6(avg(y)) AS positive_rate, r6(avg(p)) AS alert_rate,
       r6(sum(p * y) / nullif(sum(y), 0)) AS recall, r6(sum(p * (1 - y)) / nullif(sum(1 - y), 0)) AS fpr,
       r6(CASE WHEN sum(p) > 0 THEN sum(p * y) / sum(p) ELSE 0.0 END) AS precision FROM ev GROUP BY sex
"""


@query("p2_group_metrics", GROUP_SQL)
def groups(spark, sf_dir):
    """Positive rate, alert rate, recall, FPR and precision per group."""
    return G.group_metrics(scored_events(spark, sf_dir), "sex")


PROXY_SQL = f"""WITH {EV_CTE},
c AS (SELECT client_id, min(sex) AS g, avg(CAST(amount AS DOUBLE)) AS amount, avg(CAST(hour AS DOUBLE)) AS hour,
             avg(CAST(p AS DOUBLE)) AS p FROM ev GROUP BY client_id),
l AS (UNPIVOT c ON amount, hour, p INTO NAME variable VALUE v),
d AS (SELECT variable, (avg(v) FILTER (WHERE g = 'F') - avg(v) FILTER (WHERE g = 'M')) /
             sqrt(((count(v) FILTER (WHERE g = 'F') - 1) * var_samp(v) FILTER (WHERE g = 'F') +
                   (count(v) FILTER (WHERE g = 'M') - 1) * var_samp(v) FILTER (WHERE g = 'M')) /
                  (count(v) FILTER (WHERE g = 'F') + count(v) FILTER (WHERE g = 'M') - 2)) AS d FROM l GROUP BY variable)
SELECT variable, r6(d) AS d, CASE WHEN abs(d) < 0.2 THEN 'despreciable' WHEN abs(d) < 0.5 THEN 'chico'
                                  WHEN abs(d) < 0.8 THEN 'mediano' ELSE 'grande' END AS magnitude
FROM d WHERE d IS NOT NULL
"""


@query("p5_proxy_screen", PROXY_SQL)
def proxy(spark, sf_dir):
    """P5: which client-level features carry information about a protected group (Cohen's d)."""
    e = scored_events(spark, sf_dir).withColumn("hour", F.col("hour").cast("double")) \
        .withColumn("p", F.col("p").cast("double"))
    return cohens_d(e, "client_id", "sex", ["amount", "hour", "p"], "F", "M")


ORD_P_CTE = "o AS (SELECT *, CASE WHEN amount > 400000 THEN 1 ELSE 0 END AS p FROM txn_orders)"
EXPO_SQL = f"""WITH {ORD_P_CTE},
per AS (SELECT region, client_id, max(CASE WHEN p = 1 AND y = 0 THEN 1 ELSE 0 END) AS fa, max(y) AS victim,
               max(CASE WHEN p = 0 AND y = 1 THEN 1 ELSE 0 END) AS miss, max(CASE WHEN p = 1 AND y = 1 THEN 1 ELSE 0 END) AS caught
        FROM o GROUP BY region, client_id),
r AS (SELECT coalesce(CAST(region AS VARCHAR), 'TOTAL') AS region, count(*) AS clients, CAST(sum(fa) AS BIGINT) AS cfa,
             CAST(sum(victim) AS BIGINT) AS victims, CAST(sum(victim * miss) AS BIGINT) AS victims_missed,
             CAST(sum(victim * (1 - caught)) AS BIGINT) AS victims_never_alerted FROM per GROUP BY ROLLUP (region))
SELECT region, clients, cfa AS clients_false_alarm, victims, victims_missed, victims_never_alerted,
       r6(cfa / clients) AS false_alarm_rate,
       r6((cfa / clients + 1.96 * 1.96 / (2 * clients)) / (1 + 1.96 * 1.96 / clients)
          - 1.96 * sqrt(cfa / clients * (1 - cfa / clients) / clients + 1.96 * 1.96 / (4 * clients * clients)) / (1 + 1.96 * 1.96 / clients)) AS false_alarm_ci_lo,
       r6((cfa / clients + 1.96 * 1.96 / (2 * clients)) / (1 + 1.96 * 1.96 / clients)
          + 1.96 * sqrt(cfa / clients * (1 - cfa / clients) / clients + 1.96 * 1.96 / (4 * clients * clients)) / (1 + 1.96 * 1.96 / clients)) AS false_alarm_ci_hi,
       r6(CASE WHEN victims > 0 THEN victims_missed / victims END) AS miss_rate
FROM r
"""


def orders_p(spark, sf_dir):
    return txn_orders(spark, sf_dir).withColumn("p", (F.col("amount") > 400000).cast("int"))


@query("p6_person_exposure_rollup", EXPO_SQL)
def expo(spark, sf_dir):
    """Per-person exposure by group with a rollup total row and Wilson CI."""
    return G.exposure(orders_p(spark, sf_dir), "client_id", "region")


CONC_SQL = f"""WITH {ORD_P_CTE},
per AS (SELECT client_id, sum(CASE WHEN p = 1 AND y = 0 THEN 1 ELSE 0 END) AS fa FROM o GROUP BY client_id)
SELECT count(*) AS clients, r6(avg(CAST(fa > 0 AS DOUBLE))) AS share_with_false_alarm,
       CAST(max(fa) AS BIGINT) AS max_false_alarms, CAST(sum(fa) AS BIGINT) AS false_alarms FROM per
"""


@query("p7_false_alarm_concentration", CONC_SQL)
def conc(spark, sf_dir):
    """Concentration of false alarms over clients."""
    return G.false_alarm_concentration(orders_p(spark, sf_dir), "client_id")


KANON_SQL = """
WITH g AS (SELECT c_nationkey, c_mktsegment, floor(c_acctbal / 1000) AS b, count(*) AS m FROM customer GROUP BY ALL)
SELECT CAST(sum(m) AS BIGINT) AS rows, count(*) AS classes, CAST(sum(CASE WHEN m = 1 THEN 1 ELSE 0 END) AS BIGINT) AS unique_rows,
       CAST(sum(CASE WHEN m < 5 THEN m ELSE 0 END) AS BIGINT) AS rows_below_k, CAST(min(m) AS BIGINT) AS min_class,
       r6(sum(CASE WHEN m = 1 THEN 1 ELSE 0 END) / sum(m)) AS share_unique,
       r6(sum(CASE WHEN m < 5 THEN m ELSE 0 END) / sum(m)) AS share_below_k FROM g
"""


@query("p8_k_anonymity", KANON_SQL)
def kanon(spark, sf_dir):
    """K-anonymity over (nation, segment, balance band)."""
    c = load(spark, sf_dir, "customer").withColumn("b", F.floor(F.col("c_acctbal") / 1000))
    return G.k_anonymity(c, ["c_nationkey", "c_mktsegment", "b"])


STAB_SQL = """
WITH per AS (SELECT client_id, count(DISTINCT channel) AS nv, min(channel) AS v FROM scored_lines GROUP BY client_id)
SELECT v AS value, count(*) AS entities, (SELECT CAST(sum(CASE WHEN nv > 1 THEN 1 ELSE 0 END) AS BIGINT) FROM per) AS entities_multi_value,
       r6(count(*) / (SELECT count(*) FROM per)) AS share FROM per GROUP BY v
"""


@query("p9_attribute_stability", STAB_SQL)
def stab(spark, sf_dir):
    """Composition of a client attribute and clients with more than one value."""
    return G.attribute_stability(scored_lines(spark, sf_dir), "client_id", "channel")


PCONC_SQL = """
WITH s AS (SELECT strftime(ts, '%Y') AS period, y, CASE WHEN score_i >= 60 THEN 1 ELSE 0 END AS p FROM scored_lines)
SELECT period, r6(count(*) / (SELECT count(*) FROM s)) AS share_rows, r6(sum(y) / (SELECT sum(y) FROM s)) AS share_positives,
       r6(sum(p) / (SELECT sum(p) FROM s)) AS share_alerts FROM s GROUP BY period
"""


@query("p10_period_concentration", PCONC_SQL)
def pconc(spark, sf_dir):
    """P10: share of rows, positives and alerts in each period (year)."""
    s = scored_lines(spark, sf_dir).withColumn("p", (F.col("score_i") >= 60).cast("int"))
    return G.period_concentration(s, F.date_format("ts", "yyyy"))


TOPK_SQL = "SELECT txn_id, r6(amount) AS amount FROM txn_orders ORDER BY amount DESC, txn_id ASC LIMIT 10"


@query("x2_top_k", TOPK_SQL)
def topk(spark, sf_dir):
    """Top 10 rows by amount (ties by id)."""
    return O.top_k(txn_orders(spark, sf_dir), "amount", 10, ["txn_id"]).select("txn_id", "amount")


SORT_SQL = """
SELECT client_id, txn_id, CAST(row_number() OVER (ORDER BY client_id, ts, txn_id) AS BIGINT) AS position FROM txn_orders
"""


@query("x1_sort_client_time", SORT_SQL)
def sort(spark, sf_dir):
    """Total order by (client, time, tie), positions from a distributed prefix count."""
    from txnscope.plans.prefix import global_row_number, micros
    t = txn_orders(spark, sf_dir)
    # numeric key monotone in (client, ts) for the range cut; rounding can only create
    # ties, which the exact tie columns then order
    t = t.withColumn("_k", F.col("client_id").cast("double") * 1e16 + micros("ts").cast("double"))
    s = global_row_number(t, "_k", ["client_id", "ts", "txn_id"], "position")
    return O.sort_events(s, "client_id", "ts", "txn_id").select("client_id", "txn_id", "position")


EXT_SQL = """
WITH s AS (SELECT txn_id, code / 100.0 AS score, y FROM txn_events)
SELECT 'highest_alert' AS "case", txn_id, r6(score) AS score, y FROM (SELECT * FROM s WHERE score >= 0.6 ORDER BY score DESC, txn_id ASC LIMIT 1)
UNION ALL SELECT 'highest_false_alarm', txn_id, r6(score), y FROM (SELECT * FROM s WHERE score >= 0.6 AND y = 0 ORDER BY score DESC, txn_id ASC LIMIT 1)
UNION ALL SELECT 'nearest_threshold', txn_id, r6(score), y FROM (SELECT * FROM s WHERE score >= 0.6 ORDER BY score ASC, txn_id ASC LIMIT 1)
"""


@query("x4_extreme_cases", EXT_SQL)
def extremes(spark, sf_dir):
    """Highest-score alert, highest-score false alarm, alert nearest the threshold."""
    from txnscope.sources import txn_events
    e = txn_events(spark, sf_dir).withColumn("score", F.col("code") / 100.0)
    return G.extreme_cases(e, "txn_id", "score", 0.6)


CONTRIB_SQL = f"""WITH {EV_CTE},
u AS (SELECT txn_id, 'z_amount' AS variable, z_amount AS c FROM ev UNION ALL
      SELECT txn_id, 'code_dev', (code - 50) / 50.0 FROM ev UNION ALL
      SELECT txn_id, 'hour_dev', (hour - 12) / 12.0 FROM ev),
k AS (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY abs(c) DESC, variable ASC) AS rn FROM u WHERE abs(c) > 1e-6)
SELECT txn_id, string_agg(variable || ':' || CASE WHEN c > 0 THEN 'raises' ELSE 'lowers' END, ',' ORDER BY rn) AS top
FROM k WHERE rn <= 2 GROUP BY txn_id
"""


@query("x5_top_contributions", CONTRIB_SQL)
def contrib(spark, sf_dir):
    """Top-2 entries of a per-row contribution array by |value|, with direction."""
    e = scored_events(spark, sf_dir)
    arr = F.array(F.struct(F.lit("z_amount").alias("variable"), F.col("z_amount").alias("contribution")),
                  F.struct(F.lit("code_dev").alias("variable"), ((F.col("code") - 50) / 50.0).alias("contribution")),
                  F.struct(F.lit("hour_dev").alias("variable"), ((F.col("hour") - 12) / 12.0).alias("contribution")))
    top = G.top_contributions(arr, 2)
    out = e.select("txn_id", F.array_join(F.transform(top, lambda s: F.concat(s["variable"], F.lit(":"), s["direction"])),
                                          ",").alias("top"))
    return out.where(F.col("top") != "")


RANK_SQL = """
WITH t AS (SELECT amount, CAST(code AS DOUBLE) AS code, CAST(hour(ts) AS DOUBLE) AS hour, y FROM txn_events),
s AS (SELECT 'amount' AS variable, abs(corr(amount, y)) AS score_a,
             abs((avg(amount) FILTER (WHERE y = 1) - avg(amount) FILTER (WHERE y = 0)) / stddev_samp(amount)) AS score_b FROM t
      UNION ALL SELECT 'code', abs(corr(code, y)), abs((avg(code) FILTER (WHERE y = 1) - avg(code) FILTER (WHERE y = 0)) / stddev_samp(code)) FROM t
      UNION ALL SELECT 'hour', abs(corr(hour, y)), abs((avg(hour) FILTER (WHERE y = 1) - avg(hour) FILTER (WHERE y = 0)) / stddev_samp(hour)) FROM t),
r AS (SELECT *, CAST(trunc(rank() OVER (ORDER BY score_a DESC) + (count(*) OVER (PARTITION BY score_a) - 1) / 2.0) AS INT) AS rank_a,
             CAST(trunc(rank() OVER (ORDER BY score_b DESC) + (count(*) OVER (PARTITION BY score_b) - 1) / 2.0) AS INT) AS rank_b FROM s)
SELECT variable, r6(score_a) AS score_a, r6(score_b) AS score_b, rank_a, rank_b, rank_a - rank_b AS rank_jump FROM r
"""


@query("f7_rank_jump", RANK_SQL)
def rank_jump(spark, sf_dir):
    """variables ranked by |corr with label| and by |standardised mean difference|."""
    from txnscope.operators.profile import standardized_mean_difference
    from txnscope.operators.stats import pearson_long
    from txnscope.sources import txn_events
    e = txn_events(spark, sf_dir).withColumn("hour", F.hour("ts").cast("double")) \
        .withColumn("code", F.col("code").cast("double"))
    cols = ["amount", "code", "hour"]
    c = pearson_long(e, cols + ["y"], [(v, "y") for v in cols]).select(
        F.col("a").alias("variable"), F.abs("corr").alias("score_a"))
    s = standardized_mean_difference(e, cols).select("variable", F.col("abs_smd").alias("score_b"))
    return O.rank_jump(c.join(s, "variable"), "variable", "score_a", "score_b")


CUT_SQL = """
SELECT txn_id, CASE WHEN row_number() OVER (ORDER BY ts, txn_id) <= floor(0.8 * count(*) OVER ()) THEN 'fit'
                    ELSE 'validate' END AS part FROM txn_events
"""


@query("f10_chronological_cut", CUT_SQL)
def chrono(spark, sf_dir):
    """first 80 % of rows in time order to fit, last 20 % to validate."""
    from txnscope.sources import txn_events
    return O.chronological_cut(txn_events(spark, sf_dir), "ts", "txn_id", 0.8).select("txn_id", "part")


BASE_SQL = f"""WITH {ORD_P_CTE},
m AS (SELECT strftime(ts, '%Y-%m') AS period, sum(p * y) AS tp, sum(p * (1 - y)) AS fp, sum((1 - p) * y) AS fn FROM o GROUP BY 1),
f AS (SELECT period, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM m),
b AS (SELECT period, f1, list_sort(list(f1) OVER (ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)) AS prev FROM f)
SELECT period, r6(f1) AS f1, r6(CASE WHEN len(prev) > 0 THEN prev[len(prev) // 2 + 1] END) AS baseline FROM b
"""


@query("f11_moving_baseline", BASE_SQL)
def baseline(spark, sf_dir):
    """per month, upper-middle F1 of the three previous months as baseline."""
    from txnscope.operators.metrics import confusion as conf
    o = orders_p(spark, sf_dir).withColumn("period", F.date_format("ts", "yyyy-MM"))
    m = conf(o, "p", "y", by=["period"]).select("period", "f1")
    return O.moving_baseline(m, "period", "f1")


PROFILE_SQL = """
WITH e AS (SELECT txn_id, client_id, ts, amount, hour(ts) AS h, isodow(ts) - 1 AS wd FROM txn_events),
c AS (SELECT *, count(*) OVER (PARTITION BY client_id, h ORDER BY ts, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ch,
             count(*) OVER (PARTITION BY client_id, wd ORDER BY ts, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw FROM e)
SELECT txn_id, r6(avg(amount) OVER w) AS running_mean, r6(stddev_samp(amount) OVER w / avg(amount) OVER w) AS running_cv,
       arg_max(h, ch * 1e6 - h) OVER w AS fav_hour, arg_max(wd, cw * 1e6 - wd) OVER w AS fav_weekday
FROM c WINDOW w AS (PARTITION BY client_id ORDER BY ts, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


@query("f12_client_profile_features", PROFILE_SQL)
def cprofile(spark, sf_dir):
    """running mean spend, coefficient of variation, favourite hour and weekday."""
    from txnscope.sources import txn_events
    x = H.client_profile_features(txn_events(spark, sf_dir))
    return x.select("txn_id", "running_mean", "running_cv", "fav_hour", "fav_weekday")

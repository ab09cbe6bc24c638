"""Data-quality (C), set (H) and join (D) queries."""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.functions import parse as P
from txnscope.functions import rules as R
from txnscope.operators import joins as J
from txnscope.operators import profile as E
from txnscope.operators import quality as Q
from txnscope.sources import load, txn_events, txn_orders
from txnscope.sources.raw import RAW_TRANSACTIONS_SQL, raw_transactions

CUT = "1998-01-01"


def orders_with_nulls(spark, sf_dir):
    """txn_orders with data-derived missing values: segment null for low-priority
    orders, region null for very large orders."""
    t = txn_orders(spark, sf_dir)
    return (t.withColumn("segment", F.when(F.col("category") == "5-LOW", F.lit(None))
                         .otherwise(F.col("segment")))
            .withColumn("region", F.when(F.col("amount") > 400000, F.lit(None))
                        .otherwise(F.col("region"))))


NULLS_CTE = """tn AS (SELECT txn_id, client_id, ts, amount, category,
                  CASE WHEN category = '5-LOW' THEN NULL ELSE segment END AS segment,
                  CASE WHEN amount > 400000 THEN NULL ELSE region END AS region, y FROM txn_orders)"""


def dup_orders(spark, sf_dir):
    """txn_orders plus exact copies of two data-defined subsets (known multiplicities)."""
    t = txn_orders(spark, sf_dir)
    a = t.where((F.col("category") == "1-URGENT") & (F.col("segment") == "BUILDING"))
    b = t.where((F.col("y") == 1) & (F.col("region") == 0))
    return t.unionByName(a).unionByName(b)


DUP_CTE = """d AS (SELECT * FROM txn_orders UNION ALL
                   SELECT * FROM txn_orders WHERE category = '1-URGENT' AND segment = 'BUILDING' UNION ALL
                   SELECT * FROM txn_orders WHERE y = 1 AND region = 0)"""

COLS = ["txn_id", "client_id", "ts", "amount", "category", "segment", "region", "y"]

NULL_PROFILE_SQL = f"""WITH {NULLS_CTE}, c AS (SELECT count(*) AS n, {', '.join(
    f"count(*) - count({c}) AS {c}" for c in COLS)} FROM tn),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {c} AS n_null, n FROM c" for c in COLS)})
SELECT "column", CAST(n_null AS BIGINT) AS n_null, r6(n_null * 100.0 / n) AS pct_null FROM l WHERE n_null > 0
"""


@query("c2_null_profile", NULL_PROFILE_SQL)
def null_profile(spark, sf_dir):
    """Null count and % per column, non-zero only."""
    return Q.null_profile(orders_with_nulls(spark, sf_dir))


DISTINCT_SQL = f"""WITH {NULLS_CTE}, c AS (SELECT {', '.join(
    f"count(DISTINCT {c}) AS {c}" for c in COLS)} FROM tn)
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", CAST({c} AS BIGINT) AS n_distinct FROM c" for c in COLS)}
"""


@query("c3_distinct_counts", DISTINCT_SQL)
def distinct(spark, sf_dir):
    """Distinct values per column (exact)."""
    return Q.distinct_counts(orders_with_nulls(spark, sf_dir))


DUP_SUMMARY_SQL = f"""WITH {DUP_CTE}, g AS (SELECT count(*) AS m FROM d GROUP BY ALL_COLS)
SELECT CAST(sum(m) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN m > 1 THEN m - 1 ELSE 0 END) AS BIGINT) AS extra_copies,
       CAST(sum(CASE WHEN m > 1 THEN m ELSE 0 END) AS BIGINT) AS rows_involved,
       CAST(sum(CASE WHEN m > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_groups FROM g
""".replace("ALL_COLS", ", ".join(COLS))


@query("c4_duplicate_summary", DUP_SUMMARY_SQL)
def dup_summary(spark, sf_dir):
    """C4: exact-duplicate counts (null-safe grouping over all columns)."""
    return Q.duplicate_summary(dup_orders(spark, sf_dir))


DUP_HIST_SQL = f"""WITH {DUP_CTE}, g AS (SELECT count(*) AS m FROM d GROUP BY {', '.join(COLS)})
SELECT m AS multiplicity, count(*) AS groups, CAST(sum(m) AS BIGINT) AS rows FROM g GROUP BY m
"""


@query("c4_multiplicity_histogram", DUP_HIST_SQL)
def dup_hist(spark, sf_dir):
    """C4: multiplicity histogram of exact copies."""
    return Q.multiplicity_histogram(dup_orders(spark, sf_dir))


DEDUPE_SQL = f"""WITH {DUP_CTE}, u AS (SELECT DISTINCT * FROM d)
SELECT (SELECT count(*) FROM d) AS rows_before, (SELECT CAST(sum(y) AS BIGINT) FROM d) AS positives_before,
       (SELECT count(*) FROM u) AS rows_after, (SELECT CAST(sum(y) AS BIGINT) FROM u) AS positives_after
"""


@query("c5_c6_dedupe_label_report", DEDUPE_SQL)
def dedupe(spark, sf_dir):
    """C5 + C6: rows and positives before and after dropping exact duplicates."""
    return Q.dedupe_label_report(dup_orders(spark, sf_dir))


RECOVER_SQL = f"""WITH {NULLS_CTE}, g AS (SELECT client_id, max(CAST(segment IS NULL AS INT)) AS hn,
                                          max(CAST(segment IS NOT NULL AS INT)) AS hv FROM tn GROUP BY client_id)
SELECT CAST(sum(hn) AS BIGINT) AS entities_with_null, CAST(sum(hn * hv) AS BIGINT) AS recoverable,
       CAST(sum(hn * (1 - hv)) AS BIGINT) AS unrecoverable FROM g
"""


@query("c7_recoverability", RECOVER_SQL)
def recover(spark, sf_dir):
    """Clients with a missing segment that have it in another row."""
    return Q.recoverability(orders_with_nulls(spark, sf_dir), "client_id", "segment")


CHECKS_SQL = f"""WITH {NULLS_CTE}, c AS (
  SELECT count(*) AS n,
         sum(CASE WHEN amount < 0 THEN 1 ELSE 0 END) AS r0,
         sum(CASE WHEN year(ts) < 1995 OR year(ts) > 2000 THEN 1 ELSE 0 END) AS r1,
         sum(CASE WHEN segment IS NULL THEN 1 ELSE 0 END) AS r2,
         sum(CASE WHEN amount > 400000 THEN 1 ELSE 0 END) AS r3,
         sum(CASE WHEN region IS NULL AND segment IS NULL THEN 1 ELSE 0 END) AS r4 FROM tn)
SELECT * FROM (
  SELECT 'negative_amount' AS "check", CAST(r0 AS BIGINT) AS n, r6(r0 * 100.0 / n) AS pct_rows FROM c UNION ALL
  SELECT 'year_out_of_range', CAST(r1 AS BIGINT), r6(r1 * 100.0 / n) FROM c UNION ALL
  SELECT 'missing_segment', CAST(r2 AS BIGINT), r6(r2 * 100.0 / n) FROM c UNION ALL
  SELECT 'amount_over_400k', CAST(r3 AS BIGINT), r6(r3 * 100.0 / n) FROM c UNION ALL
  SELECT 'region_and_segment_missing', CAST(r4 AS BIGINT), r6(r4 * 100.0 / n) FROM c)
"""


@query("c8_c9_quality_checks", CHECKS_SQL)
def checks(spark, sf_dir):
    """C8 range/domain checks, C9 quality summary (count and % of rows), C11 co-nulls."""
    t = orders_with_nulls(spark, sf_dir)
    return Q.rule_counts(t, {
        "negative_amount": F.col("amount") < 0,
        "year_out_of_range": (F.year("ts") < 1995) | (F.year("ts") > 2000),
        "missing_segment": F.col("segment").isNull(),
        "amount_over_400k": F.col("amount") > 400000,
        "region_and_segment_missing": F.col("region").isNull() & F.col("segment").isNull(),
    })


CO_NULL_SQL = f"""WITH {NULLS_CTE}
SELECT CAST(sum(CASE WHEN segment IS NULL AND region IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_all_null FROM tn
"""


@query("c11_co_null_rows", CO_NULL_SQL)
def co_null(spark, sf_dir):
    """C11: rows with several columns null at once."""
    return Q.co_null_count(orders_with_nulls(spark, sf_dir), ["segment", "region"])


RECONCILE_SQL = f"""WITH raw AS ({RAW_TRANSACTIONS_SQL}),
b AS (SELECT txn_id, TRY_CAST(replace(amount_txt, ',', '.') AS DOUBLE) AS amount,
             CASE WHEN label_txt = 'SI' THEN 1 WHEN label_txt = 'NO' THEN 0 END AS y,
             strftime(try_strptime(strftime(try_strptime(date_txt, '%y%m%d'), '%Y-%m-%d') || ' ' ||
                      substr(lpad(time_txt, 8, '0'), 1, 6), '%Y-%m-%d %H%M%S'), '%Y-%m-%d %H:%M:%S') AS ts_s
      FROM raw),
a AS (SELECT txn_id, amount, y, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_s FROM txn_events),
j AS (SELECT a.txn_id AS ia, b.txn_id AS ib, a.amount AS aa, b.amount AS ba, a.y AS ay, b.y AS by_,
             a.ts_s AS ats, b.ts_s AS bts FROM a FULL OUTER JOIN b ON a.txn_id = b.txn_id)
SELECT CAST(count(ia) AS BIGINT) AS rows_a, CAST(count(ib) AS BIGINT) AS rows_b,
       CAST(sum(CASE WHEN ib IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_in_a,
       CAST(sum(CASE WHEN ia IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_in_b,
       CAST(sum(CASE WHEN ia IS NOT NULL AND ib IS NOT NULL AND aa IS DISTINCT FROM ba
                      AND (aa IS NULL OR ba IS NULL OR abs(aa - ba) > 1e-9) THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_amount,
       CAST(sum(CASE WHEN ia IS NOT NULL AND ib IS NOT NULL AND ay IS DISTINCT FROM by_
                      AND (ay IS NULL OR by_ IS NULL OR abs(ay - by_) > 1e-9) THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_y,
       CAST(sum(CASE WHEN ia IS NOT NULL AND ib IS NOT NULL AND ats IS DISTINCT FROM bts THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_ts_s
FROM j
"""


@query("c10_reconcile_parsed_vs_typed", RECONCILE_SQL)
def reconcile(spark, sf_dir):
    """Row-aligned reconciliation of the typed events against the same rows
    re-parsed from raw text (amount, label, timestamp)."""
    r = raw_transactions(spark, sf_dir)
    d = P.date_yymmdd("date_txt")
    b = r.select("txn_id", P.decimal_comma("amount_txt").alias("amount"),
                 P.binary_label("label_txt").alias("y"),
                 F.date_format(P.event_timestamp(d, P.time_hhmmss("time_txt")),
                               "yyyy-MM-dd HH:mm:ss").alias("ts_s"))
    a = txn_events(spark, sf_dir).select("txn_id", "amount", "y",
                                         F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_s"))
    return Q.reconcile(a, b, ["txn_id"], ["amount", "y", "ts_s"])


UNION_SQL = """
SELECT txn_id, amount, NULL::VARCHAR AS segment FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01'
UNION ALL SELECT txn_id, NULL::DOUBLE AS amount, segment FROM txn_orders WHERE ts >= TIMESTAMP '1998-01-01'
"""


@query("h1_union_by_name", UNION_SQL)
def union(spark, sf_dir):
    """H1: union by name of two tables with different columns (missing → null)."""
    t = txn_orders(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    a = t.where(F.col("ts") < cut).select("txn_id", "amount")
    b = t.where(F.col("ts") >= cut).select("txn_id", "segment")
    return Q.union_by_name(a, b).select("txn_id", "amount", "segment")


SETS_SQL = """
WITH e AS (SELECT DISTINCT client_id FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01'),
l AS (SELECT DISTINCT client_id FROM txn_orders WHERE ts >= TIMESTAMP '1998-01-01')
SELECT (SELECT count(*) FROM (SELECT * FROM e EXCEPT SELECT * FROM l)) AS only_early,
       (SELECT count(*) FROM (SELECT * FROM l EXCEPT SELECT * FROM e)) AS only_late,
       (SELECT count(*) FROM (SELECT * FROM e INTERSECT SELECT * FROM l)) AS both_periods,
       (SELECT count(*) = 0 FROM (SELECT txn_id FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01'
                                  INTERSECT SELECT txn_id FROM txn_orders WHERE ts >= TIMESTAMP '1998-01-01')) AS folds_disjoint
"""


@query("h2_h3_h4_entity_sets", SETS_SQL)
def sets(spark, sf_dir):
    """H2 difference, H3 intersection of client sets by period; H4 disjoint folds."""
    t = txn_orders(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    e = t.where(F.col("ts") < cut).select("client_id").distinct()
    late = t.where(F.col("ts") >= cut).select("client_id").distinct()
    only_e = Q.set_difference(e, late).agg(F.count(F.lit(1)).alias("only_early"))
    only_l = Q.set_difference(late, e).agg(F.count(F.lit(1)).alias("only_late"))
    both = Q.set_intersection(e, late).agg(F.count(F.lit(1)).alias("both_periods"))
    dis = Q.disjoint(t.where(F.col("ts") < cut).select("txn_id"),
                     t.where(F.col("ts") >= cut).select("txn_id")).select(
        F.col("disjoint").alias("folds_disjoint"))
    from txnscope.plans.frames import with_scalars
    return with_scalars(with_scalars(with_scalars(only_e, only_l), both), dis)


DIM_SQL = f"""
SELECT l_orderkey, l_partkey, coalesce(p.p_type, '{R.NO_CATEGORY}') AS category
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 1) p ON l_partkey = p.p_partkey
"""


@query("d1_dim_join_default", DIM_SQL)
def dim_join(spark, sf_dir):
    """Left join to a dimension (parts of size > 1 only); unmatched → literal."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = load(spark, sf_dir, "part").where(F.col("p_size") > 1)
    return J.dim_join(li, part, "l_partkey", "p_partkey", {"p_type": "category"},
                      default=R.NO_CATEGORY)


DIM2_SQL = """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""


@query("d2_second_dim_join", DIM2_SQL)
def dim2(spark, sf_dir):
    """Two chained dimension joins (fixed-size nation and region tables)."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    x = J.dim_join(c, load(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey",
                   {"n_name": "n_name", "n_regionkey": "_rk"}, bounded=True)
    x = J.dim_join(x, load(spark, sf_dir, "region"), "_rk", "r_regionkey", {"r_name": "r_name"},
                   bounded=True)
    return x.select("c_custkey", "n_name", "r_name")


LOOKUP_SQL = """
WITH tr AS (SELECT * FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01'),
m AS (SELECT client_id, avg(y) AS rate FROM tr GROUP BY client_id),
g AS (SELECT avg(y) AS gr FROM tr)
SELECT t.txn_id, r6(coalesce(m.rate, g.gr)) AS client_rate
FROM txn_orders t LEFT JOIN m ON t.client_id = m.client_id, g
WHERE t.ts >= TIMESTAMP '1998-01-01'
"""


@query("d3_lookup_join_default", LOOKUP_SQL)
def lookup(spark, sf_dir):
    """D3: per-client train rate mapped to later rows; unseen clients → global rate."""
    t = txn_orders(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    tr = t.where(F.col("ts") < cut)
    m = tr.groupBy("client_id").agg(F.avg("y").alias("rate"))
    from txnscope.plans.frames import with_scalars
    te = with_scalars(t.where(F.col("ts") >= cut), tr.agg(F.avg("y").alias("_g")))
    return J.lookup(te, m, "client_id", "rate", F.col("_g"), "client_rate") \
        .select("txn_id", "client_rate")


SEMI_SQL = """
SELECT txn_id FROM txn_orders WHERE client_id IN (SELECT client_id FROM txn_orders WHERE y = 1)
"""


@query("d4_semi_join", SEMI_SQL)
def semi(spark, sf_dir):
    """Rows of clients that have at least one positive."""
    t = txn_orders(spark, sf_dir)
    return J.semi(t, t.where(F.col("y") == 1), ["client_id"]).select("txn_id")


OVERLAP_SQL = """
WITH tr AS (SELECT client_id, max(y) AS p FROM txn_orders WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1),
te AS (SELECT DISTINCT client_id FROM txn_orders WHERE ts >= TIMESTAMP '1998-01-01'),
j AS (SELECT te.client_id, tr.p FROM te LEFT JOIN tr ON te.client_id = tr.client_id)
SELECT count(*) AS test_entities, CAST(count(p) AS BIGINT) AS seen_in_train,
       CAST(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS with_positive_in_train,
       r6(count(p) / count(*)) AS share_seen, r6(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) / count(*)) AS share_with_positive
FROM j
"""


@query("d5_entity_overlap", OVERLAP_SQL)
def overlap(spark, sf_dir):
    """Share of later clients seen earlier, and seen with a positive."""
    t = txn_orders(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return J.entity_overlap(t.where(F.col("ts") < cut), t.where(F.col("ts") >= cut), "client_id")


NEAREST_SQL = """
WITH a AS (SELECT txn_id, client_id, CAST(ts AS DATE) AS d FROM txn_orders WHERE y = 1 AND ts >= TIMESTAMP '1998-01-01'),
b AS (SELECT client_id, CAST(ts AS DATE) AS d FROM txn_orders WHERE y = 1 AND ts < TIMESTAMP '1998-01-01')
SELECT a.txn_id, a.client_id, CAST(min(abs(date_diff('day', b.d, a.d))) AS INT) AS days_to_nearest
FROM a LEFT JOIN b ON a.client_id = b.client_id GROUP BY a.txn_id, a.client_id
"""


def nearest(t):
    cut = F.lit(CUT).cast("timestamp_ntz")
    pos = t.where(F.col("y") == 1)
    return J.nearest_in_time(pos.where(F.col("ts") >= cut), pos.where(F.col("ts") < cut),
                             "client_id", "ts", "txn_id")


@query("d6_nearest_in_time", NEAREST_SQL)
def nearest_q(spark, sf_dir):
    """For each later positive, days to the nearest earlier positive of the client."""
    return nearest(txn_orders(spark, sf_dir))


HIST_SQL = """
WITH n AS (""" + NEAREST_SQL + """),
b AS (SELECT CASE WHEN days_to_nearest IS NULL THEN 'none'
                  WHEN days_to_nearest >= -0.5 AND days_to_nearest < 1.5 THEN '0-1'
                  WHEN days_to_nearest >= 1.5 AND days_to_nearest < 3.5 THEN '2-3'
                  WHEN days_to_nearest >= 3.5 AND days_to_nearest < 7.5 THEN '4-7'
                  WHEN days_to_nearest >= 7.5 AND days_to_nearest < 14.5 THEN '8-14'
                  WHEN days_to_nearest >= 14.5 AND days_to_nearest < 30.5 THEN '15-30'
                  WHEN days_to_nearest >= 30.5 AND days_to_nearest < 60.5 THEN '31-60'
                  WHEN days_to_nearest >= 60.5 AND days_to_nearest < 120.5 THEN '61-120'
                  WHEN days_to_nearest >= 120.5 AND days_to_nearest <= 400 THEN '>120' END AS bucket FROM n)
SELECT bucket, count(*) AS n, r6(count(*) / (SELECT count(*) FROM b)) AS share FROM b
WHERE bucket IS NOT NULL GROUP BY bucket
"""

NEAREST_EDGES = [-0.5, 1.5, 3.5, 7.5, 14.5, 30.5, 60.5, 120.5, 400]
NEAREST_LABELS = ["0-1", "2-3", "4-7", "8-14", "15-30", "31-60", "61-120", ">120"]


@query("e21_histogram_with_null_bucket", HIST_SQL)
def hist(spark, sf_dir):
    """Histogram of D6 day distances over given edges plus a 'none' bucket."""
    n = nearest(txn_orders(spark, sf_dir))
    return E.histogram(n, "days_to_nearest", NEAREST_EDGES, NEAREST_LABELS, "none")


# declared change calendar (parameter table): name, first and last affected month
CALENDAR = [("price_change", "1996-03", "1996-05"), ("new_segment", "1997-11", "1998-02"),
            ("campaign", "2000-06", "2000-06")]


def calendar_df(spark):
    return spark.createDataFrame(CALENDAR, "change string, from_period string, to_period string")


CAL_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in CALENDAR)
RANGE_SQL = f"""
WITH t AS (SELECT DISTINCT strftime(ts, '%Y-%m') AS period FROM txn_orders),
c AS (SELECT * FROM (VALUES {CAL_VALUES}) v(change, from_period, to_period))
SELECT t.period, c.change FROM t JOIN c ON t.period >= c.from_period AND t.period <= c.to_period
UNION ALL
SELECT t.period, NULL AS change FROM t WHERE NOT EXISTS
  (SELECT 1 FROM c WHERE t.period >= c.from_period AND t.period <= c.to_period)
"""


@query("d7_range_join_calendar", RANGE_SQL)
def range_join(spark, sf_dir):
    """Months of the data range-joined to a declared change calendar; quiet months
    (no active change) kept with a null change."""
    t = txn_orders(spark, sf_dir).select(F.date_format("ts", "yyyy-MM").alias("period")).distinct()
    cal = calendar_df(spark)
    active = J.range_join(t, cal, "period", "from_period", "to_period").select("period", "change")
    quiet = J.quiet_periods(t, cal, "period", "from_period", "to_period") \
        .withColumn("change", F.lit(None).cast("string"))
    return active.unionByName(quiet)


LAG_SQL = """
WITH t AS (SELECT strftime(ts, '%Y-%m') AS period, y FROM txn_orders),
c AS (SELECT strftime(CAST(max(period) || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m') AS cut FROM t)
SELECT period, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives FROM t, c WHERE period <= cut GROUP BY period
"""


@query("d8_labels_available", LAG_SQL)
def lag(spark, sf_dir):
    """Only months whose labels have arrived (latest month − 2)."""
    t = txn_orders(spark, sf_dir).withColumn("period", F.date_format("ts", "yyyy-MM"))
    a = J.labels_available_latest(t, "period", 2)
    return a.groupBy("period").agg(F.count(F.lit(1)).alias("rows"),
                                   F.sum("y").cast("long").alias("positives"))

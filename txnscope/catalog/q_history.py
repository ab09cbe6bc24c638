"""History-window queries."""

from pyspark.sql import functions as F

from txnscope.catalog.registry import query
from txnscope.operators import history as H
from txnscope.sources import txn_events, txn_orders

def history_raw_sql(view: str) -> str:
    """F1–F5 in SQL, unrounded (one window per client)."""
    return f"""
SELECT *, abs(z_amount) AS z_amount_abs FROM (
  SELECT *, CASE WHEN prior_sd > 0
                 THEN greatest(-10.0, least(10.0, (amount - prior_mean) / prior_sd))
                 ELSE 0.0 END AS z_amount
  FROM (
    SELECT txn_id, client_id, amount, ts,
           (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3600000000.0 AS gap_hours,
           CAST(row_number() OVER w - 1 AS BIGINT) AS prior_count,
           coalesce(avg(amount) OVER wp, amount) AS prior_mean,
           coalesce(stddev_samp(amount) OVER wp, 0.0) AS prior_sd
    FROM {view}
    WINDOW w AS (PARTITION BY client_id ORDER BY ts, txn_id),
           wp AS (PARTITION BY client_id ORDER BY ts, txn_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  )
)
"""


def history_sql(view: str) -> str:
    return f"""
SELECT txn_id, client_id, r6(gap_hours) AS gap_hours, prior_count, r6(prior_mean) AS prior_mean,
       r6(prior_sd) AS prior_sd, r6(z_amount) AS z_amount, r6(z_amount_abs) AS z_amount_abs
FROM ({history_raw_sql(view)})
"""


HISTORY_SQL = history_sql("txn_events")


@query("f1_f5_history_features", HISTORY_SQL)
def history_features(spark, sf_dir):
    """Gap, prior count, prior mean, prior sd, clipped z (events)."""
    h = H.history_features(txn_events(spark, sf_dir))
    return h.select("txn_id", "client_id", "gap_hours", "prior_count", "prior_mean",
                    "prior_sd", "z_amount", "z_amount_abs")


ORDERS_HISTORY_SQL = history_sql("txn_orders")


@query("f1_f5_history_orders_ties", ORDERS_HISTORY_SQL)
def history_orders(spark, sf_dir):
    """F1–F5 on orders: equal timestamps per client resolved by the tie column."""
    h = H.history_features(txn_orders(spark, sf_dir), chunk_hours=24 * 90)
    return h.select("txn_id", "client_id", "gap_hours", "prior_count", "prior_mean",
                    "prior_sd", "z_amount", "z_amount_abs")


FLAG_SQL = """
SELECT client_id, CAST(count(*) AS BIGINT) AS n_txn,
       CAST(sum(CASE WHEN z_amount_abs >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged,
       r6(max(z_amount_abs)) AS max_abs_z,
       r6(avg(gap_hours)) AS mean_gap_hours
FROM (""" + history_raw_sql("txn_events") + """) h GROUP BY client_id
"""


def flagged_clients(df):
    h = H.history_features(df)
    return h.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_txn"),
        F.sum(F.when(F.col("z_amount_abs") >= 3, 1).otherwise(0)).cast("long").alias("n_flagged"),
        F.max("z_amount_abs").alias("max_abs_z"),
        F.avg("gap_hours").alias("mean_gap_hours"),
    )


@query("f5_flagged_clients", FLAG_SQL)
def flagged(spark, sf_dir):
    """Flagship: history features, flag |z| >= 3, per-client summary."""
    return flagged_clients(txn_events(spark, sf_dir))


FILL_SQL = """
SELECT txn_id, client_id,
       coalesce(last_value(seg IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ts, txn_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                first_value(seg IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ts, txn_id
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS segment
FROM (SELECT txn_id, client_id, ts,
             CASE WHEN category = '5-LOW' THEN NULL ELSE segment END AS seg FROM txn_orders)
"""


@query("f6_fill_within_client", FILL_SQL)
def fill(spark, sf_dir):
    """forward/backward fill of a client attribute with injected nulls."""
    t = txn_orders(spark, sf_dir).withColumn(
        "segment", F.when(F.col("category") == "5-LOW", F.lit(None)).otherwise(F.col("segment")))
    return H.fill_within_key(t, ["segment"]).select("txn_id", "client_id", "segment")


GROUP_RATE_SQL = """
SELECT txn_id, category, r6(avg(y) OVER (PARTITION BY category)) AS y_avg,
       r6(avg(y) OVER ()) AS y_global
FROM txn_orders
"""


@query("f9_group_rate_to_rows", GROUP_RATE_SQL)
def group_rate(spark, sf_dir):
    """group and global label rate attached to each row (aggregate + join)."""
    t = txn_orders(spark, sf_dir).select("txn_id", "category", "y")
    t = H.group_value_to_rows(t, "y", ["category"], "y_avg")
    t = H.group_value_to_rows(t, "y", None, "y_global")
    return t.select("txn_id", "category", "y_avg", "y_global")

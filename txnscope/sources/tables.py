"""Driver tables and the adapter views that give them transaction roles.

``txn_events``   — one row per event: history windows, streaming, gaps.
``txn_orders``   — orders with customer segment and region: dimension joins,
                   rare label, monthly periods, date ties.
``scored_lines`` — line items with an integer score with heavy ties:
                   ranking metrics.

Each view exists twice: as a DataFrame builder (Spark) and as SQL text
(``*_SQL``) used in the DuckDB oracle queries.  Both produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("client_id"),
        "ts",
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").cast("int").alias("code"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
    )


TXN_EVENTS_SQL = """
SELECT event_id AS txn_id, user_id AS client_id, ts, value AS amount,
       event_type AS category, CAST(json_extract_string(props, '$.k') AS INT) AS code,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y
FROM events
"""


def txn_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    n = F.broadcast(load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("txn_id"),
            F.col("o_custkey").alias("client_id"),
            F.col("o_orderdate").alias("ts"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderpriority").alias("category"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_regionkey").alias("region"),
            F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), 1)
            .otherwise(0).alias("y"),
        )
    )


TXN_ORDERS_SQL = """
SELECT o_orderkey AS txn_id, o_custkey AS client_id, o_orderdate AS ts, o_totalprice AS amount,
       o_orderpriority AS category, c_mktsegment AS segment, n_regionkey AS region,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS y
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("client_id"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_extendedprice").alias("amount"),
            (F.round(F.col("l_discount") * 100).cast("int") * 9
             + F.round(F.col("l_tax") * 100).cast("int")).alias("score_i"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
            F.col("l_linestatus").alias("channel"),
            F.col("p_type").alias("category"),
        )
    )


SCORED_LINES_SQL = """
SELECT o_custkey AS client_id, l_shipdate AS ts, l_extendedprice AS amount,
       CAST(round(l_discount*100) AS INT)*9 + CAST(round(l_tax*100) AS INT) AS score_i,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       l_linestatus AS channel, p_type AS category
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


def with_views(sql: str) -> str:
    """Prefix an oracle query with the three adapter views as CTEs."""
    views = (f"txn_events AS ({TXN_EVENTS_SQL}), txn_orders AS ({TXN_ORDERS_SQL}), "
             f"scored_lines AS ({SCORED_LINES_SQL})")
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"

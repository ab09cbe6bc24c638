"""Order-dependent operators: sort, top-k, rank jump, chronological cut,
moving baseline (X1, X2, F7, F10, F11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.plans.frames import with_scalars
from txnscope.plans.prefix import global_row_number, micros


def sort_events(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Total order (key, ts, tie), nulls last (range-partitioned global sort)."""
    return df.orderBy(F.col(key).asc_nulls_last(), F.col(ts).asc_nulls_last(),
                      F.col(tie).asc_nulls_last())


def top_k(df: DataFrame, measure: str, k: int, tie: list[str]) -> DataFrame:
    """K rows with the largest measure (TakeOrdered: per-partition top-k, then merge)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc() for t in tie]).limit(k)


def average_rank(col: str, desc: bool = True):
    """Average rank among tied values (1-based) over a small table (one row per variable)."""
    o = F.col(col).desc() if desc else F.col(col).asc()
    w = Window.orderBy(o)
    ties = Window.partitionBy(col)
    return F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def rank_jump(table: DataFrame, name: str, score_a: str, score_b: str) -> DataFrame:
    """ranks of variables by two scores (average rank, truncated to int) and the jump.
    ``table`` has one row per variable (bounded), so a global window is fine."""
    x = table.withColumn("rank_a", average_rank(score_a).cast("int")) \
        .withColumn("rank_b", average_rank(score_b).cast("int"))
    return x.select(name, score_a, score_b, "rank_a", "rank_b",
                    (F.col("rank_a") - F.col("rank_b")).alias("rank_jump"))


def chronological_cut(df: DataFrame, ts: str, tie: str, share: float = 0.8,
                      tag: str = "part") -> DataFrame:
    """first floor(share·n) rows in (ts, tie) order → 'fit', the rest → 'validate'.
    The global row number comes from a distributed prefix count."""
    x = df.withColumn("_t", micros(ts).cast("double"))
    x = global_row_number(x, "_t", [tie], "_rn")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    x = with_scalars(x, n)
    return x.withColumn(tag, F.when(F.col("_rn") <= F.floor(F.col("_n") * share), F.lit("fit"))
                        .otherwise(F.lit("validate"))).drop("_t", "_rn", "_n")


def moving_baseline(timeline: DataFrame, period: str, value: str, lookback: int = 3) -> DataFrame:
    """for each period, the 'median' of the previous ``lookback`` periods with a
    value (upper middle element of the sorted list, T17).  The timeline has one row
    per period (bounded), so an ordered window over it is fine."""
    w = Window.orderBy(period).rowsBetween(-lookback, -1)
    prev = F.array_sort(F.filter(F.collect_list(value).over(w), lambda v: v.isNotNull()))
    return timeline.withColumn("_prev", prev).withColumn(
        "baseline", F.when(F.size("_prev") > 0,
                           F.element_at("_prev", (F.floor(F.size("_prev") / 2) + 1).cast("int")))
    ).drop("_prev")

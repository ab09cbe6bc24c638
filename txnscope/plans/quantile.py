"""Exact quantiles without holding a group in one task.

Spark's ``percentile`` aggregate keeps a map of every distinct value of a group
and merges the maps in one task per group: unbounded for a continuous column
that holds a third of a 100 TB table.  Here the same numbers come from:

1. distinct (group, value) counts (map-side combined; a hot value is one row);
2. the count of smaller values per group, by the distributed prefix sum
   (``plans.prefix``: value ranges in parallel, bounded per-range offsets);
3. one conditional aggregate that picks, for every requested probability, the
   values at positions ⌊p(n−1)⌋ and ⌈p(n−1)⌉ and interpolates linearly.

Same rule as Spark's ``percentile``, pandas' ``quantile`` and DuckDB's
``quantile_cont``: position h = p·(n−1), result
(⌈h⌉ − h)·x[⌊h⌋] + (h − ⌊h⌋)·x[⌈h⌉].  Nulls are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import with_scalars
from txnscope.plans.prefix import prefix_sum


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float], by: list[str] | None = None,
                    name: str = "_q", rows: str | None = None) -> DataFrame:
    """One row per group of ``by`` (exactly one row without ``by``, also for empty input)
    with ``name`` = array<double> of the exact quantiles at ``probs``, in that order.
    ``rows`` names a column with how many rows each row stands for."""
    by = list(by or [])
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, v.alias("_v"), (F.col(rows) if rows else F.lit(1).cast("long")).alias("_c")).where(F.col("_v").isNotNull())
    cnt = base.groupBy(*by, "_v").agg(F.sum("_c").alias("_c"))
    x = prefix_sum(cnt, "_v", ["_c"], by=by, inclusive=False, suffix="_before")
    n = cnt.groupBy(*by).agg(F.sum("_c").alias("_n"))
    x = x.join(n, by) if by else with_scalars(x, n)
    start, stop = F.col("_c_before"), F.col("_c_before") + F.col("_c")

    def pos(p, nn):
        return F.lit(float(p)) * (nn - 1)

    aggs = [F.max("_n").alias("_n")]
    for k, p in enumerate(probs):
        h = pos(p, F.col("_n"))
        for tag, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((start <= at) & (at < stop), F.col("_v"))).alias(f"_{tag}{k}"))
    g = x.groupBy(*by).agg(*aggs) if by else x.agg(*aggs)
    qs = []
    for k, p in enumerate(probs):
        h = pos(p, F.col("_n"))
        lo, hi = F.floor(h), F.ceil(h)
        qs.append(F.when(hi == lo, F.col(f"_lo{k}"))
                  .otherwise((hi - h) * F.col(f"_lo{k}") + (h - lo) * F.col(f"_hi{k}")))
    return g.select(*by, F.array(*qs).alias(name))


def exact_quantile_columns(df: DataFrame, cols: list[str], probs: list[float], name: str = "_q"
                           ) -> DataFrame:
    """Quantiles of several columns in one pass: (variable, ``name``) per column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"),
                                                  F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("_s")).select("_s.*")
    return exact_quantiles(long, "value", probs, by=["variable"], name=name)

"""Distributed prefix sums (running totals in a global order).

A window ordered over the whole table without ``partitionBy`` runs in one
task.  Instead:

1. the order column is cut into ``P`` ranges at approximate quantiles of its
   values (one aggregate; the cut points are a one-row table), or evenly where the
   order is a hash;
2. running sums are taken inside each range with a window partitioned by
   the range id (P parallel tasks);
3. the per-range totals (P rows, bounded by construction) get an exclusive
   running sum and are broadcast back as offsets.

The ranges are a deterministic function of the values, so the result does not
depend on partitioning or on task retries.  Callers collapse rows to distinct
order values first (``groupBy(score)``), which also removes skew: a value held
by a third of the rows is a single row after the collapse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.plans.frames import with_scalars

#: most ranges by cut points, since each row is compared with all of them
MAX_CUT_RANGES = 256


def _n_ranges(df: DataFrame, ranges: int | None) -> int:
    if ranges:
        return ranges
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def prefix_sum(df: DataFrame, order: str, sums: list[str], descending: bool = False,
               tie: list[str] | None = None, ranges: int | None = None,
               suffix: str = "_cum", inclusive: bool = True,
               by: list[str] | None = None, materialize_input: bool = False, hashed: bool = False) -> DataFrame:
    """Add ``<col><suffix>`` running sums of ``sums`` in the order of ``order``.

    ``order`` must be numeric (cast timestamps to micros first).  Rows with
    equal ``order`` are ordered by ``tie`` when given; with
    ``inclusive=True`` the current row is included.  ``by`` restarts the sums
    per group (cut points are shared by all groups).  ``materialize_input`` writes
    the input once to the checkpoint folder: worth it for collapsed (aggregated)
    inputs with an expensive upstream plan, not for row-level inputs read from files.
    ``hashed`` says that ``order`` is a 64-bit hash: its ranges are even by arithmetic, without a pass for cut points.
    """
    by = by or []
    if materialize_input:
        # the input feeds three branches (cut points, running sums, range totals); written
        # once, the upstream plan (joins, aggregations) is not recomputed per branch
        from txnscope.plans.frames import materialize
        df = materialize(df, "prefix-input")
    p = _n_ranges(df, ranges)
    if hashed:
        p = ranges or 4 * p  # several small ranges a task: even loads, and a window holds one at a time
        place = F.floor((F.col(order).cast("double") / 2.0 ** 64 + 0.5) * p)
        x = df.withColumn("_rng", F.least(place, F.lit(p - 1)).cast("int"))
    else:
        p = ranges or min(p, MAX_CUT_RANGES)
        probs = [i / p for i in range(1, p)]
        cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), probs, 10000).alias("_cuts"))
        x = with_scalars(df, cuts)
        x = x.withColumn("_rng", F.size(F.filter("_cuts", lambda c: c < F.col(order).cast("double"))))
        x = x.drop("_cuts")

    okey = F.col(order).desc() if descending else F.col(order).asc()
    tie_keys = [F.col(t).asc_nulls_last() for t in (tie or [])]
    w = Window.partitionBy(*by, "_rng").orderBy(okey, *tie_keys)
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for s in sums:
        x = x.withColumn(f"_run_{s}", F.coalesce(F.sum(s).over(frame), F.lit(0)))

    totals = x.groupBy(*by, "_rng").agg(*[F.sum(s).alias(f"_tot_{s}") for s in sums])
    rkey = F.col("_rng").desc() if descending else F.col("_rng").asc()
    # at most P rows per group: an ordered window over them is bounded
    wo = Window.partitionBy(*by).orderBy(rkey).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_rng", *[F.coalesce(F.sum(f"_tot_{s}").over(wo), F.lit(0))
                                           .alias(f"_off_{s}") for s in sums])
    if not by:
        offsets = F.broadcast(offsets)
    x = x.join(offsets, [*by, "_rng"], "left")
    for s in sums:
        x = x.withColumn(f"{s}{suffix}", F.col(f"_run_{s}") + F.col(f"_off_{s}"))
    return x.drop("_rng", *[f"_run_{s}" for s in sums], *[f"_off_{s}" for s in sums])


def global_row_number(df: DataFrame, order: str, tie: list[str], name: str = "rn",
                      ranges: int | None = None) -> DataFrame:
    """1-based row number in (order, tie) without a single-task window."""
    x = df.withColumn("_one", F.lit(1).cast("long"))
    x = prefix_sum(x, order, ["_one"], tie=tie, ranges=ranges)
    return x.withColumnRenamed("_one_cum", name).drop("_one")


def micros(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(col.cast("timestamp"))

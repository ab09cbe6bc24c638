"""Join operators.

Dimension and lookup tables derived from data are *not* broadcast by hint:
AQE converts the join to a broadcast join at runtime when the shuffled side
turns out small (its size is measured, not assumed), and keeps a shuffle join
otherwise.  Only tables whose size is bounded by construction (calendars,
parameter tables, one-row aggregates) are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.plans.carry import carry_both
from txnscope.plans.frames import with_scalars


def dim_join(t: DataFrame, dim: DataFrame, t_key: str, dim_key: str, cols: dict[str, str],
             default=None, bounded: bool = False) -> DataFrame:
    """Left join to a dimension; unmatched rows get ``default``.

    ``cols`` maps dimension column → output name.  ``bounded=True`` marks a
    dimension of fixed size (broadcast hint).
    """
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(k).alias(v) for k, v in cols.items()])
    if bounded:
        d = F.broadcast(d)
    j = t.join(d, t[t_key] == d["_dk"], "left").drop("_dk")
    if default is not None:
        j = j.fillna({v: default for v in cols.values()})
    return j


def lookup(t: DataFrame, table: DataFrame, key: str, value: str, default_col=None,
           name: str | None = None) -> DataFrame:
    """D3: map a per-key aggregate back to rows; unseen keys get ``default_col``."""
    name = name or value
    j = t.join(table.select(key, F.col(value).alias("_lv")), key, "left")
    fill = default_col if default_col is not None else F.lit(None)
    return j.withColumn(name, F.coalesce(F.col("_lv"), fill)).drop("_lv")


def semi(t: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """D4."""
    return t.join(keys.select(*on).distinct(), on, "left_semi")


def entity_overlap(train: DataFrame, test: DataFrame, key: str, label: str = "y") -> DataFrame:
    """Share of test entities seen in train, and seen with a positive in train."""
    tr = train.groupBy(key).agg(F.max(label).alias("_tr_pos"))
    te = test.select(key).distinct()
    j = te.join(tr, key, "left")
    return j.agg(
        F.count(F.lit(1)).alias("test_entities"),
        F.sum(F.when(F.col("_tr_pos").isNotNull(), 1).otherwise(0)).cast("long").alias("seen_in_train"),
        F.sum(F.when(F.col("_tr_pos") == 1, 1).otherwise(0)).cast("long")
        .alias("with_positive_in_train"),
    ).select("*", (F.col("seen_in_train") / F.col("test_entities")).alias("share_seen"),
             (F.col("with_positive_in_train") / F.col("test_entities")).alias("share_with_positive"))


def nearest_in_time(a: DataFrame, b: DataFrame, key: str, date: str,
                    a_id: str, chunk_days: int = 30) -> DataFrame:
    """For each row of ``a``, the smallest |days| to a row of ``b`` with the same key
    (null when the key has no ``b`` row).  As-of in both directions, with the dates of ``b``
    carried over chunks of ``chunk_days``: no per-key cross product, and a hot key is
    spread over as many tasks as it has chunks."""
    u = (a.select(key, F.col(date).cast("date").alias("_d"), F.col(a_id).alias("_id"))
         .withColumn("_bd", F.lit(None).cast("date"))
         .unionByName(b.select(key, F.col(date).cast("date").alias("_d"))
                      .withColumn("_id", F.lit(None).cast(dict(a.dtypes)[a_id]))
                      .withColumn("_bd", F.col("_d"))))
    # a ``b`` row of the same day lies on one side or the other; both distances are then 0 for one of them
    x = carry_both(u, key, ["_d", "_id"], F.floor(F.unix_date("_d") / F.lit(chunk_days)), ["_bd"]).where(F.col("_id").isNotNull())
    dist = F.least(F.datediff("_d", "_back_0"), F.datediff("_ahead_0", "_d"))
    return x.select(F.col("_id").alias(a_id), key, dist.alias("days_to_nearest"))


def range_join(timeline: DataFrame, calendar: DataFrame, period: str, lo: str,
               hi: str) -> DataFrame:
    """Periods × calendar entries active in them (``lo <= period <= hi``).
    The calendar is a declared parameter table (bounded) and is broadcast."""
    return timeline.join(F.broadcast(calendar),
                         (F.col(period) >= F.col(lo)) & (F.col(period) <= F.col(hi)), "inner")


def quiet_periods(timeline: DataFrame, calendar: DataFrame, period: str, lo: str,
                  hi: str) -> DataFrame:
    """Periods with no active calendar entry."""
    return timeline.join(F.broadcast(calendar),
                         (F.col(period) >= F.col(lo)) & (F.col(period) <= F.col(hi)), "left_anti")


def labels_available(t: DataFrame, period: str, now_period: str, lag_months: int) -> DataFrame:
    """Keep rows whose label has arrived: period <= now − lag months ('yyyy-MM')."""
    cut = F.date_format(F.add_months(F.to_date(F.lit(now_period + "-01")), -lag_months), "yyyy-MM")
    return t.where(F.col(period) <= cut)


def labels_available_latest(t: DataFrame, period: str, lag_months: int) -> DataFrame:
    """D8 with 'now' = the latest period present in the data."""
    latest = t.agg(F.max(period).alias("_now"))
    x = with_scalars(t, latest)
    cut = F.date_format(F.add_months(F.to_date(F.concat(F.col("_now"), F.lit("-01"))),
                                     -lag_months), "yyyy-MM")
    return x.where(F.col(period) <= cut).drop("_now")

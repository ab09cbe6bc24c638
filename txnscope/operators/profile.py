"""Descriptive aggregations.

Wide statistics are computed as one wide aggregate and turned long with
``unpivot`` afterwards (no row explosion); only quantile/bin work that needs
per-value state is done per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import with_scalars
from txnscope.plans.quantile import exact_quantile_columns, exact_quantiles


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """(value, n, share); share over non-null rows, or all rows when dropna=False."""
    x = df.where(F.col(col).isNotNull()) if dropna else df
    g = x.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    tot = x.agg(F.count(F.lit(1)).alias("_tot"))
    return with_scalars(g, tot).select("value", "n", (F.col("n") / F.col("_tot")).alias("share"))


def mode_share(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value (smallest among ties) and its share."""
    return _mode_of(value_counts(df, col))


def _mode_of(vc: DataFrame) -> DataFrame:
    best = vc.agg(F.max("n").alias("_mx"))
    x = with_scalars(vc, best).where(F.col("n") == F.col("_mx"))
    return x.agg(F.min("value").alias("mode"), F.max("share").alias("mode_share"))


def _skew_adj(n: Column, g1: Column) -> Column:
    """Bias-adjusted sample skewness from the population value."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _kurt_adj(n: Column, g2: Column) -> Column:
    """Bias-adjusted sample excess kurtosis from the population value."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: n, mean, median, sd, var, min, max, Q1, Q3, skewness, kurtosis."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__sd"), F.var_samp(x).alias(f"{c}__var"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.skewness(x).alias(f"{c}__g1"), F.kurtosis(x).alias(f"{c}__g2")]
    row = df.agg(*aggs)
    rows = []
    for c in cols:
        n = F.col(f"{c}__n")
        rows.append(F.struct(
            F.lit(c).alias("variable"), n.alias("n"), F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__sd").alias("sd"),
            F.col(f"{c}__var").alias("var"), F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
            _skew_adj(n, F.col(f"{c}__g1")).alias("skewness"),
            _kurt_adj(n, F.col(f"{c}__g2")).alias("kurtosis")))
    moments = row.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    # quartiles of all columns in one distributed exact pass (one row per column, bounded)
    q = exact_quantile_columns(df, cols, [0.25, 0.5, 0.75])
    return moments.join(F.broadcast(q), "variable", "left").select(
        "variable", "n", "mean", F.col("_q")[1].alias("median"), "sd", "var", "min", "max",
        F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"), "skewness", "kurtosis")


def describe_by(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Count, mean, std, min, quartiles, max of ``col`` per group."""
    x = F.col(col).cast("double")
    g = df.groupBy(*by).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by=by)
    return g.join(q, by, "left").select(
        *by, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
        F.col("_q")[2].alias("q75"), "max")


def percentiles(df: DataFrame, col: str, ps: list[float], exact: bool = True,
                accuracy: int = 10000) -> DataFrame:
    """(p, value); exact linear interpolation, or approximate for huge inputs."""
    x = F.col(col).cast("double")
    row = exact_quantiles(df, col, ps, name="_v") if exact else \
        df.agg(F.percentile_approx(x, ps, accuracy).alias("_v"))
    return row.select(F.posexplode("_v").alias("_i", "value")).select(
        F.element_at(F.array(*[F.lit(float(p)) for p in ps]), F.col("_i") + 1).alias("p"),
        "value")


def label_rate(df: DataFrame, keys: list[str], label: str = "y", min_n: int | None = None,
               top_k: int | None = None, drop_null_keys: bool = True) -> DataFrame:
    """Rows, positives, rate per key; optional minimum support and top-k by rate."""
    x = df
    if drop_null_keys:
        for k in keys:
            x = x.where(F.col(k).isNotNull())
    g = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                             F.sum(label).cast("long").alias("positives"),
                             F.avg(label).alias("rate"))
    if min_n is not None:
        g = g.where(F.col("n") >= min_n)
    if top_k is not None:
        g = g.orderBy(F.desc("rate"), F.desc("n"), *[F.asc(k) for k in keys]).limit(top_k)
    return g


def group_spend(df: DataFrame, key: str, amount: str, top_k: int | None = None) -> DataFrame:
    """Per group: count, total and mean spend; top-k by count."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total_amount"),
                            F.avg(amount).alias("mean_amount"))
    if top_k:
        g = g.orderBy(F.desc("n"), F.asc(key)).limit(top_k)
    return g


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """E8/E9 in long form: (a, b, n, row_share)."""
    g = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = df.groupBy(a).agg(F.count(F.lit(1)).alias("_row_n"))
    return g.join(rows, a).select(a, b, "n", (F.col("n") / F.col("_row_n")).alias("row_share"))


def crosstab(df: DataFrame, a: str, b: str, values: list, normalize: bool = False) -> DataFrame:
    """E8/E9 as a matrix (one column per listed value of ``b``); missing cells 0."""
    p = df.groupBy(a).pivot(b, values).agg(F.count(F.lit(1))).fillna(0)
    if not normalize:
        return p
    names = [str(v) for v in values]
    tot = sum((F.col(f"`{c}`") for c in names), F.lit(0))
    return p.select(a, *[(F.col(f"`{c}`") / tot).alias(c) for c in names])


def uplift(rate_a: Column, rate_b: Column) -> Column:
    """Relative uplift of rate a over rate b, in %."""
    return F.when(rate_b > 0, (rate_a / rate_b - 1) * 100)


def distinct_per_group(df: DataFrame, a: str, b: str) -> DataFrame:
    """Number of distinct ``b`` per ``a`` and the distribution of that number."""
    g = df.groupBy(a).agg(F.count_distinct(b).alias("n_distinct"))
    s = g.agg(F.count(F.lit(1)).alias("groups"), F.avg("n_distinct").alias("mean"),
              F.stddev_samp("n_distinct").alias("std"), F.min("n_distinct").alias("min"),
              F.max("n_distinct").alias("max"))
    med = exact_quantiles(g, "n_distinct", [0.5]).select(F.col("_q")[0].alias("median"))
    return with_scalars(s, med).select("groups", "mean", "std", "min", "median", "max")


def month_spine(df: DataFrame, ts: str) -> DataFrame:
    """All months between the first and last event ('yyyy-MM'); size bounded by the range."""
    r = df.agg(F.date_trunc("month", F.min(ts)).cast("date").alias("_a"),
               F.date_trunc("month", F.max(ts)).cast("date").alias("_b"))
    return r.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("_m")) \
        .select(F.date_format("_m", "yyyy-MM").alias("period"))


def monthly_summary(df: DataFrame, ts: str = "ts", key: str = "client_id",
                    label: str = "y") -> DataFrame:
    """Per month: rows, positives, active and affected clients, rate, positives per
    affected client; months without rows are present with zeros."""
    x = df.withColumn("period", F.date_format(ts, "yyyy-MM"))
    g = x.groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).cast("long").alias("positives"),
        F.count_distinct(key).alias("active_clients"),
        F.count_distinct(F.when(F.col(label) == 1, F.col(key))).alias("affected_clients"))
    s = month_spine(df, ts).join(g, "period", "left").fillna(
        0, ["rows", "positives", "active_clients", "affected_clients"])
    return s.select(
        "period", "rows", "positives", "active_clients", "affected_clients",
        F.when(F.col("rows") > 0, F.col("positives") / F.col("rows")).alias("rate"),
        F.when(F.col("affected_clients") > 0, F.col("positives") / F.col("affected_clients"))
        .alias("positives_per_affected"))


def first_period_histogram(df: DataFrame, key: str, ts: str, label: str | None = None) -> DataFrame:
    """Period of each entity's first (positive) event → entities per period."""
    x = df.where(F.col(label) == 1) if label else df
    first = x.groupBy(key).agg(F.date_format(F.min(ts), "yyyy-MM").alias("period"))
    return first.groupBy("period").agg(F.count(F.lit(1)).alias("entities"))


def period_overlap(df: DataFrame, key: str, ts: str, cut: str) -> DataFrame:
    """Entities only before ``cut``, only after, in both."""
    g = df.groupBy(key).agg(F.max((F.col(ts) < F.lit(cut).cast("timestamp_ntz")).cast("int")).alias("_e"),
                            F.max((F.col(ts) >= F.lit(cut).cast("timestamp_ntz")).cast("int")).alias("_l"))
    return g.agg(
        F.sum(F.when((F.col("_e") == 1) & (F.col("_l") == 0), 1).otherwise(0)).cast("long").alias("only_early"),
        F.sum(F.when((F.col("_e") == 0) & (F.col("_l") == 1), 1).otherwise(0)).cast("long").alias("only_late"),
        F.sum(F.when((F.col("_e") == 1) & (F.col("_l") == 1), 1).otherwise(0)).cast("long").alias("both"))


def episodes(df: DataFrame, key: str, ts: str, label: str = "y", within_days: int = 30) -> DataFrame:
    """Positives per affected client, share of clients affected, episode span in
    days, share of affected clients whose positives all fall within ``within_days``."""
    g = df.groupBy(key).agg(
        F.sum(label).alias("_pos"),
        F.datediff(F.max(F.when(F.col(label) == 1, F.col(ts))).cast("date"),
                   F.min(F.when(F.col(label) == 1, F.col(ts))).cast("date")).alias("_span"))
    aff = F.col("_pos") > 0
    return g.agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum(aff.cast("int")).cast("long").alias("affected_clients"),
        (F.sum(aff.cast("int")) / F.count(F.lit(1))).alias("share_affected"),
        F.avg(F.when(aff, F.col("_pos"))).alias("positives_per_affected"),
        F.avg(F.when(aff, F.col("_span"))).alias("mean_span_days"),
        F.max(F.when(aff, F.col("_span"))).alias("max_span_days"),
        F.avg(F.when(aff, (F.col("_span") <= within_days).cast("int"))).alias("share_within_days"))


def stratum_compare(df: DataFrame, stratum: str, period_flag: Column, label: str = "y") -> DataFrame:
    """Label rate per stratum in two periods (flag 0/1) and their ratio."""
    g = df.groupBy(stratum).agg(
        F.avg(F.when(period_flag == 0, F.col(label))).alias("rate_a"),
        F.avg(F.when(period_flag == 1, F.col(label))).alias("rate_b"),
        F.sum(F.when(period_flag == 0, 1).otherwise(0)).cast("long").alias("n_a"),
        F.sum(F.when(period_flag == 1, 1).otherwise(0)).cast("long").alias("n_b"))
    return g.withColumn("ratio", F.when(F.col("rate_a") > 0, F.col("rate_b") / F.col("rate_a")))


def standardized_mean_difference(df: DataFrame, cols: list[str], label: str = "y") -> DataFrame:
    """(mean | y=1 − mean | y=0) / sd (sample sd over all rows), one pass, ranked."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(F.when(F.col(label) == 0, x)).alias(f"{c}__m0"),
                 F.avg(F.when(F.col(label) == 1, x)).alias(f"{c}__m1"),
                 F.stddev_samp(x).alias(f"{c}__sd")]
    row = df.agg(*aggs)
    s = row.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("variable"), F.col(f"{c}__m0").alias("mean_neg"),
        F.col(f"{c}__m1").alias("mean_pos"),
        ((F.col(f"{c}__m1") - F.col(f"{c}__m0")) / F.col(f"{c}__sd")).alias("smd"))
        for c in cols])).alias("s")).select("s.*")
    return s.withColumn("abs_smd", F.abs("smd"))


def money_summary(df: DataFrame, currency: str, amount: str, label: str = "y",
                  pred: str = "p") -> DataFrame:
    """Per currency (never summed across currencies): totals, detected, missed,
    false-alarm amounts, counts and means."""
    y, p, a = F.col(label), F.col(pred), F.col(amount)
    z = F.lit(0.0)
    return df.groupBy(currency).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(a).alias("total_amount"),
        F.sum(F.when(y == 1, a).otherwise(z)).alias("positive_amount"),
        F.sum(F.when((y == 1) & (p == 1), a).otherwise(z)).alias("detected_amount"),
        F.sum(F.when((y == 1) & (p == 0), a).otherwise(z)).alias("missed_amount"),
        F.sum(F.when((y == 0) & (p == 1), a).otherwise(z)).alias("false_alarm_amount"),
        F.sum(y).cast("long").alias("positives"),
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("detected"),
        F.avg(F.when(y == 1, a)).alias("mean_positive_amount"),
        F.avg(F.when(y == 0, a)).alias("mean_negative_amount"))


def client_date_ranges(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Global date range, days covered, and per-client activity ratios."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                              F.count_distinct(F.col(ts).cast("date")).alias("_days"))
    glob = df.agg(F.min(ts).cast("date").alias("first_day"), F.max(ts).cast("date").alias("last_day"),
                  F.count_distinct(F.col(ts).cast("date")).alias("days_with_rows"),
                  F.count(F.lit(1)).alias("rows"))
    c = per.agg(F.count(F.lit(1)).alias("clients"), F.avg("_n").alias("rows_per_client"),
                F.avg("_days").alias("active_days_per_client"))
    g = with_scalars(glob, c)
    return g.select(F.date_format("first_day", "yyyy-MM-dd").alias("first_day"),
                    F.date_format("last_day", "yyyy-MM-dd").alias("last_day"),
                    (F.datediff("last_day", "first_day") + 1).alias("span_days"),
                    "days_with_rows", "rows", "clients", "rows_per_client",
                    "active_days_per_client")


def overlapping_segments(df: DataFrame, masks: dict[str, Column], label: str = "y") -> DataFrame:
    """Rate of overlapping segments (a row may be in several) and shares of
    rows and of positives; one pass."""
    names = list(masks)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_p")]
    for i, k in enumerate(names):
        aggs += [F.sum(F.when(masks[k], 1).otherwise(0)).alias(f"n{i}"),
                 F.sum(F.when(masks[k], F.col(label)).otherwise(0)).alias(f"p{i}")]
    row = df.agg(*aggs)
    s = row.select("_n", "_p", F.explode(F.array(*[F.struct(
        F.lit(k).alias("segment"), F.col(f"n{i}").alias("rows"), F.col(f"p{i}").alias("positives"))
        for i, k in enumerate(names)])).alias("s")).select("_n", "_p", "s.*")
    return s.select("segment", F.col("rows").cast("long").alias("rows"),
                    F.col("positives").cast("long").alias("positives"),
                    F.when(F.col("rows") > 0, F.col("positives") / F.col("rows")).alias("rate"),
                    (F.col("rows") / F.col("_n")).alias("share_rows"),
                    F.when(F.col("_p") > 0, F.col("positives") / F.col("_p")).alias("share_positives"))


def histogram(df: DataFrame, col: str, edges: list[float], labels: list[str],
              null_label: str = "null") -> DataFrame:
    """Counts over [e_i, e_{i+1}) bins (last bin closed) plus a bucket for nulls;
    values outside the edges are not counted.  Shares are over all rows."""
    x = F.col(col)
    inner = [float(e) for e in edges]
    b = None
    for i in range(len(inner) - 1):
        last = i == len(inner) - 2
        cond = (x >= inner[i]) & ((x <= inner[i + 1]) if last else (x < inner[i + 1]))
        b = F.when(cond, F.lit(labels[i])) if b is None else b.when(cond, F.lit(labels[i]))
    b = F.when(x.isNull(), F.lit(null_label)).otherwise(b)
    g = df.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("bucket").isNotNull())
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    return with_scalars(g, tot).select("bucket", "n", (F.col("n") / F.col("_t")).alias("share"))

"""Per-client history features over event time.

All features look only at *earlier* rows of the same client (the current row
is excluded), in order ``(ts, tie)``.

Skew: a single client may hold a large share of all rows.  A plain
``Window.partitionBy(client)`` would put that client in one task.  Instead,
rows are cut into chunks ``(client, time bucket)``:

1. inside a chunk, running statistics come from a window partitioned by
   ``(client, chunk)`` — a hot client is spread over as many tasks as it has
   buckets;
2. per chunk, ``(n, mean, m2, last ts)`` are aggregated (map-side partial
   aggregation) into a small table of clients × buckets;
3. an exclusive running merge over the chunk table gives the statistics of
   all earlier chunks, joined back on ``(client, chunk)``;
4. the two parts are merged with the parallel (Chan) update of
   count / mean / sum of squared deviations.

The result is exact (same numbers as one expanding window) for any chunk
size; the chunk size only changes parallelism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.plans.carry import LAST_CHUNK, carry_both, join_offsets, rank_of

MICROS_PER_HOUR = 3_600_000_000.0

# fixed value: z-scores are clipped to +/- this bound
Z_LIMIT = 10.0


def _micros(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def _chan_merge(n_a, mean_a, m2_a, n_b, mean_b, m2_b):
    """Parallel merge of two (count, mean, M2) summaries (either may be empty)."""
    n = n_a + n_b
    delta = mean_b - mean_a
    mean = F.when(n_a == 0, mean_b).when(n_b == 0, mean_a).otherwise(mean_a + delta * n_b / n)
    m2 = F.when(n_a == 0, m2_b).when(n_b == 0, m2_a).otherwise(
        m2_a + m2_b + delta * delta * n_a * n_b / n)
    return n, mean, m2


def history_features(df: DataFrame, key: str = "client_id", ts: str = "ts",
                     tie: str = "txn_id", amount: str = "amount",
                     chunk_hours: float = 24.0, z_limit: float = Z_LIMIT) -> DataFrame:
    """Add F1–F5 columns.

    * ``gap_hours``    — hours since the client's previous row (null for first)
    * ``prior_count``  — number of earlier rows of the client
    * ``prior_mean``   — mean amount of earlier rows; own amount for the first
    * ``prior_sd``     — sample sd of earlier rows; 0 when fewer than two
    * ``z_amount``     — (amount - prior_mean)/prior_sd clipped to ±z_limit, 0 when sd = 0
    * ``z_amount_abs`` — its absolute value
    """
    width = int(chunk_hours * MICROS_PER_HOUR)
    base = df.withColumn("_chunk", F.floor(_micros(ts) / F.lit(width)))

    # (1) running statistics inside each chunk
    w_in = Window.partitionBy(key, "_chunk").orderBy(F.col(ts).asc_nulls_last(),
                                                     F.col(tie).asc_nulls_last())
    prior = w_in.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        base
        .withColumn("_n_b", (F.row_number().over(w_in) - 1).cast("long"))
        .withColumn("_mean_b", F.coalesce(F.avg(amount).over(prior), F.lit(0.0)))
        .withColumn("_m2_b", F.coalesce(F.var_samp(amount).over(prior) * (F.col("_n_b") - 1),
                                        F.lit(0.0)))
        .withColumn("_lag_b", F.lag(ts).over(w_in))
    )

    # (2) one summary row per (client, chunk)
    chunks = base.groupBy(key, "_chunk").agg(
        F.count(F.lit(1)).alias("_n_c"),
        F.avg(amount).alias("_mean_c"),
        F.coalesce(F.var_samp(amount) * (F.count(F.lit(1)) - 1), F.lit(0.0)).alias("_m2_c"),
        F.max(ts).alias("_last_c"),
    )

    # (3) exclusive merge over earlier chunks; values are centred on the first
    # chunk mean of the client to keep the sum of squares well conditioned.
    wc = Window.partitionBy(key).orderBy("_chunk")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    shift = F.first("_mean_c").over(wc.rowsBetween(Window.unboundedPreceding,
                                                   Window.unboundedFollowing))
    chunks = chunks.withColumn("_k", shift).withColumn("_d", F.col("_mean_c") - F.col("_k"))
    n_a = F.coalesce(F.sum("_n_c").over(before), F.lit(0)).cast("long")
    s1 = F.coalesce(F.sum(F.col("_n_c") * F.col("_d")).over(before), F.lit(0.0))
    s2 = F.coalesce(F.sum(F.col("_n_c") * F.col("_d") * F.col("_d")).over(before), F.lit(0.0))
    m2w = F.coalesce(F.sum("_m2_c").over(before), F.lit(0.0))
    offsets = (
        chunks
        .withColumn("_n_a", n_a)
        .withColumn("_s1", s1).withColumn("_s2", s2).withColumn("_m2w", m2w)
        .withColumn("_last_a", F.max("_last_c").over(before))
        .select(
            key, "_chunk", "_n_a", "_last_a",
            F.when(F.col("_n_a") > 0, F.col("_k") + F.col("_s1") / F.col("_n_a"))
            .otherwise(F.lit(0.0)).alias("_mean_a"),
            F.when(F.col("_n_a") > 0,
                   F.col("_m2w") + F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("_n_a"))
            .otherwise(F.lit(0.0)).alias("_m2_a"),
        )
    )

    # (4) merge and derive the features
    j = rows.join(offsets, [key, "_chunk"], "left")
    n, mean, m2 = _chan_merge(F.col("_n_a"), F.col("_mean_a"), F.col("_m2_a"),
                              F.col("_n_b"), F.col("_mean_b"), F.col("_m2_b"))
    j = j.withColumn("prior_count", n.cast("long")).withColumn("_mean", mean).withColumn("_m2", m2)
    prev_ts = F.coalesce(F.col("_lag_b"), F.col("_last_a"))
    sd = F.when(F.col("prior_count") > 1,
                F.sqrt(F.greatest(F.col("_m2"), F.lit(0.0)) / (F.col("prior_count") - 1))
                ).otherwise(F.lit(0.0))
    out = (
        j.withColumn("gap_hours", (_micros(ts) - _micros(prev_ts)) / F.lit(MICROS_PER_HOUR))
        .withColumn("prior_mean", F.when(F.col("prior_count") > 0, F.col("_mean"))
                    .otherwise(F.col(amount)))
        .withColumn("prior_sd", sd)
        .withColumn("z_amount", clipped_z(F.col(amount), F.col("prior_mean"), F.col("prior_sd"),
                                          z_limit))
        .withColumn("z_amount_abs", F.abs(F.col("z_amount")))
    )
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def clipped_z(x: Column, mean: Column, sd: Column, limit: float = Z_LIMIT) -> Column:
    """signed z clipped to ±limit; 0 when sd is not positive."""
    return F.when(sd > 0, F.greatest(F.lit(-limit), F.least(F.lit(limit), (x - mean) / sd))) \
        .otherwise(F.lit(0.0))


def history_features_single_window(df: DataFrame, key: str = "client_id", ts: str = "ts",
                                   tie: str = "txn_id", amount: str = "amount",
                                   z_limit: float = Z_LIMIT) -> DataFrame:
    """Same result with one window per client (reference plan for tests)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last(), F.col(tie).asc_nulls_last())
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    out = (
        df.withColumn("gap_hours", (_micros(ts) - _micros(F.lag(ts).over(w))) / MICROS_PER_HOUR)
        .withColumn("prior_count", (F.row_number().over(w) - 1).cast("long"))
        .withColumn("prior_mean", F.coalesce(F.avg(amount).over(prior), F.col(amount)))
        .withColumn("prior_sd", F.coalesce(F.stddev_samp(amount).over(prior), F.lit(0.0)))
    )
    out = out.withColumn("z_amount", clipped_z(F.col(amount), F.col("prior_mean"),
                                               F.col("prior_sd"), z_limit))
    return out.withColumn("z_amount_abs", F.abs(F.col("z_amount")))


def fill_within_key(df: DataFrame, cols: list[str], key: str = "client_id", ts: str = "ts",
                    tie: str = "txn_id", chunk_hours: float = 720.0) -> DataFrame:
    """forward fill then backward fill attributes inside each key, in event order.

    Values are carried over chunks of ``chunk_hours``, so a hot key is spread over as many tasks as it has chunks;
    the width changes only that.  Rows that share one timestamp stay in one chunk."""
    x = carry_both(df, key, [ts, tie], F.floor(_micros(ts) / F.lit(int(chunk_hours * MICROS_PER_HOUR))), cols)
    filled = {c: F.coalesce(f"_back_{i}", f"_ahead_{i}") for i, c in enumerate(cols)}
    return x.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def group_value_to_rows(df: DataFrame, value: str, by: list[str] | None = None,
                        name: str | None = None) -> DataFrame:
    """a group (or global) average attached to every row.

    Computed as an aggregate joined back (partial aggregation, no row-level
    window over a single partition).  The aggregate has one row per group.
    """
    name = name or f"{value}_avg"
    if not by:
        agg = df.agg(F.avg(value).alias(name)).withColumn("_one", F.lit(1))
        # one-row aggregate: broadcast is bounded by construction
        return df.withColumn("_one", F.lit(1)).join(F.broadcast(agg), "_one").drop("_one")
    agg = df.groupBy(*by).agg(F.avg(value).alias(name))
    return df.join(agg, by, "left")


def _chunked(df: DataFrame, ts: str, tie: str, chunk_hours: float) -> DataFrame:
    width = int(chunk_hours * MICROS_PER_HOUR)
    return df.withColumn("_chunk", F.coalesce(F.floor(_micros(ts) / F.lit(width)).cast("long"), F.lit(LAST_CHUNK))) \
        .withColumn("_rank", rank_of([ts, tie]))


def expanding_mode(df: DataFrame, value: str, name: str, key: str = "client_id",
                   ts: str = "ts", tie: str = "txn_id", chunk_hours: float = 24.0) -> DataFrame:
    """most frequent ``value`` among the client's earlier rows (smallest value on
    ties; null for the first row and where all earlier values are null).  ``value`` is an integer code.

    Counts only grow, so the mode of a prefix is the value of the greatest (count, -value) seen so far.  Counts by
    value are mergeable: each chunk's counts get an exclusive prefix over the client's earlier chunks, and the best
    pair of those chunks is carried in.  No window spans a client's rows; only (client, chunk, value) counts meet."""
    base = _chunked(df, ts, tie, chunk_hours)
    by = [key, "_chunk"]

    def pair(count):
        return F.when(F.col(value).isNotNull(), F.struct(count.alias("n"), (-F.col(value)).alias("v")))

    counts = base.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(key, value).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("_end", F.sum("_n").over(upto)).withColumn("_pair", pair(F.col("_end")))
    best = counts.groupBy(*by).agg(F.max("_pair").alias("_pair"))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    best = best.select(*by, F.max("_pair").over(earlier).alias("_before"))
    offsets = join_offsets(counts.select(*by, value, (F.col("_end") - F.col("_n")).alias("_prior")), best, by)

    x = join_offsets(base, offsets, [*by, value])
    seen = Window.partitionBy(*by, value).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_here", pair(F.col("_prior") + F.count(F.lit(1)).over(seen)))
    inside = Window.partitionBy(*by).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_best", F.greatest(F.max("_here").over(inside), F.col("_before")))
    return x.select(*df.columns, (-F.col("_best.v")).alias(name))


def prior_moments(df: DataFrame, values: dict[str, str], key: str = "client_id", ts: str = "ts",
                  tie: str = "txn_id", chunk_hours: float = 24.0) -> DataFrame:
    """Add ``<name>_n``, ``<name>_mean``, ``<name>_m2`` for each name -> column of ``values``: count, mean and sum of squared
    deviations of the column's non-null values in the key's earlier rows, merged over chunks (mean and m2 are 0 where n is 0)."""
    base = _chunked(df, ts, tie, chunk_hours)
    by = [key, "_chunk"]
    inside = Window.partitionBy(*by).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    cols = list(values.items())

    def moments(c, over=lambda e: e):
        n = over(F.count(c))
        return n, F.coalesce(over(F.avg(c)), F.lit(0.0)), F.coalesce(over(F.var_pop(c)) * n, F.lit(0.0))

    rows, chunks = [], []
    for i, (_, c) in enumerate(cols):
        for part, e in zip("nms", moments(F.col(c).cast("double"), lambda e: e.over(inside))):
            rows.append(e.alias(f"_{part}b{i}"))
        for part, e in zip("nms", moments(F.col(c).cast("double"))):
            chunks.append(e.alias(f"_{part}c{i}"))
    summary = base.groupBy(*by).agg(*chunks)
    whole = Window.partitionBy(key).orderBy("_chunk")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.col(c) for c in by]
    for i in range(len(cols)):
        # sums of squares are centred on the key's first chunk that has a value
        centre = F.first(F.when(F.col(f"_nc{i}") > 0, F.col(f"_mc{i}")), True).over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        summary = summary.withColumn(f"_k{i}", F.coalesce(centre, F.lit(0.0)))
        n, d = F.col(f"_nc{i}"), F.col(f"_mc{i}") - F.col(f"_k{i}")
        na, s1, s2, sw = (F.coalesce(F.sum(e).over(before), F.lit(0)) for e in (n, n * d, n * d * d, F.col(f"_sc{i}")))
        offsets += [na.alias(f"_na{i}"), F.when(na > 0, F.col(f"_k{i}") + s1 / na).otherwise(0.0).alias(f"_ma{i}"),
                    F.when(na > 0, F.greatest(sw + s2 - s1 * s1 / na, F.lit(0.0))).otherwise(0.0).alias(f"_sa{i}")]
    x = join_offsets(base.select("*", *rows), summary.select(*offsets), by)
    out = [F.col(c) for c in df.columns]
    for i, (name, _) in enumerate(cols):
        merged = _chan_merge(*[F.col(f"_{part}{side}{i}") for side in "ab" for part in "nms"])
        out += [e.alias(f"{name}_{part}") for part, e in zip(("n", "mean", "m2"), merged)]
    return x.select(*out)


def client_profile_features(df: DataFrame, key: str = "client_id", ts: str = "ts",
                            tie: str = "txn_id", amount: str = "amount",
                            flag: str | None = None) -> DataFrame:
    """running mean spend, coefficient of variation (sd / mean of earlier rows),
    running share of a flag (e.g. card-not-present), favourite hour and weekday."""
    values = {"_amount": amount, **({"_flag": flag} if flag else {})}
    x = prior_moments(df, values, key, ts, tie)
    n, mean = F.col("_amount_n"), F.when(F.col("_amount_n") > 0, F.col("_amount_mean"))
    x = x.withColumn("running_mean", mean).withColumn("running_cv", F.when(n > 1, F.sqrt(F.col("_amount_m2") / (n - 1)) / F.col("running_mean")))
    if flag:
        x = x.withColumn("running_flag_share", F.when(F.col("_flag_n") > 0, F.col("_flag_mean")))
    x = x.drop(*[f"{v}_{part}" for v in values for part in ("n", "mean", "m2")])
    x = x.withColumn("_hour", F.hour(ts)).withColumn("_wd", F.weekday(ts))
    x = expanding_mode(x, "_hour", "fav_hour", key, ts, tie)
    x = expanding_mode(x, "_wd", "fav_weekday", key, ts, tie)
    return x.drop("_hour", "_wd")

"""Monitoring timeline and lifecycle checks.

The monthly monitoring loop is one job grouped by period: every month's
batch is binned against the frozen reference, PSI / states / triggers /
alert factor / labelled performance are computed per (period, variable) with
group-bys, not a driver loop over months.  Only model changes (retraining)
need a driver-side loop, and each of its steps is itself a Spark job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.operators.drift import (ALERT_FACTOR_LIMIT, MIN_DRIFTING, _bin_continuous,
                                      edges_of, psi_state)
from txnscope.operators.history import history_features
from txnscope.operators.metrics import add_rates
from txnscope.operators.order import moving_baseline
from txnscope.operators.stats import psi_terms
from txnscope.plans.frames import unpivot, with_scalars

# fixed value: relative F1 drop that counts as degradation
F1_DROP = 0.30


def monthly_timeline(batch: DataFrame, reference: DataFrame, cols: list[str], ref_alert_rate: DataFrame,
                     score: str, threshold: float, label: str = "y", period: str = "period",
                     monotone: list[str] = (), label_lag: int = 2) -> DataFrame:
    """O3 (monitoring part): one row per period with rows, alert rate, alert factor,
    max PSI, severe / drifting variables, triggers, alarm, and F1 when the labels of
    the period have arrived (period <= latest − label_lag months)."""
    long = unpivot(batch.select(period, *cols), [period], cols, "variable", "value")
    n = long.groupBy(period, "variable").agg(F.count(F.lit(1)).alias("_nb"))
    kinds = reference.select("variable", "kind").distinct()
    cat = long.join(kinds.where(F.col("kind") == "categorical"), "variable", "left_semi") \
        .groupBy(period, "variable", F.col("value").alias("category")).agg(F.count(F.lit(1)).alias("_c"))
    cont = _bin_continuous(long.join(kinds.where(F.col("kind") == "continuous"), "variable", "left_semi"),
                           edges_of(reference)) \
        .groupBy(period, "variable", F.col("bin_id").cast("double").alias("category")) \
        .agg(F.count(F.lit(1)).alias("_c"))
    counts = cat.unionByName(cont)
    # every (period, variable) meets every reference bin of the variable (equi-join)
    grid = n.join(reference.select("variable", "category", "ref_prop"), "variable")
    props = grid.join(counts, [period, "variable", "category"], "left") \
        .withColumn("new_prop", F.coalesce(F.col("_c"), F.lit(0)) / F.col("_nb"))
    mono = F.col("variable").isin(*monotone) if monotone else F.lit(False)
    pv = props.groupBy(period, "variable").agg(F.sum(psi_terms(F.col("ref_prop"), F.col("new_prop"))).alias("psi"))
    pv = pv.withColumn("state", psi_state(F.col("psi"), mono))
    drifting = ~F.col("state").isin("stable", "structural")
    per = pv.groupBy(period).agg(
        F.max(F.when(drifting, F.col("psi"))).alias("psi_max"),
        F.sort_array(F.collect_list(F.when(F.col("state") == "severe", F.col("variable")))).alias("severe_vars"),
        F.sort_array(F.collect_list(F.when(drifting, F.col("variable")))).alias("drifting_vars"))
    pred = batch.groupBy(period).agg(
        F.count(F.lit(1)).alias("rows"), F.avg((F.col(score) >= threshold).cast("double")).alias("alert_rate"),
        F.sum(F.when((F.col(score) >= threshold) & (F.col(label) == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((F.col(score) >= threshold) & (F.col(label) == 0), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((F.col(score) < threshold) & (F.col(label) == 1), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((F.col(score) < threshold) & (F.col(label) == 0), 1).otherwise(0)).alias("tn"))
    pred = add_rates(pred).select(period, "rows", "alert_rate", "f1")
    t = pred.join(per, period, "left")
    t = with_scalars(t, ref_alert_rate.select(F.col("alert_rate").alias("_ref_rate")))
    t = t.withColumn("alert_factor", F.col("alert_rate") / F.greatest(F.col("_ref_rate"), F.lit(1e-9))).drop("_ref_rate")
    trig = F.filter(F.array(
        F.when(F.size("severe_vars") > 0, F.lit("psi_severe")),
        F.when(F.size("drifting_vars") >= MIN_DRIFTING, F.lit("several_moderate")),
        F.when(F.col("alert_factor") >= ALERT_FACTOR_LIMIT, F.lit("alert_factor"))), lambda x: x.isNotNull())
    t = t.withColumn("triggers", trig).withColumn("alarm", F.size("triggers") > 0) \
        .withColumn("psi_max", F.coalesce(F.col("psi_max"), F.lit(0.0)))
    latest = t.agg(F.max(period).alias("_now"))
    t = with_scalars(t, latest)
    cut = F.date_format(F.add_months(F.to_date(F.concat(F.col("_now"), F.lit("-01"))), -label_lag), "yyyy-MM")
    return t.withColumn("f1", F.when(F.col(period) <= cut, F.col("f1"))).drop("_now")


def calendar_table(spark, entries: list[tuple]) -> DataFrame:
    """Declared changes: (name, from_period, to_period, affected variables, expects alert factor,
    detectable without labels)."""
    return spark.createDataFrame(
        entries, "change string, from_period string, to_period string, affected array<string>, "
                 "expects_factor boolean, detectable boolean")


def attribute_alarms(timeline: DataFrame, calendar: DataFrame, period: str = "period") -> DataFrame:
    """(period, change) pairs of active changes with the alarm attributable to the change:
    the trigger type must match the declared signature (range join on a bounded calendar)."""
    j = timeline.join(F.broadcast(calendar), (F.col(period) >= F.col("from_period")) &
                      (F.col(period) <= F.col("to_period")))
    own = ((F.array_contains("triggers", "psi_severe") & F.arrays_overlap("affected", "severe_vars")) |
           (F.array_contains("triggers", "several_moderate") & F.arrays_overlap("affected", "drifting_vars")) |
           (F.array_contains("triggers", "alert_factor") & F.col("expects_factor")))
    return j.withColumn("attributable", F.col("alarm") & F.coalesce(own, F.lit(False)))


def verify(timeline: DataFrame, calendar: DataFrame, period: str = "period") -> DataFrame:
    """Per declared change: active months, months with alarm, attributable months,
    detected, foreign alarm, first month, first own alarm and delay in months."""
    a = attribute_alarms(timeline, calendar, period)
    mi = F.year(F.to_date(F.concat(F.col(period), F.lit("-01")))) * 12 + F.month(
        F.to_date(F.concat(F.col(period), F.lit("-01"))))
    a = a.withColumn("_mi", mi)
    g = a.groupBy("change", "detectable").agg(
        F.count(F.lit(1)).alias("months"), F.sum(F.col("alarm").cast("int")).alias("months_with_alarm"),
        F.sum(F.col("attributable").cast("int")).alias("months_attributable"),
        F.min(period).alias("first_month"), F.min(F.when(F.col("attributable"), F.col(period))).alias("first_own_alarm"),
        (F.min(F.when(F.col("attributable"), F.col("_mi"))) - F.min("_mi")).alias("delay_months"))
    return g.withColumn("detected", F.col("months_attributable") > 0) \
        .withColumn("foreign_alarm", (F.col("months_with_alarm") > 0) & (F.col("months_attributable") == 0))


def quiet_false_positives(timeline: DataFrame, calendar: DataFrame, period: str = "period") -> DataFrame:
    """Months with no active change; alarms there are false positives."""
    q = timeline.join(F.broadcast(calendar), (F.col(period) >= F.col("from_period")) &
                      (F.col(period) <= F.col("to_period")), "left_anti")
    return q.agg(F.count(F.lit(1)).alias("quiet_months"),
                 F.sum(F.col("alarm").cast("int")).cast("long").alias("false_positives"))


def degradation(timeline: DataFrame, calendar: DataFrame, period: str = "period") -> DataFrame:
    """Per change: the worst labelled F1 inside the window vs the upper-middle F1 of
    the labelled months among the three calendar months before the window; degraded
    when the relative drop is >= 0.30 (null when either side has no labelled month)."""
    b = moving_baseline(timeline.select(period, "f1"), period, "f1")
    cal = calendar.select("change", "from_period", "to_period")
    j = timeline.select(period, "f1").join(
        F.broadcast(cal), (F.col(period) >= F.col("from_period")) & (F.col(period) <= F.col("to_period")))
    worst = j.groupBy("change").agg(F.min("f1").alias("f1_min_in_window"), F.min(period).alias("_p0"))
    base = b.select(F.col(period).alias("_p0"), F.col("baseline").alias("f1_before"))
    out = worst.join(base, "_p0", "left").drop("_p0")
    drop = (F.col("f1_before") - F.col("f1_min_in_window")) / F.col("f1_before")
    rel = F.when(F.col("f1_before") > 0, drop)
    return out.withColumn("relative_drop", rel).withColumn("degraded", rel >= F1_DROP)


def time_shift(df: DataFrame, ts: str, days: int = 364, period: str = "period") -> DataFrame:
    """Move event times by ``days`` (364 keeps the weekday) and re-derive the period."""
    shifted = F.col(ts) + F.make_dt_interval(F.lit(days))
    return df.withColumn(ts, shifted).withColumn(period, F.date_format(ts, "yyyy-MM"))


def continue_history(old: DataFrame, new: DataFrame, **kw) -> DataFrame:
    """History features over old ∪ new, so counters and deviations continue."""
    return history_features(old.unionByName(new, allowMissingColumns=True), **kw)


def relative_risk(df: DataFrame, factors: dict[str, tuple[Column, dict, float]], target_rate: float,
                  cap: float = 0.9) -> DataFrame:
    """Multiplicative relative-risk score from declared factor tables
    (name → (key column, {value: factor}, default)), rescaled so its mean equals
    ``target_rate`` (global mean scalar) and clipped at ``cap``."""
    risk = F.lit(1.0)
    for _, (key, table, default) in factors.items():
        m = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
        risk = risk * F.coalesce(F.try_element_at(m, key), F.lit(float(default)))
    x = df.withColumn("_risk", risk)
    mean = x.agg(F.avg("_risk").alias("_m"))
    x = with_scalars(x, mean)
    return x.withColumn("risk_prob", F.least(F.lit(cap), F.col("_risk") * target_rate / F.col("_m"))) \
        .withColumnRenamed("_risk", "relative_risk").drop("_m")

"""Drift and monitoring.

The reference distribution is a small DataFrame with one row per
(variable, bin): ``kind`` ('categorical' / 'continuous'), ``bin_id``,
``category`` (categorical), ``lo``/``hi`` (continuous, open ends), ``ref_prop``
and the train ``mean``.  Binning a new batch is an equi-join on
(variable, category) for categories and a bin index computed from the
per-variable edge array for continuous variables; the edge table has one row
per variable (bounded) and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.operators.stats import ks_two_sample, psi_terms
from txnscope.plans.frames import unpivot, with_scalars
from txnscope.plans.quantile import exact_quantiles

# fixed values: PSI cut-offs and trigger settings
PSI_MODERATE = 0.10
PSI_SEVERE = 0.25
MIN_DRIFTING = 3
ALERT_FACTOR_LIMIT = 2.0


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(variable, value, rows) of the columns: all that the operators below need, so one pass over a table
    (collapsed before its shuffle) serves the frozen reference, the proportions and the KS test."""
    long = unpivot(df.select(*cols), [], cols, "variable", "value")
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("rows"))


def _counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(F.col("variable").isin(*cols)) if df.columns == ["variable", "value", "rows"] else value_counts(df, cols)


def _mean() -> Column:
    known = F.sum(F.when(F.col("value").isNotNull(), F.col("rows")))
    return F.sum(F.col("value") * F.col("rows")) / known


def freeze_reference(train: DataFrame, cols: list[str], n_bins: int = 10) -> DataFrame:
    """Freeze the train distribution of each column.

    ≤ n_bins distinct values → categorical proportions; otherwise quantile edges
    at 0, 1/n … 1 (deduplicated, ends replaced by ±inf) and bin proportions;
    fewer than 3 edges → skipped.  Quantiles are exact (linear).
    ``train`` is a table of rows or its ``value_counts``.
    """
    long = _counts(train, cols)
    ps = [i / n_bins for i in range(n_bins + 1)]
    stats = long.groupBy("variable").agg(
        F.sum("rows").alias("_n"), _mean().alias("mean"), F.count("value").alias("_nd"))
    # one row per variable (bounded); quantiles by the distributed exact plan
    stats = stats.join(exact_quantiles(long, "value", ps, by=["variable"], rows="rows"), "variable", "left")
    stats = stats.withColumn("_edges", F.array_sort(F.array_distinct("_q"))).drop("_q")
    # categorical variables
    cat_vars = stats.where(F.col("_nd") <= n_bins).select("variable", "_n", "mean")
    cat = (long.join(cat_vars, "variable", "left_semi")
           .groupBy("variable", F.col("value").alias("category"))
           .agg(F.sum("rows").alias("_c"))
           .join(cat_vars, "variable")
           .select("variable", F.lit("categorical").alias("kind"), "category",
                   F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                   (F.col("_c") / F.col("_n")).alias("ref_prop"), "mean"))
    # continuous variables
    cont_vars = stats.where((F.col("_nd") > n_bins) & (F.size("_edges") >= 3))
    edges = cont_vars.select("variable", "_n", "mean", _open_ends("_edges").alias("_e"))
    binned = _bin_continuous(long, edges.select("variable", "_e"))
    counts = binned.groupBy("variable", "bin_id").agg(F.sum("rows").alias("_c"))
    bins = edges.select("variable", "_n", "mean", "_e",
                        F.explode(F.sequence(F.lit(0), F.size("_e") - 2)).alias("bin_id"))
    cont = (bins.join(counts, ["variable", "bin_id"], "left")
            .select("variable", F.lit("continuous").alias("kind"),
                    F.col("bin_id").cast("double").alias("category"),
                    F.element_at("_e", F.col("bin_id") + 1).alias("lo"),
                    F.element_at("_e", F.col("bin_id") + 2).alias("hi"),
                    (F.coalesce(F.col("_c"), F.lit(0)) / F.col("_n")).alias("ref_prop"), "mean"))
    return cat.unionByName(cont)


def _open_ends(edges: str) -> Column:
    e = F.col(edges)
    inner = F.slice(e, 2, F.size(e) - 2)
    return F.concat(F.array(F.lit(float("-inf"))), inner, F.array(F.lit(float("inf"))))


def _bin_continuous(long: DataFrame, edges: DataFrame) -> DataFrame:
    """bin_id = number of interior edges <= value (left-closed bins, open ends)."""
    x = long.join(F.broadcast(edges), "variable")
    inner = F.slice("_e", 2, F.size("_e") - 2)
    return x.withColumn("bin_id", F.size(F.filter(inner, lambda b: b <= F.col("value")))) \
        .drop("_e")


def edges_of(reference: DataFrame) -> DataFrame:
    """One row per continuous variable with its full edge array (bounded size)."""
    c = reference.where(F.col("kind") == "continuous")
    g = c.groupBy("variable").agg(F.array_sort(F.collect_list(F.struct("category", "lo"))).alias("_s"),
                                  F.max("hi").alias("_top"))
    return g.select("variable", F.concat(F.transform("_s", lambda s: s["lo"]),
                                         F.array("_top")).alias("_e"))


def batch_proportions(batch: DataFrame, reference: DataFrame, cols: list[str]) -> DataFrame:
    """Proportions of a new batch in the frozen bins / categories.

    Categories unseen in the reference are ignored (not renormalised, T19) and
    reported as ``unseen_share``.
    """
    long = _counts(batch, cols)
    n = long.groupBy("variable").agg(F.sum("rows").alias("_nb"), _mean().alias("mean_batch"))
    kinds = reference.select("variable", "kind").distinct()
    cat_long = long.join(kinds.where(F.col("kind") == "categorical"), "variable", "left_semi")
    cat_counts = cat_long.groupBy("variable", F.col("value").alias("category")).agg(
        F.sum("rows").alias("_c"))
    cont_long = long.join(kinds.where(F.col("kind") == "continuous"), "variable", "left_semi")
    cont_counts = _bin_continuous(cont_long, edges_of(reference)).groupBy(
        "variable", F.col("bin_id").cast("double").alias("category")).agg(F.sum("rows").alias("_c"))
    counts = cat_counts.unionByName(cont_counts)
    j = reference.join(counts, ["variable", "category"], "left").join(n, "variable", "left")
    props = j.select("variable", "kind", "category", "lo", "hi", "ref_prop", "mean", "mean_batch",
                     (F.coalesce(F.col("_c"), F.lit(0)) / F.col("_nb")).alias("new_prop"))
    seen = props.groupBy("variable").agg(F.sum("new_prop").alias("_seen"))
    return props.join(seen, "variable").withColumn("unseen_share", 1 - F.col("_seen")).drop("_seen")


def psi_state(psi: Column, structural: Column) -> Column:
    """N3 state: structural (declared monotone counter), severe, moderate, stable."""
    return (F.when(structural, F.lit("structural")).when(psi >= PSI_SEVERE, F.lit("severe"))
            .when(psi >= PSI_MODERATE, F.lit("moderate")).otherwise(F.lit("stable")))


def drift_table(reference: DataFrame, batch: DataFrame, cols: list[str],
                monotone: list[str] = (), train: DataFrame | None = None) -> DataFrame:
    """Per variable: PSI, state, train and batch means, unseen share, and the
    two-sample KS p-value when the train rows are given."""
    props = batch_proportions(batch, reference, cols)
    t = props.groupBy("variable").agg(
        F.first("kind").alias("kind"), F.sum(psi_terms(F.col("ref_prop"), F.col("new_prop"))).alias("psi"),
        F.first("mean").alias("mean_train"), F.first("mean_batch").alias("mean_batch"),
        F.first("unseen_share").alias("unseen_share"))
    mono = F.col("variable").isin(*monotone) if monotone else F.lit(False)
    t = t.withColumn("state", psi_state(F.col("psi"), mono))
    if train is not None:
        ks = ks_two_sample(_counts(train, cols), _counts(batch, cols), "value", group=["variable"], rows="rows")
        t = t.join(ks.select("variable", "ks_pvalue"), "variable", "left")
    return t


def prediction_drift(ref: DataFrame, new: DataFrame, score: str, threshold: float) -> DataFrame:
    """Alert rate and mean score in reference and batch, alert factor, KS p-value."""
    r = ref.agg(F.avg((F.col(score) >= threshold).cast("double")).alias("alert_rate_ref"),
                F.avg(score).alias("mean_score_ref"))
    b = new.agg(F.avg((F.col(score) >= threshold).cast("double")).alias("alert_rate_batch"),
                F.avg(score).alias("mean_score_batch"))
    ks = ks_two_sample(ref, new, score).select("ks_pvalue")
    out = with_scalars(with_scalars(r, b), ks)
    return out.withColumn("alert_factor", F.col("alert_rate_batch") /
                          F.greatest(F.col("alert_rate_ref"), F.lit(1e-9)))


def triggers(table: DataFrame, factor: DataFrame) -> DataFrame:
    """Active triggers (any severe; ≥3 drifting; alert factor ≥ 2) and the alarm."""
    drifting = ~F.col("state").isin("stable", "structural")
    s = table.agg(F.max((F.col("state") == "severe").cast("int")).alias("_sev"),
                  F.sum(drifting.cast("int")).alias("variables_drifting"),
                  F.sum((F.col("state") == "structural").cast("int")).alias("variables_structural"))
    x = with_scalars(s, factor.select("alert_factor"))
    arr = F.array(F.when(F.col("_sev") == 1, F.lit("psi_severe")),
                  F.when(F.col("variables_drifting") >= MIN_DRIFTING, F.lit("several_moderate")),
                  F.when(F.col("alert_factor") >= ALERT_FACTOR_LIMIT, F.lit("alert_factor")))
    trig = F.filter(arr, lambda t: t.isNotNull())
    return x.select(F.col("variables_drifting").cast("long").alias("variables_drifting"),
                    F.col("variables_structural").cast("long").alias("variables_structural"),
                    "alert_factor", trig.alias("triggers"), (F.size(trig) > 0).alias("alarm"))


def worst_variable(table: DataFrame) -> DataFrame:
    """Maximum PSI among non-structural drifting variables; 0 and null when none."""
    drifting = ~F.col("state").isin("stable", "structural")
    best = F.max_by(F.struct("psi", "variable"), F.when(drifting, F.col("psi")))
    return table.agg(best.alias("_b"), F.max(F.when(drifting, 1)).alias("_any")).select(
        F.when(F.col("_any") == 1, F.col("_b.psi")).otherwise(F.lit(0.0)).alias("psi_max"),
        F.when(F.col("_any") == 1, F.col("_b.variable")).alias("worst_variable"))


def operational_metrics(log: DataFrame, ts: str, score: str, alert: str,
                        last_n: int = 10000, id_col: str | None = None) -> DataFrame:
    """Totals, alert rate, mean score over all rows, and p95 of the score over
    the most recent ``last_n`` rows (top-k by time is the feature here; ``id_col`` breaks ties)."""
    tot = log.agg(F.count(F.lit(1)).alias("total"), F.avg(F.col(alert).cast("double")).alias("alert_rate"),
                  F.avg(score).alias("mean_score"))
    tie = [F.col(id_col).desc()] if id_col else []
    recent = log.orderBy(F.col(ts).desc(), *tie).limit(last_n)
    p95 = recent.agg(F.percentile(score, 0.95).alias("p95_recent"))   # at most last_n rows
    return with_scalars(tot, p95)


def schema_diff(df: DataFrame, expected: list[tuple[str, str]]) -> list[dict]:
    """Compare a batch schema with the column list stored with a model:
    missing columns, unexpected columns, type changes (driver-side metadata only)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = dict(expected)
    out = []
    for c, t in want.items():
        if c not in have:
            out.append({"column": c, "issue": "missing", "expected": t, "found": None})
        elif have[c] != t:
            out.append({"column": c, "issue": "type", "expected": t, "found": have[c]})
    for c in have:
        if c not in want:
            out.append({"column": c, "issue": "unexpected", "expected": None, "found": have[c]})
    return out

"""Statistics.

Association statistics over many column pairs are computed in one pass:
rows are exploded into (pair, a, b) cells *inside* the map side of a
``groupBy(...).count()`` so that only distinct cells are shuffled
(partial aggregation), never the exploded rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.plans.frames import materialize, with_scalars
from txnscope.plans.prefix import prefix_sum
from txnscope.plans.quantile import exact_quantiles


# ----------------------------------------------------------- correlation
def pearson_long(df: DataFrame, cols: list[str], pairs: list[tuple[str, str]] | None = None
                 ) -> DataFrame:
    """Pearson correlation per pair, pairwise-complete (rows where either is null
    are skipped by ``corr``), as (a, b, corr, n)."""
    pairs = pairs or list(itertools.combinations(cols, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        aggs += [F.corr(x, y).alias(f"c{i}"),
                 F.sum(F.when(x.isNotNull() & y.isNotNull(), 1).otherwise(0)).alias(f"n{i}")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"),
        F.col(f"n{i}").cast("long").alias("n")) for i, (a, b) in enumerate(pairs)])).alias("s")
    ).select("s.*")


def average_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    """Average rank (1-based, ties share the mean rank) of ``col`` joined to rows.
    Ranks come from a distributed prefix count over the distinct values."""
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    p = prefix_sum(g, "_v", ["_c"], materialize_input=True)
    ranks = p.select("_v", (F.col("_c_cum") - F.col("_c") + (F.col("_c") + 1) / 2.0).alias(name))
    return df.join(ranks, df[col] == ranks["_v"], "left").drop("_v")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman rho = Pearson correlation of average ranks (complete rows only)."""
    x = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    x = average_ranks(x, a, "_ra")
    x = average_ranks(x, b, "_rb")
    return x.agg(F.corr("_ra", "_rb").alias("spearman"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------ contingency tables
def pair_cells(df: DataFrame, cols: list[str],
               pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """(a, b, va, vb, n) counts for every pair of categorical columns (nulls dropped)."""
    pairs = pairs or list(itertools.combinations(cols, 2))
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                               F.col(a).cast("string").alias("va"),
                               F.col(b).cast("string").alias("vb")) for a, b in pairs])
    x = df.select(F.explode(cells).alias("c")).select("c.*")
    x = x.where(F.col("va").isNotNull() & F.col("vb").isNotNull())
    return x.groupBy("a", "b", "va", "vb").agg(F.count(F.lit(1)).alias("n"))


def chi2_from_cells(cells: DataFrame) -> DataFrame:
    """Pearson chi-square (no continuity correction) per pair:
    χ² = n·(Σ o²/(row·col) − 1), plus n, r (rows), k (columns)."""
    rows = cells.groupBy("a", "b", "va").agg(F.sum("n").alias("_r"))
    colm = cells.groupBy("a", "b", "vb").agg(F.sum("n").alias("_c"))
    j = cells.join(rows, ["a", "b", "va"]).join(colm, ["a", "b", "vb"])
    s = j.groupBy("a", "b").agg(F.sum(F.col("n") * F.col("n") / (F.col("_r") * F.col("_c")))
                                .alias("_s"), F.sum("n").alias("n"),
                                F.count_distinct("va").alias("r"),
                                F.count_distinct("vb").alias("k"))
    return s.select("a", "b", (F.col("n") * (F.col("_s") - 1)).alias("chi2"),
                    F.col("n").cast("long").alias("n"), F.col("r").cast("long").alias("r"),
                    F.col("k").cast("long").alias("k"))


def cramers_v(chi: DataFrame) -> DataFrame:
    """I4: bias-corrected Cramér's V from a chi-square table."""
    n, r, k, chi2 = F.col("n"), F.col("r"), F.col("k"), F.col("chi2")
    phi2c = F.greatest(F.lit(0.0), chi2 / n - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) * (r - 1) / (n - 1)
    kc = k - (k - 1) * (k - 1) / (n - 1)
    den = F.least(kc - 1, rc - 1)
    return chi.withColumn("cramers_v", F.when(den > 0, F.sqrt(phi2c / den)))


def effect_label(x: Column, large: float = 0.1) -> Column:
    """Drift effect size verdict (D or V >= 0.1 → 'large')."""
    return F.when(x >= large, F.lit("large")).otherwise(F.lit("small"))


def mutual_information(df: DataFrame, cols: list[str], label: str = "y",
                       bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) of each variable with the label, on
    equal-frequency bins (exact quantiles to 9 places as cut points; nulls → 0).
    Differs from a nearest-neighbour estimator; meant for ranking."""
    probs = [i / bins for i in range(1, bins)]
    values = df.select(F.col(label).alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    counts = materialize(values.unpivot(["_y"], cols, "variable", "value").groupBy("variable", "value", "_y")
                         .agg(F.count(F.lit(1)).alias("n")), "value-counts")
    edges = exact_quantiles(counts, "value", probs, by=["variable"], rows="n") \
        .select("variable", F.array_distinct(F.transform("_q", lambda e: F.round(e, 9))).alias("_e"))
    below = F.size(F.filter("_e", lambda e: e < F.col("value")))
    cells = counts.join(F.broadcast(edges), "variable") \
        .groupBy("variable", below.alias("bin"), "_y").agg(F.sum("n").alias("n"))  # edges: a row for each variable
    pb = cells.groupBy("variable", "bin").agg(F.sum("n").alias("_nb"))
    py = cells.groupBy("variable", "_y").agg(F.sum("n").alias("_ny"))
    tot = cells.groupBy("variable").agg(F.sum("n").alias("_n"))
    j = cells.join(pb, ["variable", "bin"]).join(py, ["variable", "_y"]).join(tot, "variable")
    term = (F.col("n") / F.col("_n")) * F.log(F.col("n") * F.col("_n") / (F.col("_nb") * F.col("_ny")))
    return j.groupBy("variable").agg(F.sum(term).alias("mutual_info"))


def digamma(n: Column) -> Column:
    """Logarithmic derivative of the gamma function for whole n >= 1 (asymptotic series ten places further on)."""
    x = n.cast("double") + 10.0
    back = sum((1.0 / (n.cast("double") + float(i)) for i in range(10)), F.lit(0.0))
    return (F.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6) + 1 / (240 * x ** 8)) - back


def neighbour_information(df: DataFrame, cols: list[str], label: str = "y", k: int = 3, grid: float = 1e-6,
                          block: int = 100_000) -> DataFrame:
    """Mutual information (nats) of each numeric variable with a class label by nearest neighbours.

    For a row, d is the distance to its k-th nearest row of the same class (fewer than k others: the furthest)
    and m the number of rows of any class nearer than d, itself included; the estimate is
    psi(N) + mean(psi(k) - psi(rows of the class) - psi(m)), not below 0.  Fixed tie rule: where d = 0, k is
    the number of rows of the class with that value and m that of all classes.  Values are whole multiples of
    ``grid``, so distances are exact.

    Rows are collapsed to (variable, value, class) counts.  In one dimension the k nearest of a class are among its k
    values on either side: the values of a class are numbered, cut into blocks of ``block`` and joined by k
    neighbours from the next blocks.  The counts m are differences of a running count over values and interval ends.

    Odd rows: a missing value counts as 0, a row without a label and a class with one row are left out; no row left: no result
    for the variable.
    """
    if block < k:
        raise ValueError("a block must hold k values")
    number = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in cols]
    values = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_y"), *number).unpivot(["_y"], cols, "variable", "_v")
    counts = materialize(values.groupBy("variable", "_y", F.round(F.col("_v") / grid).cast("long").alias("_x"))
                         .agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    classes = counts.groupBy("variable", "_y").agg(F.sum("_n").alias("_ny")).where("_ny > 1")
    cells = materialize(counts.join(classes, ["variable", "_y"]).withColumn("_one", F.lit(1).cast("long")), "class-values")

    place = F.col("_one_cum") - 1
    copies = F.array_compact(F.array(F.col("_block"), F.when(place % block < k, F.col("_block") - 1),
                                     F.when(place % block >= block - k, F.col("_block") + 1)))
    placed = prefix_sum(cells, "_x", ["_one"], by=["variable", "_y"]).withColumn("_block", F.floor(place / block)) \
        .withColumn("_in", F.explode(copies))
    w = Window.partitionBy("variable", "_y", "_in").orderBy("_x")
    beside = [F.when(f("_n", i).over(w).isNotNull(), F.struct(F.abs(F.col("_x") - f("_x", i).over(w)).alias("gap"), f("_n", i).over(w).alias("n")))
              for f in (F.lag, F.lead) for i in range(1, k + 1)]
    near = placed.withColumn("_near", F.array_sort(F.array_compact(F.array(*beside)))).where("_in = _block")
    wanted = F.least(F.lit(k).cast("long"), F.col("_ny") - 1)
    reach = F.aggregate("_near", F.struct(F.lit(0).cast("long").alias("d"), (wanted - (F.col("_n") - 1)).alias("left")),
                        lambda a, e: F.when(a["left"] > 0, F.struct(e["gap"].alias("d"), (a["left"] - e["n"]).alias("left"))).otherwise(a))
    rows = near.select("variable", "_y", "_x", "_n", "_ny", reach["d"].alias("_d")) \
        .withColumn("_k", F.when(F.col("_d") > 0, wanted).otherwise(F.col("_n")))

    # kind: an end before (0) or after (2) the values (1) at its place
    end = lambda place, kind, sign: F.struct(place.alias("_at"), kind.cast("int").alias("_kind"), F.lit(sign).alias("_sign"))
    open_ = F.col("_d") > 0
    ends = F.array(end(F.col("_x") + F.col("_d"), F.when(open_, 0).otherwise(2), 1),
                   end(F.col("_x") - F.col("_d"), F.when(open_, 2).otherwise(0), -1))
    probes = rows.withColumn("_e", F.explode(ends)).select("*", "_e.*").drop("_e").withColumn("_w", F.lit(0).cast("long"))
    points = cells.select("variable", F.col("_x").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).alias("_sign"), F.col("_n").alias("_w"))
    run = prefix_sum(probes.unionByName(points, allowMissingColumns=True), "_at", ["_w"], tie=["_kind"], by=["variable"],
                     materialize_input=True)
    inside = run.where("_sign <> 0").groupBy("variable", "_y", "_x", "_n", "_ny", "_k") \
        .agg(F.sum(F.col("_sign") * F.col("_w_cum")).alias("_m"))
    term = F.sum(F.col("_n") * (digamma(F.col("_k")) - digamma(F.col("_ny")) - digamma(F.col("_m"))))
    total = F.sum("_n")
    return inside.groupBy("variable").agg(F.greatest(F.lit(0.0), digamma(total) + term / total).alias("mutual_info"))


# ------------------------------------------------------------- two-sample
def _kolmogorov_sf(x: Column, terms: int = 100) -> Column:
    """Asymptotic Kolmogorov survival function Q(x) = 2 Σ (-1)^(k-1) exp(-2 k² x²)."""
    s = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                    lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * x * x))
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * s)))


def ks_two_sample(a: DataFrame, b: DataFrame, col: str, group: list[str] | None = None,
                  rows: str | None = None) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic D = max |F_a − F_b| and the
    asymptotic p-value, optionally per group (e.g. per variable).  The empirical
    CDFs come from a distributed prefix sum over distinct values.  ``rows`` names a
    column with how many rows each row stands for."""
    group = group or []
    v, many = F.col(col).cast("double").alias("_v"), F.col(rows) if rows else F.lit(1)
    u = a.select(*group, v, many.alias("_ia"), F.lit(0).alias("_ib")).unionByName(
        b.select(*group, v, F.lit(0).alias("_ia"), many.alias("_ib")))
    u = u.where(F.col("_v").isNotNull())
    g = u.groupBy(*group, "_v").agg(F.sum("_ia").alias("_ca"), F.sum("_ib").alias("_cb"))
    if group:
        c = prefix_sum(g, "_v", ["_ca", "_cb"], by=group, materialize_input=True)
        tot = g.groupBy(*group).agg(F.sum("_ca").alias("_na"), F.sum("_cb").alias("_nb"))
        c = c.join(tot, group)
    else:
        c = prefix_sum(g, "_v", ["_ca", "_cb"], materialize_input=True)
        c = with_scalars(c, g.agg(F.sum("_ca").alias("_na"), F.sum("_cb").alias("_nb")))
    d = F.abs(F.col("_ca_cum") / F.col("_na") - F.col("_cb_cum") / F.col("_nb"))
    agg = (c.groupBy(*group) if group else c.groupBy()).agg(
        F.max(d).alias("ks_d"), F.max("_na").cast("long").alias("n_a"),
        F.max("_nb").cast("long").alias("n_b"))
    en = F.sqrt(F.col("n_a") * F.col("n_b") / (F.col("n_a") + F.col("n_b")))
    return agg.withColumn("ks_pvalue", _kolmogorov_sf(en * F.col("ks_d")))


def psi_terms(ref: Column, new: Column, floor: float = 1e-6) -> Column:
    """I8: one bin's PSI term with the 1e-6 floor on both proportions."""
    r = F.greatest(ref, F.lit(floor))
    n = F.greatest(new, F.lit(floor))
    return (n - r) * F.log(n / r)


def psi(props: DataFrame, ref: str = "ref_prop", new: str = "new_prop",
        group: list[str] | None = None) -> DataFrame:
    """I8: PSI = Σ (new − ref)·ln(new/ref) per group."""
    g = props.groupBy(*(group or []))
    return g.agg(F.sum(psi_terms(F.col(ref), F.col(new))).alias("psi"))


def cohens_d(df: DataFrame, key: str, group: str, cols: list[str], g1, g2) -> DataFrame:
    """Cohen's d per variable on entity-level means between two groups,
    pooled sample variance; magnitude label."""
    per = df.groupBy(key).agg(F.min(group).alias("_g"),
                              *[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    aggs = []
    for c in cols:
        for tag, v in (("1", g1), ("2", g2)):
            x = F.when(F.col("_g") == v, F.col(c))
            aggs += [F.count(x).alias(f"{c}__n{tag}"), F.avg(x).alias(f"{c}__m{tag}"),
                     F.var_samp(x).alias(f"{c}__v{tag}")]
    row = per.agg(*aggs)
    out = []
    for c in cols:
        n1, n2 = F.col(f"{c}__n1"), F.col(f"{c}__n2")
        sp = F.sqrt(((n1 - 1) * F.col(f"{c}__v1") + (n2 - 1) * F.col(f"{c}__v2")) / (n1 + n2 - 2))
        d = F.when(sp > 0, (F.col(f"{c}__m1") - F.col(f"{c}__m2")) / sp)
        out.append(F.struct(F.lit(c).alias("variable"), d.alias("d")))
    s = row.select(F.explode(F.array(*out)).alias("s")).select("s.*").where(F.col("d").isNotNull())
    ad = F.abs("d")
    return s.withColumn("magnitude", F.when(ad < 0.2, "despreciable").when(ad < 0.5, "chico")
                        .when(ad < 0.8, "mediano").otherwise("grande"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval (lo, hi) for k successes of n."""
    p = k / n
    z2 = z * z
    centre = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return centre - half, centre + half


def iqr_limits(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Q1, Q3, IQR and the k·IQR outlier limits (exact linear quantiles)."""
    q = exact_quantiles(df, col, [0.25, 0.75])
    return q.select(F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")).select(
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lo"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("hi"))


def flag_outliers(df: DataFrame, col: str, limits: DataFrame, name: str = "is_outlier"
                  ) -> DataFrame:
    """1 when outside [lo, hi] (limits from ``iqr_limits``, e.g. fitted on train)."""
    x = with_scalars(df, limits.select("lo", "hi"))
    return x.withColumn(name, ((F.col(col) < F.col("lo")) | (F.col(col) > F.col("hi"))).cast("int")) \
        .drop("lo", "hi")


def scale_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sd, min, max per column."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{n}") for c in cols
                   for n, f in (("sd", F.stddev_samp), ("min", F.min), ("max", F.max))])
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("variable"), F.col(f"{c}__sd").alias("sd"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in cols]))
        .alias("s")).select("s.*")

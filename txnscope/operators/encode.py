"""Train-only encoders and preprocessing.

``fit_*`` functions compute parameters on a training DataFrame and return
them as DataFrames (one row of scalars, or one row per category);
``apply_*`` functions attach them with joins / column expressions, so the
same code serves batch and streaming inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import materialize, with_scalars
from txnscope.plans.prefix import prefix_sum
from txnscope.plans.quantile import exact_quantiles


# ------------------------------------------------------------ imputation
def fit_median(train: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """One-row table with the train median of ``col`` (exact linear, or approximate)."""
    if exact:
        return exact_quantiles(train, col, [0.5]).select(F.col("_q")[0].alias(f"{col}_median"))
    m = F.percentile_approx(F.col(col).cast("double"), 0.5, 10000).cast("double")
    return train.agg(m.alias(f"{col}_median"))


def apply_median(df: DataFrame, col: str, params: DataFrame) -> DataFrame:
    x = with_scalars(df, params.select(f"{col}_median"))
    return x.withColumn(col, F.coalesce(F.col(col).cast("double"), F.col(f"{col}_median"))) \
        .drop(f"{col}_median")


# ------------------------------------------------------- target encoding
def fit_target_encoding(train: DataFrame, key: str, label: str = "y",
                        smoothing: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(per-category table (key, te), one-row global rate).

    Unsmoothed: te = mean(label | key).  Smoothed: te = (sum + m·g) / (n + m).
    """
    glob = train.agg(F.avg(label).alias("_global_rate"))
    g = train.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_s"))
    g = with_scalars(g, glob)
    if smoothing is None:
        te = F.col("_s") / F.col("_n")
    else:
        m = float(smoothing)
        te = (F.col("_s") + m * F.col("_global_rate")) / (F.col("_n") + m)
    return g.select(key, te.alias("te")), glob


def apply_target_encoding(df: DataFrame, key: str, table: DataFrame, glob: DataFrame,
                          name: str | None = None) -> DataFrame:
    """Unseen categories get the global train rate (AQE broadcasts the table when small)."""
    name = name or f"{key}_te"
    x = with_scalars(df, glob).join(table.withColumnRenamed("te", "_te"), key, "left")
    return x.withColumn(name, F.coalesce(F.col("_te"), F.col("_global_rate"))) \
        .drop("_te", "_global_rate")


def smoothing_sensitivity(train: DataFrame, key: str, ms: list[float], label: str = "y"
                          ) -> DataFrame:
    """Encoded value of every category for each smoothing weight m (one aggregate,
    then a literal list of m values exploded over the per-category rows)."""
    glob = train.agg(F.avg(label).alias("_g"))
    g = with_scalars(train.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(label).alias("_s")), glob)
    x = g.withColumn("m", F.explode(F.array(*[F.lit(float(m)) for m in ms])))
    return x.select(key, "n", "m", ((F.col("_s") + F.col("m") * F.col("_g")) /
                                    (F.col("n") + F.col("m"))).alias("te"))


# ---------------------------------------------------------------- one-hot
def fit_categories(train: DataFrame, col: str) -> list[str]:
    """The sorted category list frozen at fit time: the names of the columns to come, so as long as the
    result is wide.  ``category_table`` and ``one_hot_sparse`` are the form for many categories."""
    cats = train.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("c")).distinct().collect()
    return sorted(r.c for r in cats)


def one_hot_drop_first(df: DataFrame, col: str, categories: list[str],
                       prefix: str | None = None) -> DataFrame:
    """One 0/1 column per frozen category except the alphabetically first.
    Unseen categories get all zeros; a batch never changes the column set (T1)."""
    prefix = prefix or f"{col}_"
    return df.withColumns({f"{prefix}{c}": (F.col(col).cast("string") == F.lit(c)).cast("double")
                           for c in categories[1:]})


def category_table(train: DataFrame, col: str) -> DataFrame:
    """(category, index) of the frozen categories except the alphabetically first, for any number of them:
    the index is a distributed rank in hash order, and the table is written once."""
    cats = train.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("category")).distinct()
    cats = materialize(cats, "categories")
    x = with_scalars(cats, cats.agg(F.min("category").alias("_first"))).where(F.col("category") != F.col("_first"))
    x = x.select("category", F.xxhash64("category").alias("_h"), F.lit(1).alias("index"))
    x = prefix_sum(x, "_h", ["index"], tie=["category"], inclusive=False, hashed=True)
    return materialize(x.select("category", F.col("index_cum").cast("int").alias("index")), "category-index")


def one_hot_sparse(df: DataFrame, col: str, table: DataFrame, name: str) -> DataFrame:
    """The indicators of ``category_table`` as one sparse vector, by an equi-join on the category.
    The first category, unseen ones and nulls are all zeros (the index after the last, which is left out)."""
    size = table.count()
    x = df.join(table.select(F.col("category").alias("_category"), F.col("index").alias("_index")),
                F.col(col).cast("string") == F.col("_category"), "left")
    x = x.withColumn("_index", F.coalesce(F.col("_index"), F.lit(size)).cast("double")).drop("_category")
    known = df.sparkSession.range(1).select(F.lit(float(size)).alias("_index"))
    return OneHotEncoder(inputCol="_index", outputCol=name, dropLast=True).fit(known).transform(x).drop("_index")


# ------------------------------------------------------------ scaling
def fit_standardizer(train: DataFrame, cols: list[str]) -> DataFrame:
    """Train mean and population sd per column (one row)."""
    return train.agg(*[a for c in cols for a in (F.avg(c).alias(f"{c}__mu"),
                                                 F.stddev_pop(c).alias(f"{c}__sd"))])


def apply_standardizer(df: DataFrame, cols: list[str], params: DataFrame) -> DataFrame:
    x = with_scalars(df, params)
    for c in cols:
        x = x.withColumn(c, F.when(F.col(f"{c}__sd") > 0,
                                   (F.col(c) - F.col(f"{c}__mu")) / F.col(f"{c}__sd"))
                         .otherwise(F.lit(0.0)))
    return x.drop(*[f"{c}__{s}" for c in cols for s in ("mu", "sd")])


# ------------------------------------------------------------ imbalance
def class_weights(train: DataFrame, label: str = "y") -> DataFrame:
    """neg/pos ratio, its square root, and balanced weights n / (2·n_class)."""
    g = train.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    return g.select(
        (F.col("n") - F.col("pos")).cast("long").alias("negatives"),
        F.col("pos").cast("long").alias("positives"),
        ((F.col("n") - F.col("pos")) / F.col("pos")).alias("neg_pos_ratio"),
        F.sqrt((F.col("n") - F.col("pos")) / F.col("pos")).alias("sqrt_ratio"),
        (F.col("n") / (2 * F.col("pos"))).alias("w_pos"),
        (F.col("n") / (2 * (F.col("n") - F.col("pos")))).alias("w_neg"))


def with_weight(df: DataFrame, weights: DataFrame, label: str = "y", name: str = "w"
                ) -> DataFrame:
    """Balanced ``weightCol`` for Spark ML learners."""
    x = with_scalars(df, weights.select("w_pos", "w_neg"))
    return x.withColumn(name, F.when(F.col(label) == 1, F.col("w_pos")).otherwise(F.col("w_neg"))) \
        .drop("w_pos", "w_neg")


def hash60(id_col: str | Column, seed: int) -> Column:
    """60 bits of the MD5 of id and seed (a hash that SQL engines have in common), as a long from 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.conv(F.substring(F.md5(F.concat_ws("|", c.cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


def hash60_sql(id_col: str, seed: int) -> str:
    """The same for DuckDB."""
    return f"CAST('0x' || substr(md5(CAST({id_col} AS VARCHAR) || '|{seed}'), 1, 15) AS BIGINT)"


def hash_order(id_col: str | Column, seed: int) -> Column:
    """Deterministic pseudo-random order key from an id (independent of partitioning), over the range of a long."""
    return (hash60(id_col, seed) - F.lit(1 << 59)) * F.lit(16)


def hash_order_sql(id_col: str, seed: int) -> str:
    return f"(({hash60_sql(id_col, seed)} - {1 << 59}) * 16)"


def undersample(df: DataFrame, id_col: str, label: str = "y", ratio: float = 10.0,
                seed: int = 42) -> DataFrame:
    """Keep all positives and the first ratio·P negatives in hash order
    (exact quota; the rank comes from a distributed prefix count)."""
    x = df.withColumn("_h", hash_order(id_col, seed).cast("double")).withColumn(
        "_neg", (F.col(label) == 0).cast("long"))
    pos = df.agg(F.sum(label).alias("_P"))
    x = prefix_sum(x.where(F.col(label) == 0), "_h", ["_neg"], tie=[id_col], hashed=True)
    x = with_scalars(x, pos).where(F.col("_neg_cum") <= F.col("_P") * ratio)
    keep_neg = x.drop("_h", "_neg", "_neg_cum", "_P")
    return df.where(F.col(label) == 1).unionByName(keep_neg)


def smote_approx(df: DataFrame, id_col: str, cols: list[str], label: str = "y", ratio: float = 0.1,
                 projections: int = 3, seed: int = 42) -> DataFrame:
    """J11, approximate: (id, *cols, label) with synthetic positives until there are ``ratio`` x negatives.

    Exact neighbours need all pairs of minority rows.  Here the minority is ordered along ``projections`` random
    directions (of standardised columns) by the distributed row number; a synthetic row lies at a random place between a
    row and the one next to it in an order.  Copies are spread evenly over the ranks and their number is exact.
    Synthetic rows have no id; nothing is added without positives or above the ratio.
    """
    import random
    from functools import reduce

    from txnscope.plans.prefix import global_row_number

    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols], label)
    n = df.agg(F.coalesce(F.sum((F.col(label) == 1).cast("long")), F.lit(0)).alias("pos"),
               F.coalesce(F.sum((F.col(label) == 0).cast("long")), F.lit(0)).alias("neg")).first()
    need = int(n["neg"] * ratio) - n["pos"]
    if need <= 0 or not n["pos"]:
        return rows
    minority = materialize(rows.where(F.col(label) == 1), "minority")
    spread = minority.agg(*[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(cols)]).first()
    draw, made = random.Random(seed), []
    for p in range(projections):
        along = F.lit(0.0)
        for i, c in enumerate(cols):
            if spread[i]:
                along = along + F.coalesce(F.col(c), F.lit(0.0)) * F.lit(draw.gauss(0, 1) / spread[i])
        ranked = materialize(global_row_number(minority.withColumn("_along", along), "_along", tie=[id_col], name="_rn").drop("_along"), "minority-ranks")
        share = need // projections + (p < need % projections)
        whole, rest, last = share // n["pos"], share % n["pos"], F.lit(n["pos"])
        extra = F.floor(F.col("_rn") * rest / last) - F.floor((F.col("_rn") - 1) * rest / last)
        copies = ranked.withColumn("_copy", F.explode(F.when(extra + whole > 0, F.sequence(F.lit(1).cast("long"), extra + whole))))
        up = F.col("_rn") + F.when(hash60(F.concat_ws("|", F.col(id_col).cast("string"), F.col("_copy").cast("string")), seed + p) % 2 == 0, 1).otherwise(-1)
        other = F.when(last == 1, F.col("_rn")).when(F.col("_rn") == 1, 2).when(F.col("_rn") == last, last - 1).otherwise(up)
        at = (hash60(F.concat_ws("|", F.col(id_col).cast("string"), F.col("_copy").cast("string")), seed + 1000 + p) % 1000000) / 1000000.0
        # a merge join: the file's size, by which Spark broadcasts, is a fraction of the rows that would pass through the driver
        near = ranked.select(F.col("_rn").alias("_other"), *[F.col(c).alias(f"_n{i}") for i, c in enumerate(cols)]).hint("merge")
        pairs = copies.withColumn("_other", other.cast("long")).withColumn("_at", at).join(near, "_other")
        made.append(pairs.select(F.lit(None).cast(rows.schema[id_col].dataType).alias(id_col),
                                             *[(F.col(c) + F.col("_at") * (F.col(f"_n{i}") - F.col(c))).alias(c) for i, c in enumerate(cols)], label))
    # written once: a fit reads its rows several times
    return rows.unionByName(materialize(reduce(lambda a, b: a.unionByName(b), made), "synthetic"))


# ------------------------------------------------------- preprocessor
@dataclass
class Preprocessor:
    """Parameters fitted once on train and applied to batch and stream."""

    limits: DataFrame          # one row: lo, hi (IQR outlier limits of amount)
    median_gap: DataFrame      # one row: gap_hours_median
    te_table: DataFrame        # (key, te)
    te_global: DataFrame       # one row: _global_rate
    categories: list[str]      # frozen one-hot categories
    key: str
    cat_col: str
    columns: list[str]         # frozen model columns (J12)

    def transform(self, df: DataFrame) -> DataFrame:
        from txnscope.plans.frames import align_columns

        x = with_scalars(df, self.limits.select("lo", "hi"))
        x = x.withColumn("is_outlier", ((F.col("amount") < F.col("lo")) |
                                        (F.col("amount") > F.col("hi"))).cast("double"))
        x = x.drop("lo", "hi")
        x = apply_median(x, "gap_hours", self.median_gap)
        x = apply_target_encoding(x, self.key, self.te_table, self.te_global, "key_te")
        if any(c.startswith("cat_") for c in self.columns):
            x = one_hot_drop_first(x, self.cat_col, self.categories, "cat_")
        keep = [c for c in df.columns if c not in self.columns]
        return align_columns(x, keep + self.columns, 0.0)


def fit_preprocessor(train: DataFrame, key: str, cat_col: str, numeric: list[str],
                     label: str = "y", smoothing: float = 50.0) -> Preprocessor:
    """Fit outlier limits, gap median, smoothed target encoding and one-hot
    categories on train; freeze the model column list."""
    from txnscope.operators.stats import iqr_limits

    lim = iqr_limits(train, "amount")
    med = fit_median(train, "gap_hours")
    te, glob = fit_target_encoding(train, key, label, smoothing)
    cats = fit_categories(train, cat_col)
    cols = numeric + ["is_outlier", "key_te"] + [f"cat_{c}" for c in cats[1:]]
    return Preprocessor(lim, med, te, glob, cats, key, cat_col, cols)

"""Splits and folds (K1–K8).

Random splits are deterministic functions of (id, seed): rows are ordered by
a hash of (id, seed) inside each class and exact per-class quotas are cut
from a distributed prefix count, so the result does not depend on
partitioning, retries or executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.operators.encode import hash60, hash_order
from txnscope.plans.prefix import prefix_sum


def _class_rank(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    x = df.withColumn("_h", hash_order(id_col, seed).cast("double")).withColumn("_one", F.lit(1))
    x = prefix_sum(x, "_h", ["_one"], tie=[id_col], by=[label], hashed=True)
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    return x.join(n, label).withColumnRenamed("_one_cum", "_rank").drop("_one", "_h")


def stratified_split(df: DataFrame, id_col: str, label: str = "y",
                     shares: list[tuple[str, float]] = (("train", 0.8), ("test", 0.2)),
                     seed: int = 42, tag: str = "split") -> DataFrame:
    """K1/K2: tag every row with a part; each class is cut at round(cum_share·n_class)."""
    x = _class_rank(df, id_col, label, seed)
    cum, expr = 0.0, None
    for name, share in shares[:-1]:
        cum += share
        cond = F.col("_rank") <= F.round(F.col("_n_class") * F.lit(cum))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(shares[-1][0])
    expr = expr.otherwise(last) if expr is not None else last
    return x.withColumn(tag, expr).drop("_rank", "_n_class")


def split_report(df: DataFrame, tag: str = "split", label: str = "y") -> DataFrame:
    """K3: rows, share of rows, positives and rate per part."""
    g = df.groupBy(tag).agg(F.count(F.lit(1)).alias("rows"),
                            F.sum(label).cast("long").alias("positives"))
    tot = df.agg(F.count(F.lit(1)).alias("_t"))
    from txnscope.plans.frames import with_scalars
    return with_scalars(g, tot).select(tag, "rows", (F.col("rows") / F.col("_t")).alias("share"),
                                       "positives", (F.col("positives") / F.col("rows")).alias("rate"))


def temporal_split(df: DataFrame, ts: str, cuts: list[tuple[str, str]], last: str,
                   tag: str = "split") -> DataFrame:
    """K4: by month cut-offs: [(name, 'yyyy-MM' last month included)...], rest → ``last``."""
    p = F.date_format(ts, "yyyy-MM")
    expr = None
    for name, upto in cuts:
        expr = F.when(p <= upto, F.lit(name)) if expr is None else expr.when(p <= upto, F.lit(name))
    return df.withColumn(tag, expr.otherwise(F.lit(last)))


def _month_before(month: Column) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), -1), "yyyy-MM")


def rolling_fold(df: DataFrame, ts: str, fold: str) -> DataFrame:
    """K5: rows of one fold with their ``role``: the test month ``fold``, the month before it for the threshold,
    all earlier ones to train.  A filter on the month; no row is copied."""
    month, upto = F.date_format(ts, "yyyy-MM"), F.lit(fold)
    role = F.when(month == upto, "test").when(month == _month_before(upto), "threshold").otherwise("train")
    return df.withColumn("role", role).where(month <= upto)


def rolling_origin(df: DataFrame, ts: str, first_test: str, label: str = "y") -> DataFrame:
    """K5: (fold, role, rows, positives) of every month >= first_test as a test month: one aggregate by month,
    then running sums over the months (one row each, so their window is bounded)."""
    m = df.groupBy(F.date_format(ts, "yyyy-MM").alias("fold")).agg(F.count(F.lit(1)).alias("rows"),
                                                                   F.sum(label).cast("long").alias("positives"))
    upto = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.orderBy("fold")
    is_thr = F.lag("fold").over(last) == _month_before(F.col("fold"))
    cols = ("rows", "positives")
    x = m.select("fold", *cols, *[F.when(is_thr, F.lag(c).over(last)).alias(f"thr_{c}") for c in cols],
                 *[F.sum(c).over(upto).alias(f"all_{c}") for c in cols]).where(F.col("fold") >= first_test)
    roles = F.array(
        F.struct(F.lit("test").alias("role"), *cols),
        F.struct(F.lit("threshold").alias("role"), *[F.col(f"thr_{c}").alias(c) for c in cols]),
        F.struct(F.lit("train").alias("role"), *[(F.col(f"all_{c}") - F.coalesce(f"thr_{c}", F.lit(0))).alias(c) for c in cols]))
    return x.select("fold", F.explode(roles).alias("r")).select("fold", "r.*").where(F.col("rows") > 0)


def stratified_kfold(df: DataFrame, id_col: str, k: int, label: str = "y", seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """K6: fold = (rank in hash order within class) mod k → balanced class counts."""
    x = _class_rank(df, id_col, label, seed)
    return x.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n_class")


def group_kfold(df: DataFrame, group: str, k: int, label: str = "y", seed: int = 42,
                name: str = "fold") -> DataFrame:
    """K7: stratified group k-fold: entities ranked by positive count (then hash) are
    dealt to folds in snake order, so no entity is in two folds and positives are
    spread.  The entity table has one row per entity."""
    ent = df.groupBy(group).agg(F.sum(label).alias("_pos"), F.count(F.lit(1)).alias("_n"))
    ent = ent.withColumn("_ord", -(F.col("_pos").cast("double") * 1e12) +
                         (hash60(group, seed) % 1000000).cast("double"))
    ent = ent.withColumn("_one", F.lit(1))
    ent = prefix_sum(ent, "_ord", ["_one"], tie=[group])
    r = F.col("_one_cum") - 1
    rnd, pos = F.floor(r / k), r % k
    fold = F.when(rnd % 2 == 0, pos).otherwise(k - 1 - pos).cast("int")
    folds = ent.select(group, fold.alias(name))
    return df.join(folds, group)


def holdout(df: DataFrame, by: str, share: float = 0.25, seed: int = 7,
            name: str = "holdout") -> DataFrame:
    """K8: hold out rows (by = row id) or whole entities (by = client) by hash < share."""
    u = (hash60(by, seed) % 1000000) / 1000000.0
    return df.withColumn(name, (u < share).cast("int"))


def fold_disjoint(df: DataFrame, group: str, fold: str = "fold") -> DataFrame:
    """H4 for folds: entities appearing in more than one fold (must be 0)."""
    return df.groupBy(group).agg(F.count_distinct(fold).alias("_f")).agg(
        F.sum(F.when(F.col("_f") > 1, 1).otherwise(0)).cast("long").alias("entities_in_several_folds"))

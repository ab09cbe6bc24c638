"""Data-quality operators (C1–C11) and set operations (H1–H4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.plans.frames import with_scalars


def null_profile(df: DataFrame, cols: list[str] | None = None,
                 nonzero_only: bool = True) -> DataFrame:
    """(column, n_null, pct_null) in one pass."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "n_null")
    long = long.select("column", F.col("n_null").cast("long").alias("n_null"),
                       F.when(F.col("_n") > 0, F.col("n_null") * 100.0 / F.col("_n"))
                       .alias("pct_null"))
    return long.where(F.col("n_null") > 0) if nonzero_only else long


def _as_text(df: DataFrame, col: str) -> Column:
    """A value as text, equal where the values are equal and only there."""
    kind, c = df.schema[col].dataType, F.col(f"`{col}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")  # -0.0 is 0.0
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.StructType)) else c.cast("string")


def distinct_counts(df: DataFrame, cols: list[str] | None = None,
                    approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values per column (nulls not counted); approximate for wide/huge tables.

    Exact: (column, value) pairs are made distinct, in the tasks first and then by pair, so every column's
    values spread over all tasks, and the distinct pairs are counted.  No distinct aggregates side by side."""
    cols = cols or df.columns
    if approx:
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), rsd).cast("long").alias(c) for c in cols])
        return row.unpivot([], [f"`{c}`" for c in cols], "column", "n_distinct")
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), _as_text(df, c).alias("value")) for i, c in enumerate(cols)])
    seen = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).groupBy("at", "value").agg(F.lit(1).alias("_one"))
    counts = seen.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    # the list of columns, so that one without values counts 0
    names = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("at"), F.element_at(F.array(*[F.lit(c) for c in cols]), (F.col("id") + 1).cast("int")).alias("column"))
    return names.join(counts, "at", "left").select("column", F.coalesce("n", F.lit(0)).cast("long").alias("n_distinct"))


def distinct_sketches(df: DataFrame, cols: list[str] | None = None, lg_k: int = 14) -> DataFrame:
    """C3 as mergeable sketches: (column, sketch) in one pass, a few KB a column.  Sketches of further parts of a table
    are unioned with these and counted by ``sketch_counts``; the relative standard error is about 1.04 / sqrt(2 ** lg_k), 0.8 % here."""
    cols = cols or df.columns
    # the mark in front is for empty texts, which a sketch leaves out
    row = df.agg(*[F.hll_sketch_agg(F.concat(F.lit("="), _as_text(df, c)), lg_k).alias(f"s{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])).alias("x")).select("x.*")


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """(column, n_distinct) of the union of all sketches of a column, e.g. one for each day."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def duplicate_groups(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Exact-duplicate groups: (cols…, multiplicity) with multiplicity > 1 (null-safe)."""
    cols = cols or df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("multiplicity")) \
        .where(F.col("multiplicity") > 1)


def duplicate_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C4: rows, duplicate rows (extra copies), rows involved, groups."""
    g = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("m"))
    return g.agg(
        F.sum("m").cast("long").alias("rows"),
        F.sum(F.when(F.col("m") > 1, F.col("m") - 1).otherwise(0)).cast("long").alias("extra_copies"),
        F.sum(F.when(F.col("m") > 1, F.col("m")).otherwise(0)).cast("long").alias("rows_involved"),
        F.sum(F.when(F.col("m") > 1, 1).otherwise(0)).cast("long").alias("duplicate_groups"),
    )


def multiplicity_histogram(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """C4: how many groups appear exactly m times (m >= 1)."""
    g = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("multiplicity"))
    return g.groupBy("multiplicity").agg(F.count(F.lit(1)).alias("groups"),
                                         F.sum("multiplicity").cast("long").alias("rows"))


def dedupe_label_report(df: DataFrame, label: str = "y") -> DataFrame:
    """C5 + C6: rows and positives before / after exact-duplicate removal."""
    after = df.dropDuplicates()
    b = df.agg(F.count(F.lit(1)).alias("rows_before"),
               F.sum(label).cast("long").alias("positives_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"),
                  F.sum(label).cast("long").alias("positives_after"))
    return with_scalars(b, a)


def recoverability(df: DataFrame, key: str, col: str) -> DataFrame:
    """Entities with a null in ``col``; of those, how many have a value in another row."""
    g = df.groupBy(key).agg(F.max(F.col(col).isNull().cast("int")).alias("has_null"),
                            F.max(F.col(col).isNotNull().cast("int")).alias("has_value"))
    return g.agg(
        F.sum("has_null").cast("long").alias("entities_with_null"),
        F.sum(F.col("has_null") * F.col("has_value")).cast("long").alias("recoverable"),
        F.sum(F.col("has_null") * (1 - F.col("has_value"))).cast("long").alias("unrecoverable"),
    )


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows matching each named condition, count and % of rows, one pass."""
    names = list(rules)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.when(rules[k], 1).otherwise(0)).cast("long").alias(f"_r{i}")
                   for i, k in enumerate(names)])
    s = row.select("_n", F.explode(F.array(*[
        F.struct(F.lit(k).alias("check"), F.col(f"_r{i}").alias("n"))
        for i, k in enumerate(names)])).alias("s")).select("_n", "s.*")
    return s.select("check", "n", F.when(F.col("_n") > 0, F.col("n") * 100.0 / F.col("_n"))
                    .alias("pct_rows"))


def co_null_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """C11: rows where all listed columns are null at once."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNull()
    return df.agg(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias("rows_all_null"))


def reconcile(a: DataFrame, b: DataFrame, key: list[str], cols: list[str],
              tol: float = 1e-9) -> DataFrame:
    """Row-aligned comparison of two datasets on a key (full outer join).

    Returns counts: rows in each, missing on either side, and per column the
    number of rows whose values differ by more than ``tol`` (null-safe).
    """
    aa = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in cols]).withColumn("_in_a", F.lit(1))
    bb = b.select(*key, *[F.col(c).alias(f"b_{c}") for c in cols]).withColumn("_in_b", F.lit(1))
    j = aa.join(bb, key, "full_outer")
    aggs = [F.sum(F.coalesce("_in_a", F.lit(0))).cast("long").alias("rows_a"),
            F.sum(F.coalesce("_in_b", F.lit(0))).cast("long").alias("rows_b"),
            F.sum(F.when(F.col("_in_b").isNull(), 1).otherwise(0)).cast("long").alias("only_in_a"),
            F.sum(F.when(F.col("_in_a").isNull(), 1).otherwise(0)).cast("long").alias("only_in_b")]
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    for c in cols:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        if dict(a.dtypes)[c] in ("double", "float", "int", "bigint", "smallint", "tinyint"):
            differs = ~x.eqNullSafe(y) & (x.isNull() | y.isNull() | (F.abs(x - y) > tol))
        else:
            differs = ~x.eqNullSafe(y)
        aggs.append(F.sum(F.when(both & differs, 1).otherwise(0)).cast("long")
                    .alias(f"mismatch_{c}"))
    return j.agg(*aggs)


# ------------------------------------------------------------------ sets
def union_by_name(*dfs: DataFrame) -> DataFrame:
    """H1."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """H2: distinct rows of a not in b."""
    return a.subtract(b)


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """H3."""
    return a.intersect(b)


def disjoint(a: DataFrame, b: DataFrame) -> DataFrame:
    """H4: one row, ``disjoint`` true when the two sets share no row."""
    return a.intersect(b).agg((F.count(F.lit(1)) == 0).alias("disjoint"),
                              F.count(F.lit(1)).alias("shared"))

"""Last-value carry over chunks of a key's rows.

"The last value seen so far" is a running statistic like a sum: each chunk
``(key, chunk)`` is summed up by its first and its last non-null value, these
summaries are scanned over the chunks of the key, and a row that finds no value
in its own chunk takes the one that the scan carried in.  Row-level windows are
partitioned by (key, chunk), so one key with most of the rows is spread over as
many tasks as it has chunks; only the summaries, one row a chunk, meet by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: chunk of the rows that have no place in time; they come last
LAST_CHUNK = 1 << 62


def rank_of(order: list[str]) -> Column:
    """Place of a row as one value that compares like the columns of ``order``, nulls last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def join_offsets(rows: DataFrame, offsets: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``offsets``; null keys meet null keys, as in a window."""
    right = offsets.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in offsets.columns if c not in on])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return rows.join(right, same, "left").drop(*[f"_r_{c}" for c in on])


def carry_both(df: DataFrame, key: str, order: list[str], chunk: Column, cols: list[str]) -> DataFrame:
    """Add ``_back_<i>`` and ``_ahead_<i>`` for each of ``cols``: the nearest non-null value at or before the row,
    and at or after it, among the rows of the same key in ``order`` (nulls last).

    ``chunk`` must not fall along ``order``; null where the first column of ``order`` is null.
    """
    base = df.withColumn("_chunk", F.coalesce(chunk.cast("long"), F.lit(LAST_CHUNK))).withColumn("_rank", rank_of(order))
    by = [key, "_chunk"]
    so_far = Window.partitionBy(*by).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    # the value ahead is the last one seen in reverse order: running frames only, linear in the rows
    from_end = Window.partitionBy(*by).orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = base.select("*", *[F.last(c, True).over(so_far).alias(f"_in_back_{i}") for i, c in enumerate(cols)],
                       *[F.last(c, True).over(from_end).alias(f"_in_ahead_{i}") for i, c in enumerate(cols)])

    ends = []
    for i, c in enumerate(cols):
        at = F.when(F.col(c).isNotNull(), F.col("_rank"))
        ends += [F.max_by(c, at).alias(f"_last_{i}"), F.min_by(c, at).alias(f"_first_{i}")]
    chunks = base.groupBy(*by).agg(*ends)
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key).orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(*by, *[F.last(f"_last_{i}", True).over(earlier).alias(f"_off_back_{i}") for i in range(len(cols))],
                            *[F.last(f"_first_{i}", True).over(later).alias(f"_off_ahead_{i}") for i in range(len(cols))])
    out = join_offsets(rows, offsets, by)
    return out.select(*df.columns, *[F.coalesce(f"_in_{w}_{i}", f"_off_{w}_{i}").alias(f"_{w}_{i}") for i in range(len(cols)) for w in ("back", "ahead")])

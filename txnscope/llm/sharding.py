"""Shards of near-equal bytes by sampled splitters.

Records are ordered by (hash of the text, id), so copies lie together.  A sample in
which a record's chance follows its size gives quantile boundaries; records go to the
ranges between them, and a range found overfull once all its bytes are counted gets
splitters of its own.  Within ranges a running sum, and between ranges a prefix sum over
their totals, give each record its exact place; a shard is the records whose middle lies
in its share of all bytes.  Copies are apart only where a boundary runs through them.
A record over a shard's share has a shard of its own, and the others share what is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.llm.tables import NO_ID, keyed, pieces_for
from txnscope.plans.frames import materialize

OVERHEAD = 16  # bytes of a record besides its text
SAMPLES_A_RANGE = 32
ROUNDS = 4


def records(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, size, text_crc32, place): what placing needs of each row; a null text has no bytes."""
    return keyed(df, id_col, text_col).select(
        "key", (F.octet_length("text") + OVERHEAD).cast("long").alias("size"), F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("place"))


def _sample(rows: DataFrame, expected: int, seed: int) -> tuple[list[tuple[int, int, float]], int]:
    """[(place, key, weight), ...] in order, about ``expected`` by size; and the bytes of all rows."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = F.col("size") * F.lit(expected / max(1, total))
    draw = F.pmod(F.xxhash64("place", "key", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    step = total / expected if expected else 0.0
    taken = rows.where(draw < share).select("place", "key", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("weight")).collect()
    return sorted((r["place"], r["key"], r["weight"]) for r in taken), total


def _quantiles(sample: list[tuple[int, int, float]], ranges: int) -> list[tuple[int, int]]:
    weight = np.array([w for _, _, w in sample])
    if not len(weight) or ranges < 2:
        return []
    upto = np.cumsum(weight)
    at = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
    return sorted({sample[int(i)][:2] for i in at})


def ranged(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``range``: how many splitters are not after (place, key)."""
    places = np.array([p for p, _ in splitters], dtype=np.int64)
    keys = np.array([k for _, k in splitters], dtype=np.int64)
    names = rows.columns

    def run(batches):
        for batch in batches:
            place, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "key"))
            low, high = np.searchsorted(places, place, side="left"), np.searchsorted(places, place, side="right")
            for i in np.unique(low[low < high]).tolist():  # splitters inside a group of copies: the key decides
                here = np.flatnonzero((low == i) & (low < high))
                end = int(high[here[0]])
                low[here] = i + np.searchsorted(keys[i:end], key[here], side="right")
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(low.astype(np.int32))], names=[*names, "range"])

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", range int")


def balanced_ranges(rows: DataFrame, ranges: int) -> tuple[DataFrame, list]:
    """``rows`` in about ``ranges`` ranges of like bytes; ranges over twice their share are divided again."""
    sample, total = _sample(rows, ranges * SAMPLES_A_RANGE, 1)
    splitters = _quantiles(sample, ranges)
    sizes: list = []
    for attempt in range(ROUNDS):
        placed = ranged(rows, splitters)
        sizes = sorted(tuple(r) for r in placed.groupBy("range").agg(F.sum("size"), F.count("*"), F.max("size")).collect())
        full = {r: b for r, b, n, most in sizes if n > 1 and b > 2 * total / ranges + most}
        if not full or attempt == ROUNDS - 1:
            return placed, sizes
        for r, b in full.items():
            parts = int(np.ceil(b * ranges / total)) + 1
            more, _ = _sample(placed.where(F.col("range") == r), parts * SAMPLES_A_RANGE, attempt + 2)
            splitters += _quantiles(more, parts)
        splitters = sorted(set(splitters))
    return ranged(rows, splitters), sizes


def oversize(rows: DataFrame, shards: int) -> tuple[int | None, int]:
    """(size, n): the n records of at least this size are each over an even share of what is left without the larger ones,
    so each has a shard of its own; (None, 0) where no record is.  Equal sizes go together: a share only falls when such
    a record leaves.  Fewer than ``shards`` records can be like this, so that many sizes are looked at."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    cut, left = None, shards
    for r in rows.select("size").orderBy(F.desc("size")).limit(shards).collect():
        if r["size"] * left <= total:
            break
        cut, total, left = r["size"], total - r["size"], left - 1
    return cut, shards - left


def assign_shards(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, size, text_crc32, place, shard, slot) of every row, by bytes.

    Slots are gapless from 0 in each shard.  A null id is ``NO_ID`` and sorts first, a null text has the overhead
    only, repeated rows have a slot each, an empty table gives no rows, other columns are not read.  A record over a
    shard's share is alone in one of the last shards; with at least as many rows as shards none is empty.
    """
    everything = materialize(records(df, id_col, text_col), "shard-records")
    cut, alone = oversize(everything, shards)
    rows = everything if cut is None else everything.where(F.col("size") < cut)
    rest = shards - alone
    ranges = pieces_for(rows, 16.0, shards)
    placed, sizes = balanced_ranges(rows, ranges)
    spark = df.sparkSession
    before, bytes_before, rows_before = [], 0, 0  # a row for each range, a bounded parameter
    for r, b, n, _ in sizes:
        before.append((int(r), bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + b, rows_before + n
    offsets = spark.createDataFrame(before, "range int, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("place", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("bytes_before") * 2 + F.coalesce(F.sum("size").over(order), F.lit(0)) * 2 + F.col("size")
    out = placed.join(F.broadcast(offsets), "range").select(
        "key", "size", "text_crc32", "place",
        F.least(F.lit(rest - 1), F.floor(middle * rest / F.lit(2 * max(1, bytes_before)))).cast("int").alias("shard"),
        (F.col("rows_before") + F.count("*").over(order)).alias("nth"))
    out = materialize(out, "shard-places")
    first = out.groupBy("shard").agg(F.min("nth").alias("first"))  # at most ``shards`` rows
    out = out.join(F.broadcast(first), "shard").select("key", "size", "text_crc32", "place", "shard", (F.col("nth") - F.col("first")).alias("slot"))
    if cut is None:
        return out
    by_size = Window.partitionBy(F.lit(0)).orderBy(F.desc("size"), "place", "key")  # fewer than ``shards`` rows
    large = everything.where(F.col("size") >= cut).select("key", "size", "text_crc32", "place", (F.row_number().over(by_size) - 1 + rest).cast("int").alias("shard"),
                                                          F.lit(0).cast("long").alias("slot"))
    return out.unionByName(large)


def write_shards(df: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``df`` as one folder of Parquet files for each shard; the columns ``shard`` and ``slot`` are added (and replace such)."""
    placed = assign_shards(df, shards, id_col, text_col).select("key", "place", "shard", "slot")
    nth = Window.partitionBy("key", "place").orderBy("slot")
    placed = placed.withColumn("nth", F.row_number().over(nth))
    rows = keyed(df, id_col, text_col).withColumn("place", F.xxhash64("text"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key", "place").orderBy("key")))
    kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("shard", "slot")]
    rows.join(placed, ["key", "place", "nth"]).select(*kept, "shard", "slot") \
        .repartition("shard", F.floor(F.col("slot") / 100_000)).write.partitionBy("shard").parquet(path)


def sharded_digest(df: DataFrame, shards: int = 40) -> DataFrame:
    out = assign_shards(df, shards)
    return out.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

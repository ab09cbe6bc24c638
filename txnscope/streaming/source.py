"""Chronological file source and stream runner.

``time_slices`` replays a table as a feed (a stand-in for a real one): each step
delivers some time slices, oldest first, into the folder that a file stream reads.
``run_to_table`` runs the query to completion (``trigger(availableNow=True)``) after
each step, from one checkpoint.  A step is one micro-batch, however many files its
slices have; order is the state processor's, which holds rows until the watermark has
passed them.  ``end_feed`` ends a finite replay: it pushes the watermark past all rows.  The state store provider that
the processors need is set where a query starts and restored afterwards.  All folders
live under the shared checkpoint directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.session import scratch_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def state_provider(spark: SparkSession) -> Iterator[None]:
    """Several state variables per operator need the RocksDB provider; the caller's setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def time_slices(df: DataFrame, ts: str, path: str, slice_days: int = 3, per_step: int = 1,
                start: str | None = None, end: str | None = None, ends: bool = False) -> Iterator[int]:
    """Deliver ``df`` into ``path`` as one parquet folder per time slice, oldest first,
    ``per_step`` slices before each yield (of how many are there); optional [start, end) filter.
    ``ends``: the last step also delivers the end of the feed.

    The input is read once: it is staged partitioned by slice in the checkpoint
    folder, then each slice folder is copied from its own partition (pruned read).  The
    slice list is one value per slice (bounded)."""
    x = df
    if start:
        x = x.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end:
        x = x.where(F.col(ts) < F.lit(end).cast("timestamp"))
    x = x.withColumn("_slice", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / (86400 * slice_days)))
    spark = df.sparkSession
    staged = scratch_path(spark, f"slices-staged-{uuid.uuid4().hex[:12]}")
    x.write.mode("overwrite").partitionBy("_slice").parquet(staged)
    st = spark.read.schema(x.schema).parquet(staged)
    slices = sorted(r[0] for r in st.select("_slice").distinct().collect())
    for i, s in enumerate(slices, 1):
        deliver(st.where(F.col("_slice") == s).select(*df.columns), path, f"{i:06d}")
        if ends and i == len(slices):
            end_feed(spark, path, df.schema, ts)
        if i % per_step == 0 or i == len(slices):
            yield i


def deliver(df: DataFrame, path: str, name: str) -> None:
    """One more slice folder of the feed."""
    df.write.mode("overwrite").parquet(f"{path}/slice={name}")


#: fixed value: a time after all rows of any feed
FEED_END = "9000-01-01"


def end_feed(spark: SparkSession, path: str, schema, ts: str = "ts") -> None:
    """The end of a finite feed: one row with nothing but a far time, so that the watermark passes all rows.
    Streams drop it after their watermark; rows delivered later come behind the watermark."""
    mark = spark.range(1).select(*[(F.lit(FEED_END) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    deliver(mark, path, "end")


def without_marks(stream: DataFrame, row_id: str, ts: str = "ts") -> DataFrame:
    """A watermarked stream without the marks of ``end_feed`` (rows without an id).  The condition names the
    time, so the optimizer leaves it above the watermark: marks move it before they go."""
    return stream.where(F.col(row_id).isNotNull() | F.col(ts).isNull())


def read_slices(spark: SparkSession, path: str, schema) -> DataFrame:
    """Streaming read of a feed; every file that is there is in the next micro-batch."""
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/slice=000000")
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def run_to_table(stream: DataFrame, path: str, output_mode: str = "append",
                 feed: Iterable = (None,), fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Run a stream to completion (availableNow) after each step of ``feed`` into a file sink
    and read it back."""
    spark = stream.sparkSession
    with state_provider(spark):
        for _ in feed:
            q = (stream.writeStream.format(fmt).outputMode(output_mode)
                 .option("checkpointLocation", f"{path}/_checkpoint").option("path", f"{path}/out")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(fmt).load(f"{path}/out")


def run_upserts(stream: DataFrame, path: str, keys: list[str], feed: Iterable = (None,)) -> DataFrame:
    """Run an aggregating stream in update mode; every micro-batch writes its updated rows
    under its batch id (a retried batch replaces its own folder), and the result keeps the
    latest version of each key (an upsert without a table format)."""
    def sink(batch_df, batch_id):
        batch_df.write.mode("overwrite").parquet(f"{path}/out/_batch={batch_id}")

    with state_provider(stream.sparkSession):
        for _ in feed:
            q = (stream.writeStream.outputMode("update").foreachBatch(sink)
                 .option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True).start())
            q.awaitTermination()
    out = stream.sparkSession.read.option("basePath", f"{path}/out").parquet(f"{path}/out/_batch=*")
    cols = [c for c in out.columns if c not in keys and c != "_batch"]
    latest = out.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("_v"))
    return latest.select(*keys, "_v.*")

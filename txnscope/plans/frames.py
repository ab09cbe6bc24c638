"""Small DataFrame helpers shared by operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# fixed value: nudge added before rounding so that exact decimal halves
# (which the two engines may land on from either side by one ulp) round alike
ROUND_NUDGE = 1e-9


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (for value-hash comparison with an oracle).

    ``round(x + 1e-9, 6) + 0.0`` — the same rule is used in the SQL oracles
    (see ``r6`` in the registry); ``+ 0.0`` turns -0.0 into 0.0.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{f.name}`").cast("double")
            cols.append((F.round(c + F.lit(ROUND_NUDGE), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def unpivot(df: DataFrame, ids: list[str], values: list[str], var: str = "variable",
            val: str = "value", cast: str | None = "double") -> DataFrame:
    """Wide → long (variable, value) without a row-level shuffle."""
    src = df
    if cast:
        src = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in values])
    return src.unpivot(ids, values, var, val)


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    ``scalars`` must be a global aggregate (exactly one row), so broadcasting
    it is bounded by construction; the join is an equi-join on a constant.
    """
    key = "__scalar_key"
    return (df.withColumn(key, F.lit(1))
            .join(F.broadcast(scalars.withColumn(key, F.lit(1))), key)
            .drop(key))


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Keep exactly ``columns`` in that order; missing ones become ``fill``."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in columns])


def safe_div(a: Column, b: Column, default=None) -> Column:
    d = F.lit(default) if default is not None else F.lit(None)
    return F.when(b != 0, a / b).otherwise(d)


def write_scratch(df: DataFrame, name: str) -> str:
    """Write ``df`` as parquet in the shared checkpoint folder; return the path."""
    import uuid

    from txnscope.session import scratch_path

    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of a table reused by several branches: write it as parquet in
    the shared checkpoint folder (``spark.checkpoint.dir``) and read it back.  A lost
    executor then only costs re-reading files, not re-running the upstream shuffles."""
    return df.sparkSession.read.parquet(write_scratch(df, name))


#: bytes of input files for each shuffle partition, bytes that a task reads from shuffles and from files
PIECE, SHUFFLED, READ = 2 << 20, 16 << 20, 32 << 20


@contextmanager
def shuffles_by_size(*inputs: DataFrame):
    """Plans that are made and run inside have shuffle partitions by the size of the files of ``inputs`` (at least the
    session's number; adaptive execution joins small ones) and small tasks, so a task's sorts and windows don't grow with the
    input.  For tables that are written inside; the session's settings are back afterwards."""
    spark = inputs[0].sparkSession
    size = sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in names}
    inside = (max(int(before[names[0]]), size // PIECE + 1), f"{min(as_bytes(before[names[1]]), SHUFFLED)}b", f"{min(as_bytes(before[names[2]]), READ)}b")
    try:
        for k, v in zip(names, inside):
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_WRITTEN: dict[tuple, str] = {}


def _files_state(spark, part) -> tuple:
    """Names, sizes and times of the files in a folder, where ``part`` is one."""
    if not isinstance(part, str) or "/" not in part:
        return ()
    path = spark._jvm.org.apache.hadoop.fs.Path(part)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in system.listStatus(path)))


def materialize_once(spark, key: tuple, build) -> DataFrame:
    """``materialize(build())`` once per application and key (e.g. (name, input folder)) while the files
    right in the key's folders stay as they are; later calls read the written table.  For tables derived only from
    the key's inputs."""
    k = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", ""), *key, *[_files_state(spark, p) for p in key])
    if k not in _WRITTEN:
        _WRITTEN[k] = write_scratch(build(), str(key[0]))
    return spark.read.parquet(_WRITTEN[k])

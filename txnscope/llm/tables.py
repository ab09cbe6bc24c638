"""Small Spark helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = -(1 << 63)  # stands for a null id: sorts first


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Arrow batches between Spark and Python hold at most so many rows and bytes, so long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df`` (for files, their size)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces_for(df: DataFrame, mb: float, least: int = 8) -> int:
    """How many pieces of about ``mb`` MB the table makes; at least the number of shuffle partitions.

    The estimate of files is their size; that of other tables can be no estimate at all, so it is then measured.
    """
    size = input_bytes(df)
    if size > 1 << 56:
        wide = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
        size = df.agg(F.sum(sum(wide, F.lit(8 * len(df.columns)).cast("long")))).first()[0] or 0
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size / (mb * 1e6)) + 1)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, key, text): all columns as one struct, the id with nulls first, the text with null as empty.

    Packing the input's columns into ``row`` keeps names that clash with those of an operator apart.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("key"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def with_columns(df: DataFrame, columns: list[str], **new) -> DataFrame:
    """``row``'s columns, with those of ``new`` replaced or added."""
    kept = [F.col(f"row.`{c}`").alias(c) for c in columns if c not in new]
    return df.select(*kept, *[v.alias(k) for k, v in new.items()])


def _nullable(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(_nullable(kind.value_type))
    if pa.types.is_map(kind):
        return pa.map_(_nullable(kind.key_type), _nullable(kind.item_type))
    return kind


def relaxed(column: pa.Array | pa.ChunkedArray) -> pa.Array | pa.ChunkedArray:
    """The column with nullable fields, as a schema written in DDL declares them."""
    kind = _nullable(column.type)
    return column if kind.equals(column.type, check_metadata=False) else column.cast(kind)

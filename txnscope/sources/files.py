"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "|",
                   encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """A1: delimited text read with an explicit all-string schema (no inference);
    typing is done afterwards with the total ``try_*`` parsers."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
            .option("header", header).option("mode", "PERMISSIVE").csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = "|", encoding: str = "ISO-8859-1") -> None:
    """Write a delimited text export (the inverse of A1)."""
    df.write.mode("overwrite").option("sep", sep).option("encoding", encoding) \
        .option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A3: curated table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A3: read a curated CSV back with its schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """A4: parquet partitioned by period (enables partition pruning on reads)."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A5: report rows as JSON (nested structs/arrays kept)."""
    df.write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append decision / prediction records as JSON lines."""
    df.write.mode("append").json(path)


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-insensitive table fingerprint of 16 hex digits: a hash of the row count, the XOR
    of 64-bit row hashes and the sum of a second row hash (pairs of equal rows cancel in the XOR
    but not in the sum).  Independent of partitioning and row order."""
    cols = cols or df.columns
    h = F.xxhash64(*[F.col(f"`{c}`") for c in cols])
    second = F.xxhash64(h, F.lit(1)).cast("decimal(38,0)")
    parts = df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("_x"), F.sum(second).alias("_s"))
    digest = F.xxhash64("rows", F.coalesce("_x", F.lit(0)), F.coalesce(F.col("_s").cast("string"), F.lit("")))
    return parts.select("rows", F.lpad(F.lower(F.hex(digest)), 16, "0").alias("fingerprint"))

"""Vectors as exact integers in blocks of rows, shared by the operators on embeddings.

A block is one row of a table: the ids and carried columns of some hundred vectors as
lists, and their components as one binary matrix of int32, so that tasks compare whole
blocks at a time and Spark moves few rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.session import scratch_path


def component_limit(dims: int) -> int:
    """Largest component: beyond it a squared distance would not fit a long (2**27 for 64 components)."""
    return math.isqrt((1 << 62) // max(dims, 1)) // 2


def finite(df: DataFrame, vector_col: str, dims: int | None = None, parts: int = 1) -> DataFrame:
    """Rows whose vector is not null, holds no null, NaN or infinite component, and has ``dims`` components
    (or, without ``dims``, a number that divides into ``parts``, not none)."""
    v = F.col(f"`{vector_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    sized = F.size(v) == dims if dims is not None else (F.size(v) > 0) & (F.size(v) % parts == 0)
    return df.where(v.isNotNull() & sized & ~bad)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of the rows of a matrix of doubles, held within ``component_limit``."""
    limit = component_limit(values.shape[1] if values.ndim > 1 else 1)
    return np.clip(np.floor(values.astype(np.float64) * scale), -limit, limit).astype(np.int32)


def matrix(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept, components): which rows of a list column have ``dims`` finite components, and those as integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).cast(pa.float64())
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    right = lengths == dims
    inside = np.repeat(right, np.maximum(lengths, 0))
    rows = values[inside].reshape(-1, dims)
    whole = np.isfinite(rows).all(axis=1) if dims else np.ones(int(right.sum()), dtype=bool)
    kept = np.flatnonzero(right)[whole]
    return kept, integers(rows[whole], scale)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, rows of c) as int64; in floating point where every sum is below 2**53."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(c)), dtype=np.int64)
    for j in range(len(c)):
        diff = x.astype(np.int64) - c[j].astype(np.int64)
        out[:, j] = (diff * diff).sum(1)
    return out


def packed(values: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def unpacked(cell, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(cell.as_py() if isinstance(cell, pa.Scalar) else cell, dtype=kind).reshape(shape)


class Scratch:
    """Written tables of one operator in the shared checkpoint folder; a table goes once no reader is left."""

    def __init__(self, spark, name: str):
        import uuid

        self.spark, self.base, self.made = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}"), 0

    def write(self, df: DataFrame) -> tuple[str, DataFrame]:
        path = f"{self.base}/{self.made}"
        self.made += 1
        df.write.option("compression", "zstd").parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Delete a table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

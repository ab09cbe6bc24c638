"""Versioned model registry.

Layout under ``root``: ``models/v=N`` (saved ``PipelineModel``),
``versions`` (one metadata row per version: metrics, params, threshold, rows,
feature list, data fingerprint) and ``pointer`` (append-only promotion
events).  The current version is the latest promotion event.  The registry
holds a handful of metadata rows, so reading it on the driver is bounded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_SCHEMA = ("version int, created_at string, threshold double, rows long, "
                  "features array<string>, metrics map<string,double>, params map<string,string>, "
                  "data_fingerprint string")
POINTER_SCHEMA = "version int, action string, at string, reason string"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(1).collect()
        return True
    except AnalysisException as e:  # a missing folder only; any other read error is the caller's to see
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def versions(spark: SparkSession, root: str) -> DataFrame:
    if _exists(spark, f"{root}/versions"):
        return spark.read.parquet(f"{root}/versions")
    return spark.createDataFrame([], VERSION_SCHEMA)


def next_version(spark: SparkSession, root: str) -> int:
    v = versions(spark, root).agg(F.max("version")).collect()[0][0]
    return (v or 0) + 1


def register(spark: SparkSession, root: str, model: PipelineModel, threshold: float, rows: int,
             features: list[str], metrics: dict[str, float], params: dict[str, str],
             data_fingerprint: str, promote: bool = True, reason: str = "initial",
             reference: DataFrame | None = None) -> int:
    """Save the model as the next version, with the frozen drift ``reference`` of its training rows if given,
    append its metadata and (optionally) promote it.

    A version's folder is never overwritten: if another writer has taken the number, saving fails."""
    v = next_version(spark, root)
    model.write().save(f"{root}/models/v={v}")
    if reference is not None:
        reference.write.parquet(f"{root}/references/v={v}")
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    row = [(v, now, float(threshold), int(rows), list(features),
            {k: float(x) for k, x in metrics.items()}, {k: str(x) for k, x in params.items()},
            data_fingerprint)]
    spark.createDataFrame(row, VERSION_SCHEMA).write.mode("append").parquet(f"{root}/versions")
    if promote:
        set_current(spark, root, v, reason)
    return v


def set_current(spark: SparkSession, root: str, version: int, reason: str) -> None:
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    spark.createDataFrame([(version, "promote", now, reason)], POINTER_SCHEMA) \
        .write.mode("append").parquet(f"{root}/pointer")


def current_version(spark: SparkSession, root: str) -> int | None:
    if not _exists(spark, f"{root}/pointer"):
        return None
    p = spark.read.parquet(f"{root}/pointer")
    return p.agg(F.max_by("version", F.struct("at", "version"))).collect()[0][0]


def load(spark: SparkSession, root: str, version: int | None = None) -> tuple[PipelineModel, dict]:
    """Load the given (or current) version with its metadata."""
    v = version or current_version(spark, root)
    meta = versions(spark, root).where(F.col("version") == v).collect()[0].asDict()
    return PipelineModel.load(f"{root}/models/v={v}"), meta


def load_reference(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The drift reference frozen with the given (or current) version."""
    return spark.read.parquet(f"{root}/references/v={version or current_version(spark, root)}")

"""Registry of named queries: a Spark callable plus, when the operator can be
written in SQL, an equivalent DuckDB query over the same parquet tables.

Doubles are rounded to 6 places on both sides (the two engines differ in the
last bits of some floating aggregates).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnscope.plans.frames import round_doubles
from txnscope.sources.tables import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def expand_r6(sql: str) -> str:
    """Expand ``r6(expr)`` into the shared rounding rule of ``round_doubles``."""
    out, i = [], 0
    while True:
        j = sql.find("r6(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 3])
            i = j + 3
            continue
        depth, k = 1, j + 3
        while depth:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
            k += 1
        inner = expand_r6(sql[j + 3:k - 1])
        out.append(sql[i:j])
        out.append(f"(round(({inner}) + 1e-9, 6) + 0.0)")
        i = k


def query(name: str, sql: str | None = None, views: bool = True):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            sql_x = expand_r6(sql)
            ORACLES[name] = with_views(sql_x) if views else sql_x
        return fn

    return deco

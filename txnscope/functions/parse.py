"""Parsing and typing of raw transaction text.

All parsers are total: malformed input gives null (ANSI mode makes the plain
casts raise, so the ``try_*`` forms are used).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decimal_comma(x: str | Column) -> Column:
    """B1: '1234,56' → 1234.56 (null when not a number)."""
    return F.regexp_replace(_c(x), ",", ".").try_cast("double")


def date_yymmdd(x: str | Column) -> Column:
    """B2: '240131' → 2024-01-31."""
    return F.try_to_date(_c(x), "yyMMdd") if hasattr(F, "try_to_date") else \
        F.to_date(F.try_to_timestamp(_c(x), F.lit("yyMMdd")))


def date_ddmmyyyy(x: str | Column) -> Column:
    """B3: '31/01/1980' → 1980-01-31."""
    return F.to_date(F.try_to_timestamp(_c(x), F.lit("dd/MM/yyyy")))


def time_hhmmss(x: str | Column) -> Column:
    """Int-like 'hhmmssxx', unpadded → 'HHmmss' text of the first six
    digits after zero padding to 8; null when not a valid time of day."""
    six = F.substring(F.lpad(_c(x).cast("string"), 8, "0"), 1, 6)
    ok = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), six), F.lit("yyyy-MM-dd HHmmss"))
    return F.when(ok.isNotNull(), six)


def event_timestamp(date: str | Column, hhmmss: str | Column) -> Column:
    """Date + 'HHmmss' → timestamp without zone; null if either is null."""
    return F.try_to_timestamp(F.concat(F.date_format(_c(date), "yyyy-MM-dd"), F.lit(" "),
                                       _c(hhmmss)), F.lit("yyyy-MM-dd HHmmss")).cast("timestamp_ntz")


def binary_label(x: str | Column, positive: str = "SI", negative: str = "NO") -> Column:
    """Two literals → 1 / 0; any other value → null."""
    return F.when(_c(x) == positive, 1).when(_c(x) == negative, 0)


def bools_to_int(df, cols: list[str] | None = None):
    """Boolean columns → int (all boolean columns when ``cols`` is None)."""
    cols = cols or [n for n, t in df.dtypes if t == "boolean"]
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("int"))
    return df


def recode(x: str | Column, mapping: dict) -> Column:
    """Replace listed values, keep the rest."""
    out = None
    for k, v in mapping.items():
        out = (F.when(_c(x) == k, F.lit(v)) if out is None else out.when(_c(x) == k, F.lit(v)))
    return out.otherwise(_c(x)) if out is not None else _c(x)


def fill_literal(x: str | Column, value) -> Column:
    """Null → explicit category."""
    return F.coalesce(_c(x), F.lit(value))

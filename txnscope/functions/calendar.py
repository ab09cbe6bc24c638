"""Date/time derived columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: weekday names (Monday first), as shown in the reports
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# fixed values: five time-of-day bands [from, to) in hours, with their labels
FIVE_BANDS = [(0, 6, "Madrugada (00-06)"), (6, 12, "Mañana (06-12)"),
              (12, 15, "Mediodía (12-15)"), (15, 19, "Tarde (15-19)"),
              (19, 24, "Noche (19-24)")]

# fixed values: four bands used by the segment report (hours 0-5, 6-11, 12-17, 18-23)
FOUR_BANDS = [(0, 6, "madrugada"), (6, 12, "manana"), (12, 18, "tarde"), (18, 24, "noche")]

# fixed value: reference date for ages
AGE_REFERENCE_DATE = "2025-01-01"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def hour_of_day(ts) -> Column:
    """B12."""
    return F.hour(_c(ts))


def weekday_mon0(d) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(_c(d))


def weekend_flag(d) -> Column:
    """1 on Saturday/Sunday."""
    return (F.weekday(_c(d)) >= 5).cast("int")


def weekday_name(d) -> Column:
    """Localised weekday name."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.weekday(_c(d)) + 1)


def month_period(d) -> Column:
    """B14: 'yyyy-MM'."""
    return F.date_format(_c(d), "yyyy-MM")


def half_year(d) -> Column:
    """B14: 'yyyy-H1' / 'yyyy-H2'."""
    return F.concat(F.year(_c(d)).cast("string"),
                    F.when(F.month(_c(d)) <= 6, F.lit("-H1")).otherwise(F.lit("-H2")))


def band(hour, bands=FIVE_BANDS) -> Column:
    """Label of the [from, to) band containing ``hour``."""
    h = _c(hour)
    out = None
    for lo, hi, label in bands:
        cond = (h >= lo) & (h < hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def age_years(birth, ref: str = AGE_REFERENCE_DATE) -> Column:
    """floor(days(ref - birth) / 365)."""
    return F.floor(F.datediff(F.lit(ref).cast("date"), _c(birth)) / 365).cast("int")


def cyclic(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2π·x/period."""
    a = _c(x) * (2 * math.pi / period)
    return F.sin(a), F.cos(a)


def log_amount(x) -> Column:
    """log(1 + x)."""
    return F.log1p(_c(x))

"""Code maps, flags, contracts, alert cards and rule predictors
(B10, B11, B20, B21, B23–B25)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: terminal type code → presence label (codes 0..12)
PRESENCE_BY_TERMINAL = {
    0: "Presencial", 1: "Presencial", 2: "Presencial", 3: "No presencial",
    4: "Presencial", 5: "No presencial", 6: "No presencial", 7: "No presencial",
    8: "No presencial", 9: "No presencial", 10: "No presencial",
    11: "No presencial", 12: "Presencial",
}
# fixed value: currency code of dollars
DOLLAR_CODE = 2
# fixed value: label of unmatched merchant categories
NO_CATEGORY = "SIN RUBRO / NO APLICA"
# fixed value: label of a missing terminal city
NO_TERMINAL = "SIN_TERMINAL"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def code_map(x, mapping: dict, default=None) -> Column:
    """Code → label through a literal map; unmapped → ``default``."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    got = F.try_element_at(m, _c(x))
    return F.coalesce(got, F.lit(default)) if default is not None else got


def presence(terminal, default=None) -> Column:
    """B10 with the fixed terminal map; T9: unknown codes → ``default``."""
    return code_map(terminal, PRESENCE_BY_TERMINAL, default)


def eq_flag(x, value) -> Column:
    """1 when equal, else 0 (null stays null)."""
    return (_c(x) == F.lit(value)).cast("int")


def postal_region(x) -> tuple[Column, Column]:
    """First digit of a four-digit postal code, and whether it is in range."""
    c = _c(x)
    return F.floor(c / 1000).cast("int"), c.between(1000, 9999)


def contract_reasons(rules: dict[str, Column]) -> Column:
    """Array of names of the violated rules (``rules`` maps name → bad-row condition)."""
    arr = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return F.filter(arr, lambda r: r.isNotNull())


def split_valid(df, rules: dict[str, Column], col: str = "reasons"):
    """(valid rows, rejected rows with reasons); also works on streams."""
    x = df.withColumn(col, contract_reasons(rules))
    return x.where(F.size(col) == 0).drop(col), x.where(F.size(col) > 0)


def alert_action(score, threshold) -> Column:
    """B24: 'review' when score >= threshold, else 'approve'."""
    return F.when(_c(score) >= threshold, F.lit("review")).otherwise(F.lit("approve"))


def money_text(amount, dollars) -> Column:
    """B23: 'US$ 1.234,56' / '$ 1.234,56' (dot thousands, comma decimals)."""
    us = F.format_number(_c(amount), 2)
    local = F.translate(us, ",.", ".,")
    return F.concat(F.when(_c(dollars) == 1, F.lit("US$ ")).otherwise(F.lit("$ ")), local)


def gap_words(hours) -> Column:
    """Gap in words: under a minute / N minutes / N.N hours."""
    h = _c(hours)
    return (F.when(h < 1 / 60, F.lit("menos de 1 minuto"))
            .when(h < 1, F.concat(F.format_string("%.0f", h * 60), F.lit(" minutos")))
            .otherwise(F.concat(F.format_string("%.1f", h), F.lit(" horas"))))


def first_flagged(cols: list[str], prefix: str, base: str) -> Column:
    """Name of the first one-hot column set to 1 (prefix removed), else the base level."""
    out = None
    for c in cols:
        v = F.lit(c[len(prefix):])
        out = F.when(F.col(c) == 1, v) if out is None else out.when(F.col(c) == 1, v)
    return out.otherwise(F.lit(base)) if out is not None else F.lit(base)

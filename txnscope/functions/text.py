"""Text helpers (B17, B18, B22) as native expressions (no per-row UDF)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters → base letter, built by rule: every code point in
    the Latin blocks whose canonical decomposition is one base letter plus
    combining marks."""
    src, dst = [], []
    ranges = [(0x00C0, 0x0250), (0x1E00, 0x1F00)]
    for lo, hi in ranges:
        for cp in range(lo, hi):
            ch = chr(cp)
            d = unicodedata.normalize("NFD", ch)
            base = "".join(c for c in d if unicodedata.category(c) != "Mn")
            if len(d) > 1 and len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


ACCENTED, UNACCENTED = _accent_table()


def strip_ws(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_text(x) -> Column:
    """Trim whitespace, upper-case, strip accents."""
    return F.translate(F.upper(strip_ws(x)), ACCENTED, UNACCENTED)


def truncate_label(x, n: int) -> Column:
    """Cut to n characters and add '...' when longer."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n)), F.lit("..."))) \
        .otherwise(c)


def readable_names(x, names: dict[str, str], prefixes: dict[str, str]) -> Column:
    """Exact-name map first, then prefix rules ('prefix' → 'label: rest')."""
    c = F.col(x) if isinstance(x, str) else x
    out = None
    for k, v in names.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    for p, label in prefixes.items():
        cond = c.startswith(p)
        val = F.concat(F.lit(label + ": "), F.substring(c, len(p) + 1, 1 << 20))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(c) if out is not None else c

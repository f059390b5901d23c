"""Log-space labels for the success count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_label(x: Column | str) -> Column:
    """Natural log; NULL for x <= 0 (the row and its raw value stay)."""
    x = _c(x)
    return F.when(x > 0, F.ln(x))


def log_label_zero_guard(x: Column | str) -> Column:
    """``x != 0 ? ln(x) : 0.0``.  Negative input has no real log: NULL."""
    x = _c(x)
    return F.when(x == 0, F.lit(0.0)).when(x > 0, F.ln(x))

"""Calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_month(date_col: Column | str) -> Column:
    """Week of month with Sunday-first weeks and one minimal day in week one.

    The first (possibly partial) week of a month is week 1; every Sunday starts
    a new week.  ``dayofweek`` is 1 for Sunday, so the offset of day one inside
    its week is ``dayofweek(first_of_month) - 1``.  Returned as a double.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    first_dow = F.dayofweek(F.trunc(d, "month"))
    return (F.floor((F.dayofmonth(d) + first_dow - 2) / 7) + 1).cast("double")

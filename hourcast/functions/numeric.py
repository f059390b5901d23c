"""Numeric helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_to_long(x: Column | str) -> Column:
    """Truncate a non-negative double toward zero as bigint (no overflow error)."""
    x = _c(x)
    return F.when(x >= 9.2e18, F.lit(9223372036854775807)).otherwise(F.floor(x)).cast("bigint")


# 2**14 + 1: multiplying by it and subtracting again leaves the leading 39 bits of a double.
SPLIT = 16385.0


def round_half_up(x: Column | str, digits: int = 6) -> Column:
    """x to 39 significant bits, then half up at ``digits`` decimals where those are coarser.

    Pure IEEE arithmetic, so every engine that evaluates the same formula on
    the same double returns the same double; ``round`` itself differs between
    engines on decimal ties (half-up on the shortest decimal text vs.
    half-even on the binary value), and long sums differ in their last bits
    with the order of their terms, whatever their size.
    """
    x = _c(x)
    leading = x * F.lit(SPLIT) - (x * F.lit(SPLIT) - x)
    f = float(10 ** digits)
    return F.when(F.abs(leading) < F.lit(1e12), F.floor(leading * F.lit(f) + F.lit(0.5)) / F.lit(f)).otherwise(leading)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (and double arrays) so results compare across engines."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_up(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            cols.append(F.transform(F.col(f.name), lambda v: round_half_up(v, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def canonical(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparison form of a query result: doubles rounded (``round_doubles``),
    dates / timestamps as ISO text and double vectors as ``[v1,...,vn]`` text, so
    the values hash the same whatever client type mapping reads them (Python
    dates vs pandas datetimes, lists vs numpy arrays)."""
    out = round_doubles(df, digits)
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)

    def render(f):
        if isinstance(f.dataType, temporal):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            # Already rounded to `digits`, so fixed-point text has no rounding ties.
            items = F.transform(F.col(f.name), lambda v: F.format_string(f"%.{digits}f", v))
            return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias(f.name)
        return F.col(f.name)
    return out.select(*[render(f) for f in out.schema.fields])

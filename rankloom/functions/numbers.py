"""Numeric column functions that never raise on an empty, constant or null group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def indicator(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(cond, 1).otherwise(0)


def fixed_text(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals; a tie goes to the even digit, as in C and Python formatting."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def percent_text(ratio: Column, digits: int = 2) -> Column:
    return F.concat(fixed_text(ratio * 100, digits), F.lit("%"))


def pearson_from_sums(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column, syy: Column) -> Column:
    """Pearson correlation from moment sums; NULL when a side is constant or there are no rows."""
    var = (n * sxx - sx * sx) * (n * syy - sy * sy)
    return F.when(var > 0, F.try_divide(n * sxy - sx * sy, F.sqrt(var)))

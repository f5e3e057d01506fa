"""Numeric column helpers: zero guards and a rounding both engines agree on."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# From here on a double times its scale has no fraction left to round.
_WHOLE_DOUBLES = float(2 ** 52)


def half_up(col, digits: int = 2) -> Column:
    """Round half up on the binary double: ``floor(x * 10^d + 0.5) / 10^d``;
    a value too large to have such a digit is returned as it is.

    Written with plain IEEE operations so any SQL engine evaluating the
    same formula gets the same bits (SQL ``round`` differs between engines
    at .5 on binary doubles).
    """
    scale = float(10 ** digits)
    x = _c(col).cast("double")
    return F.when(F.abs(x * F.lit(scale)) < _WHOLE_DOUBLES,
                  F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(x)


def at_least_one(col) -> Column:
    """``greatest(x, 1)``: the divisor guard used by every ratio."""
    return F.greatest(_c(col), F.lit(1))


def ratio(num, den, digits: int = 2) -> Column:
    """``round(num / greatest(den, 1))`` as double."""
    return half_up(_c(num).cast("double") / at_least_one(den).cast("double"), digits)


def share_pct(part, total, digits: int = 2) -> Column:
    """``round(100 * part / total)``; a zero total counts as 1."""
    t = _c(total).cast("double")
    t = F.when(t == 0, F.lit(1.0)).otherwise(t)
    return half_up(F.lit(100.0) * _c(part).cast("double") / t, digits)


def money(col) -> Column:
    """An exact decimal sum as double, 0 when there are no rows."""
    return F.coalesce(_c(col).cast("double"), F.lit(0.0))


def count_or_zero(col) -> Column:
    return F.coalesce(_c(col).cast("bigint"), F.lit(0).cast("bigint"))

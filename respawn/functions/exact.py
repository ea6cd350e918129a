"""Arithmetic helpers whose results are reproducible bit-for-bit.

Floating sums depend on the order rows meet, which differs between partitions,
executors and engines. Money is therefore summed as ``decimal(18,2)`` and
durations / counts as integers; a mean is one IEEE division of two exact
values, so every executor layout (and the SQL oracle) yields the same double.
All helpers return Column expressions, so they stay JVM-side inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Exact money value (cents precision); NULL for what it can't hold (not finite, 1e16 or more)."""
    return col(c).try_cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact money sum returned as double (NULL when no row)."""
    return F.sum(money(c)).cast("double")


def money_sum0(c: Column | str) -> Column:
    """Exact money sum, 0.0 when no row qualifies (``sum(when(..)).otherwise(0)``)."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast(MONEY)).cast("double")


def exact_div(num: Column, den: Column) -> Column:
    """num / den as one IEEE division of exact operands; NULL when den is 0 or NULL."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def int_div(a: Column, b: Column) -> Column:
    """Whole part of a / b for integers (long or decimal without fraction) of any size.

    Spark's integral division: no double in between. The quotient is a long.
    """
    return F.call_function("div", a, b)


WHOLE = "decimal(38,0)"


def ratio_round(num: Column, den: Column, digits: int) -> Column:
    """Half-up rounding of num/den to ``digits`` decimals, num and den integers >= 0.

    Whole numbers only: the quotient, then the remainder scaled and rounded, so no float
    formatting rule can move a tie. The divisor and the quotient must have at most 19 digits (any long has), the
    dividend at most 38. NULL when den is 0 or NULL.
    """
    scale = 10 ** digits
    n, d = num.cast(WHOLE), den.cast(WHOLE)
    d = F.when(d > 0, d)
    whole = int_div(n, d)
    rest = (n - (whole.cast("decimal(19,0)") * d.cast("decimal(19,0)")).cast(WHOLE)).cast("decimal(28,0)")
    part = int_div(rest * F.lit(2 * scale).cast("decimal(9,0)") + d, d * F.lit(2).cast("decimal(1,0)"))
    total = whole.cast("decimal(28,0)") * F.lit(scale).cast("decimal(9,0)") + part
    return total.cast("double") / F.lit(float(scale))


def units(x: Column | str, scale: int) -> Column:
    """floor(x * scale + 0.5) as long: a double turned into integer units.

    Plain IEEE operations (no decimal-string rounding), so any engine gives the
    same integer for the same double.
    """
    return F.floor(col(x) * F.lit(float(scale)) + F.lit(0.5)).cast("long")

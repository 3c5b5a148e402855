"""Sums, means and rounding that do not depend on row order.

Money and percentages arrive as doubles.  Adding doubles in a different order
(another partitioning, a retried task) changes the last digits, so aggregates
add decimals and go back to a double once, at the end.  A double becomes the
decimal that its shortest text shows, rounded to ten decimals: what is below
5e-11 counts as 0.  One that a type cannot hold (too large, NaN, infinite)
raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Summands: up to 1e17, to ten decimals.  Sums have ten more digits and can be
#: multiplied by a whole COUNT without losing any.
AMOUNT = "decimal(27,10)"
COUNT = "decimal(10,0)"
SUM = "decimal(37,10)"
#: The sum of AMOUNTs, and an AMOUNT times a COUNT.
TOTAL = "decimal(38,10)"
#: What is rounded is read to eight decimals first, which drops the noise of double arithmetic.
READ = "decimal(38,8)"


def _decimal(c: Column, kind: str) -> Column:
    """A cast that fails on NaN and infinity too, which a plain one turns into NULL."""
    endless = ~(F.abs(c.cast("double")) < float("inf"))  # NaN is above infinity in comparisons
    refuse = F.raise_error(F.lit("not a finite number")).cast(kind)
    return F.when(endless, refuse).otherwise(c.cast(kind))


def rounded(c: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of the value read to eight decimals.

    A decimal is only made near a tie and of large values.  Elsewhere the nearest whole number of
    10^-digits is the same in double arithmetic, whose division gives the double next to the result.
    """
    if digits > 6:
        return F.round(_decimal(c, READ), digits).cast("double")
    unit = F.lit(10.0**digits)
    scaled = c.cast("double") * unit
    plain = (F.abs(scaled) < 1e6) & (F.abs(scaled - F.rint(scaled)) < 0.4)
    # adding 0 turns -0 into 0, which decimals do not have
    return F.when(plain, F.rint(scaled) / unit + F.lit(0.0)).otherwise(F.round(_decimal(c, READ), digits).cast("double"))


def amount(c: Column) -> Column:
    """A value as a decimal whose sum is exact."""
    return _decimal(c, AMOUNT)


def exact_total(c: Column) -> Column:
    """The sum of ``amount``s.

    A value below 1e5 that is the double of a whole number of cents is added as that number.  Others
    are added as decimals.
    """
    cents = F.rint(c.cast("double") * 100)
    whole = (F.abs(cents) < 1e7) & (cents / 100 == c.cast("double"))
    of_cents = F.sum(F.when(whole, cents.cast("long"))).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    others = F.sum(F.when(F.coalesce(whole, F.lit(False)), F.lit(None)).otherwise(amount(c)))
    return F.when(F.count(c) > 0, added(of_cents, others))


def added(a: Column, b: Column) -> Column:
    """The sum of two totals, a NULL one adding 0.  Types one digit wider would cost a decimal place."""
    zero = F.lit(0).cast(SUM)
    return F.coalesce(a.cast(SUM), zero) + F.coalesce(b.cast(SUM), zero)


def exact_sum(c: Column) -> Column:
    return exact_total(c).cast("double")


def exact_mean(c: Column) -> Column:
    return F.try_divide(exact_sum(c), F.count(c))


def rounded_mean(c: Column, digits: int) -> Column:
    return rounded(exact_mean(c), digits)


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; 0 rather than NULL for a group without any."""
    return F.count_if(condition)


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over the rows where the condition holds, other rows adding 0."""
    return exact_sum(F.when(condition, value).otherwise(F.lit(0)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, NULL when whole is 0 or NULL."""
    return rounded(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)

"""Missing-value rules as column expressions.

A frame never carries NaN: an undefined number is NULL, so that comparisons and
aggregates treat it as missing. Infinity is an ordinary value.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, digits with an optional point, optional exponent; Java's type suffixes are no numbers.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is never NULL: a missing value is not a member."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Negated membership; rows with a missing value are kept."""
    return ~is_in(c, values)


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice that stays NULL when the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def sum_known(c: Column | str) -> Column:
    """Sum of the known values; 0 when there is none."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def mean_known(c: Column | str) -> Column:
    return F.avg(_col(c))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that never fails: x/0 is signed infinity, 0/0 is missing."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    inf = F.lit(float("inf"))
    quotient = F.when(d != 0, F.try_divide(n, d)).when(n > 0, inf).when(n < 0, -inf)
    known = F.when(n.isNotNull() & d.isNotNull(), quotient)
    return F.when(~F.isnan(known), known)


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(_col(c), digits)


def safe_double(c: Column | str) -> Column:
    """Text to number; text that is no plain decimal number becomes NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Text to whole number of 64 bits, truncating decimals; junk becomes NULL.

    Plain digits are read as they are, so that long codes keep every digit.
    """
    text = _col(c).cast("string")
    whole = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("bigint"))
    return F.coalesce(whole, safe_double(c).try_cast("bigint"))


def row_order(order_by: Iterable) -> Column:
    """Sort key of a row: the named values in turn, missing ones last."""
    columns = [_col(o) for o in order_by]
    return F.struct(*[part for i, c in enumerate(columns) for part in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])


def first_known(c: Column | str, order_by: Iterable) -> Column:
    """Aggregate: first non-missing value in the given row order."""
    c = _col(c)
    return F.min_by(c, F.when(c.isNotNull(), row_order(order_by)))


def last_known(c: Column | str, order_by: Iterable) -> Column:
    """Aggregate: last non-missing value in the given row order."""
    c = _col(c)
    return F.max_by(c, F.when(c.isNotNull(), row_order(order_by)))

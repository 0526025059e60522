"""First and last values by the position of rows in their files.

Facts are first reduced to their distinct values with the smallest and largest position,
which hashes and combines before the shuffle; only then is the first or last one chosen.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.functions.missing import first_known, last_known
from panelproj.operators.relational import na_join
from panelproj.sources import POSITION

ROW_BITS = 44  # lines of a source; the other bits number the sources


def position() -> Column:
    """`_src` and `_row` as one number that sorts like them."""
    src, row = POSITION
    return F.shiftleft(F.col(src).cast("bigint"), ROW_BITS) + F.col(row)


def with_position(df: DataFrame, name: str = "_pos") -> DataFrame:
    """The rows of an ingest with their position as one column."""
    return df.withColumn(name, position()).drop(*POSITION)


def by_position(
    df: DataFrame,
    keys: Sequence[str],
    *,
    first: Sequence[str] = (),
    first_known_of: Sequence[str] = (),
    last: Sequence[str] = (),
    last_known_of: Sequence[str] = (),
    at: str = "_pos",
) -> DataFrame:
    """One row a key with the first or last value of columns; `_known_of` skips missing values. A missing key is a key."""
    columns = list(dict.fromkeys([*first, *first_known_of, *last, *last_known_of]))
    distinct = df.groupBy(*keys, *columns).agg(F.min(at).alias("__first"), F.max(at).alias("__last"))
    values = [F.min_by(c, "__first").alias(c) for c in first] + [first_known(c, ["__first"]).alias(c) for c in first_known_of]
    values += [F.max_by(c, "__last").alias(c) for c in last] + [last_known(c, ["__last"]).alias(c) for c in last_known_of]
    return distinct.groupBy(*keys).agg(*values).select(*keys, *columns)


def fill_by_position(df: DataFrame, keys: Sequence[str], **how: Sequence[str]) -> DataFrame:
    """Write each key's first or last values to all its rows, as `by_position` finds them."""
    columns = [c for names in how.values() if not isinstance(names, str) for c in names]
    return na_join(df.drop(*columns), by_position(df, keys, **how), keys, "inner").select(*df.columns)

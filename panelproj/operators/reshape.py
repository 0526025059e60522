"""Long <-> wide."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.functions.missing import is_in
from panelproj.operators.relational import na_join


def pivot_wider(
    df: DataFrame,
    ids: Sequence[str],
    names: str,
    values: Sequence[str],
    *,
    members: Sequence[str] | None = None,
    fill: float | None = None,
) -> DataFrame:
    """One column per member of `names`; several values give `<value>_<member>` columns.

    Without `members` the distinct names are read first (bounded by Spark's
    spark.sql.pivotMaxValues). Two rows for one cell, or a name that is not in `members`,
    are errors: nothing is dropped.
    """
    cells = df.groupBy(*ids, names).agg(*[F.max(v).alias(v) for v in values], F.count(F.lit(1)).alias("__rows"))
    wrong = F.when(F.col("__rows") > 1, F.lit("several rows for one cell of "))
    if members is not None:
        wrong = wrong.when(~is_in(names, members), F.lit("a name outside the given members: "))
    error = F.raise_error(F.concat(wrong, F.coalesce(F.col(names).cast("string"), F.lit("a missing name"))))
    types = dict(df.dtypes)
    checked = {v: F.when(wrong.isNotNull(), error.cast(types[v])).otherwise(F.col(v)) for v in values}
    aggregates = [F.max(v).alias(v) for v in values]
    grouped = cells.withColumns(checked).groupBy(*ids)
    grouped = grouped.pivot(names) if members is None else grouped.pivot(names, list(members))
    wide = grouped.agg(*aggregates)
    new = [c for c in wide.columns if c not in ids]
    if len(values) > 1:
        renames = {}
        for c in new:
            value = next(v for v in sorted(values, key=len, reverse=True) if c.endswith(f"_{v}"))
            renames[c] = f"{value}_{c[: -len(value) - 1]}"
        wide = wide.withColumnsRenamed(renames)
        new = list(renames.values())
    return wide if fill is None else wide.fillna(fill, subset=new)


def pivot_longer(df: DataFrame, ids: Sequence[str], columns: Sequence[str], names_to: str, values_to: str) -> DataFrame:
    return df.select(*ids, *columns).unpivot(list(ids), list(columns), names_to, values_to)


def pivot_longer_split(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], names_to: tuple[str, str], values_to: str, sep: str = "_"
) -> DataFrame:
    """Unpivot columns named `<a><sep><b>` into two name columns and a value."""
    long = pivot_longer(df, ids, columns, "__name", values_to)
    parts = F.split("__name", sep)
    return long.withColumns({names_to[0]: parts[0], names_to[1]: parts[1]}).select(*ids, *names_to, values_to)


def densify(df: DataFrame, unit: Sequence[str], period: str, measures: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Every unit gets every period that occurs anywhere, a missing one included; absent measures are NULL.

    The periods travel as one array-valued row (a calendar is short), so there is no
    join between units and periods.
    """
    known = F.collect_set(period)
    unknown = F.transform(F.slice(known, 1, 0), lambda p: p)  # an empty array of the same type
    missing = F.when(F.count(F.lit(1)) > F.count(period), F.array_append(unknown, F.lit(None)))
    periods = df.agg(F.concat(known, F.coalesce(missing, unknown)).alias("p")).scalar()
    grid = df.select(*unit).distinct().withColumn(period, F.explode(periods))
    return na_join(grid, df.select(*unit, period, *measures), [*unit, period], "left")

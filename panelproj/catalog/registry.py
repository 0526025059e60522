"""Registry of example queries: name -> (Spark function, oracle SQL)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelproj.catalog.fixtures import Fixtures

_FUNCTIONS: dict[str, Callable[[Fixtures], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the example views, with the SQL that gives the same rows."""

    def add(function: Callable[[Fixtures], DataFrame]):
        _FUNCTIONS[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Callable[[Fixtures], DataFrame]):
        return lambda spark, sf_dir: function(Fixtures(spark, sf_dir))

    return {name: bound(f) for name, f in _FUNCTIONS.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round by plain arithmetic, written the same way in the SQL: library rounding differs between engines at ties."""

    def cut(c: str, n: int):
        scale = F.lit(float(10**n))
        return F.when(F.abs(c) < 1e14, F.floor(F.col(c) * scale + 0.5) / scale).otherwise(F.col(c))

    return df.withColumns({c: cut(c, n) for c, n in digits.items()})

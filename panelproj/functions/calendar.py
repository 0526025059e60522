"""Periods kept as text: month YYYYMM, quarter YYYYQn."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelproj.functions.missing import _col, safe_double


def month_to_quarter(c: Column | str) -> Column:
    """202011 -> 2020Q4; NULL when the month is not 01..12."""
    c = _col(c)
    month = F.substring(c, 5, 2)
    quarter = (
        F.when(month.isin("01", "02", "03"), "Q1")
        .when(month.isin("04", "05", "06"), "Q2")
        .when(month.isin("07", "08", "09"), "Q3")
        .when(month.isin("10", "11", "12"), "Q4")
    )
    return F.concat(F.substring(c, 1, 4), quarter)


def excel_serial_date(c: Column | str) -> Column:
    """Spreadsheet day number to ISO date text."""
    days = F.floor(safe_double(_col(c).cast("string"))).cast("int")
    return F.date_add(F.to_date(F.lit("1899-12-30")), days).cast("string")


def quarter_shift(quarter: str, by: int) -> str:
    """Driver-side period parameter: quarter_shift('2020Q4', -3) == '2020Q1'."""
    n = int(quarter[:4]) * 4 + int(quarter[5:]) - 1 + by
    return f"{n // 4}Q{n % 4 + 1}"

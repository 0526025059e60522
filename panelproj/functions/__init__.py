from panelproj.functions.calendar import excel_serial_date, month_to_quarter, quarter_shift
from panelproj.functions.missing import (
    first_known,
    half_even,
    if_else,
    is_in,
    last_known,
    mean_known,
    not_in,
    ratio,
    row_order,
    safe_double,
    safe_int,
    sum_known,
)
from panelproj.functions.text import drop_suffix, pad_code, parse_pack, remap_prefix, strip_pattern, substring_between

__all__ = [
    "drop_suffix",
    "excel_serial_date",
    "first_known",
    "half_even",
    "if_else",
    "is_in",
    "last_known",
    "mean_known",
    "month_to_quarter",
    "not_in",
    "pad_code",
    "parse_pack",
    "quarter_shift",
    "ratio",
    "remap_prefix",
    "row_order",
    "safe_double",
    "safe_int",
    "strip_pattern",
    "substring_between",
    "sum_known",
]

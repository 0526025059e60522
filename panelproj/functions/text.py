"""Code and text helpers, all built from JVM-side column functions."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.functions.missing import _col, safe_int


def strip_pattern(c: Column | str, pattern: str) -> Column:
    """Remove every match of a regular expression."""
    return F.regexp_replace(_col(c), pattern, "")


def substring_between(c: Column | str, first: int, last: int) -> Column:
    """Characters first..last, 1-based and inclusive."""
    return F.substring(_col(c), first, last - first + 1)


def drop_suffix(c: Column | str, n: int) -> Column:
    """Text without its last n characters, then without white space at its ends."""
    c = _col(c)
    return F.regexp_replace(F.substr(c, F.lit(1), F.greatest(F.length(c) - n, F.lit(0))), r"^\s+|\s+$", "")


def pad_code(c: Column | str, width: int = 7) -> Column:
    """Left-pad with zeros to a minimum width; longer codes stay whole."""
    c = _col(c).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def remap_prefix(c: Column | str, prefixes: Mapping[str, str], width: int = 7) -> Column:
    """Replace code prefixes, one rule after the other. A replaced code keeps what follows the prefix up to `width` characters."""
    c = _col(c)
    for old, new in prefixes.items():
        n = len(old)
        c = F.when(F.substring(c, 1, n) == old, F.concat(F.lit(new), F.substring(c, n + 1, max(width - n, 0)))).otherwise(c)
    return c


def _squish(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def parse_pack(df: DataFrame, pack: str = "pack") -> DataFrame:
    """Split a pack text into form, strength and size.

    The form is what precedes the first digit, the size is the whole number after
    the last white space, the strength is what lies between.
    """
    text = F.col(pack)
    digit = F.nullif(F.regexp_instr(text, F.lit(r"\d")), F.lit(0))
    space = F.length(text) + 1 - F.nullif(F.regexp_instr(F.reverse(text), F.lit(r"\s")), F.lit(0))
    df = df.withColumns({"__digit": digit, "__space": space})
    form = F.substr(text, F.lit(1), F.col("__digit") - 1)
    strength = F.substr(text, F.col("__digit"), F.greatest(F.col("__space") - F.col("__digit"), F.lit(0)))
    size = F.substr(text, F.col("__space"), F.length(text))
    return df.withColumns(
        {
            "pack_form": F.nullif(_squish(form), F.lit("")),
            "pack_strength": F.nullif(_squish(strength), F.lit("")),
            "pack_size": safe_int(_squish(size)).try_cast("int"),
        }
    ).drop("__digit", "__space")

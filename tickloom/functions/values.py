"""Column helpers: cleaning, guarded arithmetic, rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TIE_SHIFT = 1e-9


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Round after a shift far below the last digit, so exact halves do not depend on the engine."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column + F.lit(_TIE_SHIFT), digits)


def strip_thousands(value: Column | str) -> Column:
    return F.regexp_replace(value, ",", "")


def to_int(text: Column | str) -> Column:
    """Integer from text such as ``1,234``; text that is no number raises (ANSI mode)."""
    return strip_thousands(text).cast("int")


def nan_to_null(value: Column | str) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null where the denominator is 0 or null."""
    return F.try_divide(F.col(numerator) if isinstance(numerator, str) else numerator,
                        F.col(denominator) if isinstance(denominator, str) else denominator)


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column becomes 0."""
    scaled = F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0))
    return F.when(value.isNotNull(), scaled)


def minmax_inverse(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def file_extension(path: Column | str) -> Column:
    """Last suffix with its dot, empty where the file name has none."""
    return F.regexp_extract(path, r"[^/.](\.[^./]*)$", 1)


def padded_tag(tag: Column | str, value: Column | str, width: int = 25) -> Column:
    """``tag`` filled up to ``width`` characters (longer tags stay whole), a colon, the value."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    fill = F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(tag)))
    return F.concat(tag, fill, F.lit(": "), value)


def day_month_year(moment: Column | str) -> Column:
    return F.date_format(moment, "dd/MM/yyyy HH:mm:ss")


def fill_missing_int(text: Column | str) -> Column:
    """Integer from text with thousands commas; missing text counts as 0."""
    return F.coalesce(to_int(text), F.lit(0))

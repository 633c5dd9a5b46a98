"""Rates, their text forms, and JSON paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .seq import _col

NA = "NA"


def safe_rate(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """num / den; ``default`` (NULL unless given) when the denominator is 0 or missing."""
    rate = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return rate if default is None else F.coalesce(rate, F.lit(default))


def format_rate(value: Column | str) -> Column:
    """Six decimals, ``NA`` for NULL or non-finite."""
    value = _col(value).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, F.format_string("%.6f", value)).otherwise(NA)


def format_percent(value: Column | str) -> Column:
    """A fraction as a percentage with two decimals."""
    value = _col(value).cast("double")
    return F.coalesce(F.when(value.isNotNull(), F.format_string("%.2f%%", value * 100)), F.lit(NA))


def format_percent_1(value: Column | str) -> Column:
    """A value already in percent, one decimal."""
    value = _col(value).cast("double")
    return F.coalesce(F.when(value.isNotNull(), F.format_string("%.1f%%", value)), F.lit(NA))


def parse_rate(text: Column | str) -> Column:
    """NULL for '' and ``NA``."""
    text = _col(text)
    return F.when(text.isin("", NA), None).otherwise(text).cast("double")


def or_na(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(NA))


def json_path(payload: Column | str, *keys: str, default: str | None = None) -> Column:
    """Value at a nested key path of a JSON text, ``default`` if any key is missing."""
    found = F.get_json_object(_col(payload), "$" + "".join(f"['{k}']" for k in keys))
    return found if default is None else F.coalesce(found, F.lit(default))

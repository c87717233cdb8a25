"""Null-suppressing field projections and id sets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def text_or_null(value: Column) -> Column:
    return F.when(~value.isin("", "."), value)


def _numeric(value: Column) -> Column:
    """Number text only, so that words such as NaN and type suffixes stay out of the cast; most fields are empty."""
    return F.when((value != "") & value.rlike(_NUMBER), value)


def double_or_null(value: Column) -> Column:
    return _numeric(value).try_cast("double")


def long_or_null(value: Column) -> Column:
    """Whole part of a decimal or exponent number; plain integers keep all digits."""
    number = _numeric(value)
    return F.coalesce(number.try_cast("bigint"), number.try_cast("double").try_cast("bigint"))


def yes_flag(value: Column) -> Column:
    return F.coalesce(F.upper(value) == "YES", F.lit(False))


def id_list(value: Column) -> Column:
    """``&`` list -> array, one leading ``_`` removed from each id; empty text gives an empty array."""
    return F.when(
        F.length(value) > 0,
        F.transform(F.split(value, "&"), lambda v: F.when(v.startswith("_"), F.substring(v, 2, 1 << 20)).otherwise(v)),
    ).otherwise(F.array().cast("array<string>"))


def as_set(values: Column) -> Column:
    return F.sort_array(F.array_distinct(values))


def set_text(values: Column) -> Column:
    """Comma text of the non-blank members, null for none."""
    kept = F.filter(as_set(values), lambda v: F.trim(v) != "")
    return F.when(F.size(kept) > 0, F.array_join(kept, ","))


def non_empty(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def frequency_struct(ac: Column, af: Column) -> Column:
    """Population frequency; its last member decides whether it exists at all."""
    parsed = double_or_null(af)
    return F.when(parsed.isNotNull(), F.struct(long_or_null(ac).alias("AC"), parsed.alias("AF")))

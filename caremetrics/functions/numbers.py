"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total_of(value: Column | str, exact_scale: int | None = None) -> Column:
    """Sum of doubles of any size.

    Their last bits depend on the order of the rows. Where values are known to
    have at most ``exact_scale`` decimal places and 18 digits in all, as prices
    do, that scale may be given: sums of decimals are the same in any order.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(column if exact_scale is None else column.cast(f"decimal(18,{exact_scale})"))


def mean_of(total: Column | str, count: Column | str) -> Column:
    """Mean from a total and a count; null where nothing was counted."""
    total = F.col(total) if isinstance(total, str) else total
    count = F.col(count) if isinstance(count, str) else count
    return F.when(count > 0, total.cast("double") / count)


def mean(value: Column | str, exact_scale: int | None = None) -> Column:
    return mean_of(total_of(value, exact_scale), F.count(value))


def lenient_number(text: Column) -> Column:
    """Number or null; sheets mark unpublished figures with text."""
    return text.try_cast("double")


def leading_year(label: Column) -> Column:
    """``2011–12`` -> 2011 (the separator is an en dash)."""
    return F.split(label, "–")[0].cast("int")


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def text_or_na(condition: Column, text: Column) -> Column:
    return F.when(condition, text).otherwise(F.lit("N/A"))

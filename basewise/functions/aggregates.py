"""Aggregate expressions with fixed-size or de-duplicated buffers (they pre-aggregate before a shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basewise.functions._columns import as_column


def signed_extreme(value: Column | str, skip_nan: bool = True) -> Column:
    """The value farthest from zero with its sign; nulls and NaN are skipped, +x wins over -x.

    The farthest value is always the largest or the smallest one, so two plain
    ``max``/``min`` buffers are enough: no set of values is ever built.
    ``skip_nan=False`` saves the test where the column cannot hold NaN.
    """
    value = as_column(value)
    real = F.when(~F.isnan(value), value) if skip_nan else value
    top, bottom = F.max(real), F.min(real)
    # try_subtract gives null for the one integer without a positive twin; it then wins as bottom.
    return F.when(top >= F.try_subtract(F.lit(0), bottom), top).otherwise(bottom)


def joined_values(values: Column | str, sep: str = ";") -> Column:
    """The distinct non-null members of an array, sorted and joined."""
    present = F.filter(as_column(values), lambda v: v.isNotNull())
    return F.array_join(F.array_sort(F.array_distinct(present)), sep)


def joined_set(value: Column | str, sep: str = ";") -> Column:
    """The distinct non-null values of a group, sorted and joined."""
    return F.array_join(F.sort_array(F.collect_set(as_column(value).cast("string"))), sep)

"""Number extraction, two-decimal differences and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basewise.functions._columns import as_column

# Fixed value: a signed decimal number, with an optional exponent so that a
# frequency such as 1.2e-05 stays one number.
NUMBER_PATTERN = r"([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"


def number_list(text: Column | str) -> Column:
    """All numbers of a text, in order, as an array of strings."""
    return F.regexp_extract_all(as_column(text), F.lit(NUMBER_PATTERN), F.lit(1))


def rounded_difference(alternate: Column | str, baseline: Column | str, scale: int = 2) -> Column:
    """``alternate - baseline`` after rounding each half up to ``scale`` decimals.

    The cast to decimal rounds half up on the number's decimal text, and the
    subtraction is done on decimals, so the result carries no binary drift.
    """
    kind = f"decimal(18,{scale})"
    return (as_column(alternate).try_cast(kind) - as_column(baseline).try_cast(kind)).cast("double")


def threshold_flag(value: Column | str, threshold: float) -> Column:
    """1 where ``value >= threshold``, 0 where below or NaN, null where null."""
    value = as_column(value)
    return F.when(F.isnan(value), F.lit(0)).otherwise((value >= F.lit(threshold)).cast("int"))

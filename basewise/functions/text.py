"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from basewise.functions._columns import as_column


def strip_control(text: Column | str) -> Column:
    """Drop every character below the blank (carriage returns, newlines, tabs)."""
    return F.regexp_replace(as_column(text), "[\\x00-\\x1f]", "")


def trimmed_split(text: Column | str, sep: str) -> Column:
    """Split at a literal separator without trailing empty fields."""
    literal = re.escape(sep)
    return F.split(F.regexp_replace(as_column(text), f"(?:{literal})+$", ""), literal)

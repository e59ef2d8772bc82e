"""Parquet and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write parquet; by default an existing target is an error."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", single_file: bool = False) -> None:
    """Write CSV with a header in each part file; ``single_file`` sends all rows through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)

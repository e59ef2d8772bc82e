"""Per-position coverage text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions.bases import chrom_to_code


def parse_coverage(lines: DataFrame, text: str = "value") -> DataFrame:
    """Whitespace-separated lines -> ``chromosome_id_hg19, position_hg19, gnomAD_EX_coveragePercent``."""
    kept = lines.where(~F.col(text).startswith("#") & (F.trim(F.col(text)) != ""))
    words = F.col("words")
    return kept.select(F.split(F.col(text), r"\s+").alias("words")).select(
        chrom_to_code(words[0]).alias("chromosome_id_hg19"),
        F.try_element_at(words, F.lit(2)).try_cast("int").alias("position_hg19"),
        F.try_element_at(words, F.lit(9)).try_cast("double").alias("gnomAD_EX_coveragePercent"),
    )


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Read coverage files (a path or a glob)."""
    return parse_coverage(spark.read.text(path))

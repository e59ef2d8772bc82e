"""Multi-line FASTA records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions.text import strip_control


def parse_fasta(records: DataFrame, record_type: str | None = None, text: str = "value") -> DataFrame:
    """Text records -> ``nm_id, sequence``.

    A record is a header line and one or more sequence lines. The id is the
    second ``|`` field of the header. ``record_type`` keeps only records whose
    text contains ``|`` + type. The leading ``>`` may be missing (the reader
    consumes it as part of the record separator); it takes no part in the id.
    """
    if record_type is not None:
        records = records.where(F.contains(F.col(text), F.lit("|" + record_type)))
    parts = F.col("parts")
    return records.select(F.split(F.col(text), "\n", 2).alias("parts")).select(
        F.try_element_at(F.split(strip_control(parts[0]), r"\|"), F.lit(2)).alias("nm_id"),
        F.coalesce(strip_control(F.try_element_at(parts, F.lit(2))), F.lit("")).alias("sequence"),
    )


def read_fasta(spark: SparkSession, path: str, record_type: str | None = None) -> DataFrame:
    """Read FASTA files (plain files are split across tasks, ``.gz`` files are one task each)."""
    records = spark.read.option("lineSep", "\n>").text(path)
    return parse_fasta(records, record_type)

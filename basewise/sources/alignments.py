"""Transcript-to-genome alignment rows (GFF3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the accession's number.
ACCESSION_NUMBER = r"([0-9]*)\."


def parse_alignments(lines: DataFrame, text: str = "value", skip_prefixes: Sequence[str] = ("#",)) -> DataFrame:
    """Text lines -> one row per alignment segment.

    Columns: ``sequence, chromosome, sense, score, genomic_start, genomic_end,
    transcript_id, transcript_start, transcript_end, gap`` with ``gap`` an
    ``array<struct<op:string,len:int>>`` or null for an ungapped segment.
    Lines that begin with one of ``skip_prefixes`` are left out (``("#", "NT_")``
    leaves out unplaced contigs as well as comments).
    Mitochondrial and patch accessions keep the number found in their name as
    chromosome number; 23 and 24 are written as X and Y.
    """
    value = F.col(text)
    for prefix in skip_prefixes:
        lines = lines.where(~value.startswith(prefix))
    lines = lines.where(F.trim(value) != "")

    # Split once per line; the fields below are picked from the two arrays.
    lines = lines.select(F.split(value, r"\s+").alias("words"), F.split(value, ";").alias("attributes"))
    words, attributes = F.col("words"), F.col("attributes")
    gap_count = F.try_element_at(F.split(F.try_element_at(attributes, F.lit(3)), "="), F.lit(2))
    last = F.split(F.trim(F.try_element_at(attributes, F.lit(-1))), "=")
    gap_text = F.when(
        (gap_count.try_cast("int") > 0) & (last[0] == "Gap"), F.try_element_at(last, F.lit(2))
    )
    number = F.regexp_extract(words[0], ACCESSION_NUMBER, 1).try_cast("int")

    return lines.select(
        words[0].alias("sequence"),
        F.when(number == 23, "X").when(number == 24, "Y").otherwise(number.cast("string")).alias("chromosome"),
        F.try_element_at(words, F.lit(7)).alias("sense"),
        F.try_element_at(words, F.lit(6)).try_cast("double").alias("score"),
        F.try_element_at(words, F.lit(4)).try_cast("int").alias("genomic_start"),
        F.try_element_at(words, F.lit(5)).try_cast("int").alias("genomic_end"),
        F.try_element_at(F.split(F.try_element_at(words, F.lit(9)), "="), F.lit(3)).alias("transcript_id"),
        F.try_element_at(words, F.lit(10)).try_cast("int").alias("transcript_start"),
        F.try_element_at(words, F.lit(11)).try_cast("int").alias("transcript_end"),
        F.transform(
            F.split(gap_text, " "),
            lambda op: F.struct(
                F.substring(op, 1, 1).alias("op"),
                F.substring(op, 2, 2147483647).try_cast("int").alias("len"),
            ),
        ).alias("gap"),
    )


def read_alignments(spark: SparkSession, path: str, skip_prefixes: Sequence[str] = ("#",)) -> DataFrame:
    """Read alignment segments from GFF3 text."""
    return parse_alignments(spark.read.text(path), skip_prefixes=skip_prefixes)

"""Gene constraint per transcript id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.operators.quality import argmax_rows, extreme_join, key_histogram
from basewise.operators.skew import deal_by

# New names of the three id columns.
RENAMED = {"gene": "gnomadGeneSymbol", "gene_id": "gnomadGeneID", "transcript": "TranscriptID"}


def id_pairs(id_map: DataFrame) -> DataFrame:
    """Distinct ``TranscriptID, RefSeq`` pairs that have a RefSeq."""
    return id_map.where(F.col("RefSeq").isNotNull()).select("TranscriptID", "RefSeq").distinct()


def constraint_by_transcript(constraint: DataFrame, id_map: DataFrame, choice: str = "extreme") -> DataFrame:
    """Constraint rows joined to RefSeq ids (many to many), then one choice per RefSeq.

    ``choice='extreme'`` keeps rows that hold both the highest pLI and the
    lowest rank of their RefSeq, so some ids may vanish and exact ties stay.
    ``choice='argmax'`` keeps exactly one row: highest pLI, then lowest rank.

    Joined rows are many times wider than the id pairs they are made of, by whose
    bytes adaptive execution would size the tasks that sort them. So both sides are
    dealt out by transcript over a number of tasks of its own; the pairs become
    distinct there, without a shuffle of theirs. The constraint table grows with its
    genes and is not broadcast.
    """
    genes = deal_by(constraint.withColumnsRenamed(RENAMED), "TranscriptID").hint("merge")
    pairs = id_pairs(deal_by(id_map, "TranscriptID"))
    joined = genes.join(pairs, "TranscriptID", "inner")
    if choice == "extreme":
        return extreme_join(joined, ["RefSeq"], "pLI", "oe_lof_upper_rank")
    if choice == "argmax":
        order = [F.col("pLI").desc_nulls_last(), F.col("oe_lof_upper_rank").asc_nulls_last()]
        return argmax_rows(joined, ["RefSeq"], order)
    raise ValueError("choice must be 'extreme' or 'argmax'")


def constraint_summary(df: DataFrame, predicate: Column, bin_column: str = "oe_lof_upper_bin") -> DataFrame:
    """Rows per constraint bin under a predicate such as ``F.col('pLI') >= 0.9``."""
    return key_histogram(df.where(predicate), [bin_column])

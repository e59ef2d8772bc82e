"""Gene constraint per transcript id, on tables derived from parts and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.operators import check_unique, key_histogram
from basewise.plans.constraint import constraint_by_transcript, constraint_summary, id_pairs
from catalog.derive import table, text


def constraint_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a gene transcript."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("gene"),
        F.col("p_brand").alias("gene_id"),
        F.concat(F.lit("ENST"), text(key)).alias("transcript"),
        F.when(key % 13 != 0, (key % 20) / 20).alias("pLI"),
        ((key % 7) / 10).alias("pNull"),
        ((key % 3) / 10).alias("pRec"),
        size.alias("oe_lof_upper_rank"),
        (size % 10).alias("oe_lof_upper_bin"),
    )


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts to suppliers, many to many, some without an id."""
    line = table(spark, sf_dir, "lineitem")
    ref = F.when(F.col("l_linenumber") != 4, F.concat(F.lit("NM_"), text(F.col("l_suppkey") * 7 + F.col("l_partkey") % 5)))
    return line.select(F.concat(F.lit("ENST"), text(F.col("l_partkey"))).alias("TranscriptID"), ref.alias("RefSeq"))


def _chosen(spark: SparkSession, sf_dir: str, choice: str) -> DataFrame:
    return constraint_by_transcript(constraint_table(spark, sf_dir), id_map(spark, sf_dir), choice)


def id_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct id pairs."""
    return id_pairs(id_map(spark, sf_dir))


def id_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each RefSeq id occurs."""
    return key_histogram(id_pairs(id_map(spark, sf_dir)), ["RefSeq"])


def constraint_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest pLI and lowest rank, found independently."""
    return _chosen(spark, sf_dir, "extreme")


def constraint_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per RefSeq id."""
    return _chosen(spark, sf_dir, "argmax").select("RefSeq", "pLI", "oe_lof_upper_rank")


def constraint_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is RefSeq a key after the one-row choice?"""
    return check_unique(_chosen(spark, sf_dir, "argmax"), ["RefSeq"])


def constrained_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of constrained ids."""
    return constraint_summary(_chosen(spark, sf_dir, "extreme"), F.col("pLI") >= 0.9)


def unconstrained_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of ids that are neither unconstrained nor recessive."""
    predicate = (F.col("pNull") <= 0.05) | (F.col("pRec") > 0.05)
    return constraint_summary(_chosen(spark, sf_dir, "extreme"), predicate)


SQL = """
WITH loft AS (
  SELECT p_name AS gnomadGeneSymbol, p_brand AS gnomadGeneID, 'ENST' || p_partkey AS TranscriptID,
         CASE WHEN p_partkey % 13 <> 0 THEN (p_partkey % 20) / 20 END AS pLI, (p_partkey % 7) / 10 AS pNull,
         (p_partkey % 3) / 10 AS pRec, p_size AS oe_lof_upper_rank, p_size % 10 AS oe_lof_upper_bin FROM part),
ids AS (
  SELECT DISTINCT 'ENST' || l_partkey AS TranscriptID, 'NM_' || (l_suppkey * 7 + l_partkey % 5) AS RefSeq
  FROM lineitem WHERE l_linenumber <> 4),
joined AS (SELECT * FROM loft JOIN ids USING (TranscriptID)),
best AS (SELECT RefSeq, max(pLI) AS m, min(oe_lof_upper_rank) AS r FROM joined GROUP BY 1),
chosen AS (
  SELECT joined.* FROM joined JOIN best ON joined.RefSeq = best.RefSeq AND pLI = m AND oe_lof_upper_rank = r),
first AS (
  SELECT * FROM joined QUALIFY row_number() OVER (
    PARTITION BY RefSeq ORDER BY pLI DESC NULLS LAST, oe_lof_upper_rank) = 1)"""

QUERIES = {
    "id_pairs": id_pair_rows,
    "id_duplicates": id_duplicates,
    "constraint_extreme": constraint_extreme,
    "constraint_argmax": constraint_argmax,
    "constraint_unique": constraint_unique,
    "constraint_bins": constrained_bins,
    "constraint_bins_other": unconstrained_bins,
}

ORACLES = {
    "id_pairs": f"{SQL} SELECT TranscriptID, RefSeq FROM ids",
    "id_duplicates": f"{SQL} SELECT RefSeq, count(*) AS count FROM ids GROUP BY 1",
    "constraint_extreme": f"{SQL} SELECT * FROM chosen",
    "constraint_argmax": f"{SQL} SELECT RefSeq, pLI, oe_lof_upper_rank FROM first",
    "constraint_unique": f"{SQL} SELECT count(*) AS rows, count(DISTINCT RefSeq) AS distinct_keys, true AS is_unique FROM first",
    "constraint_bins": f"{SQL} SELECT oe_lof_upper_bin, count(*) AS count FROM chosen WHERE pLI >= 0.9 GROUP BY 1",
    "constraint_bins_other": f"""{SQL}
SELECT oe_lof_upper_bin, count(*) AS count FROM chosen WHERE pNull <= 0.05 OR pRec > 0.05 GROUP BY 1""",
}

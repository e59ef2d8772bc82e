"""Sequences, windows and variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions import (
    chrom_to_code,
    code_to_chrom,
    complement,
    contig_to_code,
    merge_key,
    reverse_complement,
    with_chr_prefix,
)
from basewise.operators import alternates, drop_stale_scores, split_wildtype, to_tool_records, variants, windows
from basewise.operators.pipe import FOLD_INPUT
from basewise.sources import parse_fasta
from catalog.derive import (
    SQL_SEQUENCES,
    SQL_VARIANTS,
    SQL_WINDOWS,
    checksum,
    sequences,
    sql_checksum,
    table,
    text,
)

VARIANT_COLUMNS = ("nm_id", "transcript_position", "ref", "alt", "sequence", "wildSequence")


def fasta_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and body lines with carriage returns, two record types."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    joined = sequences(spark, sf_dir).join(part, "p_partkey")
    kind = F.when(F.col("p_size") % 2 == 0, F.lit("NM")).otherwise(F.lit("XR"))
    record = F.concat(
        F.lit("ref|"), kind, F.lit("_"), text(F.col("p_partkey")), F.lit("|"), F.col("p_name"), F.lit("\r\n"),
        F.left("sequence", F.lit(60)), F.lit("\r\n"), F.substr("sequence", F.lit(61)), F.lit("\r\n"),
    )
    return parse_fasta(joined.select(record.alias("value")), "NM")


SQL_FASTA = f"""
WITH {SQL_SEQUENCES}
SELECT nm_id, sequence FROM seqs JOIN part USING (p_partkey) WHERE p_size % 2 = 0"""


def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position with its window."""
    return windows(sequences(spark, sf_dir)).drop("p_partkey")


def short_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by the rule that gives only the first positions of short sequences."""
    return windows(sequences(spark, sf_dir), short="reference").drop("p_partkey")


def alternate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternates per transcript, position range and checksum of whole rows, without wildtypes."""
    rows = alternates(windows(sequences(spark, sf_dir)), wildtype=False)
    return rows.groupBy("nm_id", "alt").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("transcript_position").alias("first_position"),
        F.max("transcript_position").alias("last_position"),
        checksum(*VARIANT_COLUMNS).alias("row_sum"),
    )


def variant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variants, summed per transcript and base change."""
    rows = variants(sequences(spark, sf_dir))
    return rows.groupBy("nm_id", "ref", "alt", "isWildType").agg(
        F.count(F.lit(1)).alias("n"), checksum(*VARIANT_COLUMNS).alias("row_sum")
    )


def base_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants counted per base change: the flagship report."""
    return (
        variants(sequences(spark, sf_dir))
        .groupBy("ref", "alt", "isWildType")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("nm_id").alias("transcripts"))
    )


def wildtype_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wildtype half of the wildtype / alternate split."""
    wild = split_wildtype(variants(sequences(spark, sf_dir)))[1]
    return wild.select("nm_id", "transcript_position", "ref", "alt", "sequence")


def scrubbed_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale score columns dropped, rows marked as alternates."""
    orders = table(spark, sf_dir, "orders")
    stale = orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("deltaMFE"), F.lit(1).alias("mfeed")
    )
    return drop_stale_scores(stale)


def tool_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Program input records of the wildtype rows."""
    wild = split_wildtype(variants(sequences(spark, sf_dir)))[1]
    return to_tool_records(wild, **FOLD_INPUT)


def complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complement and reverse complement of every sequence."""
    return sequences(spark, sf_dir).select(
        "nm_id", complement("sequence").alias("complement"), reverse_complement("sequence").alias("reversed")
    )


def chrom_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chromosome names and codes."""
    number = F.col("p_partkey") % 24 + 1
    name = F.when(number == 23, "X").when(number == 24, "Y").otherwise(text(number))
    named = table(spark, sf_dir, "part").select("p_partkey", "p_size", name.alias("chrom"))
    return named.select(
        "p_partkey",
        "chrom",
        chrom_to_code("chrom").alias("code"),
        code_to_chrom(chrom_to_code("chrom")).alias("back"),
        with_chr_prefix("chrom").alias("contig"),
        contig_to_code(with_chr_prefix("chrom")).alias("contig_code"),
        merge_key("chrom", "p_size").alias("merged"),
    )


QUERIES = {
    "fasta_parse": fasta_parse,
    "windows": window_rows,
    "windows_short": short_window_rows,
    "alternates": alternate_rows,
    "variants": variant_rows,
    "base_changes": base_changes,
    "wildtype_rows": wildtype_rows,
    "scrubbed_alternates": scrubbed_alternates,
    "tool_records": tool_records,
    "reverse_complement": complements,
    "chrom_codes": chrom_codes,
}

ORACLES = {
    "fasta_parse": SQL_FASTA,
    "windows": f"WITH {SQL_SEQUENCES}, {SQL_WINDOWS} SELECT * FROM wins",
    "windows_short": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}
SELECT wins.* FROM wins JOIN seqs USING (nm_id) WHERE length(seqs.sequence) > 101 OR transcript_position <= 51""",
    "alternates": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}, {SQL_VARIANTS}
SELECT nm_id, alt, count(*) AS n, min(transcript_position) AS first_position,
       max(transcript_position) AS last_position, {sql_checksum(*VARIANT_COLUMNS)} AS row_sum
FROM vars WHERE NOT isWildType GROUP BY nm_id, alt""",
    "variants": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}, {SQL_VARIANTS}
SELECT nm_id, ref, alt, isWildType, count(*) AS n, {sql_checksum(*VARIANT_COLUMNS)} AS row_sum
FROM vars GROUP BY ALL""",
    "base_changes": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}, {SQL_VARIANTS}
SELECT ref, alt, isWildType, count(*) AS n, count(DISTINCT nm_id) AS transcripts FROM vars GROUP BY ALL""",
    "wildtype_rows": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}
SELECT nm_id, transcript_position, ref, ref AS alt, wildSequence AS sequence FROM wins""",
    "scrubbed_alternates": "SELECT o_orderkey, o_orderstatus, false AS isWildType FROM orders",
    "tool_records": f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}
SELECT '>' || nm_id || '|' || transcript_position || '|' || ref || '|' || ref || '|' || wildSequence
       || '|true' || chr(10) || wildSequence AS value FROM wins""",
    "reverse_complement": f"""
WITH {SQL_SEQUENCES}
SELECT nm_id, translate(sequence, 'ACGT', 'TGCA') AS complement,
       reverse(translate(sequence, 'ACGT', 'TGCA')) AS reversed FROM seqs""",
    "chrom_codes": """
SELECT p_partkey, chrom, code::VARCHAR AS code, chrom AS back, 'chr' || chrom AS contig,
       code::VARCHAR AS contig_code, chrom || ':' || p_size AS merged
FROM (SELECT p_partkey, p_size, p_partkey % 24 + 1 AS code,
             CASE p_partkey % 24 + 1 WHEN 23 THEN 'X' WHEN 24 THEN 'Y'
                  ELSE (p_partkey % 24 + 1)::VARCHAR END AS chrom FROM part)""",
}

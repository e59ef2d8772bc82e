"""Inputs derived from the test tables, as Spark frames and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEX, LETTERS = "0123456789abcdef", "ACGT" * 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column) -> Column:
    """A number as text."""
    return column.cast("string")


def md5_bases(value: Column) -> Column:
    """32 bases from a hash."""
    return F.translate(F.md5(value), HEX, LETTERS)


def sql_md5_bases(value: str) -> str:
    """The same in SQL."""
    return f"translate(md5({value}), '{HEX}', '{LETTERS}')"


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nm_id, p_partkey, sequence``: 32 to 192 bases per part, some cut to 101 and some to 51."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    blocks = F.transform(
        F.sequence(F.lit(1), (key % 6 + 1).cast("int")),
        lambda i: md5_bases(F.concat(text(key), F.lit("-"), text(i))),
    )
    whole = F.array_join(blocks, "")
    cut = F.when(key % 10 == 3, F.left(whole, F.lit(101))).when(key % 10 == 7, F.left(whole, F.lit(51)))
    return part.select(
        F.concat(F.lit("NM_"), text(key)).alias("nm_id"), "p_partkey", F.coalesce(cut, whole).alias("sequence")
    )


SQL_SEQUENCES = f"""
seqs AS (
  SELECT 'NM_' || p_partkey AS nm_id, p_partkey,
         CASE WHEN p_partkey % 10 = 3 THEN left(whole, 101)
              WHEN p_partkey % 10 = 7 THEN left(whole, 51) ELSE whole END AS sequence
  FROM (
    SELECT p_partkey, string_agg({sql_md5_bases("p_partkey || '-' || i")}, '' ORDER BY i) AS whole
    FROM part, range(1, 7) AS t(i) WHERE i <= p_partkey % 6 + 1 GROUP BY p_partkey))"""

SQL_WINDOWS = """
positions AS (
  SELECT nm_id, sequence, length(sequence) AS n,
         unnest(range(1, 1 + length(sequence))) AS p
  FROM seqs),
wins AS (
  SELECT nm_id, p::INTEGER AS transcript_position, substr(sequence, p, 1) AS ref,
         substr(sequence, greatest(least(p - 51, n - 101), 0) + 1, 101) AS wildSequence,
         (p - 1 - greatest(least(p - 51, n - 101), 0))::INTEGER AS window_index
  FROM positions)"""

SQL_VARIANTS = """
vars AS (
  SELECT nm_id, transcript_position, ref, alt,
         substr(wildSequence, 1, window_index) || alt || substr(wildSequence, window_index + 2) AS sequence,
         wildSequence, alt = ref AS isWildType
  FROM wins, (SELECT unnest(['A', 'C', 'G', 'T']) AS alt))"""


def checksum(*columns: str) -> Column:
    """Order-independent sum over rows of eight hex digits of a hash of the columns."""
    digits = F.substring(F.md5(F.concat_ws("|", *[text(F.col(c)) for c in columns])), 1, 8)
    return F.sum(F.conv(digits, 16, 10).cast("long"))


def sql_checksum(*columns: str) -> str:
    """The same in SQL."""
    joined = " || '|' || ".join(f"({c})::VARCHAR" for c in columns)
    return f"sum(('0x' || substr(md5({joined}), 1, 8))::BIGINT)::BIGINT"

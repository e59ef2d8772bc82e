"""Parquet and tab-separated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The layout of the transcript id map and the gene-constraint columns in use.
ID_MAP_SCHEMA = (
    "GeneID string, GeneIDVer string, TranscriptID string, TranscriptIDVer string, "
    "EnsemblGeneSymbol string, GeneType string, GENE string, RefSeq string, NCBIGeneID int"
)
CONSTRAINT_COLUMNS = (
    "gene", "gene_id", "transcript",
    "obs_mis", "exp_mis", "oe_mis", "obs_syn", "exp_syn", "oe_syn",
    "p", "pLI", "pRec", "pNull", "oe_lof_upper", "oe_lof_upper_rank", "oe_lof_upper_bin",
)
CONSTRAINT_DOUBLES = (
    "exp_mis", "oe_mis", "exp_syn", "oe_syn", "p", "pLI", "pRec", "pNull", "oe_lof_upper",
)
CONSTRAINT_INTEGERS = ("obs_mis", "obs_syn", "oe_lof_upper_rank", "oe_lof_upper_bin")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; ``columns`` narrows the read schema."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    null_value: str = "",
) -> DataFrame:
    """Tab-separated file with a header. Without ``schema`` the types are inferred."""
    reader = spark.read.option("sep", "\t").option("header", True).option("nullValue", null_value)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """Transcript id map, as stored."""
    return read_tsv(spark, path, ID_MAP_SCHEMA)


def read_constraint(spark: SparkSession, path: str, null_value: str = "NA") -> DataFrame:
    """Gene-constraint table: 16 columns, metrics as numbers, unreadable numbers as null.

    All columns are read as text and the numbers cast by name. Letting Spark
    infer types would read the file twice and could take an id for a date.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("nullValue", null_value)
    table = reader.csv(path).select(*CONSTRAINT_COLUMNS)
    doubles = {c: F.col(c).try_cast("double") for c in (*CONSTRAINT_DOUBLES, *CONSTRAINT_INTEGERS)}
    integers = {c: F.col(c).try_cast("int") for c in CONSTRAINT_INTEGERS}
    return table.withColumns(doubles).withColumns(integers)

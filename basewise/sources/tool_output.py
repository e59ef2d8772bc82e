"""Text written by structure programs, one ``>`` record per variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions.numbers import number_list

# The key layouts the programs echo back.
FOLD_SCORES = (
    "mfeValue", "efeValue", "meafeValue", "meaValue",
    "cfeValue", "cdValue", "freqMfeEnsemble", "endValue",
)
FOLD_STRUCTURES = ("mfeStructure", "efeStructure", "meafeStructure", "cfeStructure")
VARIANT_KEY = ("nm_id", "transcript_position", "ref", "alt")
DISTANCE_SCORES = ("mfeed", "meaed", "cfeed")


def _fields(text: Column, sep: str) -> Column:
    return F.split(text, sep)


def _field(parts: Column, index: int) -> Column:
    return F.get(parts, F.lit(index))


def parse_fold(records: DataFrame, text: str = "value") -> DataFrame:
    """Seven-line fold records -> variants with 8 scores and 4 structures.

    The folded sequence is kept in the program's own letters (U for T);
    ``wildSequence`` comes from the key and is unchanged.
    """
    staged = records.select(F.split(F.col(text), "\n").alias("line")).where(F.trim(F.col("line")[0]) != "")
    line = F.col("line")

    def structure(index: int) -> Column:
        return F.substring_index(_field(line, index), " ", 1)

    def numbers(index: int) -> Column:
        row = _field(line, index)
        return number_list(F.substring(row, F.length(structure(index)) + 1, F.length(row)))

    staged = staged.select(
        line,
        _fields(_field(line, 0), r"\|").alias("key"),
        *[numbers(i).alias(f"n{i}") for i in (2, 3, 4, 5)],
        number_list(_field(line, 6)).alias("n6"),
    )

    def score(column: str, index: int, name: str) -> Column:
        return _field(F.col(column), index).try_cast("double").alias(name)

    key = F.col("key")
    return staged.select(
        _field(key, 0).alias("nm_id"),
        _field(key, 1).try_cast("int").alias("transcript_position"),
        _field(key, 2).alias("ref"),
        _field(key, 3).alias("alt"),
        F.trim(_field(line, 1)).alias("sequence"),
        _field(key, 4).alias("wildSequence"),
        (F.lower(F.trim(_field(key, 5))) == "true").alias("isWildType"),
        score("n2", 0, "mfeValue"),
        score("n3", 0, "efeValue"),
        score("n5", 0, "meafeValue"),
        score("n5", 1, "meaValue"),
        score("n4", 0, "cfeValue"),
        score("n4", 1, "cdValue"),
        score("n6", 0, "freqMfeEnsemble"),
        score("n6", 1, "endValue"),
        structure(2).alias("mfeStructure"),
        structure(3).alias("efeStructure"),
        structure(5).alias("meafeStructure"),
        structure(4).alias("cfeStructure"),
    )


def parse_distance(records: DataFrame, text: str = "value") -> DataFrame:
    """Four-line structure-distance records -> the echoed fold columns plus three integer distances."""
    staged = records.select(F.split(F.col(text), "\n").alias("line")).where(F.trim(F.col("line")[0]) != "")
    staged = staged.select("line", _fields(F.trim(F.col("line")[0]), "#").alias("key"))
    key, line = F.col("key"), F.col("line")

    def typed(names: tuple[str, ...], start: int, kind: str, prefix: str = "") -> list[Column]:
        return [_field(key, start + i).try_cast(kind).alias(prefix + n) for i, n in enumerate(names)]

    distances = [
        F.trim(F.substring(F.trim(_field(line, i + 1)), 4, 2147483647)).try_cast("int").alias(name)
        for i, name in enumerate(DISTANCE_SCORES)
    ]
    return staged.select(
        _field(key, 0).alias("nm_id"),
        _field(key, 1).try_cast("int").alias("transcript_position"),
        *typed(("ref", "alt", "sequence", "wildSequence"), 2, "string"),
        *typed(FOLD_SCORES, 6, "double"),
        *typed(FOLD_STRUCTURES, 14, "string"),
        *typed(FOLD_SCORES, 19, "double", "wt_"),
        *typed(FOLD_STRUCTURES, 27, "string", "wt_"),
        *distances,
    )


def parse_pdist(records: DataFrame, text: str = "value") -> DataFrame:
    """Profile-distance records (key line, number line) -> key, sequences and ``efeed``."""
    staged = records.select(F.split(F.col(text), "\n").alias("line")).where(F.trim(F.col("line")[0]) != "")
    key = _fields(F.trim(F.col("line")[0]), r"\|")
    return staged.select(
        _field(key, 0).alias("nm_id"),
        _field(key, 1).try_cast("int").alias("transcript_position"),
        _field(key, 2).alias("ref"),
        _field(key, 3).alias("alt"),
        _field(key, 4).alias("sequence"),
        _field(key, 5).alias("wildSequence"),
        F.trim(_field(F.col("line"), 1)).try_cast("double").alias("efeed"),
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", ">").text(path)


def read_fold_output(spark: SparkSession, path: str) -> DataFrame:
    """Fold output files as a table."""
    return parse_fold(_records(spark, path))


def read_distance_output(spark: SparkSession, path: str) -> DataFrame:
    """Structure-distance output files as a table."""
    return parse_distance(_records(spark, path))


def read_pdist_output(spark: SparkSession, path: str) -> DataFrame:
    """Profile-distance output files as a table."""
    return parse_pdist(_records(spark, path))

"""Delimited text read once into typed rows, with everything unreadable listed beside them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REJECTS = "rejects"
REJECT = "struct<column:string,value:string,reason:string>"
# Why a cell has no value.
MISSING, NOT_A_NUMBER, NOT_AN_INTEGER, OUT_OF_RANGE, EXTRA = (
    "missing", "not a number", "not an integer", "out of range", "extra fields",
)
INTEGERS = ("tinyint", "smallint", "int", "bigint")
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NAMED_NUMBERS = ("NaN", "Infinity", "-Infinity")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: lines of text files with their numbers, from 1 in each file.

    Files are read in ordinary input splits; numbers are counted inside each split
    and moved up by the lines of the splits before it, one row per split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    inside = Window.partitionBy("file", "split").orderBy("at")
    counts = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("file", "split", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
    numbered = lines.withColumn("inside", F.row_number().over(inside)).join(counts, ["file", "split"])
    return numbered.select("file", (F.col("before") + F.col("inside")).alias("line"), "value")


def _typed(cell: Column, kind: str) -> Column:
    """A cell's value, null if it is not written as the type asks."""
    if kind == "string":
        return cell
    if kind in INTEGERS:
        return F.when(F.rlike(cell, F.lit(INTEGER)), F.trim(cell).try_cast(kind))
    return F.when(F.rlike(cell, F.lit(NUMBER)) | F.trim(cell).isin(*NAMED_NUMBERS), F.trim(cell).try_cast(kind))


def _reason(cell: Column, kind: str) -> Column:
    """Why a cell that is there has no value."""
    if kind == "string":
        return F.lit(None).cast("string")
    readable = F.rlike(cell, F.lit(NUMBER)) if kind in INTEGERS else F.rlike(cell, F.lit(NUMBER)) | F.trim(cell).isin(*NAMED_NUMBERS)
    reason = F.when(~readable, NOT_A_NUMBER)
    if kind in INTEGERS:
        reason = reason.when(~F.rlike(cell, F.lit(INTEGER)), NOT_AN_INTEGER)
    return F.when(cell.isNotNull() & _typed(cell, kind).isNull(), reason.otherwise(OUT_OF_RANGE))


def check_cells(
    lines: DataFrame, names: list[str], types: Mapping[str, str], text: str = "value", sep: str = "\t", null_value: str = "NA"
) -> DataFrame:
    """Lines -> the columns of ``types``, typed, and ``rejects``: the cells that have no value though they should.

    ``names`` are all fields of a line, in order; ``types`` says which are wanted and
    as what (``string``, an integer type, ``double``). A cell equal to ``null_value``
    or empty is null. Each other cell that cannot be read as its type is null too and
    listed in ``rejects`` with its column, text and reason; so is a field that the line
    does not have, and, under a null column, what a line has beyond the last. All other
    columns of ``lines`` stay. Everything is one projection of the line.
    """
    unknown = set(types) - set(names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    wrong = {k for k in types.values() if k not in ("string", "double", "float", *INTEGERS)}
    if wrong:
        raise ValueError(f"no such types: {sorted(wrong)}")
    kept = [c for c in lines.columns if c != text]
    cells = lines.withColumn("_cells", F.split(F.regexp_replace(F.col(text), r"\r$", ""), _literal(sep)))
    values, rejects = [], []
    for name, kind in types.items():
        raw = F.get("_cells", F.lit(names.index(name)))
        cell = F.when((raw != "") & (raw != null_value), raw)
        values.append(_typed(cell, kind).alias(name))
        reason = F.when(raw.isNull(), MISSING).otherwise(_reason(cell, kind))
        rejects.append(F.when(reason.isNotNull(), F.struct(F.lit(name).alias("column"), raw.alias("value"), reason.alias("reason"))))
    size = len(names)
    rest = F.array_join(F.slice("_cells", size + 1, F.greatest(F.size("_cells") - size, F.lit(0))), sep)
    rejects.append(
        F.when(F.size("_cells") > size, F.struct(F.lit(None).cast("string").alias("column"), rest.alias("value"), F.lit(EXTRA).alias("reason")))
    )
    listed = F.filter(F.array(*rejects), lambda r: r.isNotNull()).cast(f"array<{REJECT}>")
    return cells.select(*[F.col(f"`{c}`") for c in kept], *values, listed.alias(REJECTS))


def _literal(sep: str) -> str:
    """A separator as a regular expression."""
    return "".join(f"\\x{ord(c):02x}" for c in sep)


def rejected_cells(checked: DataFrame) -> DataFrame:
    """One row per rejected cell: all columns that tell the line, then ``column, value, reason``."""
    told = [c for c in checked.columns if c in ("file", "line")]
    return checked.select(*told, F.inline(REJECTS))


def read_checked(
    spark: SparkSession, path: str, types: Mapping[str, str], sep: str = "\t", null_value: str = "NA"
) -> DataFrame:
    """Files with one header line each -> ``file, line``, the columns of ``types`` and ``rejects``.

    The header is taken from the first line of the first file; all files must have it.
    """
    lines = numbered_lines(spark, path)
    header = spark.read.text(path).limit(1).first()
    if header is None:
        raise ValueError(f"no header in {path}")
    names = header["value"].rstrip("\r").split(sep)
    rows = lines.where((F.col("line") > 1) & (F.col("value") != ""))
    return check_cells(rows, names, types, "value", sep, null_value)

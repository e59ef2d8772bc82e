"""VCF text of the variants that were moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions.bases import code_to_chrom
from basewise.operators.enrich import GENOMIC_KEY

# The two header lines and the constant columns.
HEADER = (
    "##fileformat=VCFv4.2",
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNORMAL",
)
MISSING = "."
FORMAT = "GT"
GENOTYPE = "1/0"


def to_vcf_lines(df: DataFrame, passed: str | None = "liftoverResult") -> DataFrame:
    """Distinct ``PASS`` variants as ``value``: ten tab-separated columns."""
    if passed is not None:
        df = df.where(F.col(passed) == "PASS")
    chrom, position, ref, alt = GENOMIC_KEY

    def text(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(MISSING))

    cells = [
        text(code_to_chrom(chrom)),
        text(F.col(position)),
        F.lit(MISSING),
        text(F.col(ref)),
        text(F.col(alt)),
        *[F.lit(MISSING)] * 3,
        F.lit(FORMAT),
        F.lit(GENOTYPE),
    ]
    return df.select(*GENOMIC_KEY).distinct().select(F.concat_ws("\t", *cells).alias("value"))


def vcf_header(spark: SparkSession) -> DataFrame:
    """The two header lines as ``at, value``."""
    return spark.createDataFrame(list(enumerate(HEADER)), "at int, value string")


def write_vcf(df: DataFrame, path: str, mode: str = "error", single_file: bool = False) -> None:
    """Write ``path/header`` and ``path/lines``; all part files in that order make up the VCF.

    ``single_file`` writes one part file with header and lines through one task instead.
    """
    header, lines = vcf_header(df.sparkSession), to_vcf_lines(df)
    if single_file:
        whole = header.unionByName(lines.withColumn("at", F.lit(len(HEADER))))
        whole.coalesce(1).sortWithinPartitions("at").select("value").write.mode(mode).text(path)
        return
    header.coalesce(1).sortWithinPartitions("at").select("value").write.mode(mode).text(f"{path}/header")
    lines.write.mode(mode).text(f"{path}/lines")

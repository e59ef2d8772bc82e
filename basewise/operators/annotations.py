"""Annotation text (VCF INFO) matched to each row's own transcript."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.functions.text import trimmed_split

# 0-based places of the fields in one annotation entry, and the columns made of them.
FEATURE_TYPE, FEATURE_ID = 5, 6
FIELDS = {
    "snpeffAnnotation": 1,
    "snpeffPunativeImpact": 2,
    "snpeffGeneName": 3,
    "snpeffGeneID": 4,
    "snpeffTranscriptBiotype": 7,
    "snpeffHGVSc": 9,
    "snpeffHGVSp": 10,
}
RAW = "snpeffRaw"
INFO_COLUMN = 7


def parse_annotations(
    df: DataFrame, info: str = "info", transcript: str = "nm_id", vcf_line: bool = False
) -> DataFrame:
    """Add seven ``snpeff*`` fields and ``snpeffRaw``.

    Entries are separated by ``,`` and their fields by ``|``. Entries whose
    feature id is the row's transcript are kept; the first of them that
    describes a transcript fills the fields (null without one), and all of them
    make up the raw text, fields joined by ``;`` and entries by ``,``. A ``.``
    means no annotation. Trailing empty fields do not count. ``vcf_line=True``
    takes a whole tab-separated line in ``info`` and reads its eighth column.
    """
    text: Column = F.col(info)
    if vcf_line:
        text = F.get(F.split(text, "\t"), F.lit(INFO_COLUMN))
    entries = F.transform(
        trimmed_split(F.when(text != ".", text), ","), lambda entry: trimmed_split(entry, "|")
    )
    own = F.filter(entries, lambda e: F.get(e, F.lit(FEATURE_ID)) == F.col(transcript))
    first = F.get(F.filter(F.col("_own"), lambda e: F.get(e, F.lit(FEATURE_TYPE)) == "transcript"), F.lit(0))
    raw = F.array_join(F.transform(F.col("_own"), lambda e: F.array_join(e, ";")), ",")
    # One column per step, so that the entries are split once per row.
    staged = df.withColumn("_own", own).withColumn("_first", first)
    return staged.withColumns(
        {
            **{name: F.get(F.col("_first"), F.lit(i)) for name, i in FIELDS.items()},
            RAW: F.coalesce(raw, F.lit("")),
        }
    ).drop("_own", "_first")

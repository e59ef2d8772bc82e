"""Adding columns from keyed reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.numbers import threshold_flag
from basewise.operators.skew import SALT, add_salt, copy_hot_rows, salted_join

# The genomic key, its names in reference tables, and the count columns
# as the frequency tables and the rollup write them.
GENOMIC_KEY = ("chromosome_id_hg19", "position_hg19", "ref_hg19", "alt_hg19")
TABLE_KEY = {"CHROMOSOME": "chromosome_id_hg19", "POSITION": "position_hg19", "REF": "ref_hg19", "ALT": "alt_hg19"}
TRANSCRIPT_KEY = ("nm_id", "transcript_position", "ref", "alt")
COUNT_NAMES = {
    "gnomadex_alt_count": "gnomAD_EX_alt_count",
    "gnomadex_total_count": "gnomAD_EX_total_count",
    "gnomadex_homozygous_count": "gnomAD_EX_homozygous_count",
    "gnomadwg_alt_count": "gnomAD_WG_alt_count",
    "gnomadwg_total_count": "gnomAD_WG_total_count",
    "gnomadwg_homozygous_count": "gnomAD_WG_homozygous_count",
}


def join_scores(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = TRANSCRIPT_KEY,
    columns: Sequence[str] = ("efeed",),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join that takes only ``columns`` from the second table."""
    return salted_join(a, b.select(*keys, *columns), keys, hot, "inner")


def enrich(
    df: DataFrame,
    tables: Sequence[DataFrame],
    keys: Sequence[str] = GENOMIC_KEY,
    hot: DataFrame | None = None,
    buckets: int = 32,
) -> DataFrame:
    """Left-join every table on the same keys, one after the other.

    All joins ask for the same partitioning, so ``df`` is shuffled once, however
    many tables follow. That sharing also keeps adaptive skew splitting out of
    the later joins; ``hot`` (see ``hot_keys``) spreads the heavy keys up front
    instead. Duplicate keys in a table multiply rows.
    """
    keys = list(keys)
    if hot is None:
        for table in tables:
            df = df.join(table, keys, "left")
        return df
    df = add_salt(df, keys, hot, buckets)
    for table in tables:
        df = df.join(copy_hot_rows(table, keys, hot, buckets), [*keys, SALT], "left")
    return df.drop(SALT)


def enrich_frequencies(
    df: DataFrame,
    exome: DataFrame,
    genome: DataFrame,
    exome_counts: DataFrame,
    genome_counts: DataFrame,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Two frequencies and six counts from four tables keyed CHROMOSOME, POSITION, REF, ALT.

    The counts get the names that the rollup reads.
    """
    ex = [c for c in COUNT_NAMES if c.startswith("gnomadex")]
    wg = [c for c in COUNT_NAMES if c.startswith("gnomadwg")]

    def keyed(table: DataFrame, columns: Sequence[str]) -> DataFrame:
        names = {**TABLE_KEY, **COUNT_NAMES}
        return table.select(*[F.col(c).alias(names.get(c, c)) for c in (*TABLE_KEY, *columns)])

    tables = [
        keyed(exome, ["gnomad_ex"]),
        keyed(genome, ["gnomad_wg"]),
        keyed(exome_counts, ex),
        keyed(genome_counts, wg),
    ]
    return enrich(df, tables, GENOMIC_KEY, hot)


def prefix_columns(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Put ``prefix`` in front of every column that is not a key."""
    return df.select(*[F.col(f"`{c}`") if c in keys else F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def enrich_prefixed(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str] = GENOMIC_KEY,
    prefix: str = "dbNSFP_",
    rename: Mapping[str, str] = TABLE_KEY,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left-join a whole table whose columns get a prefix; ``rename`` aligns its key names first."""
    table = table.withColumnsRenamed(dict(rename))
    return salted_join(df, prefix_columns(table, keys, prefix), keys, hot)


def coverage_flag(
    df: DataFrame,
    coverage: DataFrame,
    threshold: float,
    keys: Sequence[str] = ("chromosome_id_hg19", "position_hg19"),
    percent: str = "gnomAD_EX_coveragePercent",
    flag: str = "gnomAD_EX_coverageFlag",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left-join coverage and flag rows that reach the threshold; no coverage row means a null flag."""
    joined = salted_join(df, coverage.select(*keys, percent), keys, hot)
    return joined.withColumn(flag, threshold_flag(percent, threshold))

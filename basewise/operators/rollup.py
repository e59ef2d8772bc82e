"""One row per genomic variant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basewise.functions.aggregates import joined_set, signed_extreme
from basewise.functions.bases import merge_key
from basewise.operators.enrich import GENOMIC_KEY

# The rollup's column names, in order. The kind says how a group becomes one value.
KEY_NAMES = {"chromosome_id_hg19": "CHR", "position_hg19": "POS", "ref_hg19": "REF", "alt_hg19": "ALT"}
ROLLUP_SPEC = {
    "LiftoverResult": ("any", "liftoverResult"),
    "Coverage": ("any", "gnomAD_EX_coverageFlag"),
    "Transcript": ("keys", ("nm_id", "transcript_position")),
    "dMFE": ("extreme", "deltaMFE"),
    "dEFE": ("extreme", "deltaEFE"),
    "dMEAFE": ("extreme", "deltaMEAFE"),
    "dCFE": ("extreme", "deltaCFE"),
    "dEND": ("extreme", "deltaEND"),
    "dCD": ("extreme", "deltaCD"),
    "MFEED": ("extreme", "mfeed"),
    "MEAED": ("extreme", "meaed"),
    "EFEED": ("extreme", "efeed"),
    "CFEED": ("extreme", "cfeed"),
    "WG_alt_count": ("extreme", "gnomAD_WG_alt_count"),
    "WG_total_count": ("extreme", "gnomAD_WG_total_count"),
    "WG_homozygous_count": ("extreme", "gnomAD_WG_homozygous_count"),
    "EX_alt_count": ("extreme", "gnomAD_EX_alt_count"),
    "EX_total_count": ("extreme", "gnomAD_EX_total_count"),
    "EX_homozygous_count": ("extreme", "gnomAD_EX_homozygous_count"),
    "Annotation": ("set", "snpeffAnnotation"),
    "Impact": ("set", "snpeffPunativeImpact"),
    "Name": ("set", "snpeffGeneName"),
    "ID": ("set", "snpeffGeneID"),
    "Biotype": ("set", "snpeffTranscriptBiotype"),
}

def rollup(
    df: DataFrame,
    keys: Sequence[str] = GENOMIC_KEY,
    spec: Mapping[str, tuple] = ROLLUP_SPEC,
    passed: str | None = "liftoverResult",
    key_names: Mapping[str, str] = KEY_NAMES,
) -> DataFrame:
    """Group the ``PASS`` rows by ``keys``; each ``spec`` entry is one output column.

    Kinds: ``any`` (smallest value, so repeatable), ``extreme`` (farthest from
    zero, sign kept), ``set`` (distinct values, sorted, joined by ``;``) and
    ``keys`` (several columns merged by ``:``, then as a set). ``passed=None``
    rolls up all rows.

    Scores are fixed-size max/min buffers. Each set column has a buffer of its own
    distinct values, all of which are part of the output row; combinations of columns
    are never kept. Everything is combined on the map side, so a heavy key sends one
    short row per input task.
    """
    keys = list(keys)
    if passed is not None:
        df = df.where(F.col(passed) == "PASS")
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    makers = {"any": F.min, "extreme": lambda c: signed_extreme(c, skip_nan=c in fractional)}
    columns = []
    for name, (kind, source) in spec.items():
        if kind in makers:
            columns.append(makers[kind](source).alias(name))
        else:
            columns.append(joined_set(merge_key(*source) if kind == "keys" else source).alias(name))
    return df.groupBy(*keys).agg(*columns).withColumnsRenamed(dict(key_names))

"""Alternate-versus-wildtype scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.numbers import rounded_difference
from basewise.functions.structures import pair_distance
from basewise.functions.trees import tree_distance
from basewise.operators.skew import deal_out, salted_join
from basewise.sources.tool_output import FOLD_SCORES, FOLD_STRUCTURES

# Names of the differences, and of the columns a re-scored table must lose.
DELTA_SOURCES = {
    "deltaMFE": "mfeValue",
    "deltaEFE": "efeValue",
    "deltaMEAFE": "meafeValue",
    "deltaCFE": "cfeValue",
    "deltaEND": "endValue",
    "deltaCD": "cdValue",
}
DISTANCE_SOURCES = {"mfeed": "mfeStructure", "meaed": "meafeStructure", "cfeed": "cfeStructure"}
STALE_COLUMNS = (*DELTA_SOURCES, *DISTANCE_SOURCES, "efeed")
WILDTYPE_KEY = ("nm_id", "transcript_position")
WILDTYPE_PREFIX = "wt_"


def split_wildtype(df: DataFrame, flag: str = "isWildType") -> tuple[DataFrame, DataFrame]:
    """(alternates, wildtypes)."""
    return df.where(~F.col(flag)), df.where(F.col(flag))


def drop_stale_scores(df: DataFrame, columns: Sequence[str] = STALE_COLUMNS, flag: str = "isWildType") -> DataFrame:
    """Drop old difference and distance columns and mark every row as an alternate."""
    return df.drop(*columns).withColumn(flag, F.lit(False))


def attach_wildtype(
    alternates: DataFrame,
    wildtypes: DataFrame,
    keys: Sequence[str] = WILDTYPE_KEY,
    columns: Sequence[str] = (*FOLD_SCORES, *FOLD_STRUCTURES),
    prefix: str = WILDTYPE_PREFIX,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner-join each alternate with its position's wildtype, whose ``columns`` get ``prefix``.

    ``hot`` (see ``hot_keys``) spreads keys that hold much of the alternates.
    """
    baseline = wildtypes.select(*keys, *[F.col(c).alias(prefix + c) for c in columns])
    return salted_join(alternates, baseline, keys, hot, "inner")


def deltas(
    df: DataFrame, pairs: Mapping[str, str] = DELTA_SOURCES, prefix: str = WILDTYPE_PREFIX, scale: int = 2
) -> DataFrame:
    """Add ``name = alternate - wildtype`` for each ``name: column`` pair, rounded first."""
    return df.withColumns({name: rounded_difference(c, prefix + c, scale) for name, c in pairs.items()})


def pair_distances(
    df: DataFrame, pairs: Mapping[str, str] = DISTANCE_SOURCES, prefix: str = WILDTYPE_PREFIX
) -> DataFrame:
    """Add base-pair distances between each alternate structure and its wildtype.

    This is the size of the symmetric difference of the two base-pair sets; see
    :func:`tree_distances` for the tree-edit distance.
    """
    return df.withColumns({name: pair_distance(prefix + c, c) for name, c in pairs.items()})


def tree_distances(
    df: DataFrame, pairs: Mapping[str, str] = DISTANCE_SOURCES, prefix: str = WILDTYPE_PREFIX
) -> DataFrame:
    """Add tree-edit distances between each alternate structure and its wildtype; rows are dealt out for it."""
    df = deal_out(df)
    return df.withColumns({name: tree_distance(prefix + c, c) for name, c in pairs.items()})

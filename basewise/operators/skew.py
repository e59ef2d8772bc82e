"""Joins that stay balanced when a few keys hold much of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
# A heavy-key list is bounded by construction: at most 1 / share keys can hold that share of the rows.
DEFAULT_SHARE = 0.002


def spread(buckets: int, columns: Sequence[str] = ()) -> Column:
    """A bucket number that spreads rows, exact copies included, and is the same when a task is retried.

    It mixes the task number with the row's content: copies land in different
    buckets because they sit in different input splits, and re-running a lost
    task sends each row to the same bucket again (a random number would not).
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns]), F.lit(buckets))


def deal_out(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt evenly over the tasks, for costly or growing work on a table whose files give few splits.

    Without a number: three tasks a core. The number is explicit because adaptive
    execution would size tasks by the small input and merge them.
    """
    return df.repartition(partitions or 3 * df.sparkSession.sparkContext.defaultParallelism)


def deal_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over 16 tasks a core by their keys, for joins whose rows grow much wider than what is shuffled.

    The number is explicit because adaptive execution would merge tasks by the bytes shuffled.
    """
    return df.repartition(16 * df.sparkSession.sparkContext.defaultParallelism, *keys)


PLACE = "_place"


def splittable(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], always: bool = True
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides and the condition of an equi-join whose skewed partitions adaptive execution can split.

    Spark splits a skewed partition only where both inputs of the join come
    straight from a shuffle. A side that was just aggregated on the same keys
    is not shuffled again and rules that out; a hash of the keys as one more
    join key asks for the shuffle. Meant for sides that are small beside the
    other. Both are shuffled: Spark's estimate of a side knows nothing of rows that
    were exploded, nor of long texts, and would have it broadcast through the driver
    at any size. With ``always=False`` only a table that stems from files, which alone
    has such an estimate, is kept from it. Drop ``PLACE`` and ``PLACE + "r"`` from the result.
    """
    left = left.withColumn(PLACE, F.xxhash64(*[F.col(a) for a, _ in keys]))
    right = right.withColumn(PLACE + "r", F.xxhash64(*[F.col(b) for _, b in keys]))
    if always or right.inputFiles():
        right = right.hint("merge")
    condition = F.col(PLACE) == F.col(PLACE + "r")
    for a, b in keys:
        condition = condition & (F.col(a) == F.col(b))
    return left, right, condition


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float = DEFAULT_SHARE,
    fraction: float = 1.0,
    seed: int = 7,
) -> DataFrame:
    """Distinct key values that hold at least ``share`` of the rows (so at most ``1 / share`` of them).

    Counted at once, by an aggregation over the key columns, and returned as a
    local table: both sides of a salted join must see the very same list.
    ``fraction`` below 1 looks at a sample. Whatever is found only decides how
    rows are spread in :func:`salted_join`, never which rows are joined.
    """
    looked_at = df.select(*keys)
    if fraction < 1.0:
        looked_at = looked_at.sample(fraction=fraction, seed=seed)
    floor = looked_at.count() * share
    # At most 1 / share keys can reach the floor, so the limit cuts none of them off.
    heavy = (
        looked_at.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"))
        .limit(int(1 / share) + 1)
        .where(F.col("_n") >= floor)
        .select(*keys)
        .dropna()
    )
    return df.sparkSession.createDataFrame(heavy.collect(), heavy.schema)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None = None,
    how: str = "left",
    buckets: int = 32,
) -> DataFrame:
    """Equi-join on ``keys``; rows with a ``hot`` key are spread over ``buckets`` tasks.

    Only the right rows of hot keys are copied, once per bucket. Key equality is
    SQL equality (nulls match nothing). Without ``hot`` it is an ordinary join.
    ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    left = add_salt(left, keys, hot, buckets)
    return left.join(copy_hot_rows(right, keys, hot, buckets), [*keys, SALT], how).drop(SALT)


def _mark(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    # hot_keys() bounds the list, so this broadcast does not grow with the data.
    return df.join(F.broadcast(hot.select(*keys).distinct().withColumn("_hot", F.lit(True))), keys, "left")


def add_salt(df: DataFrame, keys: Sequence[str], hot: DataFrame, buckets: int) -> DataFrame:
    """Left side of a salted join: 0 for ordinary keys, a bucket for hot keys and for keys with a null."""
    keys = list(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    bucket = spread(buckets, df.columns)
    marked = _mark(df, keys, hot)
    return marked.withColumn(SALT, F.when(F.col("_hot") | missing, bucket).otherwise(F.lit(0).cast("long"))).drop("_hot")


def copy_hot_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame, buckets: int) -> DataFrame:
    """Right side of a salted join: hot rows once per bucket, all other rows once."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))
    salts = F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0).cast("long")))
    return _mark(df, list(keys), hot).withColumn(SALT, F.explode(salts)).drop("_hot")

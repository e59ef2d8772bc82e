"""Reference tables stored by key, and left joins that never move them.

A table that is joined again and again is written once in buckets of its key, sorted.
A join then shuffles only the other side, once for all tables. Rows that can match
nothing, often a large share that would all meet on one key, go around the joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.operators.enrich import GENOMIC_KEY
from basewise.operators.settle import shared_folder

BUCKETS = 2048


def store_by_key(
    table: DataFrame, keys: Sequence[str] = GENOMIC_KEY, buckets: int = BUCKETS, name: str | None = None, path: str | None = None
) -> DataFrame:
    """Write a table in buckets of its keys and return it as read from there.

    ``path`` is where the files go, a new folder in the shared one by default; ``name``
    is the table's name in the session's catalog. Choose ``buckets`` so that one bucket
    of the largest table fits a task; tables that are joined together need the same.
    """
    spark = table.sparkSession
    name = name or f"stored_{uuid.uuid4().hex}"
    path = path or f"{shared_folder(spark).rstrip('/')}/{name}"
    # One task per bucket writes one file per bucket, instead of each task one for every bucket.
    dealt = table.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def enrich_stored(
    df: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str] = GENOMIC_KEY, buckets: int = BUCKETS, usable: Column | None = None
) -> DataFrame:
    """Left-join tables made by :func:`store_by_key` on their keys; only ``df`` is shuffled, once.

    ``usable`` tells which rows can match at all (by default those without a null
    key). The others get nulls and are not shuffled, so a key that stands for
    'nothing' does not gather in one task. Duplicate keys in a table multiply rows.
    """
    keys = list(keys)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    can_match = F.coalesce(whole if usable is None else whole & usable, F.lit(False))
    joined = df.where(can_match).repartition(buckets, *keys)
    # The sort-merge join keeps the buckets where they are; a broadcast or a shuffle of the table would not.
    for table in tables:
        joined = joined.join(table.hint("merge"), keys, "left")
    extra = [(f.name, f.dataType) for t in tables for f in t.schema.fields if f.name not in keys]
    others = df.where(~can_match).select(*[F.col(f"`{c}`") for c in df.columns], *[F.lit(None).cast(kind).alias(c) for c, kind in extra])
    return joined.select(*[F.col(f"`{c}`") for c in (*df.columns, *[c for c, _ in extra])]).unionByName(others)

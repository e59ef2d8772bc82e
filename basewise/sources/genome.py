"""A reference genome as fixed-size chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = 10_000


def read_genome_chunks(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """FASTA genome -> ``chr, chunk_id, bases``; chunk k holds bases ``k*chunk+1 .. (k+1)*chunk``.

    The contig name is the header up to its first blank. Files are read line by
    line in ordinary input splits. Offsets are running sums inside each split,
    carried over split borders by one small row per split, so no task sees more
    than a split of lines or a chunk of bases.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", r"\s+$", "").alias("text"),
    )
    is_header = F.col("text").startswith(">")
    lines = lines.select(
        "file",
        "split",
        "at",
        "text",
        F.when(is_header, F.regexp_extract("text", r"^>\s*(\S*)", 1)).alias("header"),
        F.when(is_header, 0).otherwise(F.length("text")).cast("long").alias("bases"),
    )
    walk = Window.partitionBy("file", "split").orderBy("at")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    lines = lines.withColumn("run", F.coalesce(F.sum("bases").over(before), zero)).withColumns(
        {
            "name": F.last("header", ignorenulls=True).over(walk),
            "origin": F.last(F.when(F.col("header").isNotNull(), F.col("run")), ignorenulls=True).over(walk),
        }
    )
    splits = lines.groupBy("file", "split").agg(
        F.sum("bases").alias("total"),
        F.max_by("header", F.when(F.col("header").isNotNull(), F.col("at"))).alias("last_header"),
        F.max_by("run", F.when(F.col("header").isNotNull(), F.col("at"))).alias("last_origin"),
    )
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(order), zero)).select(
        "file",
        "split",
        "base",
        F.last("last_header", ignorenulls=True).over(order).alias("carried_name"),
        F.last(F.col("base") + F.col("last_origin"), ignorenulls=True).over(order).alias("carried_origin"),
    )
    placed = lines.where(F.col("bases") > 0).join(splits, ["file", "split"])
    placed = placed.select(
        F.coalesce("name", "carried_name").alias("chr"),
        (
            F.col("base") + F.col("run") - F.coalesce(F.col("base") + F.col("origin"), F.col("carried_origin"))
        ).alias("offset"),
        "text",
    )
    # A line fills up the open chunk and then whole chunks: linear also for one line per contig.
    room = (F.lit(chunk) - F.col("offset") % chunk).cast("int")
    rest = F.regexp_extract_all(F.substring("text", room + 1, F.length("text")), F.lit(".{1,%d}" % chunk), F.lit(0))
    pieces = F.concat(F.array(F.left("text", room)), rest)
    cut = placed.select(
        "chr",
        F.floor(F.col("offset") / F.lit(chunk)).alias("first"),
        (F.col("offset") % chunk).alias("inside"),
        F.posexplode(pieces).alias("i", "piece"),
    ).select(
        "chr",
        (F.col("first") + F.col("i")).alias("chunk_id"),
        F.struct(F.when(F.col("i") == 0, F.col("inside")).otherwise(0).alias("inside"), "piece").alias("part"),
    )
    parts = F.array_sort(F.collect_list("part"))
    return cut.groupBy("chr", "chunk_id").agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("bases")
    )

"""Chain files as a table of gap-free blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basewise.operators.skew import splittable


def parse_chains(records: DataFrame, text: str = "value") -> DataFrame:
    """Chain records -> one row per block.

    A record is a header (``score tName tSize tStrand tStart tEnd qName qSize
    qStrand qStart qEnd id``, with or without the word ``chain`` in front) and
    lines ``size dt dq``. Columns: ``src_chr, src_start, src_end`` (1-based,
    closed), ``dst_chr, dst_start`` (1-based, counted along the target strand),
    ``dst_strand, dst_size, score, chain_id, src_run_end`` (end of the stretch
    of blocks that follow each other without a hole on the source side).
    """
    tidy = F.regexp_replace(F.regexp_replace(F.col(text), r"\r", ""), r"^chain\s+", "")
    records = records.select(tidy.alias("record")).where(F.rlike(F.col("record"), F.lit(r"^[0-9]")))
    lines = records.select(
        F.split(F.split("record", "\n")[0], r"\s+").alias("h"),
        F.posexplode(F.slice(F.split("record", "\n"), 2, 2147483647)).alias("line", "cells"),
    ).where(F.rlike(F.col("cells"), F.lit(r"^\s*[0-9]")))
    cell = F.split(F.trim("cells"), r"\s+")

    def number(index: int):
        return F.coalesce(F.get(cell, F.lit(index)).try_cast("long"), F.lit(0).cast("long"))

    h = F.col("h")
    blocks = lines.select(
        h[0].try_cast("long").alias("score"),
        h[1].alias("src_chr"),
        h[4].try_cast("long").alias("t_start"),
        h[6].alias("dst_chr"),
        h[7].try_cast("long").alias("dst_size"),
        h[8].alias("dst_strand"),
        h[9].try_cast("long").alias("q_start"),
        F.get(h, F.lit(11)).alias("chain_id"),
        "line",
        number(0).alias("size"),
        number(1).alias("dt"),
        number(2).alias("dq"),
    )
    chain = ["score", "src_chr", "t_start", "dst_chr", "dst_size", "dst_strand", "q_start", "chain_id"]
    before = Window.partitionBy(*chain).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.withColumns(
        {
            "t_before": F.coalesce(F.sum(F.col("size") + F.col("dt")).over(before), zero),
            "q_before": F.coalesce(F.sum(F.col("size") + F.col("dq")).over(before), zero),
            "run": F.coalesce(F.sum(F.when(F.col("dt") > 0, 1).otherwise(0)).over(before), zero),
        }
    ).withColumns(
        {
            "src_start": F.col("t_start") + F.col("t_before") + 1,
            "src_end": F.col("t_start") + F.col("t_before") + F.col("size"),
            "dst_start": F.col("q_start") + F.col("q_before") + 1,
        }
    )
    run = Window.partitionBy(*chain, "run")
    return blocks.where(F.col("size") > 0).select(
        "src_chr",
        "src_start",
        "src_end",
        "dst_chr",
        "dst_start",
        "dst_strand",
        "dst_size",
        "score",
        "chain_id",
        F.max("src_end").over(run).alias("src_run_end"),
    )


def parse_chain_lines(lines: DataFrame) -> DataFrame:
    """Lines of chain files -> the columns of :func:`parse_chains`, whatever the length of a chain.

    ``lines`` has ``file``, ``split`` (ascending within a file), ``at`` (ascending
    within a split) and ``text``. Sums run inside each split, as in one pass over the
    file; a second pass over one row per split carries the last chain's header and
    sums into the next split. No task sees more than one split's lines, so one chain
    of any length is spread like many. A block line in front of any header, and a
    chain whose header lacks numbers, give no rows.
    """
    tidy = F.regexp_replace(F.regexp_replace("text", r"\s+$", ""), r"^\s*chain\s+", "")
    words = F.split(F.trim(tidy), r"\s+")
    lines = lines.select("file", "split", "at", words.alias("w")).withColumn("is_header", F.size("w") >= 11)
    lines = lines.where(F.col("is_header") | ((F.size("w") <= 3) & F.rlike(F.get("w", F.lit(0)), F.lit("^[0-9]+$"))))
    zero = F.lit(0).cast("long")

    def number(index: int):
        cell = F.get("w", F.lit(index)).try_cast("long")
        return F.when(F.col("is_header"), zero).otherwise(F.coalesce(cell, zero))

    h = F.col("w")
    head = F.struct(
        h[0].try_cast("long").alias("score"), h[1].alias("src_chr"), h[4].try_cast("long").alias("t_start"),
        h[6].alias("dst_chr"), h[7].try_cast("long").alias("dst_size"), h[8].alias("dst_strand"),
        h[9].try_cast("long").alias("q_start"), F.get(h, F.lit(11)).alias("chain_id"),
        F.col("file"), F.col("split"), F.col("at"),
    )
    lines = lines.select(
        "file", "split", "at", F.when(F.col("is_header"), head).alias("head"),
        number(0).alias("size"), number(1).alias("dt"), number(2).alias("dq"),
    )
    walk = Window.partitionBy("file", "split").orderBy("at")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    sums = {"t": F.col("size") + F.col("dt"), "q": F.col("size") + F.col("dq"), "run": F.when(F.col("dt") > 0, 1).otherwise(0).cast("long")}
    lines = lines.withColumns({c: F.coalesce(F.sum(step).over(before), zero) for c, step in sums.items()})
    # A header with the sums in front of it: what is behind it counts from there.
    origin = F.when(F.col("head").isNotNull(), F.struct("head", *sums))
    lines = lines.withColumn("own", F.last(origin, ignorenulls=True).over(walk))
    splits = lines.groupBy("file", "split").agg(
        F.max_by(origin, F.when(F.col("head").isNotNull(), F.col("at"))).alias("last"),
        *[F.sum(step).alias(f"sum_{c}") for c, step in sums.items()],
    )
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumns({f"base_{c}": F.coalesce(F.sum(f"sum_{c}").over(order), zero) for c in sums})
    whole = F.when(
        F.col("last").isNotNull(),
        F.struct(F.col("last.head").alias("head"), *[(F.col(f"base_{c}") + F.col(f"last.{c}")).alias(c) for c in sums]),
    )
    splits = splits.select("file", "split", *[f"base_{c}" for c in sums], F.last(whole, ignorenulls=True).over(order).alias("carried"))
    placed = lines.where("head is null and size > 0").join(splits, ["file", "split"])
    own = F.col("own").isNotNull()
    placed = placed.select(
        "size",
        F.when(own, F.col("own.head")).otherwise(F.col("carried.head")).alias("head"),
        *[
            F.when(own, F.col(c) - F.col(f"own.{c}")).otherwise(F.col(f"base_{c}") + F.col(c) - F.col(f"carried.{c}")).alias(c)
            for c in sums
        ],
    ).where("head.t_start is not null and head.q_start is not null and head.dst_size is not null")
    chain = ["file", "split", "at"]
    blocks = placed.select(
        *[F.col(f"head.{c}").alias(c) for c in chain],
        "head",
        "run",
        (F.col("head.t_start") + F.col("t") + 1).alias("src_start"),
        (F.col("head.t_start") + F.col("t") + F.col("size")).alias("src_end"),
        (F.col("head.q_start") + F.col("q") + 1).alias("dst_start"),
    )
    ends = blocks.groupBy(*[F.col(c).alias(f"_{c}") for c in (*chain, "run")]).agg(F.max("src_end").alias("src_run_end"))
    left, right, match = splittable(blocks, ends, [(c, f"_{c}") for c in (*chain, "run")])
    return left.join(right, match).select(
        "head.src_chr", "src_start", "src_end", "head.dst_chr", "dst_start", "head.dst_strand", "head.dst_size",
        "head.score", "head.chain_id", "src_run_end",
    )


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Read chain files line by line in ordinary input splits, so that one very long chain feeds all tasks."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("text"),
    )
    return parse_chain_lines(lines)

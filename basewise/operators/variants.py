"""Every single-base variant of every sequence, with its centred context window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.bases import BASES, replace_base

# Window width and the letters that replace a base.
WINDOW = 101
# Positions cut from one chunk of text. Chunks are made in one linear pass, so a
# long sequence costs its length and not its length squared.
CHUNK = 500


def _chunked(df: DataFrame, sequence: str, width: int) -> DataFrame:
    """One row per ``CHUNK`` positions: ``_first`` (0-based), ``_text`` and the start of ``_text``.

    ``_text`` is the chunk with up to ``width - 1`` neighbours on both sides,
    enough for each window that is centred in, or clamped into, the chunk.
    """
    size = max(CHUNK, width)
    margin = width - 1
    pieces = F.regexp_extract_all(F.col(sequence), F.lit("(?s).{1,%d}" % size), F.lit(0))
    df = df.withColumn("_pieces", pieces)
    parts = F.col("_pieces")
    with_context = F.transform(
        parts,
        lambda text, i: F.struct(
            (i * size).alias("first"),
            F.length(text).alias("count"),
            F.greatest(i * size - margin, F.lit(0)).alias("start"),
            F.concat(
                F.when(i > 0, F.right(F.get(parts, i - 1), F.lit(margin))).otherwise(""),
                text,
                F.coalesce(F.left(F.get(parts, i + 1), F.lit(margin)), F.lit("")),
            ).alias("text"),
        ),
    )
    keep = [F.col(c) for c in df.columns if c not in (sequence, "_pieces")]
    return df.select(
        *keep, F.length(sequence).alias("_n"), F.explode(with_context).alias("_chunk")
    )


def windows(
    df: DataFrame,
    sequence: str = "sequence",
    width: int = WINDOW,
    short: str = "all",
    partitions: int | str | None = "auto",
) -> DataFrame:
    """One row per position: ``transcript_position`` (1-based), ``ref``, ``wildSequence``, ``window_index``.

    The window is ``width`` characters around the position, moved inwards at both
    ends so that it never leaves the sequence; ``window_index`` is the 0-based
    place of the position in it. A sequence of at most ``width`` characters is
    its own window; ``short='reference'`` produces only its first
    ``width // 2 + 1`` positions (by default all are produced).

    The output is hundreds of times the input, so the chunks are first dealt out
    evenly over ``partitions`` tasks: one long sequence, or many copies of one,
    then feeds all tasks, and few input files still use the whole cluster. Only
    the input text is shuffled for this, never the windows. ``'auto'`` takes the
    larger of the session's shuffle partitions and default parallelism, ``None``
    leaves the input's partitioning. (The number is explicit because adaptive
    execution would size tasks by the small input and merge them. Spark sorts
    each task's rows before dealing them, so a re-run task deals alike.)
    """
    if short not in ("reference", "all"):
        raise ValueError("short must be 'reference' or 'all'")
    half = width // 2
    chunks = _chunked(df, sequence, width)
    if partitions == "auto":
        session = df.sparkSession
        partitions = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    if partitions:
        chunks = chunks.repartition(int(partitions))
    n = F.col("_n")
    last = n if short == "all" else F.when(n > width, n).otherwise(F.least(n, F.lit(half + 1)))
    chunk = F.col("_chunk")
    keep = [c for c in chunks.columns if c not in ("_n", "_chunk")]
    flat = chunks.select(
        *keep,
        "_n",
        chunk["first"].alias("_first"),
        chunk["start"].alias("_start"),
        chunk["text"].alias("_text"),
        F.least(chunk["count"], last - chunk["first"]).alias("_stop"),
    ).where(F.col("_stop") > 0)
    # A plain explode and plain substrings stay in generated code, where the chunk is referred to, not copied.
    stepped = flat.select(*keep, "_n", "_first", "_start", "_text", F.explode(F.sequence(F.lit(1), "_stop")).alias("_k"))
    position = F.col("_first") + F.col("_k")  # 1-based
    start = F.greatest(F.least(position - 1 - half, n - width), F.lit(0))
    return stepped.select(
        *keep,
        position.cast("int").alias("transcript_position"),
        F.substring("_text", position - F.col("_start"), F.lit(1)).alias("ref"),
        F.substring("_text", start - F.col("_start") + 1, F.lit(width)).alias("wildSequence"),
        (position - 1 - start).cast("int").alias("window_index"),
    )


def alternates(df: DataFrame, wildtype: bool = True, unknown: str = "all") -> DataFrame:
    """Windows -> three alternates per position, plus the wildtype row.

    A base outside the alphabet (N, lower case) has four alternates and the
    wildtype row; with ``unknown='reference'`` the first three of the alphabet
    are taken and the last one's row is the wildtype.
    """
    if unknown not in ("reference", "all"):
        raise ValueError("unknown must be 'reference' or 'all'")
    keep = [c for c in df.columns if c not in ("wildSequence", "window_index")]
    ref, letter = F.col("ref"), F.col("_letter")
    outside = ~ref.isin(*BASES)
    bases = [F.lit(b) for b in BASES]
    if unknown == "all":
        own = letter == ref
        letters = F.when(outside, F.array(*bases, ref)).otherwise(F.array(*bases))
    else:
        own = (letter == ref) | (outside & (letter == BASES[-1]))
        letters = F.array(*bases)
    rows = df.select("*", F.explode(letters).alias("_letter"))
    if not wildtype:
        rows = rows.where(~own)
    return rows.select(
        *keep,
        F.when(own, ref).otherwise(letter).alias("alt"),
        F.when(own, F.col("wildSequence"))
        .otherwise(replace_base("wildSequence", F.col("window_index"), letter))
        .alias("sequence"),
        "wildSequence",
        own.alias("isWildType"),
    )


def variants(
    df: DataFrame,
    sequence: str = "sequence",
    width: int = WINDOW,
    short: str = "all",
    partitions: int | str | None = "auto",
) -> DataFrame:
    """Sequences -> the variants table: four rows per position, one of them the wildtype."""
    return alternates(windows(df, sequence, width, short, partitions))

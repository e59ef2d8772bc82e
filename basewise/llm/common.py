"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
# Arrow batches are worked on in runs of at most about this many characters.
RUN_CHARS = 1_000_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1_000
# Places of a bitmap of marked values: 8 MB, whatever the number of values.
MARKS = 1 << 26


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a folder of our own only where none is set, as in tests."""
    folder = spark.conf.get(CHECKPOINT, None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Arrow batches are kept to rows of whole texts, unless the session says how large they are."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute once, keep in the shared folder, forget the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_mark(df: DataFrame, value: Column, marks: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: whether ``value`` (a long) may stand in ``marks`` (one column of longs).

    False is certain, also for null; true may be a clash of two values on one place of a bitmap, which alone is
    broadcast. So rows that certainly meet nothing are told apart, and only the others need be shuffled for a join.
    """

    def place(of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(MARKS)) + 1

    found = marks.select(place(F.col(f"`{marks.columns[0]}`")).alias("_place"))
    bitmaps = found.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position(place(value))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, 1)), 16, 10).cast("long")
    joined = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place(value)) == F.col("_bucket"), "left")
    marked = value.isNotNull() & F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn(name, marked).drop("_bucket", "_bits")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of a string column, null as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def runs(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``RUN_CHARS`` characters at most, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pa.compute.binary_length(column).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        size = size or 0
        if i > start and total + size > RUN_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def map_batches(df: DataFrame, text: str, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``make()`` once per task gives a function from a record batch to a record batch (or None)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in runs(batch, text):
                out = step(part)
                if out is not None:
                    yield out

    return df.mapInArrow(work, schema)


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number

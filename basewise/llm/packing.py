"""Packing of documents into windows of a fixed number of tokens, by least squares on lengths.

Every document is its ids and one closing id. Full windows are cut off its front; the
rest, shorter than a window, is one piece. How often which shallow combination of
rests fills a window is planned from the histogram of their lengths, which has at
most as many rows as a window has tokens, so the plan is made on the driver and its
size does not grow (``nnls``): least squares counts rounded down, then greedy exact
fills. A rest's place is its number among all rests of its length: the number within
its task, counted while encoding, plus the counts of the tasks before. The plan gives
the sequence and offset of each place. Rests that no pattern takes are laid end to
end and cut at window borders; the last, incomplete window is cut into powers of two,
which need no padding. So each rest is cut once at most (but for that last window),
and no sequence is padded at all.

Encoded lengths and checksums are written to the shared folder; the ids of a rest are
read again only where a cut falls inside it, from the files of the tasks that have
such rests.

Null texts count as empty (the closing id alone), repeated rows and null ids are
packed as documents of their own, an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm import nnls
from basewise.llm.common import Numbers, runs, settle, texts_of
from basewise.llm.warc import scratch_path

WINDOW, CLOSING = 2048, 1
# The vocabulary's rule always cuts between other characters and white space, and between a letter and a mark that
# ends a clause, so such stretches are encoded on their own.
STRETCH = re.compile(r"[ \t-\r]*[A-Za-zÀ-ÖØ-öø-ÿ]++(?:(?![,.;:!?])[^ \t-\r]+)?|[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# Characters that count as white space to one of the two engines only, or that are not in the class above.
RARE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Where a text with rare characters is cut: letters or digits of ASCII, then a space and a letter or digit.
PLAIN = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
# Stretches, and ids in them, after which a task forgets what it remembers; stretches encoded in one text.
REMEMBERED, REMEMBERED_IDS, TOGETHER = 600_000, 20_000_000, 1_000

CUT_SCHEMA = (
    "task int, at long, doc_id {id}, doc_tokens long, rest int, place long, windows long, windows_before long, "
    "window_crcs array<long>, rest_crc long, rest_ids binary"
)
PIECE_SCHEMA = "task int, at long, doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; stretches between white space are encoded once and remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Each character of a token's name stands for one byte of text.
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(names.values()) + 1, dtype=np.int64)
        for name, number in names.items():
            self.width[number] = len(name)
        self.forget()

    def forget(self) -> None:
        """Drop all stretches."""
        self.numbers = Numbers()
        self.begin = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def learn(self, stretches: list[str]) -> None:
        """Encode new stretches, in order."""
        # Those between white space and other characters can stand one behind the other: the rule cuts between them.
        plain = np.array([s[0] in " \t\n\v\f\r" and not s[-1].isspace() and not RARE.search(s) for s in stretches], dtype=bool)
        sizes = np.zeros(len(stretches), dtype=np.int64)
        ids = [np.zeros(0, dtype=np.uint32)] * 2
        joined = [s for s, p in zip(stretches, plain, strict=True) if p]
        if joined:
            texts = ["".join(joined[at : at + TOGETHER]) for at in range(0, len(joined), TOGETHER)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids[0] = np.concatenate([np.array(f.ids, dtype=np.uint32) for f in found])
            # The bytes of the ids tell where each stretch ends.
            ends = np.searchsorted(np.cumsum(self.width[ids[0]]), np.cumsum([len(s.encode()) for s in joined])) + 1
            sizes[plain] = np.diff(ends, prepend=0)
        alone = [s for s, p in zip(stretches, plain, strict=True) if not p]
        if alone:
            found = self.tokenizer.encode(alone, is_pretokenized=True, add_special_tokens=False)
            ids[1] = np.array(found.ids, dtype=np.uint32)
            sizes[~plain] = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(alone))
        begin = np.zeros(len(stretches), dtype=np.int64)
        at = len(self.ids)
        for part, chosen in zip(ids, (plain, ~plain), strict=True):
            begin[chosen] = at + np.cumsum(sizes[chosen]) - sizes[chosen]
            at += len(part)
        self.begin, self.size = np.append(self.begin, begin), np.append(self.size, sizes)
        self.ids = np.concatenate((self.ids, *ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the tokenizers library gives them without added special tokens."""
        if len(self.numbers) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self.forget()
        known = len(self.numbers)
        cut = [self.stretches(t) for t in texts]
        used = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), dtype=np.int64)
        if len(self.numbers) > known:
            self.learn(list(islice(self.numbers, known, None)))
        size = self.size[used]
        behind = np.cumsum(size)
        ids = self.ids[np.repeat(self.begin[used] - behind + size, size) + np.arange(size.sum())]
        ends = np.concatenate(([0], behind))[np.cumsum([0, *map(len, cut)])].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    @staticmethod
    def stretches(text: str) -> list[str]:
        """Parts of a text whose ids stand for themselves."""
        if not RARE.search(text):
            return STRETCH.findall(text)
        at = [0, *(m.start() for m in PLAIN.finditer(text)), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:], strict=False) if b > a]


def cut_documents(docs: DataFrame, path: str, window: int, closing: int) -> DataFrame:
    """Per document: its windows' checksums, and of the rest the ids, checksum and number among the task's rests of this length."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder(path), TaskContext.get().partitionId()
        end = array("I", [closing]).tobytes()
        places = [0] * window
        at = full = 0
        for batch in batches:
            for part in runs(batch, "text"):
                columns: dict[str, list] = {c: [] for c in ("at", "doc_tokens", "rest", "place", "windows", "windows_before", "window_crcs", "rest_crc", "rest_ids")}
                for ids in encoder.encode(texts_of(part.column(1))):
                    ids += end
                    tokens = len(ids) // 4
                    windows, rest = divmod(tokens, window)
                    step, tail = 4 * window, ids[4 * window * windows :]
                    row = (at, tokens, rest, places[rest], windows, full, [zlib.crc32(ids[i * step : i * step + step]) for i in range(windows)], zlib.crc32(tail), tail)
                    for values, value in zip(columns.values(), row, strict=True):
                        values.append(value)
                    at, full = at + 1, full + windows
                    places[rest] += 1
                n = part.num_rows
                arrays = [pa.array([task] * n, pa.int32()), pa.array(columns["at"], pa.int64()), part.column(0)]
                arrays += [pa.array(columns[c], pa.int32() if c == "rest" else pa.int64()) for c in ("doc_tokens", "rest", "place", "windows", "windows_before")]
                arrays += [pa.array(columns["window_crcs"], pa.list_(pa.int64())), pa.array(columns["rest_crc"], pa.int64()), pa.array(columns["rest_ids"], pa.binary())]
                yield pa.record_batch(arrays, names=[f.strip().split(" ")[0] for f in CUT_SCHEMA.split(",")])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, CUT_SCHEMA.format(id=kind))


class Layout:
    """Sequence and offset of every rest, from the plan: ``place`` counts rests of one length over all tasks."""

    def __init__(self, histogram: np.ndarray, first_sequence: int) -> None:
        self.window = len(histogram) + 1
        made, left = nnls.plan(np.append(histogram, 0))
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        taken = np.zeros(self.window + 1, dtype=np.int64)
        sequence = first_sequence
        for uses, repeats in made:
            offset = 0
            for length, times in uses.items():
                slots.setdefault(length, []).append((int(taken[length]), times, sequence, offset))
                taken[length] += times * repeats
                offset += times * length
            sequence += repeats
        self.slots = {length: np.array(rows, dtype=np.int64).T for length, rows in slots.items()}
        self.taken = taken
        # Where the rests of a length begin in the stream of those without a pattern, longest first.
        amount = left * np.arange(self.window + 1)
        self.stream = np.cumsum(amount[::-1])[::-1] - amount
        self.stream_sequence = sequence
        total = int(amount.sum())
        self.whole = total // self.window * self.window
        # The incomplete last window as powers of two.
        tail = total - self.whole
        sizes = [1 << bit for bit in range(tail.bit_length() - 1, -1, -1) if tail >> bit & 1]
        self.tail = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64) + self.whole

    def pieces(self, length: int, place: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of the pieces of one rest."""
        if place < self.taken[length]:
            first, times, sequence, offset = self.slots[length]
            at = int(np.searchsorted(first, place, side="right")) - 1
            repeat, use = divmod(place - int(first[at]), int(times[at]))
            return [(0, length, int(sequence[at]) + repeat, int(offset[at]) + use * length)]
        out, begin = [], int(self.stream[length]) + (place - int(self.taken[length])) * length
        at = begin
        while at < begin + length:
            if at < self.whole:
                number, offset = divmod(at, self.window)
                border = (number + 1) * self.window
            else:
                k = int(np.searchsorted(self.tail, at, side="right")) - 1
                number, offset, border = self.whole // self.window + k, at - int(self.tail[k]), int(self.tail[k + 1])
            stop = min(begin + length, border)
            out.append((at - begin, stop - at, self.stream_sequence + number, offset))
            at = stop
        return out


def place_pieces(placed: DataFrame, layout: Layout, kind: str) -> DataFrame:
    """All pieces of documents whose rests have their number among all; ``ids_crc32`` is null where a cut falls into a rest."""
    window = layout.window
    names = [f.strip().split(" ")[0] for f in PIECE_SCHEMA.split(",")]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                source: list[int] = []
                rows: list[tuple] = []
                columns = [part.column(i).to_pylist() for i in range(3, 9)]
                for i, (tokens, rest, place, window_at, crcs, crc) in enumerate(zip(*columns, strict=True)):
                    for k, value in enumerate(crcs):
                        source.append(i)
                        rows.append((k * window, window, value, tokens, window_at + k, 0))
                    if rest:
                        found = layout.pieces(rest, place)
                        for start, length, sequence, offset in found:
                            source.append(i)
                            rows.append((tokens - rest + start, length, crc if len(found) == 1 else None, tokens, sequence, offset))
                taken = part.take(pa.array(source, pa.int64()))
                values = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.record_batch([*[taken.column(i) for i in range(3)], *[pa.array(list(v), pa.int64()) for v in values]], names=names)

    return placed.mapInArrow(work, PIECE_SCHEMA.format(id=kind))


def pack(docs: DataFrame, path: str, window: int = WINDOW, closing: int = CLOSING) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``docs`` has ``doc_id`` and ``text``; ``path`` is a vocabulary file of the
    tokenizers library, whose pre-tokenizer must cut in front of white space.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = scratch_path(spark, "cut")
    cut_documents(docs, path, window, closing).write.option("compression", "zstd").parquet(kept)
    cut = spark.read.schema(CUT_SCHEMA.format(id=kind)).parquet(kept)

    counts = settle(cut.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum("windows").alias("windows")))
    histogram = np.zeros(window - 1, dtype=np.int64)
    for row in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[row["rest"] - 1] = row["n"]
    first = counts.agg(F.sum("windows")).first()[0] or 0
    layout = Layout(histogram, first)

    # One row per task and length, so the running sums see tasks, not documents.
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    of_tasks = counts.groupBy("task").agg(F.sum("windows").alias("windows")).withColumn("rest", F.lit(-1))
    zero = F.lit(0).cast("long")
    window_base = of_tasks.select(F.col("task").alias("_task"), F.coalesce(F.sum("windows").over(before), zero).alias("_windows"))
    base = counts.select(F.col("task").alias("_task"), F.col("rest").alias("_rest"), F.coalesce(F.sum("n").over(before), zero).alias("_places"))
    base = base.join(window_base, "_task")
    narrow = cut.drop("rest_ids").join(base, (F.col("task") == F.col("_task")) & (F.col("rest") == F.col("_rest")))
    placed = narrow.select(
        "task",
        "at",
        "doc_id",
        "doc_tokens",
        "rest",
        (F.col("place") + F.col("_places")).alias("place"),
        (F.col("windows_before") + F.col("_windows")).alias("window_at"),
        "window_crcs",
        "rest_crc",
    )
    pieces = settle(place_pieces(placed, layout, kind))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    torn = pieces.where("ids_crc32 is null")
    # Rests without a pattern have the last numbers of their length, so they stand in the last tasks' files.
    earliest = torn.agg(F.min("task")).first()[0]
    whole = pieces.where("ids_crc32 is not null").select(*columns)
    if earliest is None:
        return whole
    ids = cut.where(F.col("task") >= earliest).select("task", "at", "rest", "rest_ids")
    begin = (F.col("start") - F.col("doc_tokens") + F.col("rest")).cast("int") * 4 + 1
    own = F.substring("rest_ids", begin, (F.col("length") * 4).cast("int"))
    mended = torn.drop("ids_crc32").join(ids, ["task", "at"]).withColumn("ids_crc32", F.crc32(own))
    return whole.unionByName(mended.select(*columns))

"""Grouping of spelling variants: words one error apart, found with a bidirectional FM-index.

Words are maximal runs of letters, counted over all texts. A near word differs by
exactly one inserted, deleted or replaced code point, so it keeps one half of the word
unchanged: either half is matched exactly and the search goes on across the other
with one error (``fmindex``). Which words a search can meet is known beforehand:
those with the same first letters, or the same last ones, as many as the shortest
word's half has. So the vocabulary is dealt out twice, by first and by last letters;
each block is indexed in one task and searched by its own words. Letters that begin
(or end) more than ``block`` words are cut into so many blocks of indexed words and
of searching words, each pair of which is one task; only counts per word leave a task,
no pairs. How many different first letters there are is bounded by the alphabet.

Null texts hold no words, a null id counts as empty text, repeated rows count again,
an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from math import ceil, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import settle
from basewise.llm.fmindex import BidirectionalIndex
from basewise.operators.skew import splittable

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# One in so many runs of a document loses a code point, by the checksum of id and run.
DAMAGE = 31
SHORTEST, FEWEST, TIMES = 7, 2, 10
# Words of one block at most, words searched for at once, and cells of their table.
BLOCK, SEARCHED, CELLS = 200_000, 20_000, 4_000_000
# Distinct words that a task counts before it hands them on.
COUNTED = 300_000
COUNTS_SCHEMA = "word string, n long"
FOUND_SCHEMA = "word string, n long, n_near long, form struct<m: long, form: string>"


def damaged(doc_id: object, run: str) -> str:
    """The run as it is counted: without one code point if the checksum of ``<doc_id>:<run>`` says so."""
    mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if mark % DAMAGE:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``word, n``: all words of at least ``shortest`` code points and ``fewest`` occurrences, in any text."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, n in Counter(RUN.findall((text or "").translate(LOWER))).items():
                    if len(run) >= shortest:
                        word = damaged(doc_id, run)
                        if len(word) >= shortest:
                            counts[word] += n
                if len(counts) >= COUNTED:
                    yield flush()
        if counts:
            yield flush()

    parts = docs.select("doc_id", "text").mapInArrow(work, COUNTS_SCHEMA)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def post(words: DataFrame, reach: int, block: int, shards: int) -> DataFrame:
    """Each word's rows in its blocks: ``label`` of the block, ``side``, ``role`` (0 indexed, 1 searches, 2 both).

    ``side`` 0 are blocks of words with the same first ``reach`` code points, side 1
    of the same last ones. Letters with few words share a block with others.
    """
    sides = words.select(
        "word",
        "n",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.left("word", F.lit(reach)).alias("letters")),
                F.struct(F.lit(1).alias("side"), F.right("word", F.lit(reach)).alias("letters")),
            )
        ).alias("at"),
    ).select("word", "n", "at.side", "at.letters")
    cuts = sides.groupBy(F.col("side").alias("_side"), F.col("letters").alias("_letters")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("cuts")
    )
    left, right, match = splittable(sides, cuts, [("side", "_side"), ("letters", "_letters")])
    dealt = left.join(right, match).withColumn("own", F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int"))
    together = F.concat_ws(" ", F.lit("shared"), F.pmod(F.xxhash64("letters"), F.lit(shards)).cast("string"), "side")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)

    def places(role: int, indexed, searching):
        label = F.concat_ws(" ", "letters", "side", indexed.cast("string"), searching.cast("string"))
        return F.struct(label.alias("label"), F.lit(role).alias("role"))

    cut = F.concat(
        F.transform(every, lambda j: places(0, F.col("own"), j)),
        F.transform(every, lambda i: places(1, i, F.col("own"))),
    )
    whole = F.array(F.struct(together.alias("label"), F.lit(2).alias("role")))
    return dealt.select("word", "n", "side", F.inline(F.when(F.col("cuts") > 1, cut).otherwise(whole)))


def in_groups(words: list[str]) -> Iterator[list[str]]:
    """Words by length, in lists whose table of letters stays small."""
    group: list[str] = []
    for word in sorted(words, key=len):
        if group and (len(group) >= SEARCHED or (len(group) + 1) * (len(word) + 2) > CELLS):
            yield group
            group = []
        group.append(word)
    if group:
        yield group


def search_block(rows: Iterable[tuple[str, int, int, int]]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n, side, role) of one block, indexed ones first: each searching word with its near words' count and best."""
    counts: dict[str, int] = {}
    searching: dict[str, int] = {}
    index, right = None, True

    def flush() -> Iterator[pa.RecordBatch]:
        for group in in_groups(list(searching)):
            owners, places = index.one_error(group, right)
            near = [0] * len(group)
            best: list[tuple[int, str] | None] = [None] * len(group)
            for owner, place in zip(owners.tolist(), places.tolist(), strict=True):
                word, found = group[owner], index.words[place]
                # What keeps the first half as well is found on the other side.
                if right or not found.startswith(word[: len(word) // 2]):
                    near[owner] += 1
                    mine = (-counts[found], found)
                    if best[owner] is None or mine < best[owner]:
                        best[owner] = mine
            forms = [None if b is None else {"m": b[0], "form": b[1]} for b in best]
            yield pa.record_batch(
                {
                    "word": pa.array(group, pa.string()),
                    "n": pa.array([searching[w] for w in group], pa.int64()),
                    "n_near": pa.array(near, pa.int64()),
                    "form": pa.array(forms, pa.struct([("m", pa.int64()), ("form", pa.string())])),
                }
            )
        searching.clear()

    for word, n, side, role in rows:
        if role == 1:
            if index is None:
                index, right = BidirectionalIndex(list(counts)), side == 0
            searching[word] = n
            if len(searching) >= SEARCHED:
                yield from flush()
        else:
            counts[word], right = n, side == 0
            if role == 2:
                searching[word] = n
    if index is None:
        index = BidirectionalIndex(list(counts))
    yield from flush()


def near_words(words: DataFrame, reach: int, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, near_n, near``: how many near words each has, and the most frequent (ties: the smallest)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)

        for _, members in groupby(rows(), key=lambda r: r[0]):
            yield from search_block(r[1:] for r in members)

    shards = max(1, ceil(words.count() / block * 8))
    posted = post(words, reach, block, shards).select("label", "word", "n", "side", "role")
    found = posted.repartition("label").sortWithinPartitions("label", "role").mapInArrow(work, FOUND_SCHEMA)
    merged = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("form").alias("_form"))
    return merged.select("word", "n", "n_near", (-F.col("_form.m")).alias("near_n"), F.col("_form.form").alias("near"))


def follow_forms(forms: DataFrame, most: int, times: int) -> DataFrame:
    """``word, root`` of all ``word, form``: a form's form, and so on.

    A form is ``times`` as frequent as its word, so no way is longer than ``most``
    (the largest count) allows, and each round doubles the steps taken.
    """
    longest, count = 1, times
    while count * times <= most:
        count *= times
        longest += 1
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(longest))):
        roots = settle(roots)
        onward = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        left, right, match = splittable(roots, onward, [("root", "_word")])
        roots = left.join(right, match, "left").select("word", F.coalesce("_root", "root").alias("root"))
    return roots


def group_variants(
    docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, times: int = TIMES, block: int = BLOCK
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts (``doc_id``, ``text``).

    A word's ``form`` is its most frequent near word if that is at least ``times`` as
    frequent; ``root`` is where following forms ends, the word itself without a form.
    """
    if shortest < 2:
        raise ValueError("words of one letter have no halves")
    words = settle(count_words(docs, shortest, fewest))
    most = words.agg(F.max("n")).first()[0] or 0
    has_form = F.col("near_n") >= times * F.col("n")
    near = settle(near_words(words, shortest // 2, block).withColumns({"form": F.when(has_form, F.col("near")), "form_n": F.when(has_form, F.col("near_n"))}))
    forms = near.where("form is not null").select("word", "form")
    roots = follow_forms(forms, most, times).withColumnRenamed("word", "_of")
    left, right, match = splittable(near, roots, [("word", "_of")])
    return left.join(right, match, "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

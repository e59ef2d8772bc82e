"""Importance resampling towards a target: hashed n-gram counts, gains, and a seeded weighted draw.

Features are runs of one to three consecutive words; a feature's bucket is its
checksum modulo the number of buckets. Texts repeat lines, so the counts of a corpus
are taken from its lines: line ends never stand inside a word, so they cut a text into
lines; tasks count how often each line occurs, Spark adds these up, the features of
each distinct line are counted once and multiplied by its occurrences. The n-grams that
reach over a line end are counted beside that, from the two words on either side. What
comes out has one row per bucket, and so have the gains.

A document's weight is the sum of its features' gains: again each distinct line of a
batch is worked out once, and what reaches over line ends is added. Checksums of
n-grams are put together from those of their words: appending bytes to a text changes
its checksum by a linear map that depends on their number only, so there is a table
for each length, and a batch needs a few array look-ups.

The draw adds a Gumbel number made of the document's id to the weight, and the
highest scores are drawn (sampling without replacement in proportion to the weights'
exponentials). Ranks are counted within ranges of the sorted scores.

Null texts have no words, a null id counts as empty text, repeated rows are rows of
their own (their order among themselves is open), empty tables give no rows or gains
of an empty target. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import Numbers, map_batches, runs, settle, texts_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BUCKETS = 10_000
# Characters of distinct lines that a task counts before it hands them on, and words whose checksums it remembers.
COUNTED_CHARS, REMEMBERED = 8_000_000, 300_000
# The polynomial of the checksum, lowest power first, and the bytes that one table can append.
POLYNOMIAL, APPENDED = 0xEDB88320, 64
ONES = 0xFFFFFFFF
PARTS_SCHEMA = "line string, bucket int, n long"
SCORE_SCHEMA = "doc_id {id}, n_words long, n_features long, weight long"


def append_tables() -> np.ndarray:
    """[k, j, b]: what byte j of a checksum's state becomes when k zero bytes are appended."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), one >> np.uint32(1))
    out = np.empty((APPENDED + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(APPENDED):
        out[k + 1] = one[out[k] & np.uint32(255)] ^ (out[k] >> np.uint32(8))
    return out


class Checksums:
    """Checksums of n-grams of words, from states of words that are remembered."""

    def __init__(self) -> None:
        self.tables = append_tables()
        self.forget()

    def forget(self) -> None:
        """Drop all words."""
        self.numbers = Numbers()
        self.alone = np.zeros(0, dtype=np.uint32)
        self.behind = np.zeros(0, dtype=np.uint32)
        self.added = np.zeros(0, dtype=np.int64)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Numbers of words; those not seen before are worked out."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        known = len(self.numbers)
        out = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.numbers) > known:
            fresh = [w.encode("utf-8", "surrogatepass") for w in islice(self.numbers, known, None)]
            alone = [zlib.crc32(w) ^ ONES for w in fresh]
            behind = [zlib.crc32(b" " + w, ONES) ^ ONES for w in fresh]
            self.alone = np.append(self.alone, np.array(alone, dtype=np.uint32))
            self.behind = np.append(self.behind, np.array(behind, dtype=np.uint32))
            self.added = np.append(self.added, np.array([len(w) + 1 for w in fresh], dtype=np.int64))
        return out

    def append(self, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """States after a space and a word each."""
        count, state = self.added[words].copy(), state.copy()
        while (long := np.flatnonzero(count > APPENDED)).size:
            state[long] = self._zeros(state[long], np.full(len(long), APPENDED))
            count[long] -= APPENDED
        return self._zeros(state, count) ^ self.behind[words]

    def _zeros(self, state: np.ndarray, count: np.ndarray) -> np.ndarray:
        out = self.tables[count, 0, state & np.uint32(255)]
        for j in (1, 2, 3):
            out ^= self.tables[count, j, (state >> np.uint32(8 * j)) & np.uint32(255)]
        return out

    def grams(self, words: np.ndarray) -> list[np.ndarray]:
        """Buckets of the word, the two and the three words that begin at each place (fewer at the end)."""
        one = self.alone[words]
        two = self.append(one[:-1], words[1:])
        three = self.append(two[:-1], words[2:])
        return [((state ^ np.uint32(ONES)) % np.uint32(BUCKETS)).astype(np.int64) for state in (one, two, three)]


class Lines:
    """Distinct lines of a run of texts as arrays: words, buckets, and which lines each text has."""

    def __init__(self, texts: list[str], sums: Checksums) -> None:
        distinct: dict[str, int] = {}
        found: list[list[str]] = []
        lines: list[int] = []
        per_text: list[int] = []
        for text in texts:
            before = len(lines)
            # The lower case of bytes touches ASCII letters only.
            for line in text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass").split("\n"):
                number = distinct.get(line)
                if number is None:
                    number = distinct[line] = len(found)
                    found.append(WORD.findall(line))
                if found[number]:
                    lines.append(number)
            per_text.append(len(lines) - before)
        self.found = found
        self.words = sums.look_up([w for words in found for w in words])
        self.sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.lines = np.array(lines, dtype=np.int64)
        self.text_of_line = np.repeat(np.arange(len(texts)), per_text)
        self.n_texts = len(texts)
        self.sums = sums

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words beside line ends, text by text: up to two from the begin and two from the end of each line.

        With each word the number of its line (each occurrence its own) and of its text.
        """
        size, start = self.sizes[self.lines], self.starts[self.lines]
        shown = np.minimum(size, 4)
        owner = np.repeat(np.arange(len(self.lines)), shown)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(shown) - shown, shown)
        at = np.where((k >= 2) & (size[owner] > 4), size[owner] - 4 + k, k)
        return self.words[start[owner] + at], owner, self.text_of_line[owner]

    def crossing(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams that reach over a line end, and the text of each."""
        words, line, text = self.edges()
        _, two, three = self.sums.grams(words)
        over_two = (line[:-1] != line[1:]) & (text[:-1] == text[1:])
        over_three = (line[:-2] != line[2:]) & (text[:-2] == text[2:])
        return np.concatenate((two[over_two], three[over_three])), np.concatenate((text[:-1][over_two], text[:-2][over_three]))

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """Each text's sum of gains."""
        line_weights = sum_by_line(self.sums.grams(self.words), self.starts, self.sizes, gains)
        out = np.zeros(self.n_texts, dtype=np.int64)
        np.add.at(out, self.text_of_line, line_weights[self.lines])
        buckets, texts = self.crossing()
        np.add.at(out, texts, gains[buckets])
        return out

    def word_counts(self) -> np.ndarray:
        """Each text's number of words."""
        out = np.zeros(self.n_texts, dtype=np.int64)
        np.add.at(out, self.text_of_line, self.sizes[self.lines])
        return out


def sum_by_line(grams: list[np.ndarray], starts: np.ndarray, sizes: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Per line, the sum of the gains of the n-grams that lie inside it."""
    out = np.zeros(len(starts), dtype=np.int64)
    for extra, buckets in enumerate(grams):
        running = np.concatenate(([0], np.cumsum(gains[buckets])))
        stops = np.maximum(starts + sizes - extra, starts)
        begins = np.minimum(starts, len(buckets))
        out += running[np.minimum(stops, len(buckets))] - running[begins]
    return out


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, lines, chars = Checksums(), Counter(), 0
        over = np.zeros(BUCKETS, dtype=np.int64)

        def flush() -> pa.RecordBatch:
            n = len(lines)
            out = pa.record_batch([pa.array(list(lines), pa.string()), pa.nulls(n, pa.int32()), pa.array(list(lines.values()), pa.int64())], names=["line", "bucket", "n"])
            lines.clear()
            return out

        for batch in batches:
            for part in runs(batch, "text"):
                cut_lines = Lines(texts_of(part.column(0)), sums)
                over += np.bincount(cut_lines.crossing()[0], minlength=BUCKETS)
                times = np.bincount(cut_lines.lines, minlength=len(cut_lines.found)).tolist()
                for words, n in zip(cut_lines.found, times, strict=True):
                    if words:
                        line = " ".join(words)
                        if line not in lines:
                            chars += len(line)
                        lines[line] += n
                if chars > COUNTED_CHARS:
                    yield flush()
                    chars = 0
        if lines:
            yield flush()
        used = np.flatnonzero(over)
        if len(used):
            yield pa.record_batch([pa.nulls(len(used), pa.string()), pa.array(used, pa.int32()), pa.array(over[used], pa.int64())], names=["line", "bucket", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = Checksums(), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in runs(batch, "line"):
                times = part.column(2).to_numpy(zero_copy_only=False)
                over = part.column(0).is_null().to_numpy(zero_copy_only=False)
                if over.any():
                    np.add.at(total, part.column(1).filter(pa.array(over)).to_numpy(zero_copy_only=False), times[over])
                found = [line.split(" ") for line in part.column(0).drop_null().to_pylist()]
                if found:
                    total += inside_counts(found, times[~over], sums)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.record_batch([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    parts = docs.select("text").mapInArrow(cut, PARTS_SCHEMA)
    distinct = parts.groupBy("line", "bucket").agg(F.sum("n").alias("n"))
    rows = distinct.select("line", "bucket", "n").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def inside_counts(lines: list[list[str]], times: np.ndarray, sums: Checksums) -> np.ndarray:
    """Buckets of the n-grams inside lines, each line counted ``times`` over."""
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    line = np.repeat(np.arange(len(lines)), sizes)
    out = np.zeros(BUCKETS, dtype=np.int64)
    for extra, buckets in enumerate(sums.grams(sums.look_up([w for words in lines for w in words]))):
        inside = line[: len(buckets)] == line[extra:]
        np.add.at(out, buckets[inside], times[line[: len(buckets)][inside]])
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths: the logarithm of its smoothed share in the target over that in the corpus."""
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((float(t) + 1) * all_corpus / ((float(s) + 1) * all_target))) for s, t in zip(corpus, target, strict=True)],
        dtype=np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""

    def make():
        sums = Checksums()

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            lines = Lines(texts_of(part.column(1)), sums)
            n = lines.word_counts()
            features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
            return pa.record_batch(
                [part.column(0), pa.array(n), pa.array(features), pa.array(lines.weights(gains))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), "text", make, SCORE_SCHEMA.format(id=kind))


def rank_highest(df: DataFrame, score: str, tie: str, most: int) -> DataFrame:
    """``df`` with ``rank``: 1, 2, 3 ... for the ``most`` highest scores (ties: smaller ``tie`` first), else null.

    Rows are dealt out by ranges of the score and counted within each; only how many
    rows each range has is summed over ranges.
    """
    order = [F.desc(score), F.asc(tie)]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = settle(dealt.withColumn("_at", F.monotonically_increasing_id()))
    # The upper bits of this number are the partition, the lower 33 count its rows.
    dealt = dealt.withColumns({"_range": F.shiftright("_at", 33), "_in": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    ranges = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    # There are as many ranges as shuffle partitions, so this is small whatever the data.
    ranked = dealt.join(F.broadcast(ranges), F.col("_range") == F.col("_of"))
    place = F.col("_before") + F.col("_in") + 1
    return ranked.select(*[F.col(c) for c in df.columns], F.when(place <= most, place).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, fewest_words: int = 20, seed: int = 42) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    Of the documents with ``fewest_words``, ``percent`` in a hundred are drawn, towards
    the texts of ``target``.
    """
    gains = gains_of(bucket_counts(docs), bucket_counts(target))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")
    gumbel = F.floor(-1000 * F.log(-F.log((number + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = settle(weigh(docs, gains).withColumn("score", F.col("weight") + gumbel))
    enough = F.col("n_words") >= fewest_words
    drawn = percent * scored.where(enough).count() // 100
    ranked = rank_highest(scored.where(enough), "score", "doc_id", drawn)
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")

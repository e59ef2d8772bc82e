"""Benchmark passages in documents, up to an edit distance, by the pigeonhole principle.

Texts and items are compared in lower case, with one space between words. An item
of m characters may differ in k = floor(rate * m) edits. Cut into k + 1 pieces, at
least one piece of it stands unchanged in any match; all pieces of all items are
looked for at once (Aho-Corasick), and around each hit Myers' bit-parallel
algorithm gives the smallest edit distance of the item to any part of the text.

Items are sent to the tasks in blocks of bounded size; each block is a further
pass over the texts, so their number has no bound. Null and empty texts match
nothing, and neither do items of fewer than ``shortest`` characters (they would
be found anywhere). Repeated items are separate items, repeated documents have
equal results, rows with null ids stay, empty tables give no matches. Only the
named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import map_batches, texts_of

RATE = 0.05
SHORTEST = 30
# Characters of the items of one block (an automaton of about a hundred times as many bytes).
BLOCK_CHARS = 500_000
_BETWEEN = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    """Lower case, one space between words."""
    return _BETWEEN.sub(" ", text.lower()).strip()


class Pattern:
    """One item: smallest edit distance to any part of a text."""

    def __init__(self, text: str) -> None:
        self.size = len(text)
        self.masks: dict[str, int] = {}
        for i, char in enumerate(text):
            self.masks[char] = self.masks.get(char, 0) | 1 << i

    def distance(self, window: str) -> tuple[int, int]:
        """Smallest distance and the first place behind such a part."""
        full = (1 << self.size) - 1
        top = 1 << (self.size - 1)
        plus, minus = full, 0
        score = best = self.size
        where = 0
        get = self.masks.get
        for at, char in enumerate(window):
            equal = get(char, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            # The text may begin anywhere: no carry comes in from above.
            up = up << 1 & full
            down = down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
            if score < best:
                best, where = score, at + 1
        return best, where


class Finder:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]], rate: float, shortest: int) -> None:
        self.items: list[tuple[int, Pattern, int]] = []
        self.machine = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            body = normal(text or "")
            if len(body) < shortest:
                continue
            budget = int(rate * len(body))
            number = len(self.items)
            self.items.append((key, Pattern(body), budget))
            cuts = [len(body) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(body[a:b], []).append((number, a))
        for piece, owners in pieces.items():
            self.machine.add_word(piece, (len(piece), owners))
        self.empty = not pieces
        if pieces:
            self.machine.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """Item, distance and end (in the normalised text) of the best match of each item that matches."""
        if self.empty or not text:
            return []
        body = normal(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, owners) in self.machine.iter(body):
            for number, offset in owners:
                _, pattern, budget = self.items[number]
                begin = end + 1 - size - offset
                low, high = max(0, begin - budget), begin + pattern.size + budget
                spans = windows.setdefault(number, [])
                if spans and low <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], low)
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
        out = []
        for number, spans in windows.items():
            key, pattern, budget = self.items[number]
            best = None
            for low, high in spans:
                distance, end = pattern.distance(body[low:high])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, low + end)
            if best is not None:
                out.append((key, *best))
        return sorted(out)


MATCHES = "array<struct<item_id: bigint, distance: int, ends_at: int>>"


def item_blocks(items: DataFrame, key: str, text: str, block_chars: int) -> list[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, each read on its own."""
    narrow = items.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    place = F.pmod(F.xxhash64("key", "text"), F.lit(count))
    for i in range(count):
        yield [(r["key"], r["text"]) for r in narrow.where(place == i).collect()]


def mark_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    shortest: int = SHORTEST,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """All columns of ``docs`` and ``_leaks``, the items found in each text, each with its smallest distance.

    ``docs`` must not have a column named ``_leaks``.
    """
    found = docs.withColumn("_leaks", F.array().cast(MATCHES))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("ends_at", pa.int32())]))
    names = found.columns
    t = names.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    for block in item_blocks(items, item_key, item_text, block_chars):

        def make(block: list[tuple[int, str]] = block) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
            finder = Finder(block, rate, shortest)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = []
                for body, before in zip(texts_of(batch.column(t)), batch.column(len(names) - 1).to_pylist(), strict=True):
                    new = [{"item_id": k, "distance": d, "ends_at": e} for k, d, e in finder.find(body)]
                    rows.append([*(before or []), *new])
                return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], names)

            return step

        found = map_batches(found, text, make, schema)
    return found

"""Encoding and decoding with merge-type sentence-piece vocabularies.

A text becomes symbols, one per character, with a leading word mark and a mark
for every space. An agenda holds every adjacent pair of symbols whose joined text
is a piece; the entry of the best score, the leftmost among equals, is joined
first, until none is left. Where no piece of the vocabulary has a mark behind
another character, no merge crosses the place before a run of marks, so such
chunks are encoded on their own and remembered (those not met for a while are
forgotten). Short chunks share one agenda step per round as arrays, long ones
have a heap. New chunks are checked against the sentencepiece library once per
Arrow batch; where it differs its ids win and ``n_differ`` counts the uses.

Each row is handled on its own: null text counts as empty and gives no ids,
repeated rows give repeated results, null ids stay, an empty table gives none.
Only the two named columns are read, so further columns can have any name.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import itertools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from basewise.llm.common import map_batches, texts_of

MARK = "▁"
NONE = np.int32(2**31 - 1)
# Chunks of up to this many symbols are encoded side by side.
SHORT = 48
# Chunks after which a task begins to forget those it has not met since; their number bounds memory, not results.
REMEMBERED = 200_000


class MergeTable:
    """Symbols, ranks and results of all merges of a vocabulary."""

    def __init__(self, model: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        count = lib.get_piece_size()
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(count)]
        pieces = {lib.id_to_piece(i): i for i in range(count) if not special[i]}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown_id = lib.unk_id()
        self.count = count
        self.symbols = dict(pieces)
        for piece in pieces:
            for char in piece:
                self.symbols.setdefault(char, len(self.symbols) + count)
        self.unknown = len(self.symbols) + count + 1
        scores = sorted({lib.get_score(i) for i in pieces.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        merges = {}
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                a, b = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if a is not None and b is not None:
                    merges[a * (self.unknown + 1) + b] = (rank[lib.get_score(i)], i)
        self.merges = merges
        keys = np.array(sorted(merges), dtype=np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.array([merges[k][0] for k in keys] + [NONE], dtype=np.int32)
        self.results = np.array([merges[k][1] for k in keys] + [0], dtype=np.int32)
        self.by_point = np.full(0x110000, self.unknown, dtype=np.int32)
        for char, i in self.symbols.items():
            if len(char) == 1:
                self.by_point[ord(char)] = i
        # Without an inner mark no merge crosses the start of a run of marks.
        self.cuttable = not any(MARK in p.lstrip(MARK) for p in pieces)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or NONE) and resulting symbol of each pair."""
        keys = left.astype(np.int64) * (self.unknown + 1) + right
        at = np.searchsorted(self.keys, keys)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], NONE), self.results[at]

    def ids(self, symbols: list[int], text: list[str]) -> list[int]:
        """Ids of final symbols; what is no piece falls back to its bytes."""
        out: list[int] = []
        for s, t in zip(symbols, text, strict=True):
            if s < self.count:
                out.append(s)
            elif self.bytes[0] != self.unknown_id:
                out.extend(self.bytes[b] for b in t.encode())
            else:
                out.append(self.unknown_id)
        return out

    def by_heap(self, chunk: str) -> list[int]:
        """One chunk of any length with a heap as agenda."""
        text: list[str] = list(chunk)
        symbols = [self.symbols.get(c, self.unknown) for c in text]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def propose(i: int, j: int) -> None:
            found = self.merges.get(symbols[i] * (self.unknown + 1) + symbols[j])
            if found:
                heapq.heappush(agenda, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, i, a, b, joined = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = joined, -1
            text[i] += text[j]
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                propose(i, after[i])
            if before[i] >= 0:
                propose(before[i], i)
        left = [i for i in range(n) if symbols[i] >= 0]
        return self.ids([symbols[i] for i in left], [text[i] for i in left])

    def by_rounds(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, row by row, and their counts for short chunks.

        Each round takes the first agenda entry of every chunk that has one. Symbols stay in
        their places, linked to their neighbours; what is joined to its left one is gone.
        """
        rows = len(chunks)
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=rows)
        # One place more than symbols, so that the last one has a neighbour that joins with nothing.
        width = int(sizes.max()) + 1
        points = np.frombuffer("".join([c.ljust(width) for c in chunks]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        places = np.arange(width)
        kept = places < sizes[:, None]
        symbols = np.where(kept, self.by_point[points].reshape(rows, width), np.int32(self.unknown))
        rank = np.full((rows, width), NONE, dtype=np.int32)
        joined = np.zeros((rows, width), dtype=np.int32)
        rank[:, :-1], joined[:, :-1] = self.pairs(symbols[:, :-1], symbols[:, 1:])
        grid = np.arange(rows * width).reshape(rows, width)
        after, before = (grid + 1).ravel(), (grid - 1).ravel()
        flat, alive, ranks, results = symbols.ravel(), kept.ravel(), rank.ravel(), joined.ravel()
        going = np.arange(rows)
        while len(going):
            here = going * width + (rank if len(going) == rows else rank[going]).argmin(axis=1)
            some = ranks[here] != NONE
            if not some.all():
                going, here = going[some], here[some]
            gone = after[here]
            behind = after[gone]
            flat[here] = results[here]
            alive[gone], ranks[gone] = False, NONE
            after[here], before[behind] = behind, here
            ahead = before[here]
            inside = here % width > 0
            ahead, second = ahead[inside], here[inside]
            left, right = np.concatenate([here, ahead]), np.concatenate([behind, second])
            ranks[left], results[left] = self.pairs(flat[left], flat[right])
        return self.fallen_back(flat[alive], points[alive], alive.reshape(rows, width).sum(axis=1))

    def fallen_back(self, symbols: np.ndarray, points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their counts from symbols, of which those that are no piece (one character each) become their bytes."""
        odd = symbols >= self.count
        if not odd.any():
            return symbols, counts
        chars, which = np.unique(points[odd], return_inverse=True)
        found = [self.ids([self.unknown], [chr(c)]) for c in chars.tolist()]
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[odd] = np.array([len(i) for i in found])[which]
        ids = np.repeat(symbols, sizes)
        ids[np.repeat(odd, sizes)] = list(itertools.chain.from_iterable(map(found.__getitem__, which.tolist())))
        return ids, np.add.reduceat(sizes, np.cumsum(counts) - counts)


class Encoder:
    """Whole texts to ids, with remembered chunks."""

    def __init__(self, model: bytes) -> None:
        self.table = MergeTable(model)
        self.names = [str(i).encode() for i in range(self.table.count)]
        # What was used lately, and what was used before that: number of ids, ids, whether the library differs.
        self.known: dict[str, tuple[int, bytes, int]] = {}
        self.older: dict[str, tuple[int, bytes, int]] = {}
        self.differed = False
        self.cut = re.compile(f"{MARK}+[^{MARK}]*").findall

    def chunks(self, text: str) -> list[str]:
        """The parts that no merge crosses."""
        if not text:
            return []
        if self.table.cuttable and not (text[0] == " " or "  " in text or MARK in text):
            # Every mark is a run of its own.
            return (MARK + text.replace(" ", " " + MARK)).split(" ")
        marked = MARK + text.replace(" ", MARK)
        return self.cut(marked) if self.table.cuttable else [marked]

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks, check them against the library, remember them."""
        # Chunks of about the same length go side by side.
        by_length: dict[int, list[str]] = {}
        single: list[str] = []
        for chunk in chunks:
            if len(chunk) <= SHORT:
                by_length.setdefault((len(chunk) + 1) // 4, []).append(chunk)
            else:
                single.append(chunk)
        for same in by_length.values():
            for at in range(0, len(same), 20_000):
                part = same[at : at + 20_000]
                self.remember(part, *self.table.by_rounds(part))
        ids = [self.table.by_heap(chunk) for chunk in single]
        self.remember(single, np.array([i for k in ids for i in k], dtype=np.int32), np.array([len(i) for i in ids], dtype=np.int64))

    def remember(self, chunks: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Check ids against the library and keep them."""
        if not chunks:
            return
        library = self.table.library
        checked = library.encode([c[1:] for c in chunks], num_threads=1)
        right = np.fromiter(itertools.chain.from_iterable(checked), dtype=np.int32)
        right_counts = np.fromiter(map(len, checked), dtype=np.int64, count=len(checked))
        differs = [0] * len(chunks)
        ends = np.cumsum(counts)
        if not (np.array_equal(right_counts, counts) and np.array_equal(right, ids)):
            own = ids.tolist()
            for k, chunk in enumerate(chunks):
                mine = own[ends[k] - counts[k] : ends[k]]
                # A lone mark stands for a space at the end; alone, the library takes it for an empty text.
                if chunk == MARK:
                    checked[k] = mine
                differs[k] = int(mine != checked[k])
            self.differed = self.differed or any(differs)
            ids = np.fromiter(itertools.chain.from_iterable(checked), dtype=np.int32)
            ends = np.cumsum([len(c) for c in checked])
        data, at, known = ids.astype(np.int32).tobytes(), 0, self.known
        for chunk, end, d in zip(chunks, (ends * 4).tolist(), differs, strict=True):
            known[chunk] = ((end - at) // 4, data[at:end], d)
            at = end

    def encode(self, texts: list[str]) -> list[list[tuple[int, bytes, int]]]:
        """Remembered entries of all chunks of each text."""
        parts = [self.chunks(t) for t in texts]
        known, older = self.known, self.older
        new = set().union(*parts) - known.keys()
        known.update((c, older[c]) for c in new & older.keys())
        self.learn(new - older.keys())
        out = [list(map(known.__getitem__, p)) for p in parts]
        if len(known) > REMEMBERED:
            self.older, self.known = known, {}
        return out


SCHEMAS = {
    "ids": ("ids array<int>", pa.list_(pa.int32())),
    "ids_sha256": ("ids_sha256 string", pa.string()),
    "decoded": ("decoded string", pa.string()),
    "decoded_sha256": ("decoded_sha256 string", pa.string()),
}


def encode_texts(
    docs: DataFrame,
    model_path: str,
    key: str = "doc_id",
    text: str = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
) -> DataFrame:
    """Per row: key, ``n_tokens``, ``n_differ`` and the asked ``outputs`` (see ``SCHEMAS``).

    ``ids`` are those of the library without begin or end ids, ``decoded`` is what
    its ``decode`` makes of them, the digests are SHA-256 of the decimal ids joined
    by commas and of the decoded text. The model file (bounded: one vocabulary) is
    read by the driver and travels with the tasks.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", "n_tokens long", "n_differ long", *(SCHEMAS[o][0] for o in outputs)])

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        encoder = Encoder(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            # Many small objects without cycles: looking for cycles in between takes a sixth of the time.
            collects = gc.isenabled()
            gc.disable()
            try:
                return encoded(batch)
            finally:
                if collects:
                    gc.enable()

        def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = encoder.encode(texts_of(batch.column(1)))
            packed = [np.frombuffer(b"".join([e[1] for e in f]), dtype=np.int32) for f in found]
            lists = [ids.tolist() for ids in packed]
            columns = [batch.column(0), pa.array([len(i) for i in packed], pa.int64())]
            columns.append(pa.array([sum(e[2] for e in f) if encoder.differed else 0 for f in found], pa.int64()))
            names = [key, "n_tokens", "n_differ"]
            decoded = None
            if "decoded" in outputs or "decoded_sha256" in outputs:
                decoded = encoder.table.library.decode(lists) if packed else []
            for o in outputs:
                if o == "ids":
                    offsets = np.cumsum([0, *(len(i) for i in packed)]).astype(np.int32)
                    values = np.concatenate(packed) if packed else np.empty(0, dtype=np.int32)
                    column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                elif o == "ids_sha256":
                    column = [hashlib.sha256(b",".join([encoder.names[i] for i in ids])).hexdigest() for ids in lists]
                elif o == "decoded":
                    column = decoded
                else:
                    column = [hashlib.sha256(d.encode()).hexdigest() for d in decoded]
                columns.append(column if isinstance(column, pa.Array) else pa.array(column, SCHEMAS[o][1]))
                names.append(o)
            return pa.RecordBatch.from_arrays(columns, names)

        return step

    return map_batches(docs.select(key, text), text, make, schema)

"""Packing: exact cover, sequences without padding, ids of the whole text, least squares."""

from __future__ import annotations

import random
import zlib
from array import array
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest

from basewise.llm import nnls, packing, queries
from basewise.llm.packing import Encoder, Layout, pack

DOCS = "doc_id long, text string, start int, task string, place int"


def path():
    return public_tokenizers.path(queries.BYTE_MODEL)


@pytest.fixture(scope="module")
def whole():
    """Ids by the library, each text on its own and whole."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check_pieces(rows, docs, whole, window):
    """Each id of each document lies in one piece, sequences have no gap, each is full or a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id in by_doc:
        ids = [whole(t) for d, t in docs if d == doc_id]
        found = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[doc_id])
        crc = lambda part: zlib.crc32(array("I", part).tobytes())
        if len(ids) == 1:
            at = 0
            for start, length, value, tokens in found:
                assert start == at and length > 0 and tokens == len(ids[0]) and value == crc(ids[0][start : start + length])
                at += length
            assert at == len(ids[0])
        else:
            assert sum(f[1] for f in found) == sum(map(len, ids))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    # All but the powers of two of one last window are full.
    assert sum(sum(n for _, n in parts) < window for parts in by_sequence.values()) <= window.bit_length()


@pytest.mark.parametrize("window", [16, 64, 2048])
def test_every_id_in_one_piece(spark, whole, window):
    rng = random.Random(window)
    docs = [(i, " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 60)))) for i in range(400)]
    docs += [(1000, ""), (1001, None), (1002, "x" * 3000), (1003, "the same text " * 900), (1004, "<|endoftext|> a<|endoftext|>b  <|endoftext|>")]
    docs += [(i, "ties and copies") for i in range(2000, 2100)] + [(3000, "one id twice"), (3000, "of other text")]
    rows = pack(spark.createDataFrame([(*d, 1, "t", 2) for d in docs], DOCS).repartition(5), path(), window).collect()
    check_pieces(rows, docs, whole, window)


def test_lengths_that_fill_nothing(spark, whole):
    docs = [(i, "a b c d e f g h i j k") for i in range(333)]
    rows = pack(spark.createDataFrame([(*d, 1, "t", 2) for d in docs], DOCS).repartition(3), path(), 16).collect()
    check_pieces(rows, docs, whole, 16)
    assert pack(spark.createDataFrame([], DOCS), path()).count() == 0
    one = pack(spark.createDataFrame([(None, None, 1, "t", 2)], DOCS), path()).collect()
    assert [(r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["offset"]) for r in one] == [(None, 0, 1, 1, 0)]


def test_stretches_give_the_ids_of_the_whole(whole):
    rng = random.Random(5)
    letters = list("ab 1\n\t\r\x0b'.!é漢🙂") + ["\x1c", "\x85", "\xa0", "\u2003", "\u3000", " the", "  ", "'s", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice(letters[:14]) for _ in range(rng.randrange(0, 60))) for _ in range(3000)]
    encoder = Encoder(path())
    for begin in range(0, len(texts), 500):
        part = texts[begin : begin + 500]
        assert encoder.encode(part) == [array("I", whole(t)[:-1]).tobytes() for t in part]


def test_descent_reaches_the_least_squares():
    rng = np.random.default_rng(4)
    for window in (5, 9, 14):
        histogram = rng.integers(0, 50, window)
        patterns = [p for n in (1, 2, 3) for p in combinations_with_replacement(range(1, window + 1), n) if sum(p) == window]
        matrix = np.array([[p.count(length) for p in patterns] for length in range(1, window + 1)], dtype=float)
        x = np.zeros(len(patterns))
        for _ in range(20_000):
            x = np.maximum(0, x - matrix.T @ (matrix @ x - histogram) / np.linalg.norm(matrix, 2) ** 2)
        best = float(((matrix @ x - histogram) ** 2).sum())
        descent = nnls.Descent(histogram)
        descent.run(2000)
        assert all(sum(p) == window for p in descent.counts) and min(descent.counts.values()) > 0
        assert float(descent.left @ descent.left) <= best * 1.01 + 0.01


def test_plan_uses_no_piece_twice():
    rng = np.random.default_rng(6)
    for histogram in (rng.integers(0, 9, 63), rng.integers(0, 2, 63), np.zeros(63, int), np.bincount([40] * 500, minlength=64)[1:]):
        made, left = nnls.plan(np.append(histogram, 0))
        used = np.zeros(65, int)
        for uses, repeats in made:
            assert sum(n * t for n, t in uses.items()) == 64 and repeats > 0
            for n, t in uses.items():
                used[n] += t * repeats
        assert (used[1:64] + left[1:64] == histogram).all() and (left >= 0).all()
        layout = Layout(histogram, 7)
        seen = {}
        for n in range(1, 64):
            for place in range(histogram[n - 1]):
                pieces = layout.pieces(n, place)
                assert sum(p[1] for p in pieces) == n
                for _, length, sequence, offset in pieces:
                    seen.setdefault(sequence, []).append((offset, length))
        for parts in seen.values():
            assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:], strict=False))


def test_op12_packing(spark, whole):
    docs = [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    out = queries.op12_packing(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_pieces(out.collect(), docs, whole, packing.WINDOW)

"""Spelling variants: the index against brute force, hot letters in several blocks, edge rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

from basewise.llm import queries, spelling
from basewise.llm.fmindex import BidirectionalIndex

DOCS = "doc_id long, text string, word string, n int, label string, side int"


def near(a, b):
    """Exactly one insertion, deletion or replacement apart, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghij×ÿ"])
def test_index_finds_each_near_word_once(letters):
    rng = random.Random(len(letters))
    words = list({"".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(400)})
    asked = sorted({*words, "zz", "abab", "aaaaaaa"})
    index = BidirectionalIndex(words)
    seen = Counter()
    for right in (True, False):
        for i, j in zip(*index.one_error(asked, right), strict=True):
            word, found, half = asked[i], index.words[j], len(asked[i]) // 2
            assert found.startswith(word[:half]) if right else found.endswith(word[half:])
            if right or not found.startswith(word[:half]):
                seen[word, found] += 1
    assert seen == Counter((a, b) for a in asked for b in words if near(a, b))


def test_intervals_of_both_directions_agree():
    words = ["abab", "babab", "abba", "aab", "b"]
    index = BidirectionalIndex(words)
    import numpy as np

    circles = [w + "\0" for w in index.words]
    for pattern in ("a", "ab", "aba", "bb", "bab", "abab"):
        right = left = None
        for order, toward in ((pattern, True), (pattern[::-1], False)):
            state = np.zeros((3, 1), dtype=np.int64)
            state[2] = sum(map(len, circles))
            for c in order:
                state = index.extend(state, np.array([index.letters[c]]), toward)
            right, left = (state, left) if toward else (right, state)
        assert right[2, 0] == left[2, 0] == sum((c + c)[i:].startswith(pattern) for c in circles for i in range(len(c)))
        if right[2, 0]:
            assert (right == left).all()


def brute_force(docs, shortest, fewest, times):
    counts = Counter()
    for doc_id, text in docs:
        for run, n in Counter(spelling.RUN.findall((text or "").translate(spelling.LOWER))).items():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            counts[word] += n
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}
    out = {}
    for w, n in words.items():
        found = sorted((-m, v) for v, m in words.items() if near(w, v))
        form = found[0][1] if found and -found[0][0] >= times * n else None
        out[w] = (form, n, len(found), -found[0][0] if form else None)
    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return {(w, form, root(w), n, k, m) for w, (form, n, k, m) in out.items()}


@pytest.mark.parametrize("block", [200_000, 15])
def test_groups_against_brute_force(spark, block):
    rng = random.Random(block)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(12)]
    stems += ["common" + "".join(rng.choice("ab") for _ in range(4)) for _ in range(30)]

    def word():
        w = rng.choice(stems[: rng.randrange(1, len(stems))])
        if rng.random() < 0.2:
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "x", w[at] * 2]) + w[at + 1 :]
        return rng.choice([w, w.upper().replace("É", "é"), w])

    docs = [(i, rng.choice([" ", "1", ". "]).join(word() for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    docs += [(900, None), (901, ""), (None, "commonaaaa commonaaab"), (902, "Ünïcode×÷ÿ ÉCOLEécole " * 3), (903, "a" * 30_000 + " " + "a" * 30_000), (903, "ab" * 9_000 + " " + "ab" * 9_000)]
    docs += [docs[5]] * 40
    df = spark.createDataFrame([(*d, "w", 1, "l", 0) for d in docs], DOCS).repartition(4)
    for shortest in (7, 4):
        got = [tuple(r) for r in spelling.group_variants(df, shortest, 2, 3, block).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_force(docs, shortest, 2, 3)
    assert spelling.group_variants(spark.createDataFrame([], DOCS)).count() == 0


def test_op11_spelling(spark):
    docs = [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    out = queries.op11_spelling(spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert {tuple(r) for r in out.collect()} == brute_force(docs, 7, 2, 10)

"""Importance resampling against plain counting, and its checksums against zlib."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basewise.llm import queries, resample
from basewise.llm.resample import Checksums, Lines

DOCS = "doc_id long, text string, weight int, line string, bucket int, rank string, _at int"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute_force(docs, target, percent=5, fewest=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((-r[3], r[0] if r[0] is not None else -1) for r in rows if r[4] >= fewest)
    drawn = able[: percent * len(able) // 100]
    rank = {key: i + 1 for i, key in enumerate(drawn)}
    return sorted(str((*r[:4], rank.get((-r[3], r[0] if r[0] is not None else -1)) if r[4] >= fewest else None)) for r in rows)


def test_checksums():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé漢1") for _ in range(rng.choice([1, 2, 9, 30, 70, 300]))) for _ in range(400)]
    sums = Checksums()
    for n, got in enumerate(sums.grams(sums.look_up(words)), 1):
        assert got.tolist() == [bucket(" ".join(words[i : i + n])) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("lines", [1, 2, 4, 9])
def test_inside_and_over_line_ends(lines):
    rng = random.Random(lines)
    texts = ["\n".join(" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 7))) for _ in range(rng.randrange(0, lines + 1))) for _ in range(300)]
    gains = np.arange(10000, dtype=np.int64) * 7 - 20000
    cut = Lines(texts, Checksums())
    assert cut.weights(gains).tolist() == [sum(int(gains[bucket(f)]) for f in features(t)[1]) for t in texts]
    assert cut.word_counts().tolist() == [len(features(t)[0]) for t in texts]


def test_resample_against_plain_counts(spark):
    rng = random.Random(3)
    common = ["The same line stands in very many of the texts.", "Another One", "x"]
    docs = []
    for i in range(500):
        lines = [rng.choice(common) if rng.random() < 0.6 else " ".join("".join(rng.choice("abÉé1 -") for _ in range(6)) for _ in range(8)) for _ in range(rng.randrange(0, 6))]
        docs.append((i, "\n".join(lines)))
    docs += [(1000, None), (1001, ""), (1002, "\n\n \n"), (None, "null id " * 30), (1003, "one long line " * 3000), (1004, "w\n" * 5000), (1005, "K İ ß 漢字 " * 9)]
    target = ["Another one of the texts", None, "", "x\nx\nx", "漢字 ß"]
    df = spark.createDataFrame([(*d, 1, "l", 2, "r", 3) for d in docs], DOCS).repartition(4)
    goal = spark.createDataFrame([(i, t, 1, "l", 2, "r", 3) for i, t in enumerate(target)], DOCS)
    got = resample.resample(df, goal, percent=20)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_force(docs, target, percent=20)
    nothing = spark.createDataFrame([], DOCS)
    assert resample.resample(nothing, goal).count() == 0
    assert resample.resample(df, nothing).count() == len(docs)


def test_ranks_of_ties_and_copies(spark):
    df = spark.createDataFrame([(i % 7, (i * 31) % 97) for i in range(97)] * 3, "score long, doc_id long").repartition(5)
    got = resample.rank_highest(df, "score", "doc_id", 100).collect()
    want = sorted((-r["score"], r["doc_id"]) for r in got)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 101)) and len(got) == 291
    for r in got:
        if r["rank"]:
            assert want[r["rank"] - 1] == (-r["score"], r["doc_id"])


def test_op13_resample(spark):
    read = lambda name: [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.001", name).select("*").collect()]
    docs = [(d[0], d[1]) for d in queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    target = [r[0] for r in queries.table(spark, "/root/testdata/sf0.001", "benchmark").select("text").collect()]
    assert read("benchmark")
    got = queries.op13_resample(spark, "/root/testdata/sf0.001")
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_force(docs, target)

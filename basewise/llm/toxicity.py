"""Toxicity by a weighted finite-state grammar over clauses.

Two lexicons feed the grammar: fixed short lists of threat, target, negation and
reported-speech words, and insult stems learnt from labelled rows. Small weighted
transducers, one each for insult, threat, target, negation and reported speech,
read the tags of a clause's words; :func:`compose` joins them to one machine. A
clause's score is the best weight with which the machine matches it. A document
counts its matched clauses (their sum, the best one and their share of the
clauses), and a logistic regression on these three turns them into a score.

Results: null and empty texts score like any text without a match. Without toxic
labels nothing matches and every score is the share of toxic labels, or 0.
Repeated rows get equal scores, null ids stay, an empty table gives none. Only
the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import map_batches, settle, texts_of

# Labelled rows that the fit looks at, at most (those whose id hashes smallest).
SAMPLE_TOXIC = 6_000
SAMPLE_CLEAN = 12_000
# Learnt stems that the grammar holds, at most (the most significant).
STEMS = 20_000
SHORTEST, LONGEST = 4, 8
# Stems that a task counts before it sends them.
HELD_STEMS = 150_000
# Log probability by chance that a stem may have, over all stems looked at.
CHANCE = -4.0

# Words of the grammar in English, German, French and Spanish.
THREAT = "kill hurt destroy punch beat strangle töten umbringen schlagen tuer frapper matar golpear destruir".split()
TARGET = "you your youre they them he she du dein ihr sie euch tu toi vous ton tus usted ustedes ellos eres es".split()
NEGATION = "not no never isnt arent nicht kein keine nie pas jamais aucun nunca ningún jamás".split()
REPORTED = "said says called quoted wrote claimed sagte sagt nannte schrieb dit disait écrit dijo llamó escribió".split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]")
INSULT_TAG, THREAT_TAG, TARGET_TAG, NEGATION_TAG, REPORTED_TAG, OTHER = "ihtnr-"
FIXED = {w: t for words, t in ((THREAT, THREAT_TAG), (TARGET, TARGET_TAG), (NEGATION, NEGATION_TAG), (REPORTED, REPORTED_TAG)) for w in words}

# A transducer: start state, and (state, tag) -> (state, factor). A missing arc keeps the state at factor 1.
Machine = tuple[str, dict[tuple[str, str], tuple[str, float]]]
# A negation counts for the word behind it, over one word at most.
NEGATE: Machine = ("-", {("-", NEGATION_TAG): ("n", 1.0), ("n", OTHER): ("m", 1.0), ("n", INSULT_TAG): ("-", 0.3), ("n", THREAT_TAG): ("-", 0.3), ("m", OTHER): ("-", 1.0), ("m", INSULT_TAG): ("-", 0.6), ("m", THREAT_TAG): ("-", 0.6), ("n", TARGET_TAG): ("m", 1.0), ("m", TARGET_TAG): ("-", 1.0)})
# Reported speech weakens all that follows in the clause.
REPORT: Machine = ("-", {("-", REPORTED_TAG): ("r", 1.0), ("r", INSULT_TAG): ("r", 0.7), ("r", THREAT_TAG): ("r", 0.7)})
# A target before or behind strengthens an insult; a threat needs one to count.
AIM: Machine = ("-", {("-", TARGET_TAG): ("t", 1.0), ("t", INSULT_TAG): ("t", 1.25), ("t", THREAT_TAG): ("t", 1.0), ("-", THREAT_TAG): ("-", 0.2), ("-", INSULT_TAG): ("i", 1.0), ("i", INSULT_TAG): ("i", 1.1), ("i", TARGET_TAG): ("t", 1.0), ("i", THREAT_TAG): ("i", 0.6)})


def compose(first: Machine, second: Machine) -> Machine:
    """One machine that multiplies the factors of both; states are pairs, written one behind the other."""
    tags = {t for _, arcs in (first, second) for _, t in arcs}
    start = first[0] + second[0]
    arcs: dict[tuple[str, str], tuple[str, float]] = {}
    size = len(first[0])
    open_, seen = [start], {start}
    while open_:
        state = open_.pop()
        a, b = state[:size], state[size:]
        for tag in tags:
            to_a, factor_a = first[1].get((a, tag), (a, 1.0))
            to_b, factor_b = second[1].get((b, tag), (b, 1.0))
            arcs[state, tag] = (to_a + to_b, factor_a * factor_b)
            if to_a + to_b not in seen:
                seen.add(to_a + to_b)
                open_.append(to_a + to_b)
    return start, arcs


GRAMMAR = compose(compose(NEGATE, REPORT), AIM)
THREAT_WEIGHT = 2.0


def clause_score(tags: list[tuple[str, float]], grammar: Machine = GRAMMAR) -> float:
    """Summed weight of the insults and threats of one clause, each changed by the grammar's state."""
    state, arcs = grammar
    total = 0.0
    for tag, weight in tags:
        state, factor = arcs.get((state, tag), (state, 1.0))
        total += weight * factor
    return total


class Matcher:
    """Finds clauses with insult stems or threats and scores them."""

    def __init__(self, stems: dict[str, float]) -> None:
        """``stems``: ``word$`` for whole words, ``stem`` for beginnings of words."""
        self.stems = stems
        self.machine = ahocorasick.Automaton()
        for stem in stems:
            self.machine.add_word(stem.rstrip("$"), len(stem.rstrip("$")))
        for word in THREAT:
            self.machine.add_word(word, len(word))
        self.machine.make_automaton()

    def tag(self, word: str) -> tuple[str, float]:
        """Tag and weight of one word: the best stem that it begins with, or its place in the lists."""
        weight = self.stems.get(word + "$", 0.0)
        for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
            weight = max(weight, self.stems.get(word[:n], 0.0))
        if weight:
            return INSULT_TAG, weight
        tag = FIXED.get(word, OTHER)
        return tag, THREAT_WEIGHT if tag == THREAT_TAG else 0.0

    def features(self, text: str) -> tuple[float, float, float]:
        """Sum and best of the clause scores, and matched clauses per hundred clauses."""
        text = text.lower()
        scores: list[float] = []
        done = -1
        for end, size in self.machine.iter(text):
            start = end - size + 1
            if start <= done or (start and text[start - 1].isalpha()):
                continue
            begin = max((text.rfind(c, 0, start) for c in ".!?;:\n"), default=-1) + 1
            stop = CLAUSE_END.search(text, end)
            done = stop.start() if stop else len(text)
            score = clause_score([self.tag(w) for w in WORD.findall(text[begin:done])])
            if score > 0.0:
                scores.append(score)
        if not scores:
            return 0.0, 0.0, 0.0
        clauses = 1 + len(CLAUSE_END.findall(text))
        return math.log1p(sum(scores)), math.log1p(max(scores)), min(1.0, len(scores) / clauses) ** 0.5


def stem_evidence(sample: DataFrame) -> DataFrame:
    """Per stem or whole word: in how many kinds of surroundings it stands, toxic and clean (up to 64 each).

    Surroundings (hash of the word before) and not documents are counted, so that a
    word which occurs in many copies of one document is no evidence.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])

        def flush() -> pa.RecordBatch:
            keys = list(counts)
            columns = [pa.array(keys, pa.string())]
            columns += [pa.array([counts[k][i] - (1 << 64 if counts[k][i] >> 63 else 0) for k in keys], pa.int64()) for i in (0, 1)]
            columns.append(pa.array([counts[k][2] for k in keys], pa.int64()))
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["stem", "clean", "toxic", "uses"])

        for batch in batches:
            for text, toxic in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                before = ""
                for word in WORD.findall(text.lower()):
                    if len(word) >= SHORTEST:
                        bit = 1 << (hash_of(before) & 63)
                        for key in (word + "$", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))):
                            found = counts[key]
                            found[toxic] |= bit
                            found[2] += toxic
                    before = word
                if len(counts) > HELD_STEMS:
                    yield flush()
        yield flush()

    kept = sample.mapInArrow(work, "stem string, clean long, toxic long, uses long")
    return kept.groupBy("stem").agg(
        F.bit_count(F.bit_or("clean")).alias("clean"), F.bit_count(F.bit_or("toxic")).alias("toxic"), F.sum("uses").alias("uses")
    )


def hash_of(word: str) -> int:
    """A small fixed hash (Python's own changes between processes)."""
    value = 2166136261
    for char in word[-6:]:
        value = (value ^ ord(char)) * 16777619 & 0xFFFFFFFF
    return value ^ value >> 15


def choose_stems(rows: list[tuple[str, int, int, int]], clean_docs: int, toxic_docs: int, looked_at: int) -> dict[str, float]:
    """Weights of the stems that stand in toxic rows more often than chance allows.

    A beginning counts as a stem only where no single word makes up most of its
    uses; else the whole word counts.
    """
    prior = toxic_docs / max(1, clean_docs + toxic_docs)
    if not 0 < prior < 1:
        return {}
    floor = CHANCE - math.log(max(2, looked_at))
    most: dict[str, int] = defaultdict(int)
    for stem, _, _, uses in rows:
        if stem.endswith("$"):
            for n in range(SHORTEST, min(LONGEST, len(stem) - 1) + 1):
                most[stem[:n]] = max(most[stem[:n]], uses)
    found = []
    for stem, clean, toxic, uses in rows:
        if clean * 10 > toxic or (not stem.endswith("$") and most[stem] > 0.6 * uses):
            continue
        # Chance of so many toxic surroundings, with ``clean`` of them excused.
        chance = toxic * math.log(prior) + clean * math.log(1 + toxic / max(1, clean)) if clean else toxic * math.log(prior)
        if chance <= floor:
            found.append((chance, stem, math.log((toxic + 0.5) / (clean + 0.5) / (prior / (1 - prior)))))
    return {stem: weight for _, stem, weight in sorted(found)[:STEMS]}


def logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights and bias of a ridge logistic regression (Newton steps)."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    penalty = 1e-2 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def featured(docs: DataFrame, stems: dict[str, float], text: str) -> DataFrame:
    """All columns of ``docs`` and ``_features``, an array of three."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["_features array<double>"])
    place = docs.columns.index(text)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        matcher = Matcher(stems)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([matcher.features(t) for t in texts_of(batch.column(place))], pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "_features"])

        return step

    return map_batches(docs, text, make, schema)


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, train: Column | None) -> tuple[dict[str, float], list[float]]:
    """Stems and regression weights from a bounded draw of labelled rows."""
    if train is not None:
        labels = labels.where(train)
    labels = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("_toxic"))
    order = F.xxhash64(F.col(key).cast("string"))
    drawn = [labels.where(F.col("_toxic") == v).orderBy(order, key).limit(n) for v, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    # Bounded by the two limits, so this broadcast does not grow with the data.
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    sample = settle(docs.select(key, F.col(text).alias("_text")).join(chosen, key).select("_text", "_toxic"))
    sizes = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    prior = toxic / max(1, clean + toxic)
    evidence = settle(stem_evidence(sample))
    looked_at = evidence.count()
    # Ten times the stems that may stay; of more, those with the fewest toxic surroundings go.
    rows = evidence.where("toxic >= 2 and clean * 10 <= toxic").orderBy(F.desc("toxic"), "stem").limit(10 * STEMS).collect()
    stems = choose_stems([tuple(r) for r in rows], clean, toxic, looked_at)
    if not stems:
        return {}, [0.0, 0.0, 0.0, math.log(prior / (1 - prior)) if 0 < prior < 1 else (30.0 if prior else -30.0)]
    points = featured(sample, stems, "_text").select("_features", "_toxic").collect()
    weights = logistic(np.array([p[0] for p in points]), np.array([float(p[1]) for p in points]))
    return stems, [float(w) for w in weights]


def score(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    train: Column | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``_score``: how likely the text is toxic.

    ``train`` is a condition on the labels' rows. ``docs`` must not have columns
    named ``_features`` or ``_score``.
    """
    stems, weights = learn(docs, labels, key, text, label, train)
    found = featured(docs, stems, text)
    linear = F.lit(weights[3])
    for i in range(3):
        linear = linear + F.col("_features")[i] * weights[i]
    return found.withColumn("_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))).drop("_features")

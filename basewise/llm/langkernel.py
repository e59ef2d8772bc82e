"""Language of a text by a string kernel.

The kernel of two texts is the cosine of their presence sets of character
n-grams of several lengths (blended spectrum, hashed to ``DIMS`` places; runs of
other characters than letters count as one space). Landmarks drawn from a
labelled sample span the Nyström approximation, one ridge regression per
language against the rest is solved on it, and since the kernel is a product of
presence vectors, landmarks and weights fold into one matrix: a batch of texts is
scored by one matrix product.

Results: a text that is null, empty or has no letter gives ``UNKNOWN`` with score
0, and so does every text if nothing is labelled. Ties go to the first language
in sorted order. Repeated rows get equal results, rows with null ids stay, an
empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import map_batches, texts_of

UNKNOWN = "und"
DIMS = 1 << 15
LENGTHS = (1, 2, 3)
# Labelled rows per language that the fit looks at (the rows of smallest hash).
SAMPLE = 300
LANDMARKS = 400
RIDGE = 0.1
BLOCK = 64


class Grams:
    """Presence of hashed character n-grams."""

    def __init__(self) -> None:
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def places(self, text: str) -> np.ndarray:
        """Hashed n-grams of one text, repeats included; empty without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = self.letter[points]
        if not letter.any():
            return np.empty(0, dtype=np.uint32)
        # Keep letters, and one space for each run of others.
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        kept = np.where(letter, points, np.uint32(32))[keep]
        kept = np.concatenate(([32], kept, [32])).astype(np.uint32)
        out = []
        code = np.zeros(len(kept), dtype=np.uint32)
        for n in range(1, max(LENGTHS) + 1):
            last = kept[n - 1 :]
            code = (code[: len(last)] ^ last) * np.uint32(0x9E3779B1) + np.uint32(n)
            if n in LENGTHS:
                out.append((code ^ (code >> np.uint32(15))) % np.uint32(DIMS))
        return np.concatenate(out)

    def blocks(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Presence matrices of up to ``BLOCK`` texts each."""
        for at in range(0, len(texts), BLOCK):
            part = texts[at : at + BLOCK]
            present = np.zeros((len(part), DIMS), dtype=np.float32)
            for row, text in zip(present, part, strict=True):
                row[self.places(text)] = 1
            yield present


def sample_features(docs: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """Label and presence set of ``rows`` rows per label at most, those whose key hashes smallest."""
    order = Window.partitionBy("label").orderBy("place", "k")
    drawn = (
        docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("label"))
        .where(F.col("label").isNotNull() & F.col("t").isNotNull())
        .withColumn("place", F.xxhash64("k"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= rows)
        .select("t", "label")
    )

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        grams = Grams()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(grams.places(t)).astype("<u2").tobytes() for t in texts_of(batch.column(0))]
            return pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["label", "places"])

        return step

    return map_batches(drawn, "t", make, "label string, places binary")


def fit(rows: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray]:
    """Languages in sorted order and the matrix from presence to their scores."""
    rows = sorted((label, bytes(places)) for label, places in rows if places)
    labels = sorted({label for label, _ in rows})
    if not labels:
        return [], np.zeros((DIMS, 0), dtype=np.float32)
    features = np.zeros((len(rows), DIMS), dtype=np.float32)
    for row, (_, places) in zip(features, rows, strict=True):
        row[np.frombuffer(places, dtype="<u2")] = 1
    features /= np.sqrt(features.sum(axis=1, keepdims=True))
    target = np.array([[1.0 if label == want else -1.0 for want in labels] for label, _ in rows])
    # Every language weighs the same.
    share = {label: sum(r[0] == label for r in rows) for label in labels}
    weight = np.array([len(rows) / (len(labels) * share[label]) for label, _ in rows])
    picked = np.unique(np.linspace(0, len(rows) - 1, min(landmarks, len(rows))).astype(int))
    base = features[picked]
    across = (features @ base.T).astype(np.float64)
    among = (base @ base.T).astype(np.float64)
    left = across.T @ (across * weight[:, None]) + ridge * among + 1e-6 * np.eye(len(picked))
    solved = np.linalg.solve(left, across.T @ (target * weight[:, None]))
    return labels, (base.T @ solved.astype(np.float32)).astype(np.float32)


def predict(docs: DataFrame, labels: list[str], matrix: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``lang_pred`` and ``score`` (softmax of the regressions' outputs)."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        grams = Grams()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, scores = [], []
            for present in grams.blocks(texts_of(batch.column(1))):
                sizes = present.sum(axis=1)
                if not labels:
                    found.extend([UNKNOWN] * len(present))
                    scores.extend([0.0] * len(present))
                    continue
                out = (present @ matrix) / np.sqrt(np.maximum(sizes, 1))[:, None]
                power = np.exp(4.0 * (out - out.max(axis=1, keepdims=True)))
                best = out.argmax(axis=1)
                share = power[np.arange(len(out)), best] / power.sum(axis=1)
                found.extend(labels[b] if size else UNKNOWN for b, size in zip(best, sizes, strict=True))
                scores.extend(float(s) if size else 0.0 for s, size in zip(share, sizes, strict=True))
            arrays = [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays(arrays, [key, "lang_pred", "score"])

        return step

    return map_batches(docs.select(key, text), text, make, f"`{key}` {kind}, lang_pred string, score double")


def identify(
    docs: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """Learn from the labelled rows that ``train`` selects, predict all rows.

    The fit looks at ``sample`` rows per label at most (a bounded draw by hash);
    their presence sets of at most ``DIMS`` places are all that reaches the driver.
    """
    features = sample_features(docs.where(train), key, text, label, sample)
    labels, matrix = fit([(r["label"], r["places"]) for r in features.collect()])
    return predict(docs, labels, matrix, key, text)

"""Quality rules: counts of words, symbols and repetitions, and n-gram perplexity bands.

The language model is a modified Kneser-Ney model over characters, of order 4, one
for each value of the language column (null is a value of its own). Spark counts
the n-grams of all texts; a task sends each distinct n-gram once, with its count.
N-grams are dealt to shards by the character before the last, which holds all
that a prediction after this character needs, and shards are filled up to
``SHARD_NGRAMS``. A shard's model is built by one task as sorted hash arrays.
Scoring sends the rows through one Python step per shard, each of which adds the
log probabilities of the characters that its shard predicts; so the memory of a
step is bounded whatever the corpus, and the model grows with it, unpruned.

A text is rejected if the counts fail (``base_failed``) or its perplexity lies
outside its language's band, which is as wide on either side as the spread of all
texts of that language that pass the counts asks for: median and median deviation
of the mean log probability.

Null and empty texts have no words and fail. A language none of whose
texts passes has no band. Repeated
rows get equal results, null ids stay, an empty table gives none. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import map_batches, settle, texts_of
from basewise.llm.shingles import Shingler, mix

ORDER = 4
BITS = np.uint64(16)
MASKS = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER + 1)]
# 12 bytes each at most for an n-gram, so about 64 MB for a shard.
SHARD_NGRAMS = 4_000_000
# A band's width on either side: deviations from the median, and the least width in nats per
# character, for languages of a few texts, or of copies, that have next to no spread.
DEVIATIONS = 8.0
LEAST_WIDTH = 0.05
# Distinct n-grams that a task holds before it sends them.
HELD_NGRAMS = 1_000_000
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def keys_of(text: str) -> np.ndarray:
    """The n-grams of a text, one per character: four 16-bit symbols each, behind a start of line ends."""
    points = np.frombuffer(("\n" * (ORDER - 1) + text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = ((points ^ ((points >> np.uint32(16)) * np.uint32(40503))) & np.uint32(0xFFFF)).astype(np.uint64)
    out = symbols[: -ORDER + 1]
    for n in range(1, ORDER):
        out = (out << BITS) | symbols[n : len(symbols) - ORDER + 1 + n]
    return out


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``key`` and ``n``: how often each n-gram stands in the texts of each language."""
    narrow = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def fold(name: str) -> None:
            keys, counts = np.unique(np.concatenate(waiting.pop(name)), return_counts=True)
            if name in held:
                both = np.concatenate((held[name][0], keys))
                all_counts = np.concatenate((held[name][1], counts))
                keys, place = np.unique(both, return_inverse=True)
                counts = np.bincount(place, weights=all_counts).astype(np.int64)
            held[name] = (keys, counts)

        def flush() -> Iterator[pa.RecordBatch]:
            for name in list(waiting):
                fold(name)
            for name, (keys, counts) in held.items():
                for at in range(0, len(keys), 200_000):
                    k = keys[at : at + 200_000].view(np.int64)
                    arrays = [pa.array([name] * len(k), pa.string()), pa.array(k), pa.array(counts[at : at + 200_000], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "key", "n"])
            held.clear()

        for batch in batches:
            for text_, name in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if not text_:
                    continue
                keys = keys_of(text_)
                waiting.setdefault(name, []).append(keys)
                size += len(keys)
                if size > 1_000_000:
                    for waits in list(waiting):
                        fold(waits)
                    size = 0
                    if sum(len(k) for k, _ in held.values()) > HELD_NGRAMS:
                        yield from flush()
        yield from flush()

    counted = narrow.mapInArrow(work, "lang string, key long, n long")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def last(column: str, n: int) -> Column:
    """The last ``n`` symbols of a key."""
    return F.col(column).bitwiseAND(F.lit((1 << (16 * n)) - 1))


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney smoothing from how many n-grams have count 1 to 4."""
    n1, n2, n3, n4 = (counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return (0.5, 0.75, 0.9)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def level(keys: np.ndarray, counts: np.ndarray, cut: tuple[float, float, float], lower: np.ndarray) -> tuple[np.ndarray, ...]:
    """Interpolated probabilities of n-grams, and contexts with their back-off weights.

    ``keys`` are sorted, ``lower`` has the probabilities of their last symbols one order below.
    """
    context = keys >> BITS
    starts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(keys) else np.empty(0, dtype=int)
    spans = np.diff(np.append(starts, len(keys)))
    cuts = np.array([0.0, *cut])[np.minimum(counts, 3)]
    total = np.add.reduceat(counts.astype(float), starts) if len(starts) else np.empty(0)
    left = np.add.reduceat(cuts, starts) / total if len(starts) else np.empty(0)
    where = np.repeat(np.arange(len(starts)), spans)
    return (counts - cuts) / total[where] + left[where] * lower, context[starts], left


def build(keys: np.ndarray, counts: np.ndarray, cuts: dict[int, tuple], first: tuple[np.ndarray, np.ndarray, float]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tables of one language and shard: n-grams of order 4 to 2 with log probabilities, then contexts of 3 to 1 symbols with log weights.

    ``first`` has the symbols, their probabilities and that of an unknown one.
    """
    orders = {ORDER: (keys, counts)}
    for n in range(ORDER - 1, 1, -1):
        # In how many ways each shorter n-gram is continued to the left.
        orders[n] = np.unique(orders[n + 1][0] & MASKS[n], return_counts=True)
    symbols, chances, unknown = first
    grams, contexts = {}, {}
    below_keys, below = symbols, chances
    for n in range(2, ORDER + 1):
        k, c = orders[n]
        at = np.minimum(np.searchsorted(below_keys, k & MASKS[n - 1]), max(0, len(below_keys) - 1))
        found = below_keys[at] == k & MASKS[n - 1] if len(below_keys) else np.zeros(len(k), dtype=bool)
        lower = np.where(found, below[at] if len(below_keys) else 0, unknown)
        chance, context, weight = level(k, c, cuts[n], lower)
        grams[n], contexts[n] = (k, np.log(chance)), (context, np.log(weight))
        below_keys, below = k, chance
    return [grams[n] for n in range(ORDER, 1, -1)] + [contexts[n] for n in range(ORDER, 1, -1)]


class HashArray:
    """Sorted hashes of keys with a value each, found through an index of their first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float) -> None:
        hashes = mix(keys.astype(np.uint64) + np.uint64(1))
        order = np.argsort(hashes)
        self.hashes = np.append(hashes[order], np.uint64(2**64 - 1))
        self.values = np.append(values[order].astype(np.float32), np.float32(missing))
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.searchsorted(self.hashes[:-1], edges).astype(np.int32)
        sizes = np.diff(np.append(self.starts, len(keys)))
        self.longest = int(sizes.max()) if len(sizes) else 0

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (``missing`` where absent) and whether each key is present."""
        hashes = mix(keys + np.uint64(1))
        at = self.starts[hashes >> self.shift].copy()
        end = len(self.hashes) - 1
        found = self.hashes[at] == hashes
        open_ = np.flatnonzero(~found)
        for _ in range(self.longest):
            if not len(open_):
                break
            step = np.minimum(at[open_] + 1, end)
            at[open_] = step
            hit = self.hashes[step] == hashes[open_]
            found[open_[hit]] = True
            open_ = open_[~hit & (self.hashes[step] < hashes[open_])]
        at[~found] = end
        found &= at < end
        return self.values[at], found


class ShardModel:
    """One shard's tables of one language."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]], first: tuple[np.ndarray, np.ndarray, float]) -> None:
        half = ORDER - 1
        self.grams = [HashArray(*t, 0.0) for t in tables[:half]]
        self.contexts = [HashArray(*t, 0.0) for t in tables[half:]]
        self.first = HashArray(first[0], np.log(first[1]), float(np.log(first[2])))

    def log_chances(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each key behind the others."""
        out = np.zeros(len(keys))
        open_ = np.arange(len(keys))
        for i, n in enumerate(range(ORDER, 1, -1)):
            part = keys[open_] & MASKS[n]
            values, found = self.grams[i].get(part)
            out[open_[found]] += values[found]
            open_, part = open_[~found], part[~found]
            if not len(open_):
                return out
            out[open_] += self.contexts[i].get(part >> BITS)[0]
        out[open_] += self.first.get(keys[open_] & MASKS[1])[0]
        return out


def pack(tables: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Tables as bytes."""
    head = np.array([len(k) for k, _ in tables], dtype="<i8").tobytes()
    return head + b"".join(k.astype("<u8").tobytes() + v.astype("<f4").tobytes() for k, v in tables)


def unpack(data: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
    """Inverse of :func:`pack`."""
    count = 2 * (ORDER - 1)
    sizes = np.frombuffer(data, dtype="<i8", count=count)
    at, out = 8 * count, []
    for size in sizes.tolist():
        keys = np.frombuffer(data, dtype="<u8", count=size, offset=at)
        values = np.frombuffer(data, dtype="<f4", count=size, offset=at + 8 * size)
        out.append((keys, values))
        at += 12 * size
    return out


def train(docs: DataFrame, text: str, lang: str, shard_ngrams: int = SHARD_NGRAMS) -> list[dict]:
    """The model of all texts: one broadcast per shard, with the symbols that it follows."""
    spark = docs.sparkSession
    fours = settle(count_ngrams(docs, text, lang))
    tables = {ORDER: fours}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = tables[n + 1].groupBy("lang", last("key", n).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # Sizes that do not grow with the data: symbols (2 ** 16 per language) and counts of counts.
    symbols = tables[1].collect()
    of_counts: dict[str, dict[int, dict[int, int]]] = {}
    for n in range(2, ORDER + 1):
        for r in tables[n].where("n <= 4").groupBy("lang", "n").count().collect():
            of_counts.setdefault(r["lang"], {}).setdefault(n, {})[r["n"]] = r["count"]
    first: dict[str, tuple[np.ndarray, np.ndarray, float]] = {}
    cuts: dict[str, dict[int, tuple]] = {}
    by_lang: dict[str, list] = {}
    for r in symbols:
        by_lang.setdefault(r["lang"], []).append((r["key"], r["n"]))
    for name, rows in by_lang.items():
        rows.sort()
        keys = np.array([k for k, _ in rows], dtype=np.uint64)
        counts = np.array([n for _, n in rows])
        own = discounts({i: int((counts == i).sum()) for i in range(1, 5)})
        base = 1.0 / (len(keys) + 1)
        chance, _, left = level(keys, counts, own, np.full(len(keys), base))
        first[name] = (keys, chance, float(left[0] * base))
        cuts[name] = {n: discounts(of_counts.get(name, {}).get(n, {})) for n in range(2, ORDER + 1)}
    before = F.shiftrightunsigned("key", 16).bitwiseAND(F.lit(0xFFFF)).cast("int")
    sizes = fours.groupBy(before.alias("before")).count().orderBy(F.desc("count"), "before").collect()
    shards: list[list] = []
    for r in sizes:
        fit = next((s for s in shards if s[0] + r["count"] <= shard_ngrams), None)
        if fit is None:
            shards.append(fit := [0, []])
        fit[0] += r["count"]
        fit[1].append(r["before"])
    of_symbol = np.zeros(1 << 16, dtype=np.int32)
    for i, (_, members) in enumerate(shards):
        of_symbol[members] = i
    # At most 2 ** 16 symbols.
    dealt = spark.createDataFrame([(int(b), i) for i, (_, members) in enumerate(shards) for b in members] or [(0, 0)], "before int, shard int")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        name, shard = group["lang"].iloc[0], int(group["shard"].iloc[0])
        keys = group["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        found = build(keys[order], group["n"].to_numpy()[order], cuts[name], first[name])
        return pd.DataFrame({"lang": [name], "shard": [shard], "model": [pack(found)]})

    placed = fours.withColumn("before", before).join(F.broadcast(dealt), "before").drop("before")
    built = settle(placed.groupBy("shard", "lang").applyInPandas(one, "lang string, shard int, model binary"))
    out = []
    for i in range(len(shards)):
        # One shard at a time passes through the driver.
        rows = {r["lang"]: bytes(r["model"]) for r in built.where(F.col("shard") == i).collect()}
        out.append({"shard": i, "of_symbol": of_symbol, "model": spark.sparkContext.broadcast(rows), "first": first})
    return out


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: str, words: Shingler) -> tuple[int, int, int, int, int]:
    """The counts of ``STATS`` for one text."""
    _, hashes = words.words(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8))
    n = len(hashes)
    repeated = 0
    if n > 3:
        windows = mix(hashes[:-2] * np.uint64(3) + mix(hashes[1:-1]) * np.uint64(5) + mix(hashes[2:] + np.uint64(7)))
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        again = np.zeros(n - 2, dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        covered = np.zeros(n, dtype=bool)
        for i in range(3):
            covered[i : n - 2 + i] |= again
        repeated = int(covered.sum())
    seen: set[str] = set()
    copies = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            if line in seen:
                copies += 1
            seen.add(line)
    return n, len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), copies, repeated


def add_scores(docs: DataFrame, model: dict | None, text: str, lang: str, with_stats: bool) -> DataFrame:
    """Adds what one shard predicts to the column ``_log_ppl``; fills ``_stats`` on the way ``with_stats``."""
    names = docs.columns
    t, g, s, c = (names.index(n) for n in (text, lang, "_log_ppl", "_stats"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        models: dict[str, ShardModel] = {}
        words = Shingler(3, fold=False)

        def chances(body: str, name: str) -> float:
            shipped = model["model"].value
            if not body or name not in shipped:
                return 0.0
            if name not in models:
                models[name] = ShardModel(unpack(shipped[name]), model["first"][name])
            keys = keys_of(body)
            own = model["of_symbol"][(keys >> BITS) & MASKS[1]] == model["shard"]
            return float(models[name].log_chances(keys if own.all() else keys[own]).sum())

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = list(batch.columns)
            bodies = texts_of(columns[t])
            if model is not None:
                rows = zip(bodies, columns[g].to_pylist(), columns[s].to_pylist(), strict=True)
                sums = [so_far + chances(body, "" if name is None else str(name)) for body, name, so_far in rows]
                columns[s] = pa.array(sums, pa.float64())
            if with_stats:
                found = np.array([statistics(b, words) for b in bodies], dtype=np.int64).reshape(-1, len(STATS))
                columns[c] = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(STATS))], list(STATS))
            return pa.RecordBatch.from_arrays(columns, names)

        return step

    return map_batches(docs, text, make, schema)


def scored(docs: DataFrame, models: list[dict], text: str, lang: str) -> DataFrame:
    """All columns of ``docs``, ``_stats``, ``_base_failed`` and ``_log_ppl`` (nats per character, null without text)."""
    kind = "struct<" + ", ".join(f"{c}: bigint" for c in STATS) + ">"
    found = docs.withColumn("_log_ppl", F.lit(0.0)).withColumn("_stats", F.lit(None).cast(kind))
    for i, model in enumerate(models or [None]):
        found = add_scores(found, model, text, lang, with_stats=i == 0)
    n, repeated = F.col("_stats.n_words"), F.col("_stats.n_repeat_words")
    size = F.length(text)
    return found.withColumn("_base_failed", (n < 50) | (repeated * 100 > n * 50)).withColumn(
        "_log_ppl", F.when(size > 0, -F.col("_log_ppl") / size)
    )


def bands(found: DataFrame, lang: str) -> DataFrame:
    """Lower and upper bound of ``_log_ppl`` per language, from all its texts that pass the counts."""
    name = F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang")
    usable = settle(found.where(~F.col("_base_failed")).select(name, "_log_ppl"))
    middle = usable.groupBy("_lang").agg(F.percentile_approx("_log_ppl", 0.5, 10_000).alias("_middle"))
    away = F.abs(F.col("_log_ppl") - F.col("_middle"))
    # One row per language; its broadcast is left to Spark's own size check.
    spread = usable.join(middle, "_lang").groupBy("_lang", "_middle").agg(F.percentile_approx(away, 0.5, 10_000).alias("_away"))
    width = F.greatest(F.col("_away") * DEVIATIONS, F.lit(LEAST_WIDTH))
    return spread.select("_lang", (F.col("_middle") - width).alias("_lower"), (F.col("_middle") + width).alias("_upper"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep_text: bool = True) -> DataFrame:
    """All columns of ``docs``, ``_stats``, ``_base_failed``, ``_log_ppl`` and ``_kept``.

    ``docs`` must not have columns of these names. With ``keep_text`` the texts are
    scored again for the result; without, the scores are kept from the first time
    and the text column is left out.
    """
    models = train(docs, text, lang)
    found = scored(docs, models, text, lang)
    if not keep_text:
        found = settle(found.drop(text))
    seen = found if not keep_text else scored(docs.select(text, lang), models, text, lang)
    # One row per language.
    limits = {r["_lang"]: (r["_lower"], r["_upper"]) for r in bands(seen, lang).collect()}
    outside = F.lit(False)
    for name, (lower, upper) in sorted(limits.items()):
        outside = outside | ((F.coalesce(F.col(lang).cast("string"), F.lit("")) == name) & ~F.col("_log_ppl").between(lower, upper))
    return found.withColumn("_kept", ~F.col("_base_failed") & ~F.coalesce(outside, F.lit(False)))

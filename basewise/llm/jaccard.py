"""Documents linked by Jaccard similarity of word shingles: a grouped prefix join.

1. Every text becomes a set of shingle hashes; equal sets are one class.
2. Shingles are ordered by frequency, rarest first. Two sets that are similar
   enough share l of the first n - ceil(t n) + l shingles (prefix), and their sizes
   differ little (length). Classes of equal size and prefix are one group.
3. Groups of which fewer than l prefix shingles stand in any other group are done.
   Others that share a prefix shingle within neighbouring size classes are candidates. Not their pairs are listed, which may be the square of their number,
   but the connected clusters of candidates (each shingle hangs its groups on one).
4. The members of a cluster are expanded and verified together, exactly, from their
   whole sets; a cluster too large for a task is cut into blocks, and each pair of
   blocks is verified. Members that are connected already are not compared again.
5. The links found give the components.

Frequencies are counted over all texts in an array of fixed size (shingles of one
place share a count). The order only decides which shingles are looked at first,
any order gives the same links; but where a place holds very many shingles, only
the most frequent ones stand out, and clusters of candidates grow.

Results: a text without words is its own component. Rows of one id are one
document for the component, and get its smallest; a null id gets no component.
Repeated rows get equal results, an empty table gives none. Only the two named
columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import runs, settle, texts_of, with_mark
from basewise.llm.components import components
from basewise.llm.shingles import Shingler
from basewise.operators.skew import splittable

# Places of the frequency array, and the parts in which it is summed.
PLACE_BITS, PARTS = 22, 64
PLACES = 1 << PLACE_BITS
# Shingles of a block of members (8 bytes each).
BLOCK_SHINGLES = 2_000_000


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets hold a shingle of each place, over all texts. ``docs`` has ``key`` and ``text``."""
    width = PLACES // PARTS
    names = ["part", "counts"]

    def rows(total: np.ndarray) -> pa.RecordBatch:
        parts = np.flatnonzero(total.reshape(PARTS, width).any(axis=1))
        # A task's count of a place stops at 255: what is frequent still adds up over tasks.
        counts = [np.minimum(total[p * width : (p + 1) * width], 255).astype("u1").tobytes() for p in parts]
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(counts, pa.binary())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        total = np.zeros(PLACES, dtype=np.int32)
        for batch in batches:
            for part in runs(batch, "text"):
                found = list(shingler.sets([t.encode() for t in texts_of(part.column(1))]))
                places, counts = np.unique(place_of(np.concatenate(found)), return_counts=True)
                total[places] += counts.astype(np.int32)
        if total.any():
            yield rows(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(part, np.zeros(width, dtype=np.int64))
                held[part] += np.frombuffer(counts, dtype="u1")
        keys = sorted(held)
        counts = [np.minimum(held[k], 2**16 - 1).astype("<u2").tobytes() for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(counts, pa.binary())], names)

    counted = docs.mapInArrow(count, "part int, counts binary")
    out = np.zeros(PLACES, dtype=np.uint16)
    for r in counted.repartition("part").mapInArrow(add, "part int, counts binary").collect():
        out[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["counts"], dtype="<u2")
    return out


def least_common(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with any set that it is linked to."""
    return -(-percent * n // 100)


def extra(n: int, percent: int) -> int:
    """Shingles by which a prefix of a set of ``n`` is longer than what must be looked at, and one."""
    return 1 + n * (100 - percent) // 200


def place_of(hashes: np.ndarray) -> np.ndarray:
    """Place of shingles in the frequency array."""
    return (hashes >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def digest(values: np.ndarray, salt: int) -> tuple[int, int]:
    """Two 64-bit numbers that name a set."""
    found = hashlib.blake2b(values.tobytes(), digest_size=16, salt=salt.to_bytes(4, "little")).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)


SIGNED = "key long, n int, set1 long, set2 long, prefix1 long, prefix2 long, prefix array<long>"


def signatures(docs: DataFrame, size: int, percent: int, order: np.ndarray) -> DataFrame:
    """Per row: size and name of its set, and its prefix and the prefix's name."""
    shipped = docs.sparkSession.sparkContext.broadcast(order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        names = [c.split()[0] for c in SIGNED.split(", ")]
        for batch in batches:
            for part in runs(batch, "text"):
                columns: list[list] = [[] for _ in range(5)]
                prefixes = []
                for found in shingler.sets([t.encode() for t in texts_of(part.column(1))]):
                    n = len(found)
                    first = found[np.argsort(shipped.value[place_of(found)], kind="stable")[: n - least_common(n, percent) + extra(n, percent)]]
                    prefixes.append(first)
                    for column, value in zip(columns, (n, *digest(found, 1), *digest(first, n)), strict=True):
                        column.append(value)
                offsets = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                values = np.concatenate(prefixes).view(np.int64) if prefixes else np.empty(0, dtype=np.int64)
                arrays = [part.column(0), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])]
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(work, SIGNED)


def group_name() -> Column:
    """A hash of what names a group: its size and its prefix."""
    return F.xxhash64("n", "prefix1", "prefix2")


def candidate_clusters(signed: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``component`` of the groups (named by one member) that share a prefix shingle with a group of a near size."""
    # Rows that are a group by themselves post their own prefix; only those of larger groups, or of repeated keys, are looked up.
    larger = groups.where("rows > 1").select(group_name().alias("mark"))
    repeated = signed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.xxhash64("key").alias("mark"))
    marks = settle(larger.unionByName(repeated))
    marked = with_mark(with_mark(signed, group_name(), marks, "_several"), F.xxhash64("key"), marks, "_again").select("key", "n", "prefix", (F.col("_several") | F.col("_again")).alias("_look"))
    looked = marked.where("_look").join(groups.select(F.col("group").alias("key")), "key", "left_semi").dropDuplicates(["key"])
    prefixes = marked.where("not _look").unionByName(looked)
    step = math.log(100 / percent)
    # 48 bits of a shingle suffice: a clash only makes a cluster larger.
    posts = prefixes.select(F.explode("prefix").alias("token"), F.col("key").alias("group"), "n")
    posts = posts.withColumn("token", F.shiftrightunsigned("token", 16))
    shared = posts.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("m > 1")
    # Prefixes that are longer by l - 1 share l shingles, l that of the smaller set; its size is at least this one's least_common.
    smallest = F.ceil(F.col("n") * percent / 100 - 1e-9)
    asked = F.floor(smallest * (100 - percent) / 200 + 1e-9) + 1
    able = shared.withColumn("s", F.count(F.lit(1)).over(Window.partitionBy("group"))).where(F.col("s") >= asked)
    # Sizes that can match lie in one class or in neighbouring ones, so each group stands in its own and the next.
    c = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    # Both classes come from one shuffle by the shingle.
    dealt = able.select("token", "group", c.alias("c")).repartition("token")
    placed = dealt.select("token", "group", F.explode(F.array(F.col("c"), F.col("c") + 1)).alias("c"))
    hung = placed.withColumn("hub", F.min("group").over(Window.partitionBy("token", "c")))
    return components(hung.where("group != hub").select("group", "hub").distinct())


class Cluster:
    """Verifies the members of one cluster (or pair of its blocks) and joins them."""

    def __init__(self, keys: list[int], sets: list[np.ndarray], sides: list[int], percent: int) -> None:
        self.keys, self.percent = keys, percent
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.sides = np.array(sides)
        self.label = np.arange(len(keys))
        _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        self.ends = np.cumsum(self.sizes)
        self.tokens = tokens
        order = np.argsort(tokens, kind="stable")
        self.holders = owners[order]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(tokens))))

    def common(self, a: int) -> np.ndarray:
        """How many shingles each member shares with member ``a``."""
        own = self.tokens[self.ends[a] - self.sizes[a] : self.ends[a]]
        starts, counts = self.first[own], self.first[own + 1] - self.first[own]
        # All ranges [start, start + count) behind each other.
        at = np.arange(counts.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
        return np.bincount(self.holders[at], minlength=len(self.keys))

    def links(self, cross: bool) -> list[tuple[int, int]]:
        """Each joined member with the smallest of its component."""
        count = len(self.keys)
        for a in range(count):
            others = self.label != self.label[a]
            others[: a + 1] = False
            if cross:
                others &= self.sides != self.sides[a]
            # Sizes alone rule out the rest.
            others &= (100 * np.minimum(self.sizes, self.sizes[a]) >= self.percent * np.maximum(self.sizes, self.sizes[a]))
            if not others.any():
                continue
            both = self.common(a)
            near = others & (100 * both >= self.percent * (self.sizes + self.sizes[a] - both))
            if near.any():
                joined = np.unique(np.append(self.label[near], self.label[a]))
                self.label[np.isin(self.label, joined)] = joined[0]
        keys = np.array(self.keys)
        smallest = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(smallest, self.label, keys)
        return [(int(k), int(s)) for k, s in zip(keys, smallest[self.label], strict=True) if k != s]


def verified_links(docs: DataFrame, members: DataFrame, size: int, percent: int, block_shingles: int) -> DataFrame:
    """``a`` and ``b`` of links that join the members of each cluster. ``members``: key, n, set1, set2, cluster."""
    weights = members.groupBy(F.col("cluster").alias("c")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("weight")).where("m > 1")
    left, right, condition = splittable(members, weights, [("cluster", "c")])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("weight") / block_shingles)).cast("int")
    dealt = left.join(right, condition).select(
        F.col("key").alias("member"), "set1", "set2", "cluster", blocks.alias("blocks"), F.pmod(F.xxhash64("key"), blocks).cast("int").alias("block")
    )
    # Texts that belong to no cluster are left where they are.
    wanted = with_mark(docs, F.col("key"), members.select("key"), "_wanted").where("_wanted").drop("_wanted")
    texts = wanted.join(dealt, F.col("key") == F.col("member"))
    texts = texts.select("key", "text", "set1", "set2", "cluster", "blocks", "block")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for part in runs(batch, "text"):
                sets = list(shingler.sets([t.encode() for t in texts_of(part.column(1))]))
                named = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                # Of rows with one id those of the class that the id stands for.
                kept = [i for i, name in enumerate(named) if digest(sets[i], 1) == name]
                took = part.select([0, 4, 5, 6]).take(pa.array(kept, pa.int32()))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array([sets[i].tobytes() for i in kept], pa.binary())], ["key", "cluster", "blocks", "block", "shingles"])

    sets = texts.mapInArrow(shingle, "key long, cluster long, blocks int, block int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = sets.select("key", "cluster", "block", "shingles", other).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "block", "shingles"
    )
    placed = paired.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, out = None, [], []

        def close() -> None:
            if len(rows) > 1:
                cluster = Cluster([r[0] for r in rows], [np.frombuffer(r[2], dtype=np.uint64) for r in rows], [r[1] for r in rows], percent)
                out.extend(cluster.links(cross=current[1] != current[2]))

        for batch in batches:
            for c, i, j, key, block, shingles in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (c, i, j) != current:
                    if current is not None:
                        close()
                    current, rows = (c, i, j), []
                rows.append((key, block, shingles))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])
                out.clear()
        if current is not None:
            close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    return placed.mapInArrow(verify, "a long, b long")


def link_documents(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Per row: key, ``n_shingles`` and ``component``, the smallest key that links lead to.

    Two rows are linked where 100 * |intersection| >= percent * |union| of their
    sets of distinct shingles of ``size`` words.
    """
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    signed = settle(signatures(narrow, size, percent, frequencies(narrow, size)))
    usable = signed.where(F.col("key").isNotNull() & (F.col("n") > 0))
    names = ["n", "set1", "set2", "prefix1", "prefix2"]
    classes = settle(usable.groupBy(*names).agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("rows")))
    groups = classes.groupBy("n", "prefix1", "prefix2").agg(F.min("key").alias("group"), F.count(F.lit(1)).alias("classes"), F.sum("rows").alias("rows"))
    clusters = candidate_clusters(usable, groups, percent)
    # A class belongs to its group's cluster; a group of several classes is one even alone.
    left, right, condition = splittable(classes, groups.select(F.col("n").alias("gn"), F.col("prefix1").alias("g1"), F.col("prefix2").alias("g2"), "group", "classes"), [("n", "gn"), ("prefix1", "g1"), ("prefix2", "g2")])
    grouped = left.join(right, condition).select("key", "n", "set1", "set2", "group", "classes")
    members = grouped.join(clusters, F.col("group") == F.col("node"), "left").where(F.col("component").isNotNull() | (F.col("classes") > 1))
    members = settle(members.select("key", "n", "set1", "set2", F.coalesce("component", "group").alias("cluster")))
    # An id that stands for several classes links them.
    same_id = usable.select("key", "set1", "set2").join(
        usable.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "key"
    ).join(classes.select(F.col("set1").alias("s1"), F.col("set2").alias("s2"), F.col("key").alias("b")), (F.col("set1") == F.col("s1")) & (F.col("set2") == F.col("s2"))).select(F.col("key").alias("a"), "b")
    found = components(verified_links(narrow, members, size, percent, block_shingles).unionByName(same_id))
    labels = classes.join(found, F.col("key") == F.col("node"), "left").select(
        F.col("set1").alias("s1"), F.col("set2").alias("s2"), F.coalesce("component", "key").alias("label"), "rows", F.col("component").isNotNull().alias("linked")
    )
    # Most classes are one row and nothing else: those need no join.
    labels = labels.where(F.col("linked") | (F.col("rows") > 1)).select("s1", "s2", "label")
    left, right, condition = splittable(signed.select("key", "n", "set1", "set2"), labels, [("set1", "s1"), ("set2", "s2")])
    joined = left.join(right, condition, "left")
    component = F.when(F.col("key").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("label", "key"))
    return joined.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), component.alias("component"))

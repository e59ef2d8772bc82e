"""How often the many rows of a query are shuffled, and that the shorter ways give the same rows."""

import os
import random

from pyspark.sql import functions as F

import __spark_entry__ as contract
from basewise.operators import lift_positions, map_positions
from basewise.operators.alleles import common_prefix
from basewise.operators.skew import deal_by

TESTDATA = "/root/testdata/sf0.001"
SEGMENT = (
    "sequence string, chromosome string, sense string, genomic_start int, genomic_end int, transcript_id string, "
    "transcript_start int, transcript_end int, gap array<struct<op:string,len:int>>"
)


def shuffles_above(df, made):
    """Numbers of shuffles between the result and the nodes that make the column ``made``."""
    found = []

    def walk(node, above):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan(), above)
        if node.nodeName() == "Generate" and f"[{made}#" in node.simpleString(1000):
            found.append(above)
        above += node.nodeName().startswith("Exchange")
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), above)

    walk(df._jdf.queryExecution().executedPlan(), 0)
    return found


def test_variants_are_shuffled_for_liftover_and_rollup_only(spark):
    assert max(shuffles_above(contract.queries()["end_to_end"](spark, TESTDATA), "_letter")) == 2


def test_dealt_points_map_alike(spark):
    """Overlaps, accessions, senses without a place, gaps, nulls: dealt or not, as by looking at every segment."""
    rng = random.Random(3)
    rows = []
    for t in range(40):
        for _ in range(rng.randrange(1, 6)):
            start, length, place = rng.randrange(1, 200), rng.randrange(1, 60), rng.randrange(1, 9000)
            sequence = rng.choice(["NC_1.1", "NC_2.1", "NC_3.1"] + [None] * (t == 7))
            sense = rng.choice("+-.") if t % 3 == 0 else "+-"[sequence == "NC_2.1"]
            rows.append((sequence, sequence and sequence[3], sense, place, place + length - 1, f"NM_{t}", start, start + length - 1, None))
    rows += [*rows[:9], ("NC_1.1", "1", "+", 1, 9, None, 1, 9, None), ("NC_1.1", "1", "?", 1, 9, "NM_90", 1, 9, None)]
    names = [f"NM_{t}" for t in range(0, 40, 2)] + ["NM_90", "NM_99", None]
    points = [(n, p, "A", "C") for n in names for p in [*range(-1, 270, 3), None]]

    def best(name, p):
        own = [r for r in rows if r[5] == name and name is not None]
        if not own:
            return None, -1
        head = min(own, key=lambda r: tuple((v is not None, v) for v in (r[0], r[6], r[7], r[3], r[2], r[1])))
        hits = sorted(
            (r[6], r[7], r[3], r[4], r[2]) for r in own if p is not None and r[0] is not None and r[0] == head[0] and r[2] in "+-" and r[6] <= p <= r[7]
        )
        if not hits:
            return head[1], -1
        start, end, low, high, sense = hits[0]
        return head[1], (high - (end - p) if sense == "+" else low + (end - p))

    want = sorted((str(n), str(p), *map(str, best(n, p))) for n, p, _, _ in points)
    segments = spark.createDataFrame(rows, SEGMENT)
    df = spark.createDataFrame(points, "nm_id string, transcript_position int, ref string, alt string")
    for got in (map_positions(df, segments, bin_width=16), map_positions(deal_by(df, "nm_id"), segments, bin_width=16, dealt=True)):
        assert sorted((str(r.nm_id), str(r.transcript_position), str(r.chromosome_id), str(r.position)) for r in got.collect()) == want


def test_alleles_are_checked_in_the_chunk_of_their_piece(spark):
    """Missing, short and repeated chunks, pieces over many chunks, alleles behind their piece: as read off the genome."""
    rng = random.Random(8)
    bases = "".join(rng.choice("ACGT") for _ in range(96))
    chunks = [("chr2", i, bases[8 * i : 8 * i + 8]) for i in range(12) if i != 4] + [("chr2", 6, bases[48:56])]
    chunks[1] = ("chr2", 1, bases[8:11])
    blocks = [("chr1", 1, 40, "chr2", 11, "+", 96, 5, "a"), ("chr1", 30, 70, "chr2", 21, "-", 96, 9, "b"), ("chr1", 80, 90, "chr3", 1, "+", 96, 1, "c")]
    turn = str.maketrans("ACGT", "TGCA")
    points = []
    for p in range(1, 95):
        for n in (1, 2, 3):
            back, start = 30 <= p <= 70, p + 10 if p < 30 else 96 - 20 - (p - 30) - n + 1
            own = bases[start - 1 : start - 1 + n]
            points.append((p * 10 + n, "1", p, own[::-1].translate(turn) if back else own if len(own) == n else "A" * n, "G" * n))
    names = {c: [x for x in chunks if x[1] == c] for c in range(12)}
    want = []
    for i, _, p, ref, _ in points:
        back, last = 30 <= p <= 70, p + len(ref) - 1
        end = 70 if back else 40 if p < 30 else 90 if 80 <= p <= 90 else None
        if end is None or end == 90 or last > end:
            want.append((i, "NO_TARGET"))
            continue
        start = 106 - last if back else p + 10
        one, two = (start - 1) // 8, (start + len(ref) - 2) // 8
        text = ref[::-1].translate(turn) if back else ref
        for _, _, line in names[one] or [(0, 0, "")]:
            same = line[(start - 1) % 8 :][: len(ref)] == text
            want.append((i, "CANNOT_LIFTOVER_INDEL" if one != two else "PASS" if same else "MISMATCHING_REF_ALLELE"))
    got = lift_positions(
        spark.createDataFrame(points, "i int, chromosome_id string, position int, ref string, alt string"),
        spark.createDataFrame(blocks, "src_chr string, src_start long, src_end long, dst_chr string, dst_start long, dst_strand string, dst_size long, score long, chain_id string"),
        spark.createDataFrame(chunks, "chr string, chunk_id long, bases string"), 8, bin_width=16, multi_base=False,
    )
    assert sorted((r.i, r.liftoverResult) for r in got.collect()) == sorted(want)
    assert {r for _, r in want} == {"NO_TARGET", "PASS", "MISMATCHING_REF_ALLELE", "CANNOT_LIFTOVER_INDEL"}
    assert got.groupBy("i").count().where(F.col("count") > 1).count() > 0


def test_every_position_is_mapped(spark, tmp_path):
    """One order of 360 positions and one without segments: no position is left out."""
    spark.createDataFrame([(1,), (2,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1, 5, 7, 50.0), (1, 2, 6, 7, 20.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    got = {(r.nm_id, r.transcript_position): r.position for r in contract.queries()["map_positions"](spark, str(tmp_path)).collect()}
    assert set(got) == {(f"NM_{o}", p) for o in (1, 2) for p in range(1, 361)}
    # The antisense strand runs backwards; the second segment holds positions 51 to 70.
    assert [got["NM_1", p] for p in (1, 2, 50, 51, 70, 71)] == [701_054, 701_053, 701_005, 702_025, 702_006, -1]


def test_points_need_no_shuffle_to_meet_segments(spark):
    for name, others in (("map_placements", 0), ("map_positions_shuffled", 1), ("map_positions", 0)):
        assert set(shuffles_above(contract.queries()[name](spark, TESTDATA), "p")) == {others}


def test_common_prefix_computes_its_texts_once(spark):
    """A Python function may not stand in a loop over steps: the texts are made ahead of it."""
    rng = random.Random(4)
    texts = [(None, "A"), ("A", None), (None, None), ("", "A"), ("", "")]
    for _ in range(200):
        a, b = ("".join(rng.choice("AC") for _ in range(rng.randrange(0, 9))) for _ in range(2))
        texts += [(a, b), (a, a + b), ("ACGT" * 60 + a, "ACGT" * 60 + b)]
    as_it_is = F.udf(lambda t: t, "string")
    df = spark.createDataFrame(texts, "a string, b string")
    got = df.select("a", "b", common_prefix(as_it_is("a"), F.col("b")).alias("n")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n == len(os.path.commonprefix([r.a or "", r.b or ""]))

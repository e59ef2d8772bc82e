"""Alignment parsing and transcript-to-genome mapping."""

import random

import pytest

from basewise.operators import aligned_length, disjoint_pieces, lookup, map_positions, overlap_join
from basewise.sources import parse_alignments
from pyspark.sql import functions as F

GFF = (
    "NC_000004.1 RefSeq cDNA_match 5001 5090 90 - . "
    "ID=70a3;Target=NM_31.1 1 90 +;gap_count=0;identity=1"
)
SEGMENT = (
    "sequence string, chromosome string, sense string, genomic_start int, genomic_end int, transcript_id string, "
    "transcript_start int, transcript_end int, gap array<struct<op:string,len:int>>"
)
VARIANT = "nm_id string, transcript_position int, ref string, alt string"


def ops(text):
    return None if text is None else [(t[0], int(t[1:])) for t in text.split()]


def walked(sense, g_start, t_start, t_end, gaps, mode="reference"):
    """Positions by walking the transcript one base at a time."""
    order = range(t_start, t_end + 1) if sense == "+" else range(t_end, t_start - 1, -1)
    ops_left = list(gaps if sense == "+" else reversed(gaps))
    shift, left, out = 0, 0, {}
    for k, p in enumerate(order):
        while left == 0:
            if not ops_left:
                return out
            op, length = ops_left.pop(0)
            shift += {"I": -length, "D": length}.get(op, 0)
            left = 0 if (op == "D" and mode == "cigar") else length
        out[p] = g_start + k + shift
        left -= 1
    return out


def test_parse_alignment_line(spark):
    lines = [("##gff",), (GFF,), (GFF.replace("gap_count=0", "gap_count=1") + ";Gap=M40 D2 M50",)]
    rows = parse_alignments(spark.createDataFrame(lines, "value string")).collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.sequence, r.chromosome, r.sense, r.score) == ("NC_000004.1", "4", "-", 90.0)
    assert (r.genomic_start, r.genomic_end, r.transcript_start, r.transcript_end) == (5001, 5090, 1, 90)
    assert r.transcript_id == "NM_31.1" and r.gap is None
    assert [(g.op, g.len) for g in rows[1].gap] == [("M", 40), ("D", 2), ("M", 50)]


def test_golden_antisense(spark):
    segments = parse_alignments(spark.createDataFrame([(GFF,)], "value string"))
    df = spark.createDataFrame(
        [("NM_31.1", 1, "A", "C"), ("NM_31.1", 90, "G", "T"), ("NM_31.1", 91, "N", "x"),
         ("NM_9", 5, "A", "G")], VARIANT)
    rows = {(r.nm_id, r.transcript_position): r for r in map_positions(df, segments, "NM").collect()}
    r = rows[("NM_31.1", 1)]
    assert (r.chromosome_id, r.position, r.ref, r.alt, r.sense) == ("4", 5090, "T", "G", "-")
    assert rows[("NM_31.1", 90)].position == 5001
    r = rows[("NM_31.1", 91)]
    assert (r.chromosome_id, r.position, r.ref, r.alt, r.sense) == ("4", -1, "N", None, "-")
    r = rows[("NM_9", 5)]
    assert (r.chromosome_id, r.position, r.ref, r.alt, r.sense) == (None, -1, "A", "G", None)


@pytest.mark.parametrize(
    "mode,text,expected",
    [
        ("reference", "M5 I1 M7", [100, 101, 102, 103, 104, 104, 105, 106, 107, 108, 109, 110, 111]),
        ("reference", "M5 D2 M5", [100, 101, 102, 103, 104, 107, 108, 109, 110, 111]),
        ("reference", "M5 D2 M1 D3 M4", [100, 101, 102, 103, 104, 107, 108, 109, 113, 114]),
        ("cigar", "M5 D2 M1 D3 M4", [100, 101, 102, 103, 104, 107, 111, 112, 113, 114]),
    ],
)
def test_golden_gaps(spark, mode, text, expected):
    n = len(expected)
    segments = spark.createDataFrame([("NC_1.1", "1", "+", 100, expected[-1], "T", 1, n, ops(text))], SEGMENT)
    df = spark.createDataFrame([("T", p, "A", "C") for p in range(1, n + 1)], VARIANT)
    got = map_positions(df, segments, gap_mode=mode).orderBy("transcript_position")
    assert [r.position for r in got.collect()] == expected


@pytest.mark.parametrize("mode", ["reference", "cigar"])
@pytest.mark.parametrize("limit", [None, 0])
def test_random_gaps(spark, mode, limit):
    rng = random.Random(11)
    segments, points, truth = [], [], {}
    for t in range(300):
        start, g_start, sense = rng.randrange(1, 5000), rng.randrange(1, 10**6), rng.choice("+-")
        gaps = [(rng.choice("MID"), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 8))]
        gaps = [("M", rng.randrange(1, 60)), *gaps, ("M", rng.randrange(1, 60))]
        span = sum(n for op, n in gaps if op != "D")
        name = f"T{t}"
        segments.append(("NC_1.1", "1", sense, g_start, g_start + span, name, start, start + span - 1, gaps))
        place = walked(sense, g_start, start, start + span - 1, gaps, mode)
        for p in range(start - 1, start + span + 1):
            points.append((name, p, "A", "C"))
            truth[(name, p)] = place.get(p, -1)
    segments = segments + segments[:50]  # copies must change nothing
    got = map_positions(
        spark.createDataFrame(points, VARIANT), spark.createDataFrame(segments, SEGMENT), gap_mode=mode,
        broadcast_limit=limit,
    ).collect()
    assert {(r.nm_id, r.transcript_position): r.position for r in got} == truth
    assert len(got) == len(points)


def test_several_segments_and_sequences(spark):
    segments = spark.createDataFrame(
        [
            ("NC_2.1", "4", "-", 900, 949, "T", 1, 50, None),
            ("NC_1.1", "1", "+", 500, 549, "T", 51, 100, None),
            ("NC_1.1", "1", "+", 100, 149, "T", 1, 50, None),
            ("NC_1.1", "1", "+", 700, 709, "T", 45, 54, None),
        ],
        SEGMENT,
    )
    df = spark.createDataFrame([("T", p, "A", "C") for p in (1, 45, 50, 51, 54, 100, 101)], VARIANT)
    got = {r.transcript_position: (r.chromosome_id, r.position) for r in map_positions(df, segments).collect()}
    # Overlaps belong to the segment with the smaller transcript start.
    assert got == {1: ("1", 100), 45: ("1", 144), 50: ("1", 149), 51: ("1", 706), 54: ("1", 709), 100: ("1", 549), 101: ("1", -1)}
    totals = {r.sequence: r.aligned_length for r in aligned_length(segments).collect()}
    assert totals == {"NC_2.1": 50, "NC_1.1": 110}


@pytest.mark.parametrize("limit", [None, 0])
def test_interval_lookup_against_brute_force(spark, limit):
    rng = random.Random(5)
    intervals = []
    for i in range(400):
        start = rng.randrange(0, 3000)
        key = "hot" if rng.random() < 0.4 else rng.choice("abc")
        intervals.append((key, start, start + rng.choice([0, 3, 50, 700]), rng.randrange(5), i))
    points = [(rng.choice(["hot", "a", "b", "c", "none", None]), rng.randrange(0, 4000)) for _ in range(3000)]
    points += [("hot", 77)] * 1500 + [(None, None)] * 200
    best = []
    for k, p in points:
        hits = [(r, i) for key, s, e, r, i in intervals if key == k and p is not None and s <= p <= e]
        best.append((k, p, min(hits)[1] if hits else None))
    pieces = disjoint_pieces(
        spark.createDataFrame(intervals, "key string, s int, e int, r int, id int"),
        ["key"], "s", "e", [F.col("r"), F.col("id")], ["id"], 64,
    )
    df = spark.createDataFrame(points, "k string, p int")
    got = lookup(df, pieces, {"k": "key"}, "p", 64, limit).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, best))


def test_every_placement(spark):
    """One row per accession, each with its own segments, sense and holes; unknown transcripts once."""
    rows = [
        ("NC_23.1", "X", "+", 101, 150, "NM_1", 1, 50, None),
        ("NC_23.1", "X", "+", 301, 350, "NM_1", 41, 90, None),  # overlaps the first from 41 on
        ("NC_24.1", "Y", "-", 501, 560, "NM_1", 1, 60, None),
        ("NC_24.1", "Y", "-", 501, 560, "NM_1", 1, 60, None),
        ("NC_5.1", "5", "-", 10, 29, "NM_2", 1, 20, ops("M10 D3 M7")),
    ]
    segments = spark.createDataFrame(rows, SEGMENT)
    df = spark.createDataFrame([("NM_1", 45, "A", "C"), ("NM_1", 70, "A", "C"), ("NM_2", 3, "A", "C"), ("NM_3", 1, "A", "C")], VARIANT)
    for limit in (None, 10_000_000):
        got = map_positions(df, segments, bin_width=16, all_placements=True, broadcast_limit=limit)
        found = {(r.nm_id, r.transcript_position, r.placement, r.chromosome_id, r.position, r.sense, r.ref) for r in got.collect()}
        plain = {r.position for r in map_positions(df.where("nm_id = 'NM_2'"), segments).collect()}
        assert got.count() == 6 and found == {
            ("NM_1", 45, "NC_23.1", "X", 145, "+", "A"),
            ("NM_1", 45, "NC_24.1", "Y", 516, "-", "T"),
            ("NM_1", 70, "NC_23.1", "X", 330, "+", "A"),
            ("NM_1", 70, "NC_24.1", "Y", -1, "-", "T"),
            ("NM_2", 3, "NC_5.1", "5", *plain, "-", "T"),
            ("NM_3", 1, None, None, -1, None, "A"),
        }


@pytest.mark.parametrize("widths", [(8,), (4, 16, 64), (16, 1024, 1 << 20)])
def test_overlaps_once_each(spark, widths):
    rng = random.Random(len(widths))

    def spans(n):
        out = []
        for i in range(n):
            start = rng.randrange(-50, 400)
            out.append((i, rng.choice("ab"), start, start + rng.choice([0, 0, 3, 20, 200, 3000]) - rng.choice([0, 0, 0, 1])))
        return [*out, (n, None, 1, 5), (n + 1, "a", None, 5), (n + 2, "a", 5, None)]

    a, b = spans(150), spans(120)
    left = spark.createDataFrame(a, "i int, k string, s int, e int").repartition(3)
    right = spark.createDataFrame(b, "j int, m string, t long, f long").repartition(2)
    got = overlap_join(left, right, {"k": "m"}, ("s", "e"), ("t", "f"), widths)
    assert got.columns == ["i", "k", "s", "e", "j", "m", "t", "f"]
    whole = lambda rows: [r for r in rows if None not in r and r[2] <= r[3]]
    want = sorted((x[0], y[0]) for x in whole(a) for y in whole(b) if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted((r.i, r.j) for r in got.collect()) == want

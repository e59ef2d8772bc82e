"""Program output, differences, structure distance, annotations and piping."""

import random
import sys

import pytest
from pyspark.sql import functions as F

from basewise.functions import number_list, pair_distance, rounded_difference, threshold_flag
from basewise.operators import (
    attach_wildtype,
    deltas,
    drop_stale_scores,
    pair_distances,
    parse_annotations,
    pipe_batches,
    to_tool_records,
)
from basewise.operators.pipe import DISTANCE_INPUT, FOLD_INPUT
from basewise.sources import (
    parse_distance,
    parse_fold,
    parse_pdist,
    read_distance_output,
    read_fold_output,
    read_pdist_output,
)

SHAPE = "((((....)))).((((((......))))))...."
FOLD = (
    "NM_11.1|31|C|A|ACGT|false\n"
    "AUCGUAGCUAGUCGUACAUGCUACGU\n"
    f"{SHAPE} (-4.20)\n"
    f"((((.,,.)))).((((((......)))))).... [-4.90]\n"
    f"{SHAPE} {{-4.20 d=0.85}}\n"
    f"{SHAPE} {{-4.20 MEA=22.50}}\n"
    " frequency of mfe structure in ensemble 0.4375; ensemble diversity 1.6  \n"
)


def test_fold_record(spark, tmp_path):
    (tmp_path / "fold.txt").write_text(">" + FOLD + ">" + FOLD.replace("0.4375", "1.2e-05").replace("|false", "|TRUE"))
    rows = read_fold_output(spark, str(tmp_path / "fold.txt")).orderBy("isWildType").collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.nm_id, r.transcript_position, r.ref, r.alt, r.wildSequence) == ("NM_11.1", 31, "C", "A", "ACGT")
    assert r.sequence.startswith("AUCG") and r.isWildType is False
    assert (r.mfeValue, r.efeValue, r.cfeValue, r.cdValue, r.meafeValue, r.meaValue) == (-4.2, -4.90, -4.2, 0.85, -4.2, 22.5)
    assert (r.freqMfeEnsemble, r.endValue, r.mfeStructure, r.cfeStructure) == (0.4375, 1.6, SHAPE, SHAPE)
    assert r.efeStructure.startswith("((((.,,.))))")
    assert (rows[1].freqMfeEnsemble, rows[1].endValue, rows[1].isWildType) == (1.2e-05, 1.6, True)


def test_distance_record(spark, tmp_path):
    key = ["NM_1.2", "7", "C", "A", "AAC", "AAA", *[str(i + 0.5) for i in range(8)], "m", "e", "a", "c", "false",
           *[str(-i - 0.25) for i in range(8)], "wm", "we", "wa", "wc"]
    assert len(key) == 31
    (tmp_path / "d.txt").write_text(">" + "#".join(key) + " \nf: 14  \nf: 3 \nf: 9\n")
    r = read_distance_output(spark, str(tmp_path / "d.txt")).first()
    assert (r.mfeed, r.meaed, r.cfeed) == (14, 3, 9)
    assert (r.nm_id, r.transcript_position, r.sequence, r.wildSequence) == ("NM_1.2", 7, "AAC", "AAA")
    assert (r.mfeValue, r.endValue, r.wt_mfeValue, r.wt_endValue) == (0.5, 7.5, -0.25, -7.25)
    assert (r.cfeStructure, r.wt_cfeStructure) == ("c", "wc")


def test_pdist_record(spark, tmp_path):
    (tmp_path / "p.txt").write_text(">NM_11.1|31|C|A|AC|AA\n0.125\n>NM_2|1|G|T|GC|GA\n 3 \n")
    rows = read_pdist_output(spark, str(tmp_path / "p.txt")).orderBy("nm_id").collect()
    assert [(r.nm_id, r.transcript_position, r.sequence, r.wildSequence, r.efeed) for r in rows] == [
        ("NM_11.1", 31, "AC", "AA", 0.125),
        ("NM_2", 1, "GC", "GA", 3.0),
    ]


def test_numbers_and_flags(spark):
    df = spark.createDataFrame([("x -1.5 .25 d=3 1e-3",)], "t string")
    assert df.select(number_list("t")).first()[0] == ["-1.5", ".25", "3", "1e-3"]
    pairs = [(2.675, 1.005, 1.67), (-4.205, 0.0, -4.21), (0.1, 0.3, -0.2), (None, 1.0, None), (0.005, 0.004, 0.01)]
    df = spark.createDataFrame(pairs, "a double, w double, d double")
    assert [r[0] for r in df.select(rounded_difference("a", "w")).collect()] == [p[2] for p in pairs]
    df = spark.createDataFrame([(0.8,), (0.79,), (None,), (float("nan"),)], "c double")
    assert [r[0] for r in df.select(threshold_flag("c", 0.8)).collect()] == [1, 0, None, 0]


def pairs_of(text):
    stack, out = [], set()
    for i, c in enumerate(text):
        if c == "(":
            stack.append(i)
        elif c == ")":
            out.add((stack.pop(), i))
    return out


def random_structure(rng, n):
    out, depth = "", 0
    for i in range(n):
        left = n - i
        choice = rng.choice("(.)")
        if depth == left:
            choice = ")"
        elif choice == "(" and depth + 1 > left - 1:
            choice = "."
        elif choice == ")" and depth == 0:
            choice = "."
        depth += {"(": 1, ")": -1, ".": 0}[choice]
        out += choice
    return out


def test_pair_distance_against_stack(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(2000):
        n = rng.choice([0, 1, 5, 40, 101])
        a = random_structure(rng, n)
        b = a if rng.random() < 0.2 else random_structure(rng, n)
        rows.append((a, b, len(pairs_of(a) ^ pairs_of(b))))
    rows += [(None, "()", None), ("()", None, None), ("((", "()", None), (")(", "()", None), ("(())", "()", 2 + 1)]
    df = spark.createDataFrame(rows, "a string, b string, d int").repartition(5)
    got = df.select("d", pair_distance("a", "b").alias("got"))
    assert got.where(~F.col("d").eqNullSafe(F.col("got"))).count() == 0


def test_wildtype_chain(spark):
    fold = parse_fold(spark.createDataFrame([(FOLD,), (FOLD.replace("|false", "|true").replace("-4.20)", "-6.30)"),)], "value string"))
    wide = attach_wildtype(fold.where("not isWildType"), fold.where("isWildType"))
    row = pair_distances(deltas(wide)).first()
    assert (row.deltaMFE, row.deltaEND, row.mfeed, row.meaed, row.cfeed) == (2.1, 0.0, 0, 0, 0)
    cleaned = drop_stale_scores(pair_distances(deltas(wide)))
    assert "deltaMFE" not in cleaned.columns and "mfeed" not in cleaned.columns
    # What a distance program would read and echo.
    record = to_tool_records(wide, **DISTANCE_INPUT).first().value.split("\n")
    assert len(record) == 7 and record[0].startswith(">NM_11.1#31#") and record[0].count("#") == 30
    echoed = spark.createDataFrame([(record[0][1:] + "\nf: 1\nf: 2\nf: 3\n",)], "value string")
    row = deltas(parse_distance(echoed)).first()
    assert (row.deltaMFE, row.mfeed, row.wt_mfeValue, row.cfeStructure) == (2.1, 1, -6.3, SHAPE)


ECHO = """
import sys
for record in sys.stdin.read().split(">")[1:]:
    key, seq = record.split()
    print(">" + key)
    print(seq.count("A"))
"""


def test_pipe_batches(spark):
    rows = [(f"NM_{i}", i, "A", "C", "x", "AC" * (i % 5), True) for i in range(1, 250) if i % 5]
    df = spark.createDataFrame(rows, "nm_id string, transcript_position int, ref string, alt string, wildSequence string, sequence string, isWildType boolean")
    records = to_tool_records(df, **FOLD_INPUT)
    out = parse_pdist(pipe_batches(records, [sys.executable, "-c", ECHO], records_per_run=7, partitions=3))
    assert {r.nm_id: r.efeed for r in out.collect()} == {f"NM_{i}": float(i % 5) for i in range(1, 250) if i % 5}
    failing = pipe_batches(records, [sys.executable, "-c", "import sys; sys.exit(3)"])
    with pytest.raises(Exception, match="status 3"):
        failing.collect()


INFO = (
    "ANN=C|missense_variant|MODERATE|GENEA|GENEA|transcript|NM_64.1|protein_coding|3/4|c.31C>T|p.Ala11Val|43/303|31/270|11/90||,"
    "C|missense_variant|MODERATE|GENEA|GENEA|transcript|NM_88.2|protein_coding|3/4|c.31C>T|p.Ala11Val|40/300|31/270|11/90||"
)


def test_annotations(spark):
    rows = [
        ("NM_88.2", INFO),
        ("NM_64.1", INFO),
        ("NM_9", INFO),
        ("NM_9", "."),
        ("a", "x|e|i|g|h|motif|a|b,x|e2|i2|g2|h2|transcript|a|bio|r|hc,x|e3|i3|g3|h3|transcript|a|bio|r|hc|hp"),
        ("a", None),
        ("a", "short|entry"),
    ]
    df = spark.createDataFrame(rows, "nm_id string, info string")
    got = parse_annotations(df).collect()
    first = got[0]
    assert tuple(first)[2:9] == ("missense_variant", "MODERATE", "GENEA", "GENEA", "protein_coding", "c.31C>T", "p.Ala11Val")
    assert first.snpeffRaw == (
        "C;missense_variant;MODERATE;GENEA;GENEA;transcript;NM_88.2;protein_coding;3/4;c.31C>T;p.Ala11Val;40/300;31/270;11/90"
    )
    assert got[1].snpeffRaw.startswith("ANN=C;missense_variant")
    for r in (got[2], got[3], got[5], got[6]):
        assert tuple(r)[2:9] == (None,) * 7 and r.snpeffRaw == ""
    assert (got[4].snpeffAnnotation, got[4].snpeffHGVSc, got[4].snpeffHGVSp) == ("e2", "hc", None)
    assert got[4].snpeffRaw == "x;e;i;g;h;motif;a;b,x;e2;i2;g2;h2;transcript;a;bio;r;hc,x;e3;i3;g3;h3;transcript;a;bio;r;hc;hp"
    line = spark.createDataFrame([("NM_88.2", "22\t40312\t.\tT\tC\t.\t.\t" + INFO)], "nm_id string, info string")
    assert parse_annotations(line, vcf_line=True).first().snpeffGeneName == "GENEA"

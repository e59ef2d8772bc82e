"""FASTA parsing, windows and variants."""

import random

import pytest
from pyspark.sql import functions as F

from basewise.functions import complement, contig_to_code, merge_key, reverse_complement, with_chr_prefix
from basewise.operators import alternates, split_wildtype, variants, windows
from basewise.sources import parse_fasta, read_fasta

LENGTHS = [0, 1, 50, 51, 52, 100, 101, 102, 103, 152, 300, 499, 500, 501, 502, 600, 1000, 1001, 1100, 1499, 2503]


def random_sequence(n, seed=0):
    rng = random.Random(n * 7 + seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def expected_windows(seq, width=101, short="all"):
    """Position -> (ref, window, index), from the rule in words."""
    n, half = len(seq), width // 2
    last = n if short == "all" or n > width else min(n, half + 1)
    rows = []
    for p in range(1, last + 1):
        start = max(0, min(p - 1 - half, n - width))
        rows.append((p, seq[p - 1], seq[start : start + width], p - 1 - start))
    return rows


@pytest.mark.parametrize("short", ["reference", "all"])
@pytest.mark.parametrize("partitions", [None, "auto"])
def test_windows_match_rule(spark, short, partitions):
    data = [(f"NM_{n}", random_sequence(n)) for n in LENGTHS]
    df = spark.createDataFrame(data, "nm_id string, sequence string")
    got = windows(df, short=short, partitions=partitions).collect()
    expected = sorted((i, *row) for i, seq in data for row in expected_windows(seq, short=short))
    assert sorted(tuple(r) for r in got) == expected


def test_windows_all_small_lengths(spark):
    data = [(str(n), random_sequence(n, 1)) for n in range(0, 331)]
    df = spark.createDataFrame(data, "nm_id string, sequence string")
    got = sorted(tuple(r) for r in windows(df).collect())
    assert got == sorted((i, *row) for i, seq in data for row in expected_windows(seq))


def test_windows_other_width(spark):
    data = [(str(n), random_sequence(n, 2)) for n in (4, 5, 6, 11, 700)]
    df = spark.createDataFrame(data, "nm_id string, sequence string")
    got = sorted(tuple(r) for r in windows(df, width=5).collect())
    assert got == sorted((i, *row) for i, seq in data for row in expected_windows(seq, 5))


def test_variants_rows(spark):
    data = [(f"NM_{n}", random_sequence(n)) for n in LENGTHS]
    df = spark.createDataFrame(data, "nm_id string, sequence string")
    out = variants(df)
    assert out.columns == [
        "nm_id", "transcript_position", "ref", "alt", "sequence", "wildSequence", "isWildType",
    ]
    rows = out.collect()
    positions = {(i, r[0]): r for i, seq in data for r in expected_windows(seq)}
    unusual = sum(r[1] not in "ACGT" for r in positions.values())
    assert len(rows) == 4 * len(positions) + unusual
    for r in rows:
        _, ref, window, index = positions[(r.nm_id, r.transcript_position)]
        assert r.ref == ref and r.wildSequence == window
        assert r.isWildType == (r.alt == ref)
        assert r.sequence == window[:index] + r.alt + window[index + 1 :]
    alts, wild = split_wildtype(out)
    assert wild.count() * 3 + unusual == alts.count()


@pytest.mark.parametrize(("unknown", "alts"), [("all", ["A", "C", "G", "T"]), ("reference", ["A", "C", "G"])])
def test_unusual_bases(spark, unknown, alts):
    df = spark.createDataFrame([("x", "Na")], "nm_id string, sequence string")
    made = alternates(windows(df), unknown=unknown)
    rows = made.where("not isWildType").groupBy("ref").agg(F.sort_array(F.collect_list("alt")).alias("alts"))
    assert {r["ref"]: r["alts"] for r in rows.collect()} == {"N": alts, "a": alts}
    assert [(r["alt"], r["sequence"]) for r in made.where("isWildType").orderBy("alt").collect()] == [("N", "Na"), ("a", "Na")]


def test_alternates_without_wildtype(spark):
    df = spark.createDataFrame([("x", "ACGT")], "nm_id string, sequence string")
    assert alternates(windows(df), wildtype=False).count() == 12


def test_parse_fasta_record(spark):
    record = ">ref|NM_1.1|x\r\nACGT\r\nAC\r\n"
    df = spark.createDataFrame([(record,), ("gi|NR_2.1|y\nTTT",)], "value string")
    assert [tuple(r) for r in parse_fasta(df, "NM").collect()] == [("NM_1.1", "ACGTAC")]
    assert parse_fasta(df).count() == 2


def test_read_fasta_plain_and_gz(spark, tmp_path):
    import gzip

    rng = random.Random(3)
    records, truth = [], set()
    for i in range(500):
        seq = random_sequence(rng.randrange(0, 400), i)
        lines = [seq[k : k + 60] for k in range(0, len(seq), 60)]
        kind = rng.choice(["NM", "NR"])
        records.append(f">ref|{kind}_{i}.1|text\n" + "\n".join(lines))
        if kind == "NM":
            truth.add((f"NM_{i}.1", seq))
    text = "\n".join(records) + "\n"
    (tmp_path / "a.fna").write_text(text)
    with gzip.open(tmp_path / "b.fna.gz", "wt") as f:
        f.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for name in ("a.fna", "b.fna.gz"):
            got = [tuple(r) for r in read_fasta(spark, str(tmp_path / name), "NM").collect()]
            assert set(got) == truth and len(got) == len(truth)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_base_functions(spark):
    df = spark.createDataFrame([("ACGTN",), ("X",), ("",), (None,), ("acG",)], "b string")
    rows = df.select(complement("b").alias("c"), reverse_complement("b").alias("r")).collect()
    assert [r.c for r in rows] == ["TGCAN", None, "", None, None]
    assert [r.r for r in rows] == ["NACGT", "X", "", None, "Cgt"]
    names = spark.createDataFrame([("chrX",), ("chrY",), ("chr7",), ("chr1_alt",)], "c string")
    assert [r[0] for r in names.select(contig_to_code("c")).collect()] == ["23", "24", "7", "1_alt"]
    plain = spark.createDataFrame([("X",), ("chr2",), (None,)], "c string")
    assert [r[0] for r in plain.select(with_chr_prefix("c")).collect()] == ["chrX", "chr2", None]
    key = spark.createDataFrame([("NM_1", 5), (None, 6)], "a string, b int").select(merge_key("a", "b"))
    assert [r[0] for r in key.collect()] == ["NM_1:5", "null:6"]

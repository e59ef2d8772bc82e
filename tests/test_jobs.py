"""The whole pipeline through files, and the command line."""

import os
import random
import stat

import pytest

from basewise.__main__ import main
from basewise.plans import JOBS

# Stand-ins for the three programs. Each reads records on standard input and echoes the keys.
FOLD_TOOL = """#!/usr/bin/env python3
import sys
for record in sys.stdin.read().split(">")[1:]:
    key, seq = record.split()
    n = len(seq)
    shape = "(" * (seq.count("A") % 5) + "." * (n - 2 * (seq.count("A") % 5)) + ")" * (seq.count("A") % 5)
    e = -seq.count("G") / 4
    print(">" + key); print(seq.replace("T", "U")); print(f"{shape} ({e:.2f})"); print(f"{shape} [{e - 0.5:.2f}]")
    print(f"{shape} {{{e:.2f} d=1.5}}"); print(f"{shape} {{{e:.2f} MEA=40.25}}")
    print(" frequency of mfe structure in ensemble 0.25; ensemble diversity 2.5  ")
"""
DISTANCE_TOOL = """#!/usr/bin/env python3
import sys
for record in sys.stdin.read().split(">")[1:]:
    key, *shapes = record.split("\\n")
    print(">" + key)
    for a, b in zip(shapes[0::2], shapes[1::2]):
        if a:
            print("f: %d  " % sum(x != y for x, y in zip(a, b)))
"""
PDIST_TOOL = """#!/usr/bin/env python3
import sys
for record in sys.stdin.read().split(">")[1:]:
    key, a, b = record.split()
    print(">" + key); print(sum(x != y for x, y in zip(a, b)) / 2)
"""


def tool(home, name, text):
    path = home / "bin" / name
    path.parent.mkdir(exist_ok=True)
    path.write_text(text)
    path.chmod(path.stat().st_mode | stat.S_IXUSR)


@pytest.fixture
def files(tmp_path):
    rng = random.Random(8)
    chrom = "".join(rng.choice("ACGT") for _ in range(4000))
    comp = str.maketrans("ACGT", "TGCA")
    forward, backward = chrom[100:230], chrom[500:640].translate(comp)[::-1]
    (tmp_path / "rna.fna").write_text(
        f">ref|NM_1.1|one\n{forward[:60]}\n{forward[60:]}\n>ref|XR_5.1|skipped\nACGT\n>ref|NM_2.1|two\r\n{backward}\r\n"
    )
    row = "{}\tRefSeq\tcDNA_match\t{}\t{}\t100\t{}\t.\tID=i;Target={} 1 {} +;gap_count=0;identity=1\n"
    (tmp_path / "a.gff3").write_text(
        "##gff-version 3\n" + row.format("NC_000002.12", 101, 230, "+", "NM_1.1", 130)
        + row.format("NC_000002.12", 501, 640, "-", "NM_2.1", 140)
    )
    # 150..159 (0-based) are lost, what follows moves up by 10.
    (tmp_path / "c.chain").write_text("chain 99 chr2 4000 + 0 4000 chr2 3990 + 0 3990 1\n150\t10\t0\n3840\n\n")
    lifted = chrom[:150] + chrom[160:]
    (tmp_path / "g.fa").write_text(">chr2\n" + "\n".join(lifted[i : i + 50] for i in range(0, 3990, 50)) + "\n")
    (tmp_path / "cov.txt").write_text("#chrom pos\n" + "".join(f"2\t{p}\t" + "1\t" * 6 + f"{0.9 if p % 2 else 0.1}\t0\n" for p in range(1, 400)))
    home = tmp_path / "tools"
    home.mkdir()
    for name, text in (("RNAfold", FOLD_TOOL), ("RNAdistance", DISTANCE_TOOL), ("RNApdist", PDIST_TOOL)):
        tool(home, name, text)
    return tmp_path


def test_pipeline(spark, files):
    def at(name):
        return str(files / name)

    JOBS["variants"](spark, at("rna.fna"), at("variants"), "NM", 4)
    variants = spark.read.parquet(at("variants"))
    assert variants.count() == 4 * (130 + 140)
    JOBS["wildtypes"](spark, at("variants"), at("wild"))
    variants.where("not isWildType").write.parquet(at("alts"))
    JOBS["fold"](spark, at("alts"), at("alt_folds"), at("tools"), 3)
    JOBS["fold"](spark, at("wild"), at("wild_folds"), at("tools"), 3)
    JOBS["scrub"](spark, at("alt_folds"), at("scrubbed"))
    JOBS["combine"](spark, at("scrubbed"), at("wild_folds"), at("wide"))
    assert spark.read.parquet(at("wide")).count() == 3 * 270
    JOBS["distance"](spark, at("wide"), at("distances"), at("tools"), 3)
    JOBS["distance"](spark, at("wide"), at("pair_distances"))
    JOBS["pdist"](spark, at("alts"), at("pdists"), at("tools"), 3)
    JOBS["join"](spark, at("distances"), at("pdists"), at("scored"))
    scored = spark.read.parquet(at("scored"))
    assert scored.count() == 810 and {r.efeed for r in scored.select("efeed").distinct().collect()} == {0.5}
    # The fold program writes U for T, and the key carries the wildtype sequence unchanged.
    assert scored.where("contains(sequence, 'T') or contains(wildSequence, 'U')").count() == 0
    other = spark.read.parquet(at("pair_distances"))
    assert set(other.columns) == set(spark.read.parquet(at("distances")).columns)
    JOBS["map-genome"](spark, at("scored"), at("mapped"), at("a.gff3"), "NM")
    JOBS["genome-chunks"](spark, at("g.fa"), at("chunks.parquet"))
    JOBS["liftover"](spark, at("mapped"), at("lifted"), at("c.chain"), at("chunks.parquet"))
    JOBS["liftover"](spark, at("mapped"), at("lifted_from_text"), at("c.chain"), at("g.fa"))
    JOBS["liftover"](spark, at("mapped"), at("lifted_single"), at("c.chain"), at("g.fa"), "single")
    lifted = spark.read.parquet(at("lifted"))
    counts = {r.liftoverResult: r["count"] for r in lifted.groupBy("liftoverResult").count().collect()}
    assert counts == {"PASS": 780, "NO_TARGET": 30}
    for other in ("lifted_from_text", "lifted_single"):
        assert lifted.exceptAll(spark.read.parquet(at(other))).count() == 0
    JOBS["coverage"](spark, at("lifted"), at("covered"), at("cov.txt"), "0.5")
    key = "select distinct chromosome_id_hg19 CHROMOSOME, position_hg19 POSITION, ref_hg19 REF, alt_hg19 ALT"
    lifted.createOrReplaceTempView("lifted")
    for name, extra in {
        "ex": "0.5D gnomad_ex",
        "wg": "0.25D gnomad_wg",
        "exc": "1 gnomadex_alt_count, 2 gnomadex_total_count, 3 gnomadex_homozygous_count",
        "wgc": "-4 gnomadwg_alt_count, 5 gnomadwg_total_count, 6 gnomadwg_homozygous_count",
        "fun": "'tolerated' SIFT",
    }.items():
        spark.sql(f"{key}, {extra} from lifted where position_hg19 % 2 = 0").write.parquet(at(name))
    JOBS["frequencies"](spark, at("covered"), at("freq"), at("ex"), at("wg"), at("exc"), at("wgc"))
    JOBS["functional"](spark, at("freq"), at("fun"), at("functional"))
    functional = spark.read.parquet(at("functional"))
    assert functional.count() == 810 and "dbNSFP_SIFT" in functional.columns
    entry = "concat('ANN=x|missense|LOW|G|ID|transcript|', nm_id, '|coding|1|c.1A>G|p.1')"
    functional.selectExpr("*", f"{entry} as info").write.parquet(at("with_info"))
    JOBS["annotate"](spark, at("with_info"), at("annotated"))
    JOBS["rollup"](spark, at("annotated"), at("rolled"))
    rolled = spark.read.parquet(at("rolled"))
    assert rolled.count() == 780 and len(rolled.columns) == 28
    even = rolled.where("POS % 2 = 0").first()
    assert (even.WG_alt_count, even.EX_total_count, even.Annotation) == (-4, 2, "missense")
    JOBS["export-vcf"](spark, at("annotated"), at("vcf"))
    JOBS["export-vcf"](spark, at("annotated"), at("vcf_one"), "yes")
    header = [r.value for r in spark.read.text(at("vcf/header")).collect()]
    lines = [r.value for r in spark.read.text(at("vcf/lines")).collect()]
    assert header == ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tNORMAL"]
    assert len(lines) == 780 and all(len(x.split("\t")) == 10 for x in lines)
    parts = [f for f in os.listdir(at("vcf_one")) if f.startswith("part")]
    whole = (files / "vcf_one" / parts[0]).read_text().splitlines()
    assert len(parts) == 1 and whole[:2] == header and sorted(whole[2:]) == sorted(lines)
    JOBS["export-csv"](spark, at("rolled"), at("csv"))
    JOBS["export-csv"](spark, at("rolled"), at("csv_one"), "yes")
    assert spark.read.csv(at("csv"), header=True).count() == 780
    assert len([f for f in os.listdir(at("csv_one")) if f.startswith("part")]) == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        JOBS["rollup"](spark, at("annotated"), at("rolled"))


def test_constraint_job(spark, tmp_path):
    header = "gene\tgene_id\ttranscript\textra\tobs_mis\texp_mis\toe_mis\tobs_syn\texp_syn\toe_syn\tp\tpLI\tpRec\tpNull\toe_lof_upper\toe_lof_upper_rank\toe_lof_upper_bin\n"
    body = "\t1\t2.5\t0.4\t1\t2.5\t0.4\t0.1\t{}\t0.2\t0.3\t0.9\t{}\t{}\n"
    (tmp_path / "c.tsv").write_text(
        header + "G1\tE1\tT1\tx" + body.format("0.99", "10", "1") + "G2\tE2\tT2\tx" + body.format("0.5", "20", "NA")
        + "G3\tE3\tT3\tx" + body.format("NA", "NaN", "2")
    )
    names = "GeneID\tGeneIDVer\tTranscriptID\tTranscriptIDVer\tEnsemblGeneSymbol\tGeneType\tGENE\tRefSeq\tNCBIGeneID\n"
    row = "g\tg.1\t{}\tt.1\tS\tcoding\tS\t{}\t{}\n"
    (tmp_path / "m.tsv").write_text(
        names + row.format("T1", "NM_1", 1) + row.format("T1", "NM_1", 2) + row.format("T2", "NM_1", 3)
        + row.format("T2", "NM_2", 4) + row.format("T3", "", 5) + row.format("T3", "NM_3", "")
    )
    for choice, expected in (("extreme", [("NM_1", "T1"), ("NM_2", "T2")]), ("argmax", [("NM_1", "T1"), ("NM_2", "T2"), ("NM_3", "T3")])):
        JOBS["constraint"](spark, str(tmp_path / "c.tsv"), str(tmp_path / "m.tsv"), str(tmp_path / "out"), choice)
        out = spark.read.parquet(str(tmp_path / "out"))
        assert sorted((r.RefSeq, r.TranscriptID) for r in out.collect()) == expected
        kinds = dict(out.dtypes)
        assert kinds["pLI"] == "double" and kinds["oe_lof_upper_rank"] == "int" and "extra" not in kinds


def test_command_line(spark, files):
    main(["variants", str(files / "rna.fna"), str(files / "out"), "NM", "2"])
    assert spark.read.parquet(str(files / "out")).count() == 4 * 270
    with pytest.raises(SystemExit):
        main(["no-such-job"])


def test_inferred_tsv(spark, tmp_path):
    from basewise.sources import read_parquet, read_tsv

    (tmp_path / "t.tsv").write_text("name\tn\tx\na\t1\t0.5\nb\tNA\tNA\n")
    table = read_tsv(spark, str(tmp_path / "t.tsv"), null_value="NA")
    assert dict(table.dtypes) == {"name": "string", "n": "int", "x": "double"} and table.where("n is null").count() == 1
    table.write.parquet(str(tmp_path / "t.parquet"))
    assert read_parquet(spark, str(tmp_path / "t.parquet"), ["n"]).columns == ["n"]


def test_coverage_lines(spark, tmp_path):
    from basewise.sources import read_coverage

    (tmp_path / "c.txt").write_text("#chrom\tpos\nX\t7 1 2 3 4 5 6 0.75 9\nY\t8 1 2 3 4 5 6 NaN 9\n3\t9 1 2 3 4 5 6 x 9\n")
    rows = sorted((r[0], r[1], str(r[2])) for r in read_coverage(spark, str(tmp_path / "c.txt")).collect())
    assert rows == [("23", 7, "0.75"), ("24", 8, "nan"), ("3", 9, "None")]

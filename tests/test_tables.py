"""Enrichment, skewed joins, rollup, extremes, counts, samples."""

import random

import pytest
from pyspark.sql import functions as F

from basewise.functions import joined_set, signed_extreme
from basewise.operators import (
    Progress,
    argmax_rows,
    check_unique,
    coverage_flag,
    enrich,
    enrich_frequencies,
    enrich_prefixed,
    enrich_stored,
    extreme_join,
    hot_keys,
    join_scores,
    key_histogram,
    rollup,
    salted_join,
    sample_rows,
    store_by_key,
    with_row_metrics,
)
from basewise.operators.rollup import ROLLUP_SPEC
from basewise.operators.sizing import broadcast_if_small
from basewise.sources import check_cells, read_checked, rejected_cells


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_signed_extreme(spark):
    data = [("a", -5.0, 3), ("a", 5.0, -3), ("a", None, None), ("b", None, None), ("c", -7.0, -(2**31)), ("c", 2.0, 2**31 - 1),
            ("d", float("nan"), 1), ("d", -1.0, 1), ("e", float("nan"), 0)]
    df = spark.createDataFrame(data, "k string, x double, i int")
    got = {r.k: (r.x, r.i) for r in df.groupBy("k").agg(signed_extreme("x").alias("x"), signed_extreme("i").alias("i")).collect()}
    assert got == {"a": (5.0, 3), "b": (None, None), "c": (-7.0, -(2**31)), "d": (-1.0, 1), "e": (None, 0)}


def test_joined_set(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "z"), ("b", None)], "k string, v string")
    assert {r.k: r.v for r in df.groupBy("k").agg(joined_set("v").alias("v")).collect()} == {"a": "b;z", "b": ""}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(4)
    left = [(rng.choice([1, 1, 1, 1, 2, 3, 4, None]), rng.choice("xy"), 0) for _ in range(2000)] + [(9, "x", 1)] * 1500
    right = [(1, "x", "p"), (1, "x", "q"), (9, "x", "r"), (2, "y", "s"), (7, "x", "t"), (None, "x", "u")]
    a = spark.createDataFrame(left, "k int, m string, v int").repartition(6)
    b = spark.createDataFrame(right, "k int, m string, w string")
    hot = hot_keys(a, ["k", "m"], share=0.1)
    assert {tuple(r) for r in hot.collect()} == {(1, "x"), (1, "y"), (9, "x")}
    assert rows_of(salted_join(a, b, ["k", "m"], hot, how, buckets=4)) == rows_of(a.join(b, ["k", "m"], how))
    both = enrich(a, [b, b.withColumnRenamed("w", "w2")], ["k", "m"], hot, buckets=4)
    assert rows_of(both) == rows_of(enrich(a, [b, b.withColumnRenamed("w", "w2")], ["k", "m"]))


def test_salt_spreads_copies(spark):
    a = spark.createDataFrame([(9, "x")] * 4000, "k int, m string").repartition(16)
    from basewise.operators.skew import SALT, add_salt

    salted = add_salt(a, ["k"], hot_keys(a, ["k"]), 8).groupBy(SALT).count().collect()
    assert len(salted) > 3 and sum(r["count"] for r in salted) == 4000


def test_chained_joins_shuffle_left_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).select(F.col("id").alias("k"), F.lit("left").alias("side"))
        tables = [spark.range(50).select(F.col("id").alias("k"), F.lit(i).alias(f"c{i}")) for i in range(4)]
        plan = enrich(left, tables, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_is_decided_by_size(spark):
    small = spark.range(1000).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("t"))

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(small, limit=10_000_000)) and not hinted(broadcast_if_small(small, limit=20_000))
    assert not hinted(broadcast_if_small(small))
    assert not hinted(broadcast_if_small(small, limit=0))
    assert hinted(broadcast_if_small(small, limit=200_000, bound=lambda: (10, 1_000_000)))
    assert not hinted(broadcast_if_small(small, limit=200_000, bound=lambda: (10, 10_000_000)))
    assert hinted(broadcast_if_small(small, limit=200_000, bound=lambda: (10, 100_000)))


KEY = "chromosome_id_hg19 string, position_hg19 int, ref_hg19 string, alt_hg19 string"
PLAIN = "CHROMOSOME string, POSITION int, REF string, ALT string"


def test_frequencies_prefix_and_coverage(spark):
    left = spark.createDataFrame([("1", 5, "A", "C"), ("23", 6, "G", "T"), (None, 7, "G", "T")], KEY)
    ex = spark.createDataFrame([("1", 5, "A", "C", 0.5, "x"), ("1", 5, "A", "C", 0.6, "y")], PLAIN + ", gnomad_ex double, other string")
    wg = spark.createDataFrame([("23", 6, "G", "T", 0.1)], PLAIN + ", gnomad_wg double")
    exc = spark.createDataFrame([("1", 5, "A", "C", 1, 2, 3)], PLAIN + ", gnomadex_alt_count int, gnomadex_total_count int, gnomadex_homozygous_count int")
    wgc = spark.createDataFrame([("1", 5, "A", "C", 4, 5, 6)], PLAIN + ", gnomadwg_alt_count int, gnomadwg_total_count int, gnomadwg_homozygous_count int")
    out = enrich_frequencies(left, ex, wg, exc, wgc)
    assert out.count() == 4  # a duplicate key in a table multiplies rows
    assert set(out.columns) >= {"gnomad_ex", "gnomad_wg", "gnomAD_EX_alt_count", "gnomAD_WG_homozygous_count"}
    r = out.where("gnomad_ex = 0.6").first()
    assert (r.gnomAD_EX_total_count, r.gnomAD_WG_total_count, r.gnomad_wg) == (2, 5, None)
    functional = spark.createDataFrame([("1", 5, "A", "C", "s", 1.0)], PLAIN + ", SIFT string, `a.b` double")
    out = enrich_prefixed(left, functional)
    assert out.columns[4:] == ["dbNSFP_SIFT", "dbNSFP_a.b"] and out.where("dbNSFP_SIFT = 's'").count() == 1
    coverage = spark.createDataFrame([("1", 5, 0.8), ("23", 6, float("nan"))], "chromosome_id_hg19 string, position_hg19 int, gnomAD_EX_coveragePercent double")
    flags = {r.position_hg19: r.gnomAD_EX_coverageFlag for r in coverage_flag(left, coverage, 0.8).collect()}
    assert flags == {5: 1, 6: 0, 7: None}


def test_join_scores(spark):
    keys = "nm_id string, transcript_position int, ref string, alt string"
    a = spark.createDataFrame([("n", 1, "A", "C", 7), ("n", 2, "A", "C", 8)], keys + ", mfeed int")
    b = spark.createDataFrame([("n", 1, "A", "C", 0.5, "s")], keys + ", efeed double, sequence string")
    assert [tuple(r) for r in join_scores(a, b).collect()] == [("n", 1, "A", "C", 7, 0.5)]


def test_rollup(spark):
    base = {
        "chromosome_id_hg19": "1", "position_hg19": 5, "ref_hg19": "A", "alt_hg19": "C", "liftoverResult": "PASS",
        "gnomAD_EX_coverageFlag": 1, "nm_id": "NM_1", "transcript_position": 9, "efeed": 0.5, "mfeed": 1, "meaed": 2, "cfeed": 3,
        **{f"delta{x}": 1.0 for x in ("MFE", "EFE", "MEAFE", "CFE", "END", "CD")},
        **{f"gnomAD_{k}_{w}_count": 4 for k in ("EX", "WG") for w in ("alt", "total", "homozygous")},
        "snpeffAnnotation": "b", "snpeffPunativeImpact": "LOW", "snpeffGeneName": "G", "snpeffGeneID": "I",
        "snpeffTranscriptBiotype": "t",
    }
    rows = [
        base,
        base | {"nm_id": "NM_2", "deltaMFE": -3.0, "mfeed": -4, "snpeffAnnotation": "a", "gnomAD_EX_coverageFlag": 0},
        base | {"nm_id": "NM_3", "deltaMFE": 3.0, "snpeffGeneName": None, "gnomAD_EX_alt_count": None},
        base | {"liftoverResult": "NO_TARGET", "deltaMFE": 99.0},
        base | {"position_hg19": 6},
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], list(base))
    out = rollup(df)
    assert out.columns == ["CHR", "POS", "REF", "ALT", *ROLLUP_SPEC]
    got = {r.POS: r for r in out.collect()}
    r = got[5]
    assert (r.LiftoverResult, r.Coverage, r.Transcript) == ("PASS", 0, "NM_1:9;NM_2:9;NM_3:9")
    assert (r.dMFE, r.MFEED, r.EX_alt_count, r.Annotation, r.Name) == (3.0, -4, 4, "a;b", "G")
    assert len(got) == 2 and got[6].Transcript == "NM_1:9"


def test_extremes_and_counts(spark):
    data = [("a", 0.9, 5, "r1"), ("a", 0.9, 5, "r2"), ("b", 0.9, 7, "r3"), ("b", 0.5, 1, "r4"), ("c", None, 3, "r5"), ("c", 0.1, None, "r6")]
    df = spark.createDataFrame(data, "k string, pli double, rank int, id string")
    assert sorted(r.id for r in extreme_join(df, ["k"], "pli", "rank").collect()) == ["r1", "r2"]
    order = [F.col("pli").desc_nulls_last(), F.col("rank").asc_nulls_last()]
    assert sorted(r.id for r in argmax_rows(df, ["k"], order).collect()) == ["r1", "r3", "r6"]
    assert "WindowGroupLimit" in argmax_rows(df, ["k"], order)._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in key_histogram(df, ["k"]).collect()] == [("a", 2), ("b", 2), ("c", 2)]
    assert tuple(check_unique(df, ["k"]).first()) == (6, 3, False)
    assert tuple(check_unique(df, ["id"]).first()) == (6, 6, True)
    assert tuple(check_unique(df.where("false"), ["id"]).first()) == (0, 0, True)
    picked = [r.id for r in sample_rows(df, 3, 1, ["id"]).collect()]
    assert len(set(picked)) == 3 and picked == [r.id for r in sample_rows(df.repartition(5), 3, 1, ["id"]).collect()]
    observed, metrics = with_row_metrics(df)
    observed.collect()
    assert metrics.get["rows"] == 6


def test_hot_bin_is_split_by_adaptive_execution(spark):
    """A shuffled lookup where one bin holds half of the points: Spark splits the skewed partition."""
    from basewise.operators import disjoint_pieces, lookup

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        position = F.when(F.col("id") % 2 == 0, F.lit(77)).otherwise(F.col("id") % 50_000)
        points = spark.range(0, 200_000, 1, 12).select("id", F.lit("a").alias("k"), position.alias("p"))
        ranges = spark.range(500).select(F.lit("a").alias("key"), (F.col("id") * 100).alias("s"), (F.col("id") * 100 + 79).alias("e"), "id")
        pieces = disjoint_pieces(ranges, ["key"], "s", "e", [F.col("id")], ["id"], 64).withColumnRenamed("id", "hit")
        found = lookup(points, pieces, {"k": "key"}, "p", 64, broadcast_limit=0)
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in plan
    at_77 = sum(i % 2 == 0 or i % 50_000 == 77 for i in range(200_000))
    assert len(rows) == 200_000 and sum(r.hit == 0 for r in rows if r.p == 77) == at_77
    assert all(r.hit == (r.p // 100 if r.p % 100 < 80 else None) for r in rows)


def test_stored_tables_are_not_shuffled(spark):
    """A third of the rows goes around the joins, and no exchange stands on a table's side."""
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"), F.when(F.col("id") % 7 != 0, "x").alias("m"), "id")
    tables = [spark.range(300).select(F.col("id").alias("k"), F.lit("x").alias("m"), (F.col("id") * i).alias(f"c{i}")) for i in (1, 2, 3)]
    tables[1] = tables[1].unionByName(tables[1].where("k < 10"))
    stored = [store_by_key(t, ["k", "m"], 8) for t in tables]
    got = enrich_stored(left, stored, ["k", "m"], 8, usable=F.col("k") >= 0)
    want = left
    for t in tables:
        want = want.join(t, ["k", "m"], "left")
    assert got.columns == ["k", "m", "id", "c1", "c2", "c3"]
    assert rows_of(got) == rows_of(want.select(*got.columns))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 3
    assert rows_of(enrich_stored(left.limit(0), stored, ["k", "m"], 8)) == []


def test_progress_is_delivered(spark):
    progress = Progress()
    rows = progress.at(spark.range(1000, numPartitions=4), "made", top=F.max("id"))
    kept = progress.at(rows.where("id % 3 = 0"), "kept")
    stored, numbers = progress.deliver(kept.groupBy((F.col("id") % 10).alias("g")).count())
    assert stored.count() == 10
    got = {(r.place, r.metric): r.value for r in numbers.collect()}
    assert got == {("made", "rows"): 1000, ("made", "top"): 999, ("kept", "rows"): 334, ("result", "rows"): 10}
    again = Progress()
    _, numbers = again.deliver(again.at(spark.range(0), "none", top=F.max("id")), recount=True)
    assert {(r.place, r.metric, r.value, r.exact) for r in numbers.collect()} == {("none", "rows", 0, True), ("none", "top", None, True), ("result", "rows", 0, True)}
    with pytest.raises(ValueError, match="two places"):
        again.at(spark.range(1), "none")


def test_sets_of_many_values(spark):
    """Six independent columns of 1,000 values in one group: no combinations are kept."""
    columns = {f"s{i}": F.concat(F.lit(f"{i}-"), (F.xxhash64("id", F.lit(i)) % 1000).cast("string")) for i in range(6)}
    df = spark.range(60_000).select(F.lit("g").alias("g"), *[c.alias(n) for n, c in columns.items()])
    rolled = rollup(df, ["g"], {n: ("set", n) for n in columns}, passed=None).first()
    for i in range(6):
        values = rolled[f"s{i}"].split(";")
        assert values == sorted(set(values)) and set(values) == {r[0] for r in df.select(f"s{i}").distinct().collect()}


BAD = (
    "gene\tn\tx\tname\n"
    "a\t1\t0.5\tp\n"
    "b\tx\t1e3\tq\r\n"
    "\n"
    "c\t1.0\tNaN\tNA\n"
    "d\t99999999999\t-.5\t\n"
    "e\tNA\t0x1\n"
    "f\t 7 \t1d\tr\ts\tt\n"
)


@pytest.mark.parametrize("split", ["9", "134217728"])
def test_rejected_cells(spark, tmp_path, split):
    for name in ("one", "two"):
        (tmp_path / f"{name}.tsv").write_text(BAD)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        checked = read_checked(spark, str(tmp_path), {"n": "int", "x": "double", "name": "string", "gene": "string"})
        rows = checked.collect()
        bad = rejected_cells(checked).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert checked.columns == ["file", "line", "n", "x", "name", "gene", "rejects"]
    assert dict(checked.dtypes)["n"] == "int" and len(rows) == 12
    got = sorted((r.line, r.gene, r.n, str(r.x), r["name"]) for r in rows if r.file.endswith("one.tsv"))
    assert got == [
        (2, "a", 1, "0.5", "p"), (3, "b", None, "1000.0", "q"), (5, "c", None, "nan", None),
        (6, "d", None, "-0.5", None), (7, "e", None, "None", None), (8, "f", 7, "None", "r"),
    ]
    assert sorted((r.line, str(r.column), r.value, r.reason) for r in bad if r.file.endswith("two.tsv")) == [
        (3, "n", "x", "not a number"), (5, "n", "1.0", "not an integer"), (6, "n", "99999999999", "out of range"),
        (7, "name", None, "missing"), (7, "x", "0x1", "not a number"), (8, "None", "s\tt", "extra fields"), (8, "x", "1d", "not a number"),
    ]
    with pytest.raises(ValueError, match="no such types"):
        check_cells(spark.createDataFrame([("1",)], "value string"), ["a"], {"a": "date"})
    with pytest.raises(ValueError, match="no such fields"):
        check_cells(spark.createDataFrame([("1",)], "value string"), ["a"], {"b": "int"})

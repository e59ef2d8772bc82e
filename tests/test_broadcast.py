"""Tables whose rows were exploded are never broadcast on Spark's own estimate."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from basewise.operators.pipe import pipe_batches
from basewise.operators.skew import splittable
from basewise.plans.constraint import constraint_by_transcript

TESTDATA = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_side_is_shuffled(spark):
    right = spark.range(10).select("id", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("n")).withColumnRenamed("id", "k")
    left, right, match = splittable(spark.range(100), right, [("id", "k")])
    for how in ("left", "inner"):
        joined = left.join(right, match, how)
        assert "BroadcastHashJoin" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert left.join(right, match).count() == 10_000


@pytest.mark.parametrize(
    "name",
    ["end_to_end", "lift_positions", "lift_positions_shuffled", "vcf_lines", "overlaps", "map_positions", "map_positions_gapped", "map_positions_cigar"],
)
def test_queries_broadcast_contig_names_at_most(spark, name):
    plan = _plan(contract.queries()[name](spark, TESTDATA))
    assert plan.count("BroadcastHashJoin") <= ("lift" in name or name in ("end_to_end", "vcf_lines"))


def test_genome_of_alleles_is_shuffled(spark):
    assert "BroadcastHashJoin" not in _plan(contract.queries()["lift_indels"](spark, TESTDATA))


def test_costly_rows_are_dealt_out(spark):
    few = spark.range(40).coalesce(1)
    at_least = spark.sparkContext.defaultParallelism
    piped = pipe_batches(few.select(F.concat(F.lit(">"), F.col("id").cast("string")).alias("value")), ["cat"])
    assert piped.rdd.getNumPartitions() >= at_least
    assert {r.value.strip() for r in piped.collect()} == {str(i) for i in range(40)}
    assert contract.queries()["tree_distance"](spark, TESTDATA).rdd.getNumPartitions() >= at_least


def test_constraint_join_is_dealt_out_by_transcript(spark):
    genes = spark.createDataFrame(
        [("g1", "i1", "T1", 0.5, 3), ("g1", "i1", "T1", 0.5, 3), ("g2", "i2", "T2", 0.9, 7), ("g3", "i3", "T3", None, 1), ("g4", "i4", None, 1.0, 1)],
        "gene string, gene_id string, transcript string, pLI double, oe_lof_upper_rank int",
    )
    ids = [("T1", "N1"), ("T1", "N1"), ("T2", "N1"), ("T3", "N2"), ("T1", None), (None, "N3"), ("T9", "N4")]
    chosen = constraint_by_transcript(genes, spark.createDataFrame(ids, "TranscriptID string, RefSeq string"), "argmax")
    assert chosen.columns == ["TranscriptID", "gnomadGeneSymbol", "gnomadGeneID", "pLI", "oe_lof_upper_rank", "RefSeq"]
    assert sorted((r.RefSeq, r.TranscriptID, r.pLI) for r in chosen.collect()) == [("N1", "T2", 0.9), ("N2", "T3", None)]
    for name in ("constraint_argmax", "constraint_unique"):
        plan = _plan(contract.queries()[name](spark, TESTDATA))
        assert "BroadcastHashJoin" not in plan and plan.count("REPARTITION_BY_NUM") == 2

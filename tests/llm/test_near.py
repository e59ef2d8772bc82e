"""Near duplicates: what is shuffled, and odd ids."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from basewise.llm import common, jaccard


def nodes(plan):
    """All nodes of an executed plan, those of finished stages included."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        inner = [plan.executedPlan()]
    elif kind.endswith("QueryStageExec"):
        inner = [plan.plan()]
    else:
        inner = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan, *(n for i in inner for n in nodes(i))]


def texts_shuffled(df):
    """Rows with a text that the exchanges of a collected frame wrote."""
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in found if "text#" in n.output().toString())


def words(seed, count=60):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(10**6)}" for _ in range(count))


def test_only_documents_of_clusters_are_shuffled(spark):
    rows = [(i, words(i)) for i in range(300)] + [(1000, words(7)), (1001, words(8) + " end"), (5, words(5)), (6, words(900)), (None, words(9)), (None, None), (2000, ""), (2001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    six = min(words(6), words(900), key=lambda t: spark.sql("select xxhash64(:t)", {"t": t}).first()[0])
    want = [(i, words(i)) for i in range(300) if i != 6] + [(6, six), (None, words(9)), (None, None), (2000, ""), (2001, None)]
    assert got == sorted(want, key=str)
    assert texts_shuffled(kept) <= 20


def test_only_members_texts_are_verified(spark):
    docs = spark.createDataFrame([(i, words(i)) for i in range(200)] + [(500, words(3) + " end")], "key long, text string")
    signed = jaccard.signatures(docs, 5, 80, jaccard.frequencies(docs, 5))
    members = signed.where("key in (3, 500)").select("key", "n", "set1", "set2", F.lit(3).cast("long").alias("cluster"))
    links = jaccard.verified_links(docs, common.settle(members), 5, 80, jaccard.BLOCK_SHINGLES)
    assert [tuple(r) for r in links.collect()] == [(500, 3)]
    assert texts_shuffled(links) <= 10


def test_marks_miss_nothing(spark):
    marks = spark.range(0, 3000, 3)
    values = spark.range(3000).union(spark.createDataFrame([(None,), (-1,), (2**63 - 1,)], "id long"))
    got = {r["id"]: r["m"] for r in common.with_mark(values, F.col("id"), marks, "m").collect()}
    assert all(got[i] for i in range(0, 3000, 3)) and got[None] is False
    assert sum(got[i] for i in got if i is not None and i % 3) < 10
    assert not any(r["m"] for r in common.with_mark(values, F.col("id"), marks.limit(0), "m").collect())

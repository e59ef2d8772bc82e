"""The corpus pipeline: documents in, filtered, deduplicated and encoded documents out.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame; all but the last
keep the columns of ``docs``, whatever these are. Documents of null or empty text
are rejected by the quality rules. Rows that share one id, the null id apart, are
one document: the deduplication keeps one row of them, that of the smallest text
hash. Rows with a null id have no group and stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basewise.llm import jaccard, leaks, ngram, pieces, toxicity
from basewise.llm.common import settle, table, with_mark
from basewise.llm.queries import PIECE_MODEL, ship_workers
from basewise.llm.warc import scratch_path
from basewise.operators.skew import splittable

ship_workers()

# Near duplicates: five words, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, learned from the labelled ones, does not reject."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("_score") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and lie in their language's perplexity band."""
    judged = ngram.judge(docs)
    return judged.where("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that of the smallest id."""
    linked = jaccard.link_documents(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)
    # Most ids are one row that stays: only rows whose id may be another case are joined with those.
    rows, least = F.count(F.lit(1)), F.count_if(F.col("doc_id") == F.col("component"))
    found = linked.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(rows.alias("_all"), least.alias("_rows"))
    cases = settle(found.where("_all > 1 or _rows = 0").select("_id", "_rows"))
    marked = with_mark(docs, F.col("doc_id"), cases.select("_id"), "_case")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    left, right, condition = splittable(marked.where("_case").drop("_case"), cases, [("doc_id", "_id")])
    joined = left.join(right, condition, "left").withColumn("_rows", F.coalesce("_rows", F.lit(1)))
    single = joined.where("_rows = 1").select(*columns)
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    several = joined.where("_rows > 1").withColumn("_at", F.row_number().over(order)).where("_at = 1").select(*columns)
    return marked.where("not _case").select(*columns).unionByName(single).unionByName(several)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    marked = leaks.mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("_leaks") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and whether decoding gives its text back."""
    out = pieces.encode_texts(docs, public_tokenizers.path(PIECE_MODEL), outputs=("ids", "ids_sha256", "decoded_sha256"))
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pieces", encode),
]

# The learned stages have no SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents; what a stage keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(spark, docs)
    return docs


def stored(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Written as Parquet in the shared folder and read again."""
    path = scratch_path(spark, "stage")
    docs.write.parquet(path)
    return spark.read.parquet(path)

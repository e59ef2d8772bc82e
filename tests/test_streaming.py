"""Row-wise operators on a streaming DataFrame."""

from basewise.operators import variants
from basewise.sources import parse_fasta


def test_variants_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fna").write_text(">ref|NM_1.1|x\nACGT\n>ref|NM_2.1|y\nGG\n")
    records = spark.readStream.option("lineSep", "\n>").text(str(tmp_path / "in"))
    query = (
        variants(parse_fasta(records, "NM"), partitions=None)
        .writeStream.format("memory")
        .queryName("stream_variants")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.table("stream_variants")
    assert rows.count() == 24 and rows.where("isWildType").count() == 6

"""Alignment mapping and liftover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.operators import aligned_length, alternates, lift_positions, map_positions, overlap_join, rollup, windows
from basewise.operators.skew import deal_by, deal_out
from basewise.sinks import to_vcf_lines
from basewise.sources import parse_alignments, parse_chain_lines, parse_chains
from catalog.derive import (
    SQL_SEQUENCES,
    SQL_VARIANTS,
    SQL_WINDOWS,
    md5_bases,
    sequences,
    sql_md5_bases,
    table,
    text,
)

STEP, SLOT, GENOME_CHUNK, FAR = 17, 50, 64, 100_000_000
LETTER = "ACGT"


def _letter(number) -> Column:
    return F.substring(F.lit(LETTER), (number % 4 + 1).cast("int"), F.lit(1))


def exon_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ungapped segment per lineitem; an order is a transcript. Segments may repeat and overlap."""
    line = table(spark, sf_dir, "lineitem")
    accession = F.col("l_orderkey") % 24 + 1 + F.when(F.col("l_partkey") % 40 == 0, 1).otherwise(0)
    start = (F.col("l_linenumber") - 1) * SLOT + 1
    g_start = F.col("l_suppkey") % 50 * 100_000 + F.col("l_linenumber") * 1000 + F.col("l_partkey") % 500
    length = F.col("l_quantity").cast("int")
    segments = line.select(
        F.concat(F.lit("NC_"), F.lpad(text(accession), 6, "0"), F.lit(".12")).alias("sequence"),
        F.when(accession == 23, "X").when(accession == 24, "Y").otherwise(text(accession)).alias("chromosome"),
        F.when(F.col("l_orderkey") % 2 == 0, "+").otherwise("-").alias("sense"),
        g_start.cast("int").alias("genomic_start"),
        (g_start + length - 1).cast("int").alias("genomic_end"),
        F.concat(F.lit("NM_"), text(F.col("l_orderkey"))).alias("transcript_id"),
        start.cast("int").alias("transcript_start"),
        (start + length - 1).cast("int").alias("transcript_end"),
        F.lit(None).cast("array<struct<op:string,len:int>>").alias("gap"),
    )
    return segments


SQL_SEGMENTS = f"""
segs AS MATERIALIZED (
  SELECT 'NC_' || lpad(accession::VARCHAR, 6, '0') || '.12' AS sequence,
         CASE accession WHEN 23 THEN 'X' WHEN 24 THEN 'Y' ELSE accession::VARCHAR END AS chromosome,
         CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS sense, gs, gs + len - 1 AS ge,
         'NM_' || l_orderkey AS transcript_id, ts, ts + len - 1 AS te
  FROM (SELECT *, l_orderkey % 24 + 1 + CASE WHEN l_partkey % 40 = 0 THEN 1 ELSE 0 END AS accession,
               (l_linenumber - 1) * {SLOT} + 1 AS ts, l_quantity::INTEGER AS len,
               l_suppkey % 50 * 100000 + l_linenumber * 1000 + l_partkey % 500 AS gs FROM lineitem))"""


def transcript_points(spark: SparkSession, sf_dir: str, step: int = STEP) -> DataFrame:
    """Positions of every order, also of orders without segments and past their ends."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("NM_"), text(F.col("o_orderkey"))).alias("nm_id"))
    # Dealt out by transcript before the points are made, so that these need no shuffle to meet the segments.
    orders = deal_by(orders, "nm_id")
    points = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(7 * SLOT + 10), F.lit(step))).alias("p"))
    return points.select(
        "nm_id",
        F.col("p").alias("transcript_position"),
        _letter(F.col("o_orderkey") + F.col("p")).alias("ref"),
        _letter(F.col("o_orderkey") + F.col("p") + 1).alias("alt"),
    )


def map_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of a transcript to the genome over ungapped segments."""
    return map_positions(transcript_points(spark, sf_dir, step=1), exon_segments(spark, sf_dir), prefix="NM", dealt=True)


def map_exons_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with shuffled instead of broadcast joins, counted per chromosome."""
    mapped = map_positions(transcript_points(spark, sf_dir), exon_segments(spark, sf_dir), broadcast_limit=0, dealt=True)
    return mapped.groupBy("chromosome_id", "sense", "ref").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("position").cast("long")).alias("position_sum")
    )


def _sql_mapped(step: int) -> str:
    return f"""
WITH {SQL_SEGMENTS},
chosen AS MATERIALIZED (SELECT transcript_id, min(sequence) AS sequence FROM segs GROUP BY 1),
kept AS MATERIALIZED (SELECT DISTINCT segs.* FROM segs JOIN chosen USING (transcript_id, sequence)),
known AS MATERIALIZED (SELECT DISTINCT transcript_id, chromosome, sense FROM kept),
points AS MATERIALIZED (
  SELECT 'NM_' || o_orderkey AS nm_id, p, substr('{LETTER}', (o_orderkey + p) % 4 + 1, 1) AS r,
         substr('{LETTER}', (o_orderkey + p + 1) % 4 + 1, 1) AS a
  FROM orders, range(1, {7 * SLOT + 11}, {step}) AS t(p)),
hits AS MATERIALIZED (
  SELECT nm_id, p, CASE WHEN kept.sense = '+' THEN ge - (te - p) ELSE gs + (te - p) END AS g
  FROM points JOIN kept ON kept.transcript_id = nm_id AND p BETWEEN ts AND te
  QUALIFY row_number() OVER (PARTITION BY nm_id, p ORDER BY ts, te, gs, ge) = 1),
mapped AS (
  SELECT nm_id, p::INTEGER AS transcript_position,
         CASE WHEN sense = '-' THEN translate(r, 'ACGT', 'TGCA') ELSE r END AS ref,
         CASE WHEN sense = '-' THEN translate(a, 'ACGT', 'TGCA') ELSE a END AS alt,
         chromosome AS chromosome_id, coalesce(g, -1)::INTEGER AS position, sense
  FROM points LEFT JOIN known ON known.transcript_id = nm_id LEFT JOIN hits USING (nm_id, p))"""


def map_every_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every accession of a transcript, as for genes that lie on both sex chromosomes."""
    return map_positions(transcript_points(spark, sf_dir), exon_segments(spark, sf_dir), prefix="NM", all_placements=True, dealt=True)


SQL_EVERY_PLACEMENT = f"""
WITH {SQL_SEGMENTS},
known AS (
  SELECT transcript_id, sequence, arg_min(chromosome, (ts, te, gs, sense)) AS chromosome, arg_min(sense, (ts, te, gs, sense)) AS sense
  FROM segs GROUP BY ALL),
points AS (
  SELECT 'NM_' || o_orderkey AS nm_id, p, substr('{LETTER}', (o_orderkey + p) % 4 + 1, 1) AS r,
         substr('{LETTER}', (o_orderkey + p + 1) % 4 + 1, 1) AS a
  FROM orders, range(1, {7 * SLOT + 11}, {STEP}) AS t(p)),
hits AS (
  SELECT nm_id, p, sequence, CASE WHEN sense = '+' THEN ge - (te - p) ELSE gs + (te - p) END AS g
  FROM points JOIN segs ON transcript_id = nm_id AND p BETWEEN ts AND te
  QUALIFY row_number() OVER (PARTITION BY nm_id, p, sequence ORDER BY ts, te, gs, ge) = 1)
SELECT nm_id, p::INTEGER AS transcript_position, CASE WHEN sense = '-' THEN translate(r, 'ACGT', 'TGCA') ELSE r END AS ref,
       CASE WHEN sense = '-' THEN translate(a, 'ACGT', 'TGCA') ELSE a END AS alt, known.sequence AS placement,
       chromosome AS chromosome_id, coalesce(g, -1)::INTEGER AS position, sense
FROM points LEFT JOIN known ON known.transcript_id = nm_id LEFT JOIN hits USING (nm_id, p, sequence)"""


def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of the liftover's blocks with regions of 800 to three million bases."""
    key = F.col("p_partkey")
    start = F.floor(key / 24) * 1000 + key % 500
    width = F.lit(800) * F.pow(F.lit(4), key % 7).cast("long")
    regions = table(spark, sf_dir, "part").select(
        "p_partkey", _contig(key % 24 + 1).alias("chr"), start.alias("start"), (start + width - 1).alias("end")
    )
    blocks = lift_blocks(spark, sf_dir).select("src_chr", "src_start", "src_end", "chain_id")
    pairs = overlap_join(regions, blocks, {"chr": "src_chr"}, ("start", "end"), ("src_start", "src_end"))
    shared = F.least("end", "src_end") - F.greatest("start", "src_start") + 1
    return pairs.select("p_partkey", "chain_id", shared.alias("shared"))


def chain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of chain files given as lines in many splits: short chains, one that holds most lines, lines without a chain."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cells = F.concat_ws("\t", text(customer % 50 + 1), text(customer % 3), text(key % 4))
    heads = F.concat_ws(
        " ", F.lit("chain"), text(key % 1000), F.concat(F.lit("chr"), text(key % 24 + 1)), F.lit("90000"), F.lit("+"), text(key * 10), F.lit("0"),
        F.concat(F.lit("chr"), text(key % 7 + 1)), F.lit(str(FAR)), F.when(key % 2 == 0, "+").otherwise("-"), text(key * 20), F.lit("0"),
        F.concat(F.lit("c"), text(key)),
    )
    place = [F.concat(F.lit("f"), text(key % 2)).alias("file"), F.floor(key / 50).alias("split")]
    blocks = orders.select(*place, (key * 2 + 1).alias("at"), cells.alias("text"))
    headers = orders.where((key % CHAIN_EVERY == 5) & (key < CHAIN_LAST)).select(*place, (key * 2).alias("at"), heads.alias("text"))
    return parse_chain_lines(blocks.unionByName(headers))


# A header stands in front of the line of every so many orders, up to this order.
CHAIN_EVERY, CHAIN_LAST = 211, 5_000

SQL_CHAIN_LINES = f"""
WITH items AS (
  SELECT o_orderkey % 2 AS file, o_orderkey AS spot, o_custkey % 50 + 1 AS size, o_custkey % 3 AS dt, o_orderkey % 4 AS dq,
         CASE WHEN o_orderkey % {CHAIN_EVERY} = 5 AND o_orderkey < {CHAIN_LAST} THEN o_orderkey END AS head FROM orders),
chained AS (SELECT *, max(head) OVER (PARTITION BY file ORDER BY spot) AS k FROM items),
sums AS (
  SELECT *, coalesce(sum(size + dt) OVER w, 0) AS t, coalesce(sum(size + dq) OVER w, 0) AS q, coalesce(sum((dt > 0)::INT) OVER w, 0) AS run
  FROM chained WHERE k IS NOT NULL WINDOW w AS (PARTITION BY file, k ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT 'chr' || (k % 24 + 1) AS src_chr, (k * 10 + t + 1)::BIGINT AS src_start, (k * 10 + t + size)::BIGINT AS src_end,
       'chr' || (k % 7 + 1) AS dst_chr, (k * 20 + q + 1)::BIGINT AS dst_start, CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS dst_strand,
       {FAR}::BIGINT AS dst_size, (k % 1000)::BIGINT AS score, 'c' || k AS chain_id,
       max(k * 10 + t + size) OVER (PARTITION BY file, k, run)::BIGINT AS src_run_end
FROM sums"""


def gapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GFF3 text with gap lists of two or four and five operations, both senses."""
    size, key = F.col("p_size"), F.col("p_partkey")
    a, b, c = size + 5, key % 4 + 1, size % 7 + 3
    short = F.concat(F.lit("M"), text(a), F.when(size % 3 == 0, " I").otherwise(" D"), text(b), F.lit(" M"), text(c))
    gaps = F.when(size % 3 == 2, F.concat(short, F.lit(" I2 M4 D5 M6"))).otherwise(short)
    span = a + c + F.when(size % 3 == 0, b).when(size % 3 == 2, 12).otherwise(0)
    start, g_start = key % 90 + 1, key * 100 + 7
    line = F.concat_ws(
        "\t", F.concat(F.lit("NC_"), F.lpad(text(key % 24 + 1), 6, "0"), F.lit(".12")), F.lit("RefSeq"),
        F.lit("cDNA_match"), text(g_start), text(g_start + span - 1), F.lit("9.5"),
        F.when(key % 3 == 0, "-").otherwise("+"), F.lit("."),
        F.concat(
            F.lit("ID=x;Target=NM_"), text(key), F.lit(" "), text(start), F.lit(" "), text(start + span - 1),
            F.lit(" +;gap_count=1;Gap="), gaps,
        ),
    )
    # Few splits of short rows grow to many pieces and points each.
    part = deal_out(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    return part.select("p_partkey", line.alias("value"), start.alias("start"), span.alias("span"))


def alignment_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed alignment rows; the gap list is written back as text."""
    parsed = parse_alignments(gapped_lines(spark, sf_dir))
    ops = F.transform("gap", lambda g: F.concat(g["op"], text(g["len"])))
    return parsed.withColumn("gap", F.array_join(ops, " "))


def _map_gapped(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    lines = gapped_lines(spark, sf_dir)
    points = lines.select(
        F.concat(F.lit("NM_"), text(F.col("p_partkey"))).alias("nm_id"),
        F.explode(F.sequence((F.col("start") - 1).cast("int"), (F.col("start") + F.col("span")).cast("int"))).alias(
            "transcript_position"
        ),
        F.lit("A").alias("ref"),
        F.lit("C").alias("alt"),
    )
    mapped = map_positions(points, parse_alignments(lines), gap_mode=mode)
    return mapped.select("nm_id", "transcript_position", "chromosome_id", "position", "ref")


def map_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapped segments, deletions taking up transcript positions."""
    return _map_gapped(spark, sf_dir, "reference")


def map_gapped_cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapped segments as a plain alignment walk."""
    return _map_gapped(spark, sf_dir, "cigar")


SQL_GAPPED_PARTS = """
gapped AS (
  SELECT *, p_partkey % 90 + 1 AS ts, p_partkey * 100 + 7 AS gs,
         a + c + CASE p_size % 3 WHEN 0 THEN b WHEN 2 THEN 12 ELSE 0 END AS span,
         [{op: 'M', len: a}, {op: CASE WHEN p_size % 3 = 0 THEN 'I' ELSE 'D' END, len: b}, {op: 'M', len: c}]
         || CASE WHEN p_size % 3 = 2 THEN [{op: 'I', len: 2}, {op: 'M', len: 4}, {op: 'D', len: 5}, {op: 'M', len: 6}]
                 ELSE [] END AS ops
  FROM (SELECT *, p_size + 5 AS a, p_partkey % 4 + 1 AS b, p_size % 7 + 3 AS c FROM part))"""


def _sql_gapped(mode: str) -> str:
    takes = "CASE WHEN op = 'D' THEN 0 ELSE len END" if mode == "cigar" else "len"
    return f"""
WITH {SQL_GAPPED_PARTS},
steps AS (
  SELECT p_partkey, op, len, CASE WHEN p_partkey % 3 = 0 THEN -i ELSE i END AS turn
  FROM (SELECT p_partkey, unnest(ops).op AS op, unnest(ops).len AS len, generate_subscripts(ops, 1) AS i FROM gapped)),
shifts AS (
  SELECT p_partkey, op, CASE op WHEN 'I' THEN -len WHEN 'D' THEN len ELSE 0 END AS shift,
         coalesce(sum({takes}) OVER (PARTITION BY p_partkey ORDER BY turn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM steps),
points AS (SELECT p_partkey, gs, ts, span, unnest(range(ts - 1, ts + span + 1)) AS p FROM gapped),
offsets AS (
  SELECT *, p BETWEEN ts AND ts + span - 1 AS inside,
         CASE WHEN p_partkey % 3 = 0 THEN ts + span - 1 - p ELSE p - ts END AS k FROM points)
SELECT 'NM_' || o.p_partkey AS nm_id, p::INTEGER AS transcript_position,
       CASE WHEN o.p_partkey % 24 = 22 THEN 'X' WHEN o.p_partkey % 24 = 23 THEN 'Y'
            ELSE (o.p_partkey % 24 + 1)::VARCHAR END AS chromosome_id,
       CASE WHEN any_value(inside) THEN any_value(gs) + any_value(k) + sum(CASE WHEN begins <= k THEN shift ELSE 0 END)
            ELSE -1 END::INTEGER AS position,
       CASE WHEN o.p_partkey % 3 = 0 THEN 'T' ELSE 'A' END AS ref
FROM offsets o JOIN shifts s ON s.p_partkey = o.p_partkey GROUP BY o.p_partkey, p"""


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned bases per sequence and transcript."""
    return aligned_length(exon_segments(spark, sf_dir))


def chain_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain text of eight blocks each, parsed."""
    key, size = F.col("p_partkey"), F.col("p_size")
    group = F.floor(key / 8)
    cells = F.when(
        key % 8 != 7, F.concat_ws("\t", text(size), text(key % 5), text(key % 3))
    ).otherwise(text(size))
    grouped = (
        table(spark, sf_dir, "part")
        .select(group.alias("g"), F.struct("p_partkey", cells.alias("line")).alias("row"))
        .groupBy("g")
        .agg(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["line"]).alias("lines"))
    )
    g = F.col("g")
    head = F.concat_ws(
        " ", text(g % 1000), F.concat(F.lit("chr"), text(g % 24 + 1)), F.lit("90000"), F.lit("+"), text(g * 10),
        F.lit("0"), F.concat(F.lit("chr"), text(g % 7 + 1)), F.lit(str(FAR)),
        F.when(g % 2 == 0, "+").otherwise("-"), text(g * 20), F.lit("0"), F.concat(F.lit("c"), text(g)),
    )
    return parse_chains(grouped.select(F.concat(head, F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n")).alias("value")))


SQL_CHAINS = f"""
WITH steps AS (
  SELECT p_partkey // 8 AS g, p_partkey AS i, p_size AS size,
         CASE WHEN p_partkey % 8 = 7 THEN 0 ELSE p_partkey % 5 END AS dt,
         CASE WHEN p_partkey % 8 = 7 THEN 0 ELSE p_partkey % 3 END AS dq FROM part),
sums AS (
  SELECT *, coalesce(sum(size + dt) OVER w, 0) AS t, coalesce(sum(size + dq) OVER w, 0) AS q,
         coalesce(sum((dt > 0)::INTEGER) OVER w, 0) AS run
  FROM steps WINDOW w AS (PARTITION BY g ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT 'chr' || (g % 24 + 1) AS src_chr, (g * 10 + t + 1)::BIGINT AS src_start, (g * 10 + t + size)::BIGINT AS src_end,
       'chr' || (g % 7 + 1) AS dst_chr, (g * 20 + q + 1)::BIGINT AS dst_start,
       CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS dst_strand, {FAR}::BIGINT AS dst_size,
       (g % 1000)::BIGINT AS score, 'c' || g AS chain_id,
       max(g * 10 + t + size) OVER (PARTITION BY g, run)::BIGINT AS src_run_end
FROM sums"""


def _contig(number) -> Column:
    return F.when(number == 23, "chrX").when(number == 24, "chrY").otherwise(F.concat(F.lit("chr"), text(number)))


def lift_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks per part that overlap on the source; both strands; one contig not in the genome."""
    part = deal_out(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    key, size = F.col("p_partkey"), F.col("p_size")
    rank = F.floor(key / 24)
    number = key % 24 + 1
    low = rank * 960 + 1 + size
    variants = F.array(
        F.struct((rank * 1000 + 1).alias("start"), F.lit(800).alias("width"), (key % 5 + 20).alias("score"), F.lit("a").alias("id")),
        F.struct((rank * 1000 + 700).alias("start"), F.lit(251).alias("width"), size.cast("long").alias("score"), F.lit("b").alias("id")),
    )
    b = F.col("b")
    rows = part.select("p_partkey", "p_size", F.explode(variants).alias("b"))
    high = low + b["width"] - 1
    return rows.select(
        _contig(number).alias("src_chr"),
        b["start"].alias("src_start"),
        (b["start"] + b["width"] - 1).alias("src_end"),
        F.when(key % 50 == 49, "chrUn").otherwise(_contig(number % 24 + 1)).alias("dst_chr"),
        F.when(size % 2 == 0, low).otherwise(F.lit(FAR) - high + 1).alias("dst_start"),
        F.when(size % 2 == 0, "+").otherwise("-").alias("dst_strand"),
        F.lit(FAR).cast("long").alias("dst_size"),
        b["score"].alias("score"),
        F.concat(b["id"], text(key)).alias("chain_id"),
    )


def genome_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen chunks of the target genome per part."""
    key = F.col("p_partkey")
    number, rank = key % 24 + 1, F.floor(key / 24)
    chunks = deal_out(table(spark, sf_dir, "part").select("p_partkey")).select(
        _contig(number).alias("chr"), F.explode(F.sequence(rank * 15, rank * 15 + 14)).alias("chunk_id")
    )
    name = F.concat(F.col("chr"), F.lit("-"), text(F.col("chunk_id")))
    half = [md5_bases(F.concat(name, F.lit(s))) for s in ("-l", "-r")]
    return chunks.select("chr", "chunk_id", F.concat(*half).alias("bases"))


def lift_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variant per lineitem; some without chromosome, on an unknown one, unmapped or in a hole."""
    part, order, number = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_partkey") % 24 + 1
    chrom = F.when(number == 23, "X").when(number == 24, "Y").otherwise(text(number))
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(*columns).select(
        "l_orderkey",
        "l_linenumber",
        F.when(order % 97 != 0, F.when(F.col("l_suppkey") % 29 == 0, F.lit("25")).otherwise(chrom)).alias("chromosome_id"),
        F.when(order % 101 == 0, -1).otherwise(F.floor(part / 24) * 1000 + order % 1000 + 1).cast("int").alias("position"),
        _letter(F.col("l_linenumber")).alias("ref"),
        _letter(F.col("l_linenumber") + 1).alias("alt"),
    )


def _lifted(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return lift_positions(
        lift_points(spark, sf_dir), lift_blocks(spark, sf_dir), genome_chunks(spark, sf_dir), GENOME_CHUNK,
        multi_base=False, **options,
    )


def lift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liftover with allele check."""
    return _lifted(spark, sf_dir)


def lift_rows_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through shuffled joins, counted per result and chromosome."""
    lifted = _lifted(spark, sf_dir, broadcast_limit=0)
    return lifted.groupBy("liftoverResult", "chromosome_id_hg19").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("position_hg19").cast("long")).alias("position_sum")
    )


def lift_unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liftover of one- to three-base alleles without a target genome."""
    points = lift_points(spark, sf_dir)
    longer = F.repeat(F.col("ref"), (F.col("l_orderkey") % 3 + 1).cast("int"))
    points = points.withColumn("ref", longer).withColumn("alt", F.repeat(F.col("alt"), (F.col("l_orderkey") % 2 + 1).cast("int")))
    blocks = lift_blocks(spark, sf_dir).where(F.col("chain_id").startswith("a"))
    return lift_positions(points, blocks).drop("liftoverOrig")


def vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifted variants as VCF text."""
    return to_vcf_lines(lift_rows(spark, sf_dir))


def _sql_contig(number: str) -> str:
    return f"CASE {number} WHEN 23 THEN 'chrX' WHEN 24 THEN 'chrY' ELSE 'chr' || ({number}) END"


def _sql_blocks(name: str, start: str, width: int, score: str) -> str:
    return f"""
  SELECT {_sql_contig("p_partkey % 24 + 1")} AS src_chr, p_partkey // 24 * 1000 + {start} AS ss,
         p_partkey // 24 * 1000 + {start} + {width} - 1 AS se,
         CASE WHEN p_partkey % 50 = 49 THEN 'chrUn' ELSE {_sql_contig("(p_partkey % 24 + 1) % 24 + 1")} END AS dst_chr,
         p_partkey // 24 * 960 + 1 + p_size AS low, {width} AS width,
         p_size % 2 = 0 AS forward, {score} AS score, '{name}' || p_partkey AS chain_id FROM part"""


_ORDER, _LINE = "l_orderkey", "l_linenumber"
SQL_TARGET = f"""
blocks AS ({_sql_blocks("a", "1", 800, "p_partkey % 5 + 20")} UNION ALL {_sql_blocks("b", "700", 251, "p_size")}),
chunks AS (
  SELECT chr, chunk_id, {sql_md5_bases("chr || '-' || chunk_id || '-l'")} || {sql_md5_bases("chr || '-' || chunk_id || '-r'")} AS bases
  FROM (SELECT {_sql_contig("p_partkey % 24 + 1")} AS chr, p_partkey // 24 * 15 + i AS chunk_id
        FROM part, range(0, 15) AS t(i)))"""

SQL_LIFT_INPUT = f"""{SQL_TARGET},
points AS (
  SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_suppkey % 29 = 0 THEN '25'
              ELSE substr({_sql_contig("l_partkey % 24 + 1")}, 4) END AS chromosome_id,
         CASE WHEN l_orderkey % 101 = 0 THEN -1 ELSE l_partkey // 24 * 1000 + l_orderkey % 1000 + 1 END::INTEGER AS position,
         substr('{LETTER}', l_linenumber % 4 + 1, 1) AS ref, substr('{LETTER}', (l_linenumber + 1) % 4 + 1, 1) AS alt
  FROM lineitem)"""

SQL_CODED = "CASE {0} WHEN 'chrX' THEN '23' WHEN 'chrY' THEN '24' ELSE substr({0}, 4) END"

SQL_LIFTING = f"""
hits AS (
  SELECT points.*, 'chr' || chromosome_id AS contig, dst_chr, forward,
         CASE WHEN forward THEN low + position - ss ELSE low + width - 1 - (position - ss) END AS g
  FROM points LEFT JOIN blocks ON src_chr = 'chr' || chromosome_id AND position BETWEEN ss AND se
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, chain_id, ss) = 1),
checked AS (
  SELECT hits.*, CASE WHEN forward THEN ref ELSE translate(ref, 'ACGT', 'TGCA') END AS new_ref,
         CASE WHEN forward THEN alt ELSE translate(alt, 'ACGT', 'TGCA') END AS new_alt,
         substr(bases, ((g - 1) % {GENOME_CHUNK} + 1)::INTEGER, 1) AS base,
         dst_chr IN (SELECT chr FROM chunks) AS known
  FROM hits LEFT JOIN chunks ON chr = dst_chr AND chunk_id = (g - 1) // {GENOME_CHUNK}),
judged AS (
  SELECT *, CASE WHEN contig IS NULL THEN 'Unknown' WHEN g IS NULL OR NOT known THEN 'NO_TARGET'
                 WHEN coalesce(base = new_ref, false) THEN 'PASS' ELSE 'MISMATCHING_REF_ALLELE' END AS res FROM checked),
lifted AS (
  SELECT l_orderkey, l_linenumber, chromosome_id, position, ref, alt,
         CASE res WHEN 'Unknown' THEN 'None' WHEN 'PASS' THEN {SQL_CODED.format("dst_chr")}
                  ELSE {SQL_CODED.format("contig")} END AS chromosome_id_hg19,
         CASE res WHEN 'Unknown' THEN -1 WHEN 'PASS' THEN g ELSE position END::INTEGER AS position_hg19,
         CASE res WHEN 'Unknown' THEN 'None' WHEN 'PASS' THEN new_ref ELSE ref END AS ref_hg19,
         CASE res WHEN 'Unknown' THEN 'None' WHEN 'PASS' THEN new_alt ELSE alt END AS alt_hg19,
         res AS liftoverResult,
         CASE res WHEN 'Unknown' THEN 'None'
                  WHEN 'PASS' THEN 'OriginalContig=' || contig || ';OriginalStart=' || position
                  WHEN 'NO_TARGET' THEN '.'
                  ELSE 'AttemptedLocus=' || dst_chr || ':' || g || '-' || g END AS liftoverOrig
  FROM judged)"""
SQL_LIFTED = f"WITH {SQL_LIFT_INPUT}, {SQL_LIFTING}"

SQL_LIFT_UNCHECKED = f"""
WITH {SQL_LIFT_INPUT},
longer AS (SELECT * REPLACE (repeat(ref, l_orderkey % 3 + 1) AS ref, repeat(alt, l_orderkey % 2 + 1) AS alt) FROM points),
hits AS (
  SELECT longer.*, 'chr' || chromosome_id AS contig, dst_chr, forward, length(ref) AS n,
         position + length(ref) - 1 <= se AS whole,
         CASE WHEN forward THEN low + position - ss ELSE low + width - 1 - (position - ss) - length(ref) + 1 END AS g
  FROM longer LEFT JOIN (SELECT * FROM blocks WHERE chain_id LIKE 'a%')
       ON src_chr = 'chr' || chromosome_id AND position BETWEEN ss AND se),
judged AS (
  SELECT *, CASE WHEN contig IS NULL THEN 'Unknown' WHEN g IS NULL OR NOT whole THEN 'NO_TARGET'
                 WHEN NOT forward AND n <> length(alt) THEN 'CANNOT_LIFTOVER_INDEL' ELSE 'PASS' END AS res FROM hits)
SELECT l_orderkey, l_linenumber, chromosome_id, position, ref, alt,
       CASE res WHEN 'Unknown' THEN 'None' WHEN 'PASS' THEN {SQL_CODED.format("dst_chr")}
                ELSE {SQL_CODED.format("contig")} END AS chromosome_id_hg19,
       CASE res WHEN 'Unknown' THEN -1 WHEN 'PASS' THEN g ELSE position END::INTEGER AS position_hg19,
       CASE WHEN res = 'Unknown' THEN 'None' WHEN res = 'PASS' AND NOT forward
            THEN reverse(translate(ref, 'ACGT', 'TGCA')) ELSE ref END AS ref_hg19,
       CASE WHEN res = 'Unknown' THEN 'None' WHEN res = 'PASS' AND NOT forward
            THEN reverse(translate(alt, 'ACGT', 'TGCA')) ELSE alt END AS alt_hg19,
       res AS liftoverResult
FROM judged"""

END_SPEC = {"Transcript": ("keys", ("nm_id", "transcript_position")), "dMFE": ("extreme", "score")}


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences to variants, to the genome, to another assembly, to one row per variant."""
    # Dealt out by transcript before the variants are made, so that these need no shuffle to meet the segments.
    base = deal_by(sequences(spark, sf_dir), "nm_id")
    sizes = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    key, number = F.col("p_partkey"), F.col("p_partkey") % 24 + 1
    start = (F.floor(key / 24) * 1000 + 1 + F.col("p_size")).cast("int")
    segments = base.join(sizes.hint("merge"), "p_partkey").select(
        F.concat(F.lit("NC_"), F.lpad(text(number), 6, "0"), F.lit(".12")).alias("sequence"),
        F.when(number == 23, "X").when(number == 24, "Y").otherwise(text(number)).alias("chromosome"),
        F.when(key % 2 == 0, "+").otherwise("-").alias("sense"),
        start.alias("genomic_start"),
        (start + F.length("sequence") - 1).alias("genomic_end"),
        F.col("nm_id").alias("transcript_id"),
        F.lit(1).alias("transcript_start"),
        F.length("sequence").alias("transcript_end"),
        F.lit(None).cast("array<struct<op:string,len:int>>").alias("gap"),
    )
    rows = alternates(windows(base, partitions=None), wildtype=False).drop("sequence", "wildSequence", "isWildType", "p_partkey")
    scored = rows.withColumn("score", F.lit(60) - F.col("transcript_position"))
    mapped = map_positions(scored, segments, prefix="NM", dealt=True)
    lifted = lift_positions(mapped, lift_blocks(spark, sf_dir), genome_chunks(spark, sf_dir), GENOME_CHUNK, multi_base=False)
    return rollup(lifted, spec=END_SPEC)


SQL_END_TO_END = f"""
WITH {SQL_SEQUENCES}, {SQL_WINDOWS}, {SQL_VARIANTS}, {SQL_TARGET},
points AS (
  SELECT row_number() OVER () AS rid, p_partkey AS l_orderkey, transcript_position AS l_linenumber,
         substr({_sql_contig("p_partkey % 24 + 1")}, 4) AS chromosome_id,
         (p_partkey // 24 * 1000 + 1 + p_size
          + CASE WHEN p_partkey % 2 = 0 THEN transcript_position - 1 ELSE length(seqs.sequence) - transcript_position END
         )::INTEGER AS position,
         CASE WHEN p_partkey % 2 = 0 THEN ref ELSE translate(ref, 'ACGT', 'TGCA') END AS ref,
         CASE WHEN p_partkey % 2 = 0 THEN alt ELSE translate(alt, 'ACGT', 'TGCA') END AS alt
  FROM vars JOIN seqs USING (nm_id) JOIN part USING (p_partkey) WHERE NOT isWildType), {SQL_LIFTING}
SELECT chromosome_id_hg19 AS CHR, position_hg19 AS POS, ref_hg19 AS REF, alt_hg19 AS ALT,
       string_agg(DISTINCT 'NM_' || l_orderkey || ':' || l_linenumber, ';' ORDER BY 'NM_' || l_orderkey || ':' || l_linenumber)
       AS Transcript,
       CASE WHEN max(60 - l_linenumber) >= -min(60 - l_linenumber) THEN max(60 - l_linenumber)
            ELSE min(60 - l_linenumber) END AS dMFE
FROM lifted WHERE liftoverResult = 'PASS' GROUP BY 1, 2, 3, 4"""

QUERIES = {
    "end_to_end": end_to_end,
    "map_positions": map_exons,
    "map_positions_shuffled": map_exons_shuffled,
    "map_placements": map_every_placement,
    "overlaps": overlaps,
    "chain_lines": chain_lines,
    "alignment_parse": alignment_parse,
    "map_positions_gapped": map_gapped,
    "map_positions_cigar": map_gapped_cigar,
    "aligned_length": lengths,
    "chain_blocks": chain_blocks,
    "lift_positions": lift_rows,
    "lift_positions_shuffled": lift_rows_shuffled,
    "lift_alleles": lift_unchecked,
    "vcf_lines": vcf_lines,
}

ORACLES = {
    "end_to_end": SQL_END_TO_END,
    "map_positions": f"{_sql_mapped(1)} SELECT * FROM mapped",
    "map_positions_shuffled": f"""{_sql_mapped(STEP)}
SELECT chromosome_id, sense, ref, count(*) AS n, sum(position)::BIGINT AS position_sum FROM mapped GROUP BY ALL""",
    "map_placements": SQL_EVERY_PLACEMENT,
    "overlaps": f"""
WITH {SQL_TARGET}, regions AS (
  SELECT p_partkey, {_sql_contig("p_partkey % 24 + 1")} AS chr, p_partkey // 24 * 1000 + p_partkey % 500 AS s,
         p_partkey // 24 * 1000 + p_partkey % 500 + 800 * pow(4, p_partkey % 7)::BIGINT - 1 AS e FROM part)
SELECT p_partkey, chain_id, (least(e, se) - greatest(s, ss) + 1)::BIGINT AS shared
FROM regions JOIN blocks ON chr = src_chr AND s <= se AND ss <= e""",
    "chain_lines": SQL_CHAIN_LINES,
    "alignment_parse": f"""
WITH {SQL_GAPPED_PARTS}
SELECT 'NC_' || lpad((p_partkey % 24 + 1)::VARCHAR, 6, '0') || '.12' AS sequence,
       CASE WHEN p_partkey % 24 = 22 THEN 'X' WHEN p_partkey % 24 = 23 THEN 'Y'
            ELSE (p_partkey % 24 + 1)::VARCHAR END AS chromosome,
       CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS sense, 9.5::DOUBLE AS score,
       gs::INTEGER AS genomic_start, (gs + span - 1)::INTEGER AS genomic_end, 'NM_' || p_partkey AS transcript_id,
       ts::INTEGER AS transcript_start, (ts + span - 1)::INTEGER AS transcript_end,
       array_to_string(list_transform(ops, lambda o: o.op || o.len), ' ') AS gap
FROM gapped""",
    "map_positions_gapped": _sql_gapped("reference"),
    "map_positions_cigar": _sql_gapped("cigar"),
    "aligned_length": f"""
WITH {SQL_SEGMENTS}
SELECT sequence, transcript_id, sum(ge - gs + 1)::BIGINT AS aligned_length FROM segs GROUP BY ALL""",
    "chain_blocks": SQL_CHAINS,
    "lift_positions": f"{SQL_LIFTED} SELECT * FROM lifted",
    "lift_positions_shuffled": f"""{SQL_LIFTED}
SELECT liftoverResult, chromosome_id_hg19, count(*) AS n, sum(position_hg19)::BIGINT AS position_sum
FROM lifted GROUP BY ALL""",
    "lift_alleles": SQL_LIFT_UNCHECKED,
    "vcf_lines": f"""{SQL_LIFTED}
SELECT DISTINCT concat_ws(chr(9), CASE chromosome_id_hg19 WHEN '23' THEN 'X' WHEN '24' THEN 'Y' ELSE chromosome_id_hg19 END,
       position_hg19, '.', ref_hg19, alt_hg19, '.', '.', '.', 'GT', '1/0') AS value
FROM lifted WHERE liftoverResult = 'PASS'""",
}

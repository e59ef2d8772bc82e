"""Keyed enrichment, rollup, extremes, counts and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions import joined_set, merge_key, signed_extreme
from basewise.operators import (
    argmax_rows,
    check_unique,
    coverage_flag,
    enrich,
    enrich_frequencies,
    enrich_prefixed,
    extreme_join,
    hot_keys,
    join_scores,
    key_histogram,
    rollup,
    sample_rows,
)
from basewise.operators.enrich import COUNT_NAMES
from basewise.operators.quality import Progress
from basewise.operators.rollup import KEY_NAMES, ROLLUP_SPEC
from basewise.operators.stored import enrich_stored, store_by_key
from basewise.sources.checked import check_cells
from catalog.derive import table, text

SEED = 7


def _keyed(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    """Line items under a genomic key with the given column names."""
    chrom, position, ref, alt = names
    return table(spark, sf_dir, "lineitem").select(
        text(F.col("l_suppkey") % 24 + 1).alias(chrom),
        F.col("l_partkey").cast("int").alias(position),
        F.col("l_returnflag").alias(ref),
        F.col("l_linestatus").alias(alt),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
    )


HG19 = ("chromosome_id_hg19", "position_hg19", "ref_hg19", "alt_hg19")
PLAIN = ("CHROMOSOME", "POSITION", "REF", "ALT")


def _sql_keyed(names: tuple[str, ...]) -> str:
    chrom, position, ref, alt = names
    return f"""SELECT (l_suppkey % 24 + 1)::VARCHAR AS {chrom}, l_partkey::INTEGER AS {position}, l_returnflag AS {ref},
       l_linestatus AS {alt}, l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem"""


def frequency_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four left joins on the genomic key."""
    rows = _keyed(spark, sf_dir, PLAIN)
    taxed, cheap = rows.where("l_tax > 0.04"), rows.where("l_discount > 0.05")

    def counts(source: DataFrame, kind: str) -> DataFrame:
        return source.groupBy(*PLAIN).agg(
            F.count(F.lit(1)).alias(f"gnomad{kind}_alt_count"),
            F.sum(F.col("l_quantity").cast("long")).alias(f"gnomad{kind}_total_count"),
            F.max("l_linenumber").alias(f"gnomad{kind}_homozygous_count"),
        )

    left = _keyed(spark, sf_dir, HG19).select(*HG19, "l_orderkey", "l_linenumber")
    joined = enrich_frequencies(
        left,
        taxed.groupBy(*PLAIN).agg(F.max("l_discount").alias("gnomad_ex")),
        cheap.groupBy(*PLAIN).agg(F.min("l_tax").alias("gnomad_wg")),
        counts(taxed, "ex"),
        counts(cheap, "wg"),
    )
    # Integers without a match are written as -1, since a null integer is a float to some readers.
    return joined.fillna(-1, [c for c in joined.columns if c.endswith("_count")])


def _sql_counts(kind: str) -> str:
    return f"""count(*) AS gnomAD_{kind}_alt_count, sum(l_quantity::BIGINT)::BIGINT AS gnomAD_{kind}_total_count,
         max(l_linenumber) AS gnomAD_{kind}_homozygous_count"""


_KEYS = ", ".join(HG19)
_COUNTS = ", ".join(
    f"coalesce(gnomAD_{kind}_{what}_count, -1) AS gnomAD_{kind}_{what}_count"
    for kind in ("EX", "WG")
    for what in ("alt", "total", "homozygous")
)
SQL_FREQUENCIES = f"""
WITH rows AS ({_sql_keyed(HG19)}),
ex AS (SELECT {_KEYS}, max(l_discount) AS gnomad_ex, {_sql_counts("EX")} FROM rows WHERE l_tax > 0.04 GROUP BY {_KEYS}),
wg AS (SELECT {_KEYS}, min(l_tax) AS gnomad_wg, {_sql_counts("WG")} FROM rows WHERE l_discount > 0.05 GROUP BY {_KEYS})
SELECT {_KEYS}, l_orderkey, l_linenumber, gnomad_ex, gnomad_wg, {_COUNTS}
FROM rows LEFT JOIN ex USING ({_KEYS}) LEFT JOIN wg USING ({_KEYS})"""


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four joins against stored tables; a third of the rows has no position and one key that stands for that."""
    rows = _keyed(spark, sf_dir, HG19)
    taxed, cheap = rows.where("l_tax > 0.04"), rows.where("l_discount > 0.05")

    def counts(source: DataFrame, kind: str) -> DataFrame:
        return source.groupBy(*HG19).agg(
            F.count(F.lit(1)).alias(f"gnomad{kind}_alt_count"),
            F.sum(F.col("l_quantity").cast("long")).alias(f"gnomad{kind}_total_count"),
            F.max("l_linenumber").alias(f"gnomad{kind}_homozygous_count"),
        ).withColumnsRenamed(COUNT_NAMES)

    tables = [
        taxed.groupBy(*HG19).agg(F.max("l_discount").alias("gnomad_ex")),
        cheap.groupBy(*HG19).agg(F.min("l_tax").alias("gnomad_wg")),
        counts(taxed, "ex"),
        counts(cheap, "wg"),
    ]
    stored = [store_by_key(t, HG19, STORED_BUCKETS) for t in tables]
    lifted = F.col("l_linenumber") % 3 != 0
    none = {"position_hg19": F.lit(-1)}
    left = rows.select(
        *[F.when(lifted, F.col(c)).otherwise(none.get(c, F.lit("None"))).alias(c) for c in HG19], "l_orderkey", "l_linenumber"
    )
    joined = enrich_stored(left, stored, HG19, STORED_BUCKETS, usable=F.col("position_hg19") >= 0)
    return joined.fillna(-1, [c for c in joined.columns if c.endswith("_count")])


STORED_BUCKETS = 16
_NO_KEY = ", ".join(
    f"CASE WHEN l_linenumber % 3 = 0 THEN {'-1' if c == 'position_hg19' else repr('None')} ELSE {c} END AS {c}" for c in HG19
)
SQL_STORED = SQL_FREQUENCIES.replace("FROM rows LEFT JOIN", f"FROM (SELECT * REPLACE ({_NO_KEY}) FROM rows) LEFT JOIN")


def skewed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two left joins where one key holds over a third of the left rows, and a null key many more."""
    line = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_linenumber") <= 3, F.lit(0)).when(F.col("l_linenumber") > 4, F.col("l_suppkey"))
    left = line.select(key.cast("long").alias("k"), "l_orderkey", "l_linenumber", "l_partkey")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_name")
    return enrich(left, [supplier, nation], ["k"], hot=hot_keys(left, ["k"], share=0.05)).fillna(-1, ["k"])


def prefixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table joined under a prefix."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return enrich_prefixed(customer, nation, ["c_nationkey"], rename={"n_nationkey": "c_nationkey"})


def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage percent and flag; documents without a label stay null."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    percent = (F.col("quality") * 0.5 + F.col("toxic") * 0.25).alias("gnomAD_EX_coveragePercent")
    flagged = coverage_flag(documents, table(spark, sf_dir, "labels").select("doc_id", percent), 0.5, keys=["doc_id"])
    return flagged.fillna(-1, ["gnomAD_EX_coverageFlag"])


def joined_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join on four keys, one column taken."""
    rows = _keyed(spark, sf_dir, ("nm_id", "transcript_position", "ref", "alt"))
    other = rows.groupBy("nm_id", "transcript_position", "ref", "alt").agg(
        F.max("l_tax").alias("efeed"), F.min("l_tax").alias("unused")
    )
    return join_scores(rows.where("l_quantity > 10").drop("l_tax", "l_discount"), other.where("efeed > 0.05"))


def extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance farthest from zero per nation, of doubles and of integers."""
    customer = table(spark, sf_dir, "customer")
    shifted = customer.withColumn("shifted", (F.col("c_acctbal") - 5000).cast("int"))
    return shifted.groupBy("c_nationkey").agg(
        signed_extreme("c_acctbal").alias("balance"), signed_extreme("shifted").alias("shifted")
    )


def _lifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lifted variants with every column that the rollup reads."""
    line = table(spark, sf_dir, "lineitem").drop("l_shipdate")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    whole = (quantity - 25).cast("int")
    count = F.when(F.col("l_linenumber") % 2 == 0, whole)
    return line.select(
        text(F.col("l_suppkey") % 24 + 1).alias("chromosome_id_hg19"),
        F.col("l_partkey").cast("int").alias("position_hg19"),
        F.lit("A").alias("ref_hg19"),
        F.col("l_linestatus").alias("alt_hg19"),
        F.when(F.col("l_returnflag") != "R", "PASS").otherwise("NO_TARGET").alias("liftoverResult"),
        (F.col("l_discount") > 0.02).cast("int").alias("gnomAD_EX_coverageFlag"),
        F.concat(F.lit("NM_"), text(F.col("l_orderkey") % 50)).alias("nm_id"),
        F.col("l_linenumber").alias("transcript_position"),
        *[(price - shift).alias(n) for n, shift in DOUBLE_SCORES.items()],
        (F.col("l_tax") - 0.04).alias("efeed"),
        *[whole.alias(n) for n in ("mfeed", "meaed", "cfeed")],
        *[count.alias(source) for _, source in (s for s in ROLLUP_SPEC.values() if str(s[1]).startswith("gnomAD") and s[0] == "extreme")],
        F.col("l_returnflag").alias("snpeffAnnotation"),
        F.col("l_linestatus").alias("snpeffPunativeImpact"),
        F.when(F.col("l_tax") > 0.03, text(F.col("l_suppkey"))).alias("snpeffGeneName"),
        text(F.col("l_linenumber")).alias("snpeffGeneID"),
        F.lit("coding").alias("snpeffTranscriptBiotype"),
    )


DOUBLE_SCORES = {
    "deltaMFE": 50000, "deltaEFE": 40000, "deltaMEAFE": 30000, "deltaCFE": 60000, "deltaEND": 70000, "deltaCD": 0,
}


def rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full 28-column rollup."""
    rolled = rollup(_lifted(spark, sf_dir))
    return rolled.fillna(-99, [c for c in rolled.columns if c.endswith("_count")])


def _sql_extreme(value: str) -> str:
    return f"CASE WHEN max({value}) >= -min({value}) THEN max({value}) ELSE min({value}) END"


def _sql_rollup() -> str:
    whole = "(l_quantity - 25)::INTEGER"
    values = {n: f"l_extendedprice - {s}" for n, s in DOUBLE_SCORES.items()}
    values |= {"efeed": "l_tax - 0.04::DOUBLE", "mfeed": whole, "meaed": whole, "cfeed": whole}
    sets = {
        "snpeffAnnotation": "l_returnflag",
        "snpeffPunativeImpact": "l_linestatus",
        "snpeffGeneName": "CASE WHEN l_tax > 0.03 THEN l_suppkey::VARCHAR END",
        "snpeffGeneID": "l_linenumber::VARCHAR",
    }
    out = []
    for name, (kind, source) in ROLLUP_SPEC.items():
        if kind == "extreme":
            value = values.get(source, f"CASE WHEN l_linenumber % 2 = 0 THEN {whole} END")
            extreme = _sql_extreme(value)
            out.append(f"coalesce({extreme}, -99) AS {name}" if name.endswith("_count") else f"{extreme} AS {name}")
        elif name == "Biotype":
            out.append("'coding' AS Biotype")
        elif kind == "set":
            v = sets[source]
            out.append(f"coalesce(string_agg(DISTINCT {v}, ';' ORDER BY {v}), '') AS {name}")
    merged = "'NM_' || (l_orderkey % 50) || ':' || l_linenumber"
    return f"""
SELECT (l_suppkey % 24 + 1)::VARCHAR AS CHR, l_partkey::INTEGER AS POS, 'A' AS REF, l_linestatus AS ALT,
       'PASS' AS LiftoverResult, min((l_discount > 0.02)::INTEGER) AS Coverage,
       string_agg(DISTINCT {merged}, ';' ORDER BY {merged}) AS Transcript, {", ".join(out)}
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3, 4"""


def joined_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct priorities and merged keys per customer."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        joined_set("o_orderpriority").alias("priorities"),
        joined_set(merge_key("o_orderstatus", "o_orderpriority")).alias("merged"),
    )


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = F.floor(F.col("o_totalprice") / 100000).alias("grade")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", grade, "o_orderpriority")


def extreme_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that hold both their customer's best grade and first priority."""
    return extreme_join(_graded(spark, sf_dir), ["o_custkey"], "grade", "o_orderpriority")


def best_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per customer: best grade, then first priority."""
    return argmax_rows(_graded(spark, sf_dir), ["o_custkey"], [F.desc("grade"), F.asc("o_orderpriority")])


SQL_GRADED = "graded AS (SELECT o_orderkey, o_custkey, floor(o_totalprice / 100000)::BIGINT AS grade, o_orderpriority FROM orders)"


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (flag, status), most frequent first."""
    return key_histogram(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is (order, line) a key?"""
    return check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct ids, largest and smallest price."""
    return table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("l_partkey").alias("parts"),
        F.max("l_extendedprice").alias("highest"),
        F.min("l_extendedprice").alias("lowest"),
    )


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten repeatable random parts."""
    return sample_rows(table(spark, sf_dir, "part"), 10, SEED, ["p_partkey"])


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and quantities at three places of one plan, observed while it is computed."""
    progress = Progress()
    scanned = progress.at(table(spark, sf_dir, "lineitem"), "scanned", quantity=F.sum("l_quantity"))
    kept = progress.at(scanned.where("l_returnflag <> 'R'"), "kept", last_line=F.max("l_linenumber"))
    grouped = kept.groupBy("l_suppkey", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    _, numbers = progress.deliver(grouped)
    return numbers.select("place", "metric", "value")


def checked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated lines with unreadable, missing and surplus cells: typed values and what was rejected."""
    key = F.col("p_partkey")
    number = (
        F.when(key % 11 == 3, F.concat(F.lit("x"), text(key))).when(key % 17 == 5, F.concat(text(key), F.lit(".5")))
        .when(key % 19 == 7, "99999999999").otherwise(text(key))
    )
    price = (
        F.when(key % 13 == 2, "1,5").when(key % 23 == 4, "NA").when(key % 29 == 6, "").when(key % 31 == 8, "1e400x")
        .otherwise(F.concat(text(key % 1000), F.lit(".25")))
    )
    whole = F.concat_ws("\t", number, price, F.col("p_brand"))
    value = F.when(key % 37 == 9, number).when(key % 41 == 10, F.concat(whole, F.lit("\ta\tb"))).otherwise(whole)
    lines = table(spark, sf_dir, "part").select(key.alias("line"), value.alias("value"))
    checked = check_cells(lines, ["number", "price", "brand"], {"number": "int", "price": "double", "brand": "string"})
    each = F.transform("rejects", lambda r: F.concat_ws("|", F.coalesce(r["column"], F.lit("*")), r["value"], r["reason"]))
    return checked.withColumns({"number": F.coalesce("number", F.lit(-1)), "rejects": F.array_join(each, ";")})


_INTEGER, _NUMBER = r"\s*[+-]?[0-9]+\s*", r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"
SQL_CHECKED = f"""
WITH lines AS (
  SELECT p_partkey AS line, CASE WHEN p_partkey % 37 = 9 THEN number WHEN p_partkey % 41 = 10 THEN whole || chr(9) || 'a' || chr(9) || 'b' ELSE whole END AS value
  FROM (SELECT *, number || chr(9) || price || chr(9) || p_brand AS whole FROM (
    SELECT p_partkey, p_brand,
      CASE WHEN p_partkey % 11 = 3 THEN 'x' || p_partkey WHEN p_partkey % 17 = 5 THEN p_partkey || '.5' WHEN p_partkey % 19 = 7 THEN '99999999999' ELSE p_partkey::VARCHAR END AS number,
      CASE WHEN p_partkey % 13 = 2 THEN '1,5' WHEN p_partkey % 23 = 4 THEN 'NA' WHEN p_partkey % 29 = 6 THEN '' WHEN p_partkey % 31 = 8 THEN '1e400x' ELSE (p_partkey % 1000) || '.25' END AS price
    FROM part))),
cells AS (SELECT line, string_split(value, chr(9)) AS c FROM lines),
clean AS (SELECT *, nullif(nullif(c[1], ''), 'NA') AS a, nullif(nullif(c[2], ''), 'NA') AS b FROM cells),
typed AS (
  SELECT *, CASE WHEN regexp_full_match(a, '{_INTEGER}') THEN try_cast(a AS INTEGER) END AS number,
    CASE WHEN regexp_full_match(b, '{_NUMBER}') THEN try_cast(b AS DOUBLE) END AS price, nullif(nullif(c[3], ''), 'NA') AS brand FROM clean)
SELECT line, coalesce(number, -1) AS number, price, brand,
  array_to_string(list_filter([
    CASE WHEN c[1] IS NULL THEN 'number|missing' WHEN a IS NOT NULL AND number IS NULL THEN 'number|' || a || '|' ||
      CASE WHEN NOT regexp_full_match(a, '{_NUMBER}') THEN 'not a number' WHEN NOT regexp_full_match(a, '{_INTEGER}') THEN 'not an integer' ELSE 'out of range' END END,
    CASE WHEN c[2] IS NULL THEN 'price|missing' WHEN b IS NOT NULL AND price IS NULL THEN 'price|' || b || '|not a number' END,
    CASE WHEN c[3] IS NULL THEN 'brand|missing' END,
    CASE WHEN len(c) > 3 THEN '*|' || array_to_string(c[4:], chr(9)) || '|extra fields' END], lambda r: r IS NOT NULL), ';') AS rejects
FROM typed"""


QUERIES = {
    "enrich_left_outer": frequency_rows,
    "enrich_skewed": skewed_rows,
    "enrich_prefixed": prefixed_rows,
    "coverage_flag": flagged_rows,
    "join_scores": joined_scores,
    "signed_extreme": extremes,
    "rollup": rolled_up,
    "collect_join_string": joined_priorities,
    "extreme_join": extreme_rows,
    "argmax_rows": best_rows,
    "key_histogram": histogram,
    "check_unique": uniqueness,
    "distinct_count": distinct_counts,
    "sample_rows": sampled,
    "row_metrics": counted,
    "enrich_stored": stored_rows,
    "checked_cells": checked_lines,
}

ORACLES = {
    "enrich_left_outer": SQL_FREQUENCIES,
    "enrich_skewed": """
SELECT coalesce(k, -1) AS k, l_orderkey, l_linenumber, l_partkey, s_name, n_name
FROM (SELECT *, CASE WHEN l_linenumber <= 3 THEN 0 WHEN l_linenumber > 4 THEN l_suppkey END AS k FROM lineitem)
LEFT JOIN supplier ON s_suppkey = k LEFT JOIN nation ON n_nationkey = k""",
    "enrich_prefixed": """
SELECT customer.*, n_name AS dbNSFP_n_name, n_regionkey AS dbNSFP_n_regionkey
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "coverage_flag": """
SELECT doc_id, lang, percent AS gnomAD_EX_coveragePercent, coalesce((percent >= 0.5)::INTEGER, -1) AS gnomAD_EX_coverageFlag
FROM documents LEFT JOIN (SELECT doc_id, quality * 0.5::DOUBLE + toxic * 0.25::DOUBLE AS percent FROM labels) USING (doc_id)""",
    "join_scores": f"""
WITH rows AS ({_sql_keyed(("nm_id", "transcript_position", "ref", "alt"))}),
other AS (SELECT nm_id, transcript_position, ref, alt, max(l_tax) AS efeed FROM rows GROUP BY ALL HAVING max(l_tax) > 0.05)
SELECT nm_id, transcript_position, ref, alt, l_orderkey, l_linenumber, l_quantity, efeed
FROM rows JOIN other USING (nm_id, transcript_position, ref, alt) WHERE l_quantity > 10""",
    "signed_extreme": """
SELECT c_nationkey, arg_max(c_acctbal, (abs(c_acctbal), c_acctbal)) AS balance,
       arg_max(shifted, (abs(shifted), shifted)) AS shifted
FROM (SELECT *, trunc(c_acctbal - 5000)::INTEGER AS shifted FROM customer) GROUP BY 1""",
    "rollup": _sql_rollup(),
    "collect_join_string": """
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities,
       string_agg(DISTINCT o_orderstatus || ':' || o_orderpriority, ';' ORDER BY o_orderstatus || ':' || o_orderpriority) AS merged
FROM orders GROUP BY 1""",
    "extreme_join": f"""
WITH {SQL_GRADED}
SELECT graded.* FROM graded JOIN (
  SELECT o_custkey, max(grade) AS g, min(o_orderpriority) AS p FROM graded GROUP BY 1) e
ON graded.o_custkey = e.o_custkey AND grade = g AND o_orderpriority = p""",
    "argmax_rows": f"""
WITH {SQL_GRADED}
SELECT * FROM graded QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY grade DESC, o_orderpriority, o_orderkey) = 1""",
    "key_histogram": """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL ORDER BY count DESC, 1, 2""",
    "check_unique": """
SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem""",
    "distinct_count": """
SELECT count(*) AS rows, count(DISTINCT l_partkey) AS parts, max(l_extendedprice) AS highest,
       min(l_extendedprice) AS lowest FROM lineitem""",
    "sample_rows": f"SELECT * FROM part ORDER BY md5(p_partkey || '|{SEED}'), p_partkey LIMIT 10",
    "row_metrics": """
SELECT 'scanned' AS place, 'rows' AS metric, count(*)::DOUBLE AS value FROM lineitem
UNION ALL SELECT 'scanned', 'quantity', sum(l_quantity)::DOUBLE FROM lineitem
UNION ALL SELECT 'kept', 'rows', count(*)::DOUBLE FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT 'kept', 'last_line', max(l_linenumber)::DOUBLE FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT 'result', 'rows', count(DISTINCT (l_suppkey, l_linestatus))::DOUBLE FROM lineitem WHERE l_returnflag <> 'R'""",
    "enrich_stored": SQL_STORED,
    "checked_cells": SQL_CHECKED,
}

assert set(KEY_NAMES) == set(HG19)

"""Program output, differences, structure distances, annotations and piping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.functions import pair_distance, tree_distance
from basewise.operators import attach_wildtype, deltas, parse_annotations, pipe_batches, to_tool_records
from basewise.operators.pipe import PDIST_INPUT
from basewise.operators.skew import deal_out
from basewise.sources import parse_coverage, parse_distance, parse_fold, parse_pdist
from basewise.sources.tool_output import FOLD_SCORES, FOLD_STRUCTURES
from catalog.derive import SQL_SEQUENCES, sequences, table, text

# A stand-in for a distance program: reads records of a key line and two sequences, writes the
# key and the number of places at which the sequences differ.
HAMMING = """
import sys
for record in sys.stdin.read().split(">")[1:]:
    key, a, b = record.split()
    print(">" + key)
    print(sum(x != y for x, y in zip(a, b)))
"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name", "p_brand", "p_type")


def _numbers() -> dict[str, Column]:
    """Score texts made of a part's key and size; the SQL twin is ``SQL_NUMBERS``."""
    key, size = F.col("p_partkey"), F.col("p_size")
    cents = F.lpad(text(key % 100), 2, "0")
    return {
        "mfeValue": F.concat(F.lit("-"), text(size), F.lit("."), cents),
        "efeValue": F.concat(F.lit("-"), text(size + 1), F.lit("."), cents),
        "meafeValue": F.concat(text(size), F.lit(".5")),
        "meaValue": F.concat(text(key % 97), F.lit(".25")),
        "cfeValue": F.concat(F.lit("-"), text(key % 50), F.lit("."), cents),
        "cdValue": F.concat(F.lit("."), cents),
        "freqMfeEnsemble": F.concat(text(key % 9 + 1), F.lit(".2e-05")),
        "endValue": text(size * 3),
    }


SQL_NUMBERS = """
numbers AS (
  SELECT *, '-' || p_size || '.' || cents AS mfeValue, '-' || (p_size + 1) || '.' || cents AS efeValue,
         p_size || '.5' AS meafeValue, (p_partkey % 97) || '.25' AS meaValue,
         '-' || (p_partkey % 50) || '.' || cents AS cfeValue, '.' || cents AS cdValue,
         (p_partkey % 9 + 1) || '.2e-05' AS freqMfeEnsemble, (p_size * 3)::VARCHAR AS endValue
  FROM (SELECT *, lpad((p_partkey % 100)::VARCHAR, 2, '0') AS cents FROM part)),
shapes AS (
  SELECT *, repeat('(', p_size) || '...' || repeat(')', p_size) AS mfeStructure,
         repeat('{', p_size) || ',|,' || repeat('}', p_size) AS efeStructure,
         repeat('.', p_size) || '(...)' AS meafeStructure, repeat('.', p_size + 3) AS cfeStructure
  FROM numbers)"""


def _structures() -> dict[str, Column]:
    size = F.col("p_size")

    def run(char: str) -> Column:
        return F.repeat(F.lit(char), size)

    return {
        "mfeStructure": F.concat(run("("), F.lit("..."), run(")")),
        "efeStructure": F.concat(run("{"), F.lit(",|,"), run("}")),
        "meafeStructure": F.concat(run("."), F.lit("(...)")),
        "cfeStructure": F.concat(run("."), F.lit("...")),
    }


def _key(sep: str, *more: Column) -> Column:
    fixed = [F.concat(F.lit("NM_"), text(F.col("p_partkey"))), text(F.col("p_size")), F.lit("C"), F.lit("A")]
    return F.concat_ws(sep, *fixed, *more)


def fold_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-line fold records; the frequency has an exponent."""
    n, s = _numbers(), _structures()
    lines = [
        _key("|", F.col("p_type"), F.when(F.col("p_size") % 2 == 0, "true").otherwise("false")),
        F.lit("AUCG"),
        F.concat(s["mfeStructure"], F.lit(" ("), n["mfeValue"], F.lit(")")),
        F.concat(s["efeStructure"], F.lit(" ["), n["efeValue"], F.lit("]")),
        F.concat(s["cfeStructure"], F.lit(" {"), n["cfeValue"], F.lit(" d="), n["cdValue"], F.lit("}")),
        F.concat(s["meafeStructure"], F.lit(" {"), n["meafeValue"], F.lit(" MEA="), n["meaValue"], F.lit("}")),
        F.concat(
            F.lit(" frequency of mfe structure in ensemble "), n["freqMfeEnsemble"],
            F.lit("; ensemble diversity "), n["endValue"], F.lit("  "),
        ),
    ]
    return parse_fold(_parts(spark, sf_dir).select(F.concat_ws("\n", *lines).alias("value")))


def _as_double(names: tuple[str, ...]) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in names)


def distance_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-line distance records whose key echoes 31 fields."""
    n, s = _numbers(), _structures()
    scores = [n[c] for c in FOLD_SCORES] + [s[c] for c in FOLD_STRUCTURES]
    baseline = [n["efeValue"], *[n[c] for c in FOLD_SCORES[1:]]] + [s[c] for c in FOLD_STRUCTURES]
    key = _key("#", F.col("p_type"), F.col("p_brand").substr(7, 5), *scores, F.lit("false"), *baseline)
    size = F.col("p_size")
    rest = [F.concat(F.lit("f: "), text(v), F.lit("  ")) for v in (size, size * 2, F.col("p_partkey") % 7)]
    return parse_distance(_parts(spark, sf_dir).select(F.concat_ws("\n", key, *rest).alias("value")))


def pdist_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile-distance records."""
    key = _key("|", F.col("p_type"), F.lit("ACGT"))
    return parse_pdist(_parts(spark, sf_dir).select(F.concat(key, F.lit("\n"), _numbers()["meaValue"], F.lit(" \n")).alias("value")))


def coverage_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage lines with a comment line per hundred."""
    key = F.col("p_partkey")
    chrom = F.when(key % 24 == 22, "X").when(key % 24 == 23, "Y").otherwise(text(key % 24 + 1))
    line = F.concat_ws(
        "\t", chrom, text(key * 10), *[F.lit("1.0")] * 6, F.concat(F.lit("0."), text(F.col("p_size"))), F.lit("0")
    )
    return parse_coverage(_parts(spark, sf_dir).select(F.when(key % 100 == 0, "#chrom pos").otherwise(line).alias("value")))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alternates of their part's wildtype."""
    line = table(spark, sf_dir, "lineitem").drop("l_shipdate", "l_returnflag", "l_linestatus")
    part = table(spark, sf_dir, "part")
    price, sevenths = F.col("l_extendedprice"), F.col("l_extendedprice") / 7
    alternates = line.select(
        F.col("l_partkey").alias("nm_id"), (F.col("l_partkey") % 100).alias("transcript_position"), "l_orderkey",
        "l_linenumber", price.alias("mfeValue"), sevenths.alias("efeValue"), (-sevenths).alias("meafeValue"),
        F.col("l_discount").alias("cfeValue"), F.col("l_tax").alias("cdValue"), F.col("l_quantity").alias("endValue"),
    )
    retail = F.col("p_retailprice")
    wildtypes = part.select(
        F.col("p_partkey").alias("nm_id"), (F.col("p_partkey") % 100).alias("transcript_position"),
        retail.alias("mfeValue"), (retail / 7).alias("efeValue"), (-retail / 7).alias("meafeValue"),
        (retail / 700).alias("cfeValue"), (retail / 1300).alias("cdValue"), F.col("p_size").cast("double").alias("endValue"),
    )
    scores = ("mfeValue", "efeValue", "meafeValue", "cfeValue", "cdValue", "endValue")
    return attach_wildtype(alternates, wildtypes, columns=scores)


def wildtype_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternates with the wildtype's columns."""
    return _wide(spark, sf_dir).select("nm_id", "transcript_position", "l_orderkey", "l_linenumber", "mfeValue", "wt_mfeValue", "wt_endValue")


def delta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six two-decimal differences."""
    names = ("deltaMFE", "deltaEFE", "deltaMEAFE", "deltaCFE", "deltaEND", "deltaCD")
    return deltas(_wide(spark, sf_dir)).select("nm_id", "l_orderkey", "l_linenumber", *names)


SQL_WIDE = """
wide AS (
  SELECT l_partkey AS nm_id, l_partkey % 100 AS transcript_position, l_orderkey, l_linenumber,
         l_extendedprice AS mfe, l_extendedprice / 7 AS efe, -(l_extendedprice / 7) AS meafe, l_discount AS cfe,
         l_tax AS cd, l_quantity AS fin, p_retailprice AS w_mfe, p_retailprice / 7 AS w_efe, -p_retailprice / 7 AS w_meafe,
         p_retailprice / 700 AS w_cfe, p_retailprice / 1300 AS w_cd, p_size::DOUBLE AS w_fin
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _sql_delta(name: str, column: str) -> str:
    kind = "DECIMAL(18, 2)"
    return f"(round({column}, 2)::{kind} - round(w_{column}, 2)::{kind})::DOUBLE AS {name}"


SQL_DELTAS = ", ".join(
    _sql_delta(f"delta{c.upper() if c != 'fin' else 'END'}", c) for c in ("mfe", "efe", "meafe", "cfe", "fin", "cd")
)


def _bracket_pair() -> tuple[Column, Column]:
    """Two structures per part: helices of one part, changed in one of three ways."""
    a, b = F.col("p_size"), F.col("p_partkey") % 5 + 1

    def run(char: str, count: Column) -> Column:
        return F.repeat(F.lit(char), count.cast("int"))

    second_helix = F.concat(run("(", b), F.lit(".."), run(")", b))
    first = F.concat(run("(", a), F.lit("..."), run(")", a), second_helix)
    shorter = F.concat(run("(", a - 1), F.lit("....."), run(")", a - 1), second_helix)
    nested = F.concat(run("(", a + b), F.lit("....."), run(")", a + b))
    shifted = F.concat(F.lit("."), run("(", a), F.lit(".."), run(")", a), second_helix)
    second = F.when(F.col("p_partkey") % 3 == 0, shorter).when(F.col("p_partkey") % 3 == 1, nested).otherwise(shifted)
    return first, second


def pair_distance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base-pair distance of two structures per part."""
    first, second = _bracket_pair()
    pairs = _parts(spark, sf_dir).select("p_partkey", first.alias("first"), second.alias("second"))
    return pairs.select("p_partkey", pair_distance("first", "second").alias("distance"))


def tree_distance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree-edit distance of the same structures; SQL has no form of it."""
    first, second = _bracket_pair()
    pairs = deal_out(_parts(spark, sf_dir)).select("p_partkey", first.alias("first"), second.alias("second"))
    return pairs.select("p_partkey", "first", "second", tree_distance("first", "second").alias("distance"))


SQL_PAIR_DISTANCE = """
WITH texts AS (
  SELECT p_partkey, repeat('(', a) || '...' || repeat(')', a) || helix AS s1,
         CASE p_partkey % 3 WHEN 0 THEN repeat('(', a - 1) || '.....' || repeat(')', a - 1) || helix
              WHEN 1 THEN repeat('(', a + b) || '.....' || repeat(')', a + b)
              ELSE '.' || repeat('(', a) || '..' || repeat(')', a) || helix END AS s2
  FROM (SELECT p_partkey, p_size AS a, b, repeat('(', b) || '..' || repeat(')', b) AS helix
        FROM (SELECT *, p_partkey % 5 + 1 AS b FROM part))),
sides AS (SELECT p_partkey, 1 AS side, s1 AS s FROM texts UNION ALL SELECT p_partkey, 2, s2 FROM texts),
chars AS (SELECT p_partkey, side, i, substr(s, i, 1) AS c FROM (SELECT *, unnest(range(1, length(s) + 1)) AS i FROM sides)),
levels AS (
  SELECT *, sum(CASE c WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY p_partkey, side ORDER BY i)
            + CASE WHEN c = ')' THEN 1 ELSE 0 END AS depth
  FROM chars),
mates AS (
  SELECT p_partkey, side, c, i, lead(i) OVER (PARTITION BY p_partkey, side, depth ORDER BY i) AS j
  FROM levels WHERE c <> '.'),
pairs AS (SELECT p_partkey, side, i, j FROM mates WHERE c = '(')
SELECT p_partkey, coalesce(d, 0)::INTEGER AS distance
FROM part LEFT JOIN (
  SELECT p_partkey, count(*) AS d FROM (SELECT p_partkey, i, j FROM pairs GROUP BY ALL HAVING count(*) = 1) GROUP BY 1
) USING (p_partkey)"""


def piped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence pairs through an external program and back."""
    base = sequences(spark, sf_dir)
    rows = base.select(
        "nm_id", F.col("p_partkey").alias("transcript_position"), F.lit("A").alias("ref"), F.lit("C").alias("alt"),
        "sequence", F.reverse("sequence").alias("wildSequence"),
    )
    out = pipe_batches(to_tool_records(rows, **PDIST_INPUT), ["python3", "-c", HAMMING])
    return parse_pdist(out).select("nm_id", "transcript_position", "efeed")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INFO text with other transcripts, other feature types, missing fields and no annotation."""
    key, size = F.col("p_partkey"), F.col("p_size")
    own = F.concat(F.lit("NM_"), text(key))

    def entry(effect: Column, feature: str, name: Column, tail: Column) -> Column:
        cells = [F.lit("C"), effect, F.lit("LOW"), F.col("p_type"), F.col("p_brand"), F.lit(feature), name,
                 F.lit("protein_coding"), F.lit("3/4"), F.concat(F.lit("c."), text(size), F.lit("A>G"))]
        return F.concat(F.concat_ws("|", *cells), tail)

    full = F.concat(F.lit("|p.Gln"), text(size), F.lit("Arg|||"))
    info = F.concat(
        F.lit("ANN="),
        F.concat_ws(
            ",",
            entry(F.lit("other"), "transcript", F.concat(own, F.lit("9")), full),
            F.when(size % 3 == 0, entry(F.lit("motif"), "motif", own, full)),
            F.when(size % 4 != 0, entry(F.concat(F.lit("missense_"), text(size)), "transcript", own, F.when(size % 2 == 0, full).otherwise("||||"))),
            F.when(size % 5 == 0, entry(F.lit("second"), "transcript", own, full)),
        ),
    )
    rows = _parts(spark, sf_dir).select(own.alias("nm_id"), F.when(key % 11 == 0, ".").otherwise(info).alias("info"))
    return parse_annotations(rows).drop("info")


def _sql_entry(effect: str, feature: str, tail: str) -> str:
    cells = ["'C'", effect, "'LOW'", "p_type", "p_brand", f"'{feature}'", "own", "'protein_coding'", "'3/4'"]
    return " || ';' || ".join([*cells, "'c.' || p_size || 'A>G'"]) + f" || {tail}"


_TAIL = "';p.Gln' || p_size || 'Arg'"
SQL_ANNOTATIONS = f"""
WITH rows AS (
  SELECT *, 'NM_' || p_partkey AS own, p_partkey % 11 <> 0 AS noted, p_size % 3 = 0 AS motif, p_size % 4 <> 0 AS main,
         p_size % 5 = 0 AS extra FROM part),
picked AS (SELECT *, noted AND (main OR extra) AS found FROM rows)
SELECT own AS nm_id,
       CASE WHEN found THEN CASE WHEN main THEN 'missense_' || p_size ELSE 'second' END END AS snpeffAnnotation,
       CASE WHEN found THEN 'LOW' END AS snpeffPunativeImpact, CASE WHEN found THEN p_type END AS snpeffGeneName,
       CASE WHEN found THEN p_brand END AS snpeffGeneID,
       CASE WHEN found THEN 'protein_coding' END AS snpeffTranscriptBiotype,
       CASE WHEN found THEN 'c.' || p_size || 'A>G' END AS snpeffHGVSc,
       CASE WHEN found AND (p_size % 2 = 0 OR NOT main) THEN 'p.Gln' || p_size || 'Arg' END AS snpeffHGVSp,
       CASE WHEN noted THEN concat_ws(',',
            CASE WHEN motif THEN {_sql_entry("'motif'", "motif", _TAIL)} END,
            CASE WHEN main THEN {_sql_entry("'missense_' || p_size", "transcript", f"CASE WHEN p_size % 2 = 0 THEN {_TAIL} ELSE '' END")} END,
            CASE WHEN extra THEN {_sql_entry("'second'", "transcript", _TAIL)} END) ELSE '' END AS snpeffRaw
FROM picked"""

QUERIES = {
    "parse_fold": fold_parse,
    "parse_distance": distance_parse,
    "parse_pdist": pdist_parse,
    "parse_coverage": coverage_parse,
    "attach_wildtype": wildtype_attached,
    "deltas": delta_rows,
    "pair_distance": pair_distance_rows,
    "tree_distance": tree_distance_rows,
    "pipe_batches": piped,
    "parse_annotations": annotations,
}

_SHAPES = ", ".join(FOLD_STRUCTURES)
ORACLES = {
    "parse_fold": f"""
WITH {SQL_NUMBERS}
SELECT 'NM_' || p_partkey AS nm_id, p_size AS transcript_position, 'C' AS ref, 'A' AS alt, 'AUCG' AS sequence,
       p_type AS wildSequence, p_size % 2 = 0 AS isWildType, {_as_double(FOLD_SCORES)}, {_SHAPES} FROM shapes""",
    "parse_distance": f"""
WITH {SQL_NUMBERS}
SELECT 'NM_' || p_partkey AS nm_id, p_size AS transcript_position, 'C' AS ref, 'A' AS alt, p_type AS sequence,
       substr(p_brand, 7, 5) AS wildSequence, {_as_double(FOLD_SCORES)}, {_SHAPES}, efeValue::DOUBLE AS wt_mfeValue,
       {", ".join(f"{c}::DOUBLE AS wt_{c}" for c in FOLD_SCORES[1:])}, {", ".join(f"{c} AS wt_{c}" for c in FOLD_STRUCTURES)},
       p_size AS mfeed, p_size * 2 AS meaed, (p_partkey % 7)::INTEGER AS cfeed FROM shapes""",
    "parse_pdist": f"""
WITH {SQL_NUMBERS}
SELECT 'NM_' || p_partkey AS nm_id, p_size AS transcript_position, 'C' AS ref, 'A' AS alt, p_type AS sequence,
       'ACGT' AS wildSequence, meaValue::DOUBLE AS efeed FROM numbers""",
    "parse_coverage": """
SELECT (p_partkey % 24 + 1)::VARCHAR AS chromosome_id_hg19, (p_partkey * 10)::INTEGER AS position_hg19,
       ('0.' || p_size)::DOUBLE AS gnomAD_EX_coveragePercent FROM part WHERE p_partkey % 100 <> 0""",
    "attach_wildtype": f"""
WITH {SQL_WIDE}
SELECT nm_id, transcript_position, l_orderkey, l_linenumber, mfe AS mfeValue, w_mfe AS wt_mfeValue, w_fin AS wt_endValue FROM wide""",
    "deltas": f"WITH {SQL_WIDE} SELECT nm_id, l_orderkey, l_linenumber, {SQL_DELTAS} FROM wide",
    "pair_distance": SQL_PAIR_DISTANCE,
    "pipe_batches": f"""
WITH {SQL_SEQUENCES}
SELECT nm_id, p_partkey::INTEGER AS transcript_position, hamming(sequence, reverse(sequence))::DOUBLE AS efeed FROM seqs""",
    "parse_annotations": SQL_ANNOTATIONS,
}

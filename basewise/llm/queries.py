"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.llm import chat, common, fmindex, jaccard, langkernel, leaks, licenses, maintext, ngram, nnls, packing, pieces, resample, shingles, spelling, toxicity, warc
from basewise.llm.common import table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.read_back(chat.format_turns(turns.unionByName(planted))).withColumnRenamed("conversation", "conv_id")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return maintext.extract(table(spark, sf_dir, "pages"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document under the 32k merge vocabulary."""
    docs = table(spark, sf_dir, "documents")
    out = pieces.encode_texts(docs, public_tokenizers.path(PIECE_MODEL), outputs=("ids_sha256", "decoded_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("n_differ").alias("n_differ"))


def remainder(modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 % of their four-word shingles."""
    out = jaccard.link_documents(table(spark, sf_dir, "documents"), size=4, percent=85)
    return out.withColumnRenamed("component", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    out = toxicity.score(docs, table(spark, sf_dir, "labels"), train=~held_out)
    predicted = (F.col("_score") >= 0.5).cast("int").alias("predicted")
    return out.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), predicted)


def op6_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, read back and assembled to captures."""
    path = warc.scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_records(spark, path))
    fields = F.col("metadata.fields")
    revisit = F.col("response.type") == "revisit"
    return captures.select(
        fields["capture"].cast("long").alias("page_id"),
        F.when(revisit, fields["payload-bytes"].cast("long")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("response.claimed_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        fields["refers-to"].cast("long").alias("refers_to"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that stands in a document, with its edit distance."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    each = found.select("doc_id", F.explode("_leaks").alias("leak"))
    return each.select("doc_id", "leak.item_id", "leak.distance")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    out = langkernel.identify(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, perplexity and verdict of every document."""
    out = ngram.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep_text=False)
    return out.select(
        "doc_id",
        *[F.col(f"_stats.{c}").alias(c) for c in ngram.STATS],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.col("_log_ppl").alias("log_ppl"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words and the forms that they vary."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_MODEL))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark texts, and the draw."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_main_text": op2_main_text,
    "op3_pieces": op3_pieces,
    "op4_jaccard": op4_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_captures": op6_captures,
    "op7_licenses": op7_licenses,
    "op8_leaks": op8_leaks,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_packing": op12_packing,
    "op13_resample": op13_resample,
}

SQL_CAPTURES = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest AS d, min(page_id) AS f FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN f IS NOT NULL AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d AND payload_bytes >= 100
"""

SQL_CHAT = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(role) + length(text) + 20)::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars + CASE WHEN conv_id = -1 THEN 6 ELSE 0 END AS formatted_chars,
  CASE WHEN conv_id = -1 THEN 2 ELSE 0 END::BIGINT AS n_escaped
FROM g
"""



def sql_list(values: list[str]) -> str:
    """A SQL list of texts."""
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def sql_licenses() -> str:
    """The license scan with list functions, every template against every line."""
    hits = " UNION ALL ".join(
        f"SELECT r, pos, '{label}' AS label FROM n WHERE "
        + " AND ".join(f"w{k} = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in licenses.PHRASES.items()
    )
    longest = max(len(phrase.split()) for phrase in licenses.PHRASES)
    leads = ", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(longest))
    templates = ", ".join(f"('{label}', {sql_list(sorted(set(text.split())))})" for label, text in licenses.TEMPLATES)
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    lower = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    return f"""
WITH d AS (SELECT doc_id, {lower} AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT doc_id, r, regexp_extract_all(t, {word}) AS w FROM d),
u AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w),
n AS (SELECT r, pos, {leads} FROM u WINDOW o AS (PARTITION BY r ORDER BY pos)),
h AS ({hits}),
b AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base FROM h GROUP BY r),
lines AS (SELECT r, list_distinct(regexp_extract_all(line, {word})) AS words FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)),
t(label, words) AS (VALUES {templates}),
m AS (
  SELECT r, label, len(list_intersect(lines.words, t.words)) / len(t.words) AS c
  FROM lines, t WHERE list_has_any(lines.words, t.words)
    AND len(list_intersect(lines.words, t.words)) >= ceil({licenses.THRESHOLD} * len(t.words) - 1e-9)
),
best AS (SELECT r, list(DISTINCT label) AS found, max(c) AS c FROM m GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(base, []) || coalesce(found, []))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN best USING (r)
"""


def sql_crc32(text: str) -> str:
    """The unsigned checksum of a text's UTF-8 bytes; the single row of ``crc_table`` must be joined."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    values = f"list_transform(range(strlen({text})), lambda i: {byte})"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), {step}), 4294967295)"


# The table of the reflected polynomial, by rule: eight halving steps a byte.
SQL_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc)"""

SQL_SPELLING = f"""
WITH RECURSIVE {SQL_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{licenses.UPPER}', '{licenses.LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
marked AS (SELECT run, k, {sql_crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
shorter AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS m FROM shorter a JOIN shorter b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, near)) AS near FROM pairs GROUP BY word),
out AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS onward FROM out
  UNION ALL SELECT walk.word, walk.onward, out.form FROM walk JOIN out ON out.word = walk.onward)
SELECT out.word, form, root, n, n_near, form_n FROM out JOIN walk ON walk.word = out.word AND walk.onward IS NULL
"""

def sql_features(name: str) -> str:
    """All features of a table's texts as lists, one row per text."""
    lower = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    return f"""SELECT *, w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS features
  FROM (SELECT *, regexp_extract_all({lower}, {SQL_WORD}) AS w FROM {name})"""


SQL_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SQL_RESAMPLE = f"""
WITH {SQL_CRC_TABLE},
docs AS MATERIALIZED ({sql_features("documents")}),
used AS MATERIALIZED (SELECT doc_id, feature, count(*) AS k FROM (SELECT doc_id, unnest(features) AS feature FROM docs) GROUP BY ALL),
wanted AS MATERIALIZED (SELECT unnest(features) AS feature FROM ({sql_features("benchmark")})),
numbered AS MATERIALIZED (
  SELECT feature, {sql_crc32("feature")} % 10000 AS bucket
  FROM (SELECT feature FROM used UNION SELECT feature FROM wanted), crc_table),
s AS (SELECT bucket, sum(k) AS s FROM used JOIN numbered USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN numbered USING (feature) GROUP BY bucket),
both_totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (all_t + 10000))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket), both_totals),
weights AS (SELECT doc_id, sum(k * gain)::BIGINT AS weight FROM used JOIN numbered USING (feature) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w) AS n_words, len(features) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLES: dict[str, str] = {"op7_licenses": sql_licenses(), "op1_chat": SQL_CHAT, "op6_captures": SQL_CAPTURES, "op11_spelling": SQL_SPELLING, "op13_resample": SQL_RESAMPLE}

# Modules with code for Python workers; they travel with the plan, so that a
# session which was started elsewhere needs no package on its executors.
WORKERS = (chat, common, fmindex, jaccard, langkernel, leaks, maintext, ngram, nnls, packing, pieces, resample, shingles, spelling, toxicity, warc)


def ship_workers() -> None:
    """Pickle the workers' modules by value from now on."""
    for module in WORKERS:
        cloudpickle.register_pickle_by_value(module)

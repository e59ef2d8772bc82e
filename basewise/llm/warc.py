"""WARC archives of captured pages: write them with Spark, read them back, assemble captures.

A capture is four records: a ``request``, a ``response`` (or ``revisit``), and a
``metadata`` record, the first and the last naming the response in
``WARC-Concurrent-To``. Records are rows of Spark's text writer, whose line
separator is the two line ends that close a WARC record; each part file is one
archive, compressed as a whole. The reader streams lines and takes every block
by its ``Content-Length``, so blocks may hold any text, blank lines and record
headers included, and no task holds more than one record.

Of captures with equal payloads of at least ``smallest`` bytes the one of the
smallest id holds the payload, the others are revisits that refer to it; shorter
payloads are always kept. Null payloads count as empty, null urls give an empty
target. Rows with a null id are not archived, each row of a repeated id gives a
capture of its own, an empty table gives no captures. Only the named columns are
read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basewise.llm.common import ensure_checkpoint_dir
from basewise.operators.skew import PLACE, splittable

END = "\r\n"
SMALLEST = 100
VERSION = "WARC/1.1"


def payload_table(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Id, url, payload, its bytes and digest."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", " ").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
    )


def with_originals(table: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """Adds ``original``: the smallest id of an equal payload, the own id if it is short."""
    first = (
        table.where(F.col("bytes") >= smallest)
        .groupBy(F.col("digest").alias("digest_r"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    left, right, condition = splittable(table, first, [("digest", "digest_r")])
    joined = left.join(right, condition, "left")
    original = F.when((F.col("bytes") >= smallest) & F.col("first").isNotNull(), F.col("first")).otherwise(F.col("id"))
    return joined.withColumn("original", original).drop(PLACE, PLACE + "r", "digest_r", "first")


def record_id(kind: str, key: Column) -> Column:
    """A record's identifier, made from its kind, capture and payload."""
    name = F.sha2(F.concat(F.lit(kind), F.lit(":"), key.cast("string"), F.lit(":"), F.col("digest")), 256)
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(kind: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of a record without the two line ends that close it. Null headers are left out."""
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(name + ": "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def records(table: DataFrame, date: str) -> DataFrame:
    """The records of each capture, one text column, request first."""
    own, is_revisit = record_id("response", F.col("id")), F.col("original") != F.col("id")
    when = ("WARC-Date", F.lit(date))
    target = ("WARC-Target-URI", F.col("url"))
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    head = F.lit(END.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "", ""]))
    request_block = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1" + END + "Host: "), host, F.lit(END + END))
    made = [
        record(
            F.lit("request"),
            [("WARC-Record-ID", record_id("request", F.col("id"))), when, target, ("WARC-Concurrent-To", own)],
            request_block,
        ),
        record(
            F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
            [
                ("WARC-Record-ID", own),
                when,
                target,
                ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
                ("WARC-Refers-To", F.when(is_revisit, record_id("response", F.col("original")))),
                ("Content-Type", F.lit("application/http; msgtype=response")),
            ],
            F.when(is_revisit, head).otherwise(F.concat(head, F.col("payload"))),
        ),
        record(
            F.lit("metadata"),
            [("WARC-Record-ID", record_id("metadata", F.col("id"))), when, target, ("WARC-Concurrent-To", own)],
            F.concat(
                F.lit("capture: "), F.col("id").cast("string"), F.lit(END + "payload-bytes: "), F.col("bytes").cast("string"),
                F.when(is_revisit, F.concat(F.lit(END + "refers-to: "), F.col("original").cast("string"))).otherwise(F.lit("")),
                F.lit(END),
            ),
        ),
    ]
    return table.select(F.explode(F.array(*made)).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    smallest: int = SMALLEST,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one compressed archive per task to ``path``, which must not exist."""
    table = with_originals(payload_table(pages, key, url, payload), smallest)
    records(table, date).write.option("lineSep", END + END).option("compression", "gzip").text(path)


RECORD_SCHEMA = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, date string,"
    " claimed_digest string, payload_bytes long, payload_digest string, fields map<string, string>, payload string"
)


def parse_records(lines: Iterator[str], keep_payload: bool) -> Iterator[tuple]:
    """Records from lines that were cut at ``END``."""
    for line in lines:
        if line != VERSION:
            if line:
                raise ValueError(f"a record should begin here: {line[:80]!r}")
            continue
        headers: dict[str, str] = {}
        for line in lines:
            if not line:
                break
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        left = int(headers["content-length"])
        parts: list[bytes] = []
        size = -len(END)
        while size < left:
            part = next(lines).encode()
            parts.append(part)
            size += len(part) + len(END)
        block = END.encode().join(parts)
        if len(block) != left:
            raise ValueError(f"a block of {left} bytes has {len(block)}")
        yield _row(headers, block, keep_payload)


def _row(headers: dict[str, str], block: bytes, keep_payload: bool) -> tuple:
    kind = headers.get("warc-type", "")
    fields: dict[str, str] = {}
    body = block
    if kind in ("response", "revisit", "request"):
        body = block.partition(2 * END.encode())[2]
    elif kind == "metadata":
        for line in block.decode().split(END):
            name, sep, value = line.partition(":")
            if sep:
                fields[name.strip()] = value.strip()
    return (
        kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
        headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        len(body), hashlib.sha256(body).hexdigest(), list(fields.items()), body.decode() if keep_payload and kind == "response" else None,
    )


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of all archives under ``path`` (see ``RECORD_SCHEMA``)."""
    names = [part.split()[0] for part in RECORD_SCHEMA.replace("map<string, string>", "map").split(",")]
    kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for batch in batches for line in batch.column(0).to_pylist())
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for row in parse_records(lines, payloads):
            rows.append(row)
            size += len(row[-1] or "")
            if len(rows) >= 5_000 or size > 8_000_000:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()

    # A compressed file is never split, so a task sees whole archives in order.
    return spark.read.option("lineSep", END).text(path).mapInArrow(work, RECORD_SCHEMA)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), ``request`` and ``metadata``, joined by ``WARC-Concurrent-To``.

    Records without their partner stay, with null for what is missing; of several
    equal partners the one of the smallest record id counts.
    """
    capture = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.col("concurrent_to"))
    whole = F.struct(*[c for c in found.columns])
    parts = found.where(F.col("type").isin("response", "revisit", "request", "metadata")).select(capture.alias("capture"), "type", whole.alias("record"))

    def side(name: str, *kinds: str) -> DataFrame:
        return parts.where(F.col("type").isin(*kinds)).select("capture", F.col("record").alias(name))

    def one(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("capture").agg(F.min_by(name, F.col(f"{name}.record_id")).alias(name))

    answers = side("response", "response", "revisit")
    extras = [one(side(name, name), name) for name in ("request", "metadata")]
    return answers.join(extras[0], "capture", "full").join(extras[1], "capture", "full")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

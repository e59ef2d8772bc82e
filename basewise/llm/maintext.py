"""Main text of web pages by differencing pages of near URLs.

Every page is read once as text blocks (lines) with their place in the markup, and
kept in the shared folder. Pages of one host are sorted by URL path and each is paired
with the page before and the page behind it; pages of one content in a row count as
one page. The lines of a pair are aligned by their longest common subsequence, and
shared lines are deleted as the site's template.

All lines of a page take part in the alignment. Copies of an article and passages
that several articles quote are shared lines as well, and some template lines
differ between any two neighbours. So three rules frame the deletion: a line
inside an ``article`` or ``main`` element is not deleted as shared; a pair that
shares more than half of the larger page's text (menus and the like apart) is a pair
of copies and says nothing about the template; and of the lines that differencing
leaves, those under markup that names its role (menus, headers and footers of the
page, sidebars, notices, adverts, forms, comments) go as well. :func:`deleted_lines`
counts the lines that go either way.

Only lines outside articles and without such a name can be kept or deleted by what
neighbours share, so only pages that have some are joined with their shared lines.

Null pages give empty text, null URLs form a host of their own, repeated rows are
one page for differencing, null ids stay, an empty table gives none. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import settle
from basewise.llm.warc import scratch_path
from basewise.operators.skew import PLACE, splittable

# Element names of HTML.
SILENT = frozenset("script style noscript template button select textarea iframe svg canvas object head title".split())
LABELLED = frozenset("nav aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT = frozenset(("article", "main"))
# A start tag that ends an open paragraph.
CLOSES_P = BLOCKS - {"br"}
ROLE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|sponsor(?:ed)?|promo|cookies?|consent|notices?|newsletter|subscribe|popup|modal"
    r"|navbar|nav|menu|breadcrumbs?|sidebar|widget|footer|masthead|site-?header|comments?|disqus|replies|share|social|related|login|search|pagination|pager)(?:$|[\s_-])",
    re.IGNORECASE,
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Cells of the largest alignment table; larger ones are halved.
TABLE = 4_000_000
SPACE = re.compile(r"\s+")


# Kinds of lines.
ARTICLE, PLAIN, FURNITURE = "apf"


class Blocks(HTMLParser):
    """Collects text blocks and their kinds."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        # Open elements: tag, whether it silences its text, whether it is labelled as furniture.
        self.open: list[tuple[str, bool, bool]] = []
        self.text: list[str] = []
        self.silent = self.labelled = self.content = 0

    def end_block(self) -> None:
        """Close the current block."""
        text = SPACE.sub(" ", "".join(self.text)).strip()
        self.text = []
        if text:
            self.blocks.append((text, FURNITURE if self.labelled else ARTICLE if self.content else PLAIN))

    def is_labelled(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Whether the markup says that the element is not main text."""
        if tag in LABELLED:
            return True
        if tag in ("header", "footer"):
            return not self.content
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            if name in ("class", "id") and ROLE.search(value or ""):
                return True
            if name == "role" and (value or "").lower() in ROLES:
                return True
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """Open an element."""
        if tag in BLOCKS:
            self.end_block()
        if tag in VOID:
            return
        if tag in CLOSES_P and any(t == "p" for t, _, _ in self.open[-8:]):
            # A block ends the paragraph before it, unless something else was opened inside.
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in BLOCKS:
                    if self.open[i][0] == "p":
                        self.close_to(i)
                    break
        labelled = self.is_labelled(tag, attrs)
        # Furniture inside a line is left out of it without cutting the line.
        silent = tag in SILENT or (labelled and tag not in BLOCKS)
        self.silent += silent
        self.labelled += labelled
        self.content += tag in CONTENT
        self.open.append((tag, silent, labelled))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """An element that is closed at once (the slash means nothing on other elements than void ones)."""
        self.handle_starttag(tag, attrs)

    def close_to(self, index: int) -> None:
        """Close all elements from ``index`` on."""
        for tag, silent, labelled in self.open[index:]:
            self.silent -= silent
            self.labelled -= labelled
            self.content -= tag in CONTENT
        del self.open[index:]

    def handle_endtag(self, tag: str) -> None:
        """Close an element and whatever is still open in it."""
        if tag in BLOCKS:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_to(i)
                return
            if tag not in BLOCKS and self.open[i][0] in BLOCKS and self.open[i][0] not in ("p",):
                return

    def handle_data(self, data: str) -> None:
        """Text of the current block."""
        if not self.silent:
            self.text.append(data)


def blocks_of(html: str | None) -> list[tuple[str, str]]:
    """Text blocks of a page in order, each with its kind."""
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.blocks


def digest(text: str) -> int:
    """64-bit hash of a line."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def shared_lines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Positions in ``left`` of a longest common subsequence of two arrays of line hashes."""
    keep_left, keep_right = np.isin(left, right), np.isin(right, left)
    a, b = left[keep_left], right[keep_right]
    places = np.flatnonzero(keep_left)
    size = min(len(a), len(b))
    differs = np.flatnonzero(a[:size] != b[:size])
    front = int(differs[0]) if len(differs) else size
    differs = np.flatnonzero(a[len(a) - size + front :][::-1] != b[len(b) - size + front :][::-1])
    back = int(differs[0]) if len(differs) else size - front
    inner = lcs_inside(a[front : len(a) - back], b[front : len(b) - back])
    return places[np.concatenate((np.arange(front), inner + front, np.arange(len(a) - back, len(a)))).astype(np.int64)]


def prefix_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.where(b == x, row[:-1] + 1, row[1:]))
    return row


def lcs_inside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions in ``a`` of a longest common subsequence.

    Where the table would be large, ``a`` is cut in half and ``b`` where the two
    halves' lengths add up to the most, so memory grows with the lines, not with
    their product.
    """
    if not len(a) or not len(b):
        return np.empty(0, dtype=np.int64)
    if len(a) * len(b) > TABLE and len(a) > 1:
        half = len(a) // 2
        cut = int(np.argmax(prefix_lengths(a[:half], b) + prefix_lengths(a[half:][::-1], b[::-1])[::-1]))
        return np.concatenate((lcs_inside(a[:half], b[:cut]), lcs_inside(a[half:], b[cut:]) + half))
    # Rows of the usual table, filled by whole rows: best[i, j] for a[i:] and b[j:].
    best = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for i in range(len(a) - 1, -1, -1):
        take = np.where(b == a[i], best[i + 1, 1:] + 1, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(take[::-1])[::-1]
    found, i, j = [], 0, 0
    while i < len(a) and j < len(b) and best[i, j]:
        if a[i] == b[j] and best[i, j] == best[i + 1, j + 1] + 1:
            found.append(i)
            i, j = i + 1, j + 1
        elif best[i + 1, j] == best[i, j]:
            i += 1
        else:
            j += 1
    return np.array(found, dtype=np.int64)


SIGNED = ("host", "path", "content", "lines", "sizes")


def parse_pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Per row: id, url, host and path, the page's digest, its lines as hashes, sizes and kinds, and the texts of all but furniture."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^#]*)", 1)
    narrow = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lines, sizes, kinds, texts = [], [], [], [], []
            for page in batch.column(4).to_pylist():
                found = blocks_of(page)
                names.append(digest(page or ""))
                lines.append(np.array([digest(t) for t, _ in found], dtype="<i8").tobytes())
                # Furniture counts for nothing when copies are told from neighbours.
                sizes.append(np.array([0 if k == FURNITURE else len(t) for t, k in found], dtype="<i4").tobytes())
                kinds.append("".join(k for _, k in found))
                texts.append([t for t, k in found if k != FURNITURE])
            columns = [*batch.columns[:4], pa.array(names, pa.int64()), pa.array(lines, pa.binary()), pa.array(sizes, pa.binary())]
            columns += [pa.array(kinds, pa.string()), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["page", "url", *SIGNED, "kinds", "texts"])

    kind = narrow.schema["page"].dataType.simpleString()
    return narrow.mapInArrow(
        work, f"page {kind}, url string, host string, path string, content long, lines binary, sizes binary, kinds string, texts array<string>"
    )


def pair_lines(a: tuple, b: tuple) -> bytes:
    """Hashes of the lines that two pages of one host share in order; none if they are copies."""
    if a[0] != b[0] or a[2] == b[2]:
        return b""
    left, right = (np.frombuffer(x[3], dtype="<i8") for x in (a, b))
    at = shared_lines(left, right)
    sizes = [np.frombuffer(x[4], dtype="<i4").sum() for x in (a, b)]
    common = np.frombuffer(a[4], dtype="<i4")[at].sum()
    return b"" if common * 2 > max(sizes) else left[at].tobytes()


def found_batch(found: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    """Rows of host, content and shared lines."""
    kinds = (pa.string(), pa.int64(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["host", "content", "shared"])


def shared_with_neighbours(signed: DataFrame) -> DataFrame:
    """Per host and page content the hashes of lines that the nearest page before or behind it shares in order.

    Pages are sorted over all tasks by ranges of (host, path, content), so that a
    host of any size is spread; the first and last page of each range are paired
    in a second, small step.
    """
    order = ("host", "path", "content")
    ordered = settle(signed.repartitionByRange(*order).sortWithinPartitions(*order))
    schema = "host string, content long, shared binary"

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out: list[tuple] = []
            for row in rows(batch):
                if before is not None and (shared := pair_lines(before, row)):
                    out += [(x[0], x[2], shared) for x in (before, row)]
                before = row
            if out:
                yield found_batch(out)

    inner = ordered.mapInArrow(neighbours, schema)
    # Two rows per range at most, whatever the size of the table.
    part = F.spark_partition_id().alias("part")
    edges = ordered.withColumn("part", part).withColumn("place", F.monotonically_increasing_id())
    ends = edges.groupBy("part").agg(*(f(F.struct("place", *SIGNED)).alias(n) for f, n in ((F.min, "first"), (F.max, "last"))))
    both = ends.select("part", F.explode(F.array("first", "last")).alias("end")).select("part", "end.*").distinct()
    followed = Window.partitionBy(F.lit(0)).orderBy("place")
    behind = both.withColumn("behind", F.lead(F.struct("part", *SIGNED)).over(followed)).where("behind.part != part")
    crossing = behind.select(*SIGNED, *[F.col(f"behind.{c}").alias(f"{c}_b") for c in SIGNED])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows(batch):
                a, b = row[: len(SIGNED)], row[len(SIGNED) :]
                if shared := pair_lines(a, b):
                    out += [(x[0], x[2], shared) for x in (a, b)]
            if out:
                yield found_batch(out)

    return inner.unionByName(crossing.mapInArrow(cross, schema))


def stored_pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """The parsed pages, written to the shared folder once and read again."""
    spark = pages.sparkSession
    kept = scratch_path(spark, "pages")
    parsed = parse_pages(pages, key, url, html)
    parsed.write.option("compression", "zstd").parquet(kept)
    return spark.read.schema(parsed.schema).parquet(kept)


def with_template(some: DataFrame, parsed: DataFrame) -> DataFrame:
    """``some`` parsed pages with ``shared``: lists of hashes of lines that a neighbour shares, null without any."""
    shared = shared_with_neighbours(parsed.where(F.octet_length("lines") > 0).select(*SIGNED))
    # One row per content and host; few have more than two lists.
    template = shared.groupBy(F.col("host").alias("h"), F.col("content").alias("c")).agg(F.collect_set("shared").alias("shared"))
    left, right, match = splittable(some, template, [("host", "h"), ("content", "c")])
    return left.join(right, match, "left").drop(PLACE, PLACE + "r", "h", "c")


def differenced(lines: bytes, kinds: str, shared: list[bytes] | None) -> list[bool]:
    """Which lines of a page go because a neighbour shares them."""
    gone = {h for part in shared or () for h in np.frombuffer(part, dtype="<i8").tolist()}
    return [k != ARTICLE and h in gone for k, h in zip(kinds, np.frombuffer(lines, dtype="<i8").tolist(), strict=True)]


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, url, ``text`` (kept blocks joined by a line end) and ``n_chars``."""
    parsed = stored_pages(pages, key, url, html)
    kind = parsed.schema["page"].dataType.simpleString()
    open_lines = F.contains("kinds", F.lit(PLAIN))
    undecided = with_template(parsed.where(open_lines).select("page", "url", "host", "content", "lines", "kinds", "texts"), parsed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for lines, kinds, page, shared in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                gone = differenced(lines, kinds, shared)
                left = [g for g, k in zip(gone, kinds, strict=True) if k != FURNITURE]
                texts.append("\n".join(text for text, g in zip(page, left, strict=True) if not g))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "url", "text", "n_chars"])

    schema = f"`{key}` {kind}, url string, text string, n_chars long"
    decided = parsed.where(~open_lines).select(
        F.col("page").alias(key), "url", F.array_join("texts", "\n").alias("text")
    )
    decided = decided.withColumn("n_chars", F.length("text").cast("long"))
    return undecided.select("page", "url", "lines", "kinds", "texts", "shared").mapInArrow(work, schema).unionByName(decided)


def deleted_lines(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, ``n_differenced`` (lines that a neighbour shares) and ``n_marked`` (others, by their markup's name)."""
    parsed = stored_pages(pages, key, url, html)
    kind = parsed.schema["page"].dataType.simpleString()
    marked = with_template(parsed.select("page", "host", "content", "lines", "kinds"), parsed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for lines, kinds, shared in zip(*(batch.column(i).to_pylist() for i in range(1, 4)), strict=True):
                gone = differenced(lines, kinds, shared)
                both.append((sum(gone), sum(k == FURNITURE and not g for k, g in zip(kinds, gone, strict=True))))
            counts = [pa.array([b[i] for b in both], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts], [key, "n_differenced", "n_marked"])

    return marked.select("page", "lines", "kinds", "shared").mapInArrow(work, f"`{key}` {kind}, n_differenced long, n_marked long")

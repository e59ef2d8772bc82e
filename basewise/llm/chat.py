"""Chat formatting with a grammar that reads its own output back.

A conversation is the concatenation of its turns' segments; a segment is

    <s>[INST] role [/INST] text </s>

without the blanks. A backslash takes the meaning from a control string (or a
backslash) behind it. :func:`render` writes a turn with as little escaping as
will do: it parses what it wrote with :func:`parse`, compares role and text with
the source, and escapes the next class of conflicting content until they are
identical. The last level escapes every backslash and control string, which
always reads back.

Turns are sorted by (turn, role, text) within a conversation, nulls first, and
streamed, so that a conversation of any length needs the memory of one turn. Null
roles and texts count as empty; repeated rows are repeated turns; a null
conversation id is a conversation of its own; an empty table gives no rows. Only
the four named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
ESCAPE = "\\"
# Control strings of this template and of other common chat templates.
CONTROL = (BEGIN, END, OPEN, CLOSE, "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_ANY = "|".join(map(re.escape, CONTROL))
_CONTROL = re.compile(f"({_ANY})")
_CONFLICT = re.compile(rf"(\\|{_ANY})")
_ESCAPED = re.compile(rf"\\(\\|{_ANY})")
_SCAN = re.compile(rf"\\(?:\\|{_ANY})|{_ANY}")
LEVELS = 3


def escape(text: str, level: int) -> str:
    """0: as it is; 1: control strings get a backslash; 2: backslashes as well."""
    if level == 0:
        return text
    return (_CONTROL if level == 1 else _CONFLICT).sub(r"\\\1", text)


def parse(formatted: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """The turn that begins at ``at``: role, text, the text's place and length as written, and where the turn ends.

    None where no turn begins.
    """
    head = BEGIN + OPEN
    if not formatted.startswith(head, at):
        return None
    at += len(head)
    bounds = []
    start = at
    for want in (CLOSE, END):
        while True:
            found = _SCAN.search(formatted, at)
            if not found:
                return None
            at = found.end()
            if found[0][0] == ESCAPE:
                continue
            if found[0] != want:
                return None
            bounds.append((start, found.start()))
            start = at
            break
    (a, b), (c, d) = bounds
    return _ESCAPED.sub(r"\1", formatted[a:b]), _ESCAPED.sub(r"\1", formatted[c:d]), c, d - c, at


def render(role: str, text: str) -> tuple[str, int, int, int]:
    """A turn's segment, the text's place and length in it, and the level that was needed."""
    for level in range(LEVELS):
        segment = BEGIN + OPEN + escape(role, level) + CLOSE + escape(text, level) + END
        back = parse(segment)
        if back and back[:2] == (role, text) and back[4] == len(segment):
            return segment, back[2], back[3], level
    raise AssertionError("the last level always reads back")


SEGMENTS = "segment string, text_start int, text_length int, level int, trained boolean"


def format_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per turn, in order within each partition, which holds whole conversations.

    ``segment`` is the turn as written; its loss mask covers ``text_length``
    characters from ``text_start`` where ``trained``. The segments of a
    conversation, joined, are the formatted conversation (:func:`whole`).
    """
    # One sorted pass over the text; the columns get fixed names, so any others may clash.
    narrow = turns.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    placed = narrow.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            made = [render(r, t) for r, t in zip(roles, texts, strict=True)]
            columns = [batch.column(0), batch.column(1)]
            columns.append(pa.array([m[0] for m in made], pa.string()))
            columns += [pa.array([m[i] for m in made], pa.int32()) for i in (1, 2, 3)]
            columns.append(pa.array([r in trained for r in roles], pa.bool_()))
            names = ["conversation", "turn", "segment", "text_start", "text_length", "level", "trained"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"conversation {kinds['conversation']}, turn {kinds['turn']}, {SEGMENTS}"
    return placed.mapInArrow(work, schema)


def whole(segments: DataFrame) -> DataFrame:
    """One row per conversation with its text and loss spans (start, length).

    For conversations that fit one row (2 GB); :func:`format_turns` has no such bound.
    """
    parts = F.sort_array(F.collect_list(F.struct("turn", "segment", "text_start", "text_length", "trained")))
    ends = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda state, part: F.struct(
            (state["at"] + F.length(part["segment"])).alias("at"),
            F.when(
                part["trained"],
                F.concat(state["spans"], F.array(F.struct((state["at"] + part["text_start"]).alias("start"), part["text_length"].alias("length")))),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
    )
    grouped = segments.groupBy("conversation").agg(parts.alias("parts"))
    return grouped.select("conversation", F.array_join("parts.segment", "").alias("formatted"), ends["spans"].alias("loss_spans"))


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_escaped long"


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation the digests of what :func:`format_turns` wrote, read back from its segments.

    Needs the order and partitioning in which :func:`format_turns` returns its rows.
    """
    kind = segments.schema["conversation"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        out: list[tuple] = []

        def row() -> tuple:
            return (current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        names = ["conversation", *(c.split()[0] for c in DIGESTS.split(", "))]
        types = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            types[0] = batch.schema.field(0).type
            for key, segment, start, length, level, trained in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6)), strict=True):
                if current is None or current[0] != key:
                    if current is not None:
                        out.append(row())
                        if len(out) >= 10_000:
                            yield flush()
                            out = []
                    current, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text, *_ = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if trained:
                    masked = _ESCAPED.sub(r"\1", segment[start : start + length])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(segment)
                state[5] += level > 0
        if current is not None:
            out.append(row())
        if out:
            yield flush()

    return segments.mapInArrow(work, f"conversation {kind}, {DIGESTS}")

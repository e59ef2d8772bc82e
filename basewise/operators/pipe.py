"""Records through an external program that the user supplies."""

from __future__ import annotations

import subprocess
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.operators.skew import deal_out

# Key and sequence columns that the three kinds of program get, with their separators.
FOLD_INPUT = {
    "key_cols": ("nm_id", "transcript_position", "ref", "alt", "wildSequence", "isWildType"),
    "line_cols": ("sequence",),
    "sep": "|",
}
PDIST_INPUT = {
    "key_cols": ("nm_id", "transcript_position", "ref", "alt", "sequence", "wildSequence"),
    "line_cols": ("wildSequence", "sequence"),
    "sep": "|",
}
_SCORES = (
    "mfeValue", "efeValue", "meafeValue", "meaValue", "cfeValue", "cdValue", "freqMfeEnsemble", "endValue",
    "mfeStructure", "efeStructure", "meafeStructure", "cfeStructure",
)
DISTANCE_INPUT = {
    "key_cols": (
        "nm_id", "transcript_position", "ref", "alt", "sequence", "wildSequence",
        *_SCORES, "isWildType", *[f"wt_{c}" for c in _SCORES],
    ),
    "line_cols": (
        "wt_mfeStructure", "mfeStructure", "wt_meafeStructure", "meafeStructure", "wt_cfeStructure", "cfeStructure",
    ),
    "sep": "#",
}


def tool_record(key_cols: Sequence[str], line_cols: Sequence[str], sep: str = "|") -> Column:
    """``>key1|key2...`` and one line per ``line_cols`` entry, as one text value."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    key = F.concat(F.lit(">"), F.concat_ws(sep, *[text(c) for c in key_cols]))
    return F.concat_ws("\n", key, *[text(c) for c in line_cols])


def to_tool_records(
    df: DataFrame, key_cols: Sequence[str], line_cols: Sequence[str], sep: str = "|"
) -> DataFrame:
    """Rows -> ``value``: one multi-line record per row, ready for ``write.text`` or :func:`pipe_batches`."""
    return df.select(tool_record(key_cols, line_cols, sep).alias("value"))


def _run(command: Sequence[str], text: str, timeout: float | None) -> str:
    done = subprocess.run(list(command), input=text, capture_output=True, text=True, timeout=timeout, check=False)
    if done.returncode != 0:
        raise RuntimeError(f"{command[0]} ended with status {done.returncode}: {done.stderr[-2000:]}")
    return done.stdout


def pipe_batches(
    df: DataFrame,
    command: Sequence[str],
    records_per_run: int = 1000,
    record_start: str = ">",
    partitions: int | None = None,
    timeout: float | None = None,
) -> DataFrame:
    """Feed the ``value`` records to ``command`` and return its output records as ``value``.

    The program runs once per ``records_per_run`` records, reads them on
    standard input and writes records that begin with ``record_start`` (taken
    off in the result) on standard output, as the ``parse_*`` functions expect.
    Records are dealt out over ``partitions`` tasks (:func:`deal_out`), however few
    files they come from. Only one such batch is held at a time. A non-zero exit status fails the task.
    The program must be a pure function of its input, since lost tasks are run again.
    """
    command = list(command)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, records_per_run):
                records = batch.column(0).slice(begin, records_per_run).to_pylist()
                output = _run(command, "\n".join(records) + "\n", timeout)
                values = [part for part in output.split(record_start) if part.strip()]
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    return deal_out(df.select("value"), partitions).mapInArrow(run, "value string")

"""DataFrame-to-DataFrame operators."""

from basewise.operators.alleles import genome_text, left_align
from basewise.operators.annotations import parse_annotations
from basewise.operators.enrich import (
    coverage_flag,
    enrich,
    enrich_frequencies,
    enrich_prefixed,
    join_scores,
    prefix_columns,
)
from basewise.operators.intervals import disjoint_pieces, lookup, overlap_join
from basewise.operators.liftover import lift_positions
from basewise.operators.pipe import pipe_batches, to_tool_records
from basewise.operators.positions import aligned_length, linear_segments, map_positions
from basewise.operators.quality import (
    Progress,
    argmax_rows,
    check_unique,
    extreme_join,
    key_histogram,
    sample_rows,
    with_row_metrics,
)
from basewise.operators.rollup import rollup
from basewise.operators.scores import (
    attach_wildtype,
    deltas,
    drop_stale_scores,
    pair_distances,
    split_wildtype,
    tree_distances,
)
from basewise.operators.skew import hot_keys, salted_join
from basewise.operators.variants import alternates, variants, windows

from basewise.operators.settle import settle
from basewise.operators.stored import enrich_stored, store_by_key

__all__ = [
    "Progress",
    "aligned_length",
    "alternates",
    "argmax_rows",
    "attach_wildtype",
    "check_unique",
    "coverage_flag",
    "deltas",
    "disjoint_pieces",
    "drop_stale_scores",
    "enrich",
    "enrich_frequencies",
    "enrich_prefixed",
    "enrich_stored",
    "extreme_join",
    "genome_text",
    "hot_keys",
    "join_scores",
    "key_histogram",
    "left_align",
    "lift_positions",
    "linear_segments",
    "lookup",
    "map_positions",
    "overlap_join",
    "pair_distances",
    "parse_annotations",
    "pipe_batches",
    "prefix_columns",
    "rollup",
    "salted_join",
    "sample_rows",
    "settle",
    "split_wildtype",
    "store_by_key",
    "to_tool_records",
    "tree_distances",
    "variants",
    "windows",
    "with_row_metrics",
]

"""Column expressions; all but the two structure distances, which run in Arrow batches, stay inside the JVM."""

from basewise.functions.aggregates import joined_set, joined_values, signed_extreme
from basewise.functions.bases import (
    chrom_to_code,
    code_to_chrom,
    complement,
    contig_to_code,
    merge_key,
    replace_base,
    reverse_complement,
    with_chr_prefix,
)
from basewise.functions.numbers import number_list, rounded_difference, threshold_flag
from basewise.functions.structures import pair_distance
from basewise.functions.text import strip_control, trimmed_split
from basewise.functions.trees import tree_distance

__all__ = [
    "chrom_to_code",
    "code_to_chrom",
    "complement",
    "contig_to_code",
    "joined_set",
    "joined_values",
    "merge_key",
    "number_list",
    "pair_distance",
    "replace_base",
    "reverse_complement",
    "rounded_difference",
    "signed_extreme",
    "strip_control",
    "threshold_flag",
    "tree_distance",
    "trimmed_split",
    "with_chr_prefix",
]

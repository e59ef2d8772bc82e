"""Readers. Each returns a lazy DataFrame and leaves splitting of the input to Spark."""

from basewise.sources.alignments import parse_alignments, read_alignments
from basewise.sources.chains import parse_chain_lines, parse_chains, read_chain
from basewise.sources.checked import check_cells, numbered_lines, read_checked, rejected_cells
from basewise.sources.coverage import parse_coverage, read_coverage
from basewise.sources.fasta import parse_fasta, read_fasta
from basewise.sources.genome import read_genome_chunks
from basewise.sources.tables import read_constraint, read_id_map, read_parquet, read_tsv
from basewise.sources.tool_output import (
    parse_distance,
    parse_fold,
    parse_pdist,
    read_distance_output,
    read_fold_output,
    read_pdist_output,
)

__all__ = [
    "check_cells",
    "numbered_lines",
    "parse_alignments",
    "parse_chain_lines",
    "parse_chains",
    "parse_coverage",
    "parse_distance",
    "parse_fasta",
    "parse_fold",
    "parse_pdist",
    "read_alignments",
    "read_chain",
    "read_checked",
    "read_constraint",
    "read_coverage",
    "read_distance_output",
    "read_fasta",
    "read_fold_output",
    "read_genome_chunks",
    "read_id_map",
    "read_parquet",
    "read_pdist_output",
    "read_tsv",
    "rejected_cells",
]

"""Nucleotide letters, alleles and chromosome names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basewise.functions._columns import as_column

# The alternate alphabet, the complement table and the numeric
# codes that stand for the two sex chromosomes in every keyed table.
BASES = "ACGT"
COMPLEMENT_FROM = "ACGTN"
COMPLEMENT_TO = "TGCAN"
X_CODE = "23"
Y_CODE = "24"


def complement(base: Column | str) -> Column:
    """Complement of upper-case bases; anything outside ``ACGTN`` gives null."""
    base = as_column(base)
    leftover = F.translate(base, COMPLEMENT_FROM, "")
    return F.when(leftover == "", F.translate(base, COMPLEMENT_FROM, COMPLEMENT_TO))


def reverse_complement(bases: Column | str) -> Column:
    """Reverse complement that keeps case and leaves letters without a complement alone."""
    bases = as_column(bases)
    both_from = COMPLEMENT_FROM + COMPLEMENT_FROM.lower()
    both_to = COMPLEMENT_TO + COMPLEMENT_TO.lower()
    return F.reverse(F.translate(bases, both_from, both_to))


def replace_base(sequence: Column | str, index: Column, base: Column | str) -> Column:
    """``sequence`` with the character at the 0-based ``index`` replaced by ``base``."""
    return F.overlay(as_column(sequence), as_column(base), (index + 1).cast("int"), F.lit(1))


def chrom_to_code(chrom: Column | str) -> Column:
    """``X`` and ``Y`` as numeric codes, every other name unchanged."""
    chrom = as_column(chrom)
    return F.when(chrom == "X", X_CODE).when(chrom == "Y", Y_CODE).otherwise(chrom)


def code_to_chrom(code: Column | str) -> Column:
    """Inverse of :func:`chrom_to_code`."""
    code = as_column(code)
    return F.when(code == X_CODE, "X").when(code == Y_CODE, "Y").otherwise(code)


def with_chr_prefix(chrom: Column | str) -> Column:
    """Add ``chr`` in front unless it is there already."""
    chrom = as_column(chrom)
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def contig_to_code(contig: Column | str) -> Column:
    """``chrX``/``chrY`` as codes; otherwise the contig name without its first three letters."""
    return chrom_to_code(F.substring(as_column(contig), 4, 2147483647))


def merge_key(*parts: Column | str, sep: str = ":") -> Column:
    """Join key parts with ``sep``; a missing part is written as ``null`` so that no part shifts."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("null")) for p in parts]
    return F.concat_ws(sep, *texts)

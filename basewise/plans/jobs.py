"""The pipeline's steps as functions of paths.

Each job ends in one write. Some look at their input before: frequencies, coverage
and functional at a sample of the keys, liftover keeps its rows in the shared folder
in between. ``python -m basewise <job> --help``
runs them from ``spark-submit``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basewise.operators.annotations import parse_annotations
from basewise.operators.enrich import (
    GENOMIC_KEY,
    coverage_flag,
    enrich_frequencies,
    enrich_prefixed,
    join_scores,
)
from basewise.operators.liftover import lift_positions
from basewise.operators.pipe import DISTANCE_INPUT, FOLD_INPUT, PDIST_INPUT, pipe_batches, to_tool_records
from basewise.operators.positions import map_positions
from basewise.operators.rollup import rollup as rollup_rows
from basewise.operators.scores import attach_wildtype, deltas, drop_stale_scores, pair_distances, split_wildtype
from basewise.operators.settle import settle
from basewise.operators.skew import hot_keys
from basewise.operators.variants import variants as expand_variants
from basewise.plans.constraint import constraint_by_transcript
from basewise.sinks import write_csv, write_parquet
from basewise.sinks import write_vcf as write_vcf_files
from basewise.sources import (
    parse_distance,
    parse_fold,
    parse_pdist,
    read_alignments,
    read_chain,
    read_constraint,
    read_coverage,
    read_fasta,
    read_genome_chunks,
    read_id_map,
)

# Programs and arguments run on the user's own installation.
FOLD_PROGRAM = ("bin/RNAfold", "-p", "--MEA", "--noPS")
DISTANCE_PROGRAM = ("bin/RNAdistance",)
PDIST_PROGRAM = ("bin/RNApdist",)

SAMPLE = 0.01


def _program(home: str, program: tuple[str, ...]) -> list[str]:
    return [os.path.join(home, program[0]), *program[1:]]


def _hot_genomic(df: DataFrame, keys: tuple[str, ...] = GENOMIC_KEY) -> DataFrame:
    """Heavy keys of a positioned table, from a sample; unmapped variants share one key."""
    return hot_keys(df, keys, fraction=SAMPLE)


def variants(spark: SparkSession, fasta: str, out: str, record_type: str | None = None, partitions: int = 5000) -> None:
    """FASTA -> variants table."""
    records = read_fasta(spark, fasta, record_type)
    write_parquet(expand_variants(records, partitions=int(partitions)), out)


def wildtypes(spark: SparkSession, source: str, out: str) -> None:
    """Only the wildtype rows of a variants table."""
    write_parquet(split_wildtype(spark.read.parquet(source))[1], out)


def fold(spark: SparkSession, source: str, out: str, home: str, partitions: int = 20000) -> None:
    """Fold every sequence with the program under ``home``."""
    records = to_tool_records(spark.read.parquet(source), **FOLD_INPUT)
    piped = pipe_batches(records, _program(home, FOLD_PROGRAM), partitions=int(partitions))
    write_parquet(parse_fold(piped), out)


def scrub(spark: SparkSession, source: str, out: str) -> None:
    """Drop stale score columns and mark rows as alternates."""
    write_parquet(drop_stale_scores(spark.read.parquet(source)), out)


def combine(spark: SparkSession, alternates: str, wildtype_folds: str, out: str) -> None:
    """Put each alternate's fold next to its wildtype's."""
    write_parquet(attach_wildtype(spark.read.parquet(alternates), spark.read.parquet(wildtype_folds)), out)


def distance(spark: SparkSession, source: str, out: str, home: str = "", partitions: int = 20000) -> None:
    """Differences and structure distances; without ``home`` the distances are base-pair distances."""
    wide = spark.read.parquet(source)
    if home:
        records = to_tool_records(wide, **DISTANCE_INPUT)
        piped = pipe_batches(records, _program(home, DISTANCE_PROGRAM), partitions=int(partitions))
        scored = deltas(parse_distance(piped))
    else:
        scored = pair_distances(deltas(wide)).drop("isWildType")
    write_parquet(scored, out)


def pdist(spark: SparkSession, source: str, out: str, home: str, partitions: int = 50000) -> None:
    """Profile distances with the program under ``home``."""
    records = to_tool_records(spark.read.parquet(source), **PDIST_INPUT)
    piped = pipe_batches(records, _program(home, PDIST_PROGRAM), partitions=int(partitions))
    write_parquet(parse_pdist(piped), out)


def join(spark: SparkSession, distances: str, pdists: str, out: str) -> None:
    """Join both kinds of distance."""
    write_parquet(join_scores(spark.read.parquet(distances), spark.read.parquet(pdists)), out)


def map_genome(spark: SparkSession, source: str, out: str, gff3: str, prefix: str | None = None) -> None:
    """Transcript positions to genomic positions."""
    write_parquet(map_positions(spark.read.parquet(source), read_alignments(spark, gff3), prefix), out)


def genome_chunks(spark: SparkSession, fasta: str, out: str) -> None:
    """Cut a genome into the chunk table that the liftover reads; needed once per genome."""
    write_parquet(read_genome_chunks(spark, fasta), out)


def liftover(spark: SparkSession, source: str, out: str, chain: str, genome: str, alleles: str = "any") -> None:
    """Move variants to another assembly; ``genome`` is a chunk table (``*.parquet``) or FASTA.

    A FASTA genome is read and cut once, into the shared folder. ``alleles`` is ``any``
    or ``single`` for tables that hold single-base alleles only, which is quicker.
    """
    if alleles not in ("any", "single"):
        raise ValueError("alleles must be 'any' or 'single'")
    stored = genome.rstrip("/").endswith(".parquet")
    chunks = spark.read.parquet(genome) if stored else settle(read_genome_chunks(spark, genome))
    lifted = lift_positions(spark.read.parquet(source), read_chain(spark, chain), chunks, multi_base=alleles == "any")
    write_parquet(lifted, out)


def frequencies(
    spark: SparkSession, source: str, out: str, exome: str, genome: str, exome_counts: str, genome_counts: str
) -> None:
    """Population frequencies and counts."""
    df = spark.read.parquet(source)
    tables = [spark.read.parquet(p) for p in (exome, genome, exome_counts, genome_counts)]
    write_parquet(enrich_frequencies(df, *tables, hot=_hot_genomic(df)), out)


def coverage(spark: SparkSession, source: str, out: str, files: str, threshold: float) -> None:
    """Coverage and its flag."""
    df = spark.read.parquet(source)
    hot = _hot_genomic(df, GENOMIC_KEY[:2])
    write_parquet(coverage_flag(df, read_coverage(spark, files), float(threshold), hot=hot), out)


def functional(spark: SparkSession, source: str, table: str, out: str) -> None:
    """Functional annotation table, columns prefixed."""
    df = spark.read.parquet(source)
    write_parquet(enrich_prefixed(df, spark.read.parquet(table), hot=_hot_genomic(df)), out)


def annotate(spark: SparkSession, source: str, out: str, info: str = "info") -> None:
    """Parse annotation text held in a column."""
    write_parquet(parse_annotations(spark.read.parquet(source), info), out)


def rollup(spark: SparkSession, source: str, out: str) -> None:
    """One row per genomic variant."""
    write_parquet(rollup_rows(spark.read.parquet(source)), out)


def export_csv(spark: SparkSession, source: str, out: str, single_file: str = "") -> None:
    """Parquet to CSV; any ``single_file`` text asks for one file."""
    write_csv(spark.read.parquet(source), out, single_file=bool(single_file))


def export_vcf(spark: SparkSession, source: str, out: str, single_file: str = "") -> None:
    """PASS variants to VCF text."""
    write_vcf_files(spark.read.parquet(source), out, single_file=bool(single_file))


def constraint(spark: SparkSession, table: str, id_map: str, out: str, choice: str = "extreme") -> None:
    """Gene constraint per RefSeq id; overwrites ``out``."""
    chosen = constraint_by_transcript(read_constraint(spark, table), read_id_map(spark, id_map), choice)
    write_parquet(chosen, out, mode="overwrite")


JOBS: dict[str, Callable[..., None]] = {
    f.__name__.replace("_", "-"): f
    for f in (
        variants, wildtypes, fold, scrub, combine, distance, pdist, join, map_genome,
        genome_chunks, liftover,
        frequencies, coverage, functional, annotate, rollup, export_csv, export_vcf, constraint,
    )
}

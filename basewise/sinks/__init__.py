"""Writers. All write in parallel; one-file output is opt-in."""

from basewise.sinks.tables import write_csv, write_parquet
from basewise.sinks.vcf import to_vcf_lines, vcf_header, write_vcf

__all__ = ["to_vcf_lines", "vcf_header", "write_csv", "write_parquet", "write_vcf"]

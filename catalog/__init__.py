"""Named queries over the star-schema test tables, each with its DuckDB counterpart.

The tables hold no sequences, so every query first derives its input from whole
tables with plain expressions, the same way on both engines.
"""

from catalog import enrichment, indels, mapping, notebook, scores, sequences

MODULES = (sequences, mapping, indels, scores, enrichment, notebook)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

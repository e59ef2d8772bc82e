"""Batch analytics over sequence-variant tables, as Spark DataFrame operators."""

from basewise import functions, operators, plans, sinks, sources

__all__ = ["functions", "operators", "plans", "sinks", "sources"]

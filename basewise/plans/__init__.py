"""Whole jobs: read, compose operators, write."""

from basewise.plans.constraint import constraint_by_transcript, constraint_summary
from basewise.plans.jobs import JOBS

__all__ = ["JOBS", "constraint_by_transcript", "constraint_summary"]

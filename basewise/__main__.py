"""Run one job of :mod:`basewise.plans.jobs`.

``python -m basewise <job> <arguments>``, or on a cluster
``spark-submit --py-files basewise.zip basewise/__main__.py <job> <arguments>``.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from basewise.plans.jobs import JOBS


def build_parser() -> argparse.ArgumentParser:
    """One sub-command per job; its arguments are the job function's own."""
    parser = argparse.ArgumentParser(prog="basewise", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=(job.__doc__ or "").strip())
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            if parameter.default is inspect.Parameter.empty:
                command.add_argument(parameter.name)
            else:
                command.add_argument(parameter.name, nargs="?", default=parameter.default)
    return parser


def main(argv: list[str] | None = None) -> None:
    """Parse the command line and run the job."""
    arguments = vars(build_parser().parse_args(argv))
    job = JOBS[arguments.pop("job")]
    spark = SparkSession.builder.appName(f"basewise {job.__name__}").getOrCreate()
    job(spark, **arguments)


if __name__ == "__main__":
    main()

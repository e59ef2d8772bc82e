"""Counting, uniqueness, group extremes, samples and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from basewise.operators.settle import settle


def key_histogram(df: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    """Rows per key, most frequent first (ties by key)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), *keys)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows``, ``distinct_keys`` (keys with a null count too), ``is_unique``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys")
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def extreme_join(df: DataFrame, keys: Sequence[str], highest: str, lowest: str) -> DataFrame:
    """Rows that hold both their group's maximum of ``highest`` and its minimum of ``lowest``.

    The two are found independently, so a group where no row has both
    disappears, and rows that tie in both stay. See :func:`argmax_rows`.
    """
    keys = list(keys)
    extremes = df.groupBy(*keys).agg(F.max(highest).alias(highest), F.min(lowest).alias(lowest))
    # Joining on the values too spreads a heavy key over the tasks by its values.
    return df.join(extremes, [*keys, highest, lowest], "inner").select(*df.columns)


def argmax_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in ``order``; remaining ties are broken by all other columns.

    Spark applies the rank limit before the shuffle as well (a group limit per
    input task), so a heavy key sends one row per task.
    """
    names = [F.col(f"`{c}`").asc() for c in df.columns]
    window = Window.partitionBy(*keys).orderBy(*order, *names)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def sample_rows(df: DataFrame, k: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """``k`` rows in random but repeatable order: the smallest hashes of key and seed.

    Each task keeps its own ``k`` smallest, so only those travel.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in keys]
    ticket = F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))
    return df.orderBy(ticket, *keys).limit(k)


def with_row_metrics(df: DataFrame, name: str = "rows", **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and observe further aggregates) while they pass; ``observation.get[name]`` is set after the first action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias(name), *[m.alias(n) for n, m in metrics.items()]), observation


class Progress:
    """Numbers observed at several places of one plan, delivered together with its result.

    ``at`` marks a place in a plan; ``deliver`` computes the plan once, into the
    shared folder, and gives the stored rows and a table ``place, metric, value``.
    Spark adds a stage's numbers again when it repeats a lost map stage. The rows that
    arrived are therefore counted from what was stored, and if they differ from the
    rows observed last, or ``recount`` is set, every place is counted by a query of its
    own instead; ``exact`` in the table tells which numbers are certain.
    """

    def __init__(self) -> None:
        self.places: dict[str, tuple[Observation, DataFrame, dict[str, Column]]] = {}

    def at(self, df: DataFrame, place: str, **metrics: Column) -> DataFrame:
        """``df``, counted under the name ``place`` while it is computed; further numeric aggregates by name."""
        if place in self.places:
            raise ValueError(f"two places are named {place}")
        observed, observation = with_row_metrics(df, place, **metrics)
        self.places[place] = (observation, df, metrics)
        return observed

    def deliver(self, df: DataFrame, recount: bool = False) -> tuple[DataFrame, DataFrame]:
        """The result, computed and stored, and the numbers of all places; rows that arrived are the place ``result``."""
        spark = df.sparkSession
        stored = settle(self.at(df, "result"))
        arrived = stored.count()
        if self.places["result"][0].get["result"] != arrived:
            recount = True
        rows = []
        for place, (observation, plan, metrics) in self.places.items():
            if place == "result":
                rows.append((place, "rows", float(arrived), True))
                continue
            if recount:
                counted = plan.agg(F.count(F.lit(1)).alias(place), *[m.alias(n) for n, m in metrics.items()]).first().asDict()
            else:
                counted = observation.get
            for name in (place, *metrics):
                value = counted[name]
                rows.append((place, "rows" if name == place else name, None if value is None else float(value), recount))
        return stored, spark.createDataFrame(rows, "place string, metric string, value double, exact boolean")

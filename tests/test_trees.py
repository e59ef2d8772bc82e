"""Tree-edit distance against the plain recursion over forests."""

import functools
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from basewise.functions.trees import edit_distance, tree_distance
from basewise.operators import tree_distances

WEIGHT = {"P": 2, "U": 1}


def forest(structure):
    open_lists = [[]]
    for char in structure:
        if char == "(":
            open_lists.append([])
        elif char == ")":
            inside = tuple(open_lists.pop())
            open_lists[-1].append(("P", inside))
        else:
            open_lists[-1].append(("U", ()))
    return tuple(open_lists[0])


@functools.cache
def cost(trees):
    return sum(WEIGHT[kind] + cost(inside) for kind, inside in trees)


@functools.cache
def plain(a, b):
    """Least cost: the last root of either forest goes, or both are matched."""
    if not a or not b:
        return cost(a) + cost(b)
    (kind_a, inside_a), (kind_b, inside_b) = a[-1], b[-1]
    return min(
        plain(a[:-1] + inside_a, b) + WEIGHT[kind_a],
        plain(a, b[:-1] + inside_b) + WEIGHT[kind_b],
        plain(a[:-1], b[:-1]) + plain(inside_a, inside_b) + (kind_a != kind_b),
    )


def structure(rng, n):
    out, depth = "", 0
    for i in range(n):
        choice = ")" if depth == n - i else rng.choice("()." if depth + 2 <= n - i else ").")
        if choice == ")" and depth == 0:
            choice = "."
        depth += {"(": 1, ")": -1, ".": 0}[choice]
        out += choice
    return out


@pytest.mark.parametrize("longest", [5, 11, 18])
def test_distance_against_recursion(longest):
    rng = random.Random(longest)
    for _ in range(1200):
        a, b = structure(rng, rng.randrange(0, longest)), structure(rng, rng.randrange(0, longest))
        assert edit_distance(a, b) == edit_distance(b, a) == plain(forest(a), forest(b))


def test_known_distances():
    assert edit_distance("", "") == 0 and edit_distance("", "((..))") == 6
    assert edit_distance("((..))", "(....)") == 4 and edit_distance("(.)", "(..)") == 1
    assert edit_distance("()", ".") == 1 and edit_distance("((", "") is None and edit_distance(")(", "") is None
    a = "(" * 300 + "...." + ")" * 300
    assert edit_distance(a, "(" * 298 + "...." + ")" * 298) == 4


def test_tree_distance_rows(spark):
    rng = random.Random(8)
    rows = [(structure(rng, 12), structure(rng, 12)) for _ in range(300)]
    rows += [(None, "()"), ("()", None), ("((", "()"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "a string, b string").repartition(4)
    for a, b, got in df.select("a", "b", tree_distance("a", "b").alias("d")).collect():
        usable = a is not None and b is not None and a != "(("
        assert got == (plain(forest(a), forest(b)) if usable else None)
    wide = df.select(F.col("a").alias("x"), F.col("b").alias("wt_x"))
    assert tree_distances(wide, {"d": "x"}).where("d is not null").count() == 302


def test_tree_distance_query(spark):
    got = contract.queries()["tree_distance"](spark, "/root/testdata/sf0.001")
    small = [r for r in got.collect() if len(r["first"]) <= 24]
    assert len(small) > 10 and all(r["distance"] == plain(forest(r["first"]), forest(r["second"])) for r in small)

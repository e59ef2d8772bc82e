"""Tree-edit distance of bracket strings.

A structure is an ordered tree: every base pair is a node around what it encloses,
every unpaired base a leaf. The distance is the least cost of edits that turn one tree
into the other. It is found with the usual table of distances of subtrees, one for
each pair of subtrees that do not lie on the left-most path of a larger one. A row of
such a table is one step in numpy: the running minimum along a row is a cumulative
minimum once the insertion costs are taken off. Subtrees that are one unpaired base,
by far the most, need no table: such a base always saves one when it is matched with
any node, so its distance to a tree is the tree's cost less one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from basewise.functions._columns import as_column

# Cost of inserting or deleting an unpaired base or a pair, and of turning one into the other.
UNPAIRED, PAIR, TURN = 1, 2, 1


def tree_of(structure: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Cost and left-most leaf of every node in postorder, without a root; None if brackets do not match."""
    costs: list[int] = []
    leaves: list[int] = []
    begun: list[int] = []
    for char in structure:
        if char == "(":
            begun.append(len(costs))
        elif char == ")":
            if not begun:
                return None
            leaves.append(begun.pop())
            costs.append(PAIR)
        else:
            leaves.append(len(costs))
            costs.append(UNPAIRED)
    if begun:
        return None
    return np.array(costs, dtype=np.int32), np.array(leaves, dtype=np.int64)


def subtree_costs(costs: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Cost of each whole subtree."""
    running = np.concatenate(([0], np.cumsum(costs)))
    return running[1:] - running[leaves]


def path_ends(costs: np.ndarray, leaves: np.ndarray) -> list[int]:
    """The largest subtree of each left-most path, unless it is one unpaired base."""
    last = {int(leaf): i for i, leaf in enumerate(leaves)}
    return [i for i in sorted(last.values()) if costs[i] == PAIR]


def edit_distance(first: str, second: str) -> int | None:
    """Least cost of edits between two structures; None if one is no structure."""
    a, b = tree_of(first), tree_of(second)
    if a is None or b is None:
        return None
    if first == second:
        return 0
    cost_a, leaf_a = a
    cost_b, leaf_b = b
    distance = np.zeros((len(cost_a), len(cost_b)), dtype=np.int32)
    distance[cost_a == UNPAIRED, :] = subtree_costs(cost_b, leaf_b) - 1
    distance[:, cost_b == UNPAIRED] = (subtree_costs(cost_a, leaf_a) - 1)[:, None]
    for i in path_ends(cost_a, leaf_a):
        for j in path_ends(cost_b, leaf_b):
            fill(distance, cost_a, leaf_a, cost_b, leaf_b, int(leaf_a[i]), i + 1, int(leaf_b[j]), j + 1, True)
    # The two lists of outermost nodes hang below one root each; the roots are matched at no cost.
    return fill(distance, cost_a, leaf_a, cost_b, leaf_b, 0, len(cost_a), 0, len(cost_b), False)


def fill(
    distance: np.ndarray, cost_a: np.ndarray, leaf_a: np.ndarray, cost_b: np.ndarray, leaf_b: np.ndarray,
    low_a: int, high_a: int, low_b: int, high_b: int, store: bool,
) -> int:
    """Distance of two stretches of nodes; distances of subtrees on their left-most paths are put into ``distance``."""
    width = high_b - low_b
    inserted = np.concatenate(([0], np.cumsum(cost_b[low_b:high_b])))
    on_path = leaf_b[low_b:high_b] == low_b
    before = leaf_b[low_b:high_b] - low_b
    table = np.empty((high_a - low_a + 1, width + 1), dtype=np.int64)
    table[0] = inserted
    for row, node in enumerate(range(low_a, high_a), 1):
        left = int(leaf_a[node]) - low_a
        best = table[left][before] + distance[node, low_b:high_b]
        if left == 0:
            # Both are whole trees: match the two nodes, or what is below them apart.
            turned = np.where(cost_b[low_b:high_b] == cost_a[node], 0, TURN)
            best = np.where(on_path, table[row - 1][:-1] + turned, best)
        best = np.minimum(best, table[row - 1][1:] + cost_a[node])
        begin = table[row - 1][0] + cost_a[node]
        table[row] = np.minimum.accumulate(np.concatenate(([begin], best)) - inserted) + inserted
        if store and left == 0:
            distance[node, low_b:high_b][on_path] = table[row][1:][on_path]
    return int(table[-1][-1])


def _tree_distance(first: pd.Series, second: pd.Series) -> pd.Series:
    """Distances of a batch; equal pairs of structures are worked out once."""
    pairs = list(zip(first, second, strict=True))
    known = {p: None if None in p else edit_distance(*p) for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype="Int32")


def tree_distance(first: Column | str, second: Column | str) -> Column:
    """Tree-edit distance of two bracket strings; null if one is null or unbalanced.

    An unpaired base costs 1 to insert or delete, a base pair 2, turning one into the
    other 1. Memory is the product of the two lengths.
    """
    return F.pandas_udf(_tree_distance, "int")(as_column(first), as_column(second))

"""Regression trees as arrays, scored with numpy inside Spark tasks.

Spark ships this module with the tasks, so the workers need numpy and pyarrow only.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

#: Rows scored in one go; all trees look at them at once.
CHUNK = 2_048
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


@dataclass(frozen=True)
class Node:
    """A split (``feature`` at most ``threshold`` goes left), or a leaf (``feature`` -1)."""

    feature: int
    threshold: float
    left: int
    right: int
    value: float = 0.0


def parse(text: str) -> list[Node]:
    """The nodes of a tree from Spark's description of it, the root first.

    Leaves have no value yet; they appear in the order in which Spark numbers them.
    """
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
    nodes: list[Node] = []
    at = 0

    def read() -> int:
        nonlocal at
        line, mine = lines[at], len(nodes)
        at += 1
        nodes.append(Node(-1, 0.0, mine, mine))
        found = _SPLIT.match(line)
        if found:
            left = read()
            at += 1  # the line that says Else
            nodes[mine] = Node(int(found[1]), float(found[2]), left, read())
        elif not line.startswith("Predict"):
            raise ValueError(f"Neither a split nor a leaf: {line}")
        return mine

    read()
    return nodes


def with_values(nodes: Sequence[Node], features: Sequence[int], values: dict[int, float]) -> list[Node]:
    """Features renumbered, and leaf ``k`` given ``values[k]`` (0 where no row fell)."""
    out, leaves = [], 0
    for node in nodes:
        if node.feature < 0:
            out.append(Node(-1, 0.0, node.left, node.right, values.get(leaves, 0.0)))
            leaves += 1
        else:
            out.append(Node(features[node.feature], node.threshold, node.left, node.right))
    return out


def scorer(start: float, trees: Sequence[Sequence[Node]]) -> Callable[..., pa.Array]:
    """The Arrow function that turns feature columns into ``start`` plus all trees' leaves."""
    size = max((len(tree) for tree in trees), default=1)
    shape = (len(trees), size)
    feature, left, right = (np.zeros(shape, np.int32) for _ in range(3))
    threshold, value = np.full(shape, np.inf), np.zeros(shape)
    for t, tree in enumerate(trees):
        for n, node in enumerate(tree):
            feature[t, n], threshold[t, n] = max(node.feature, 0), node.threshold
            left[t, n], right[t, n], value[t, n] = node.left, node.right, node.value
    depth = max((_depth(tree, 0) for tree in trees), default=0)
    number = np.arange(len(trees))[:, None]

    def score(*columns: pa.Array) -> pa.Array:
        rows = np.vstack([c.to_numpy(zero_copy_only=False) for c in columns])
        out = np.full(rows.shape[1], start)
        for first in range(0, rows.shape[1], CHUNK):
            part = rows[:, first : first + CHUNK]
            at = np.zeros((len(trees), part.shape[1]), np.int32)
            column = np.arange(part.shape[1])[None, :]
            for _ in range(depth):
                small = part[feature[number, at], column] <= threshold[number, at]
                at = np.where(small, left[number, at], right[number, at])
            out[first : first + CHUNK] += value[number, at].sum(axis=0)
        return pa.array(out)

    return score


def _depth(tree: Sequence[Node], at: int) -> int:
    node = tree[at]
    if node.feature < 0:
        return 0
    return 1 + max(_depth(tree, node.left), _depth(tree, node.right))


cloudpickle.register_pickle_by_value(sys.modules[__name__])

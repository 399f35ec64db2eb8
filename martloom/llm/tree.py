"""Small decision trees, fitted on a bounded table of numbers and read as paths or applied to arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    """A leaf when ``column`` is negative; else rows with value <= ``cut`` go to ``low``."""

    share: float
    rows: int
    column: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def fit(x: np.ndarray, y: np.ndarray, depth: int, least: int, columns: np.ndarray | None = None) -> Node:
    """Tree of at most ``depth`` splits a path that lowers the Gini impurity most at each node.

    Leaves hold at least ``least`` rows. Equal splits go to the first column and the lowest cut, so
    the tree depends only on the rows.
    """
    node = Node(float(y.mean()) if len(y) else 0.0, len(y))
    if depth == 0 or len(y) < 2 * least or node.share in (0.0, 1.0):
        return node
    best = (1e-9, -1, 0.0)
    impurity = node.share * (1 - node.share) * len(y)
    for column in range(x.shape[1]) if columns is None else columns:
        order = np.argsort(x[:, column], kind="stable")
        values, ones = x[order, column], np.cumsum(y[order])
        at = np.arange(1, len(y))
        allowed = (values[1:] > values[:-1]) & (at >= least) & (len(y) - at >= least)
        if not allowed.any():
            continue
        at = at[allowed]
        left, right = ones[at - 1], ones[-1] - ones[at - 1]
        gain = impurity - left * (1 - left / at) - right * (1 - right / (len(y) - at))
        top = int(np.argmax(gain))
        if gain[top] > best[0] + 1e-12:
            best = (float(gain[top]), int(column), float((values[at[top] - 1] + values[at[top]]) / 2))
    if best[1] < 0:
        return node
    node.column, node.cut = best[1], best[2]
    low = x[:, node.column] <= node.cut
    node.low = fit(x[low], y[low], depth - 1, least, columns)
    node.high = fit(x[~low], y[~low], depth - 1, least, columns)
    return node


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    """Share of ones in the leaf of each row."""
    if node.column < 0:
        return np.full(len(x), node.share)
    low = x[:, node.column] <= node.cut
    out = np.empty(len(x))
    out[low] = predict(node.low, x[low])
    out[~low] = predict(node.high, x[~low])
    return out


#: Conditions of one path: column, whether the value is above the cut, the cut.
Path = tuple[tuple[int, bool, float], ...]


def paths(node: Node, above: Path = ()) -> list[Path]:
    """Conditions from the root to every node below it, inner nodes included."""
    if node.column < 0:
        return []
    found = []
    for child, high in ((node.low, False), (node.high, True)):
        path = (*above, (node.column, high, node.cut))
        found += [path, *paths(child, path)]
    return found

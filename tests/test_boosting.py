"""Boosted trees against the same trees grown in a plain loop."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest

from tidewatch.operators import boosting as T


def made(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b = rng.gauss(0, 1), rng.choice([1.0, 2.0, 3.0])
        y = (3.0 if a > 0.2 else 0.0) + b * (1 if a > 0 else -1) + rng.gauss(0, 0.5)
        out.append((None if rng.random() < 0.04 else y, None if rng.random() < 0.25 else a, b, 7.0, None))
    return out


COLUMNS = "y double, a double, b double, flat double, gone double"
FEATURES = ["a", "b", "flat", "gone"]


def loop(train, valid, objective, rate, most, depth, bins, least, patience):
    """(predictions of a function, trees kept) by going over rows."""
    train, valid = [[r for r in x if r[0] is not None] for x in (train, valid)]
    mean = objective == "mean"
    middle = statistics.fmean if mean else statistics.median
    cuts = [sorted(set(np.quantile([r[j] for r in train if r[j] is not None], [i / bins for i in range(1, bins)]).tolist())) if any(r[j] is not None for r in train) else [] for j in range(1, 5)]
    binned = lambda r: [-1 if r[j] is None else sum(r[j] > c for c in cuts[j - 1]) for j in range(1, 5)]
    start = middle(r[0] for r in train)
    rows, held = [[r[0], binned(r), start] for r in train], [[r[0], binned(r), start] for r in valid]

    def grow(own, level):
        found = None
        g = [(r[0] - r[2]) if mean else float(np.sign(r[0] - r[2])) for r in own]
        if level < depth:
            for j in range(4):
                for c in range(len(cuts[j])):
                    for null_left in (False, True):
                        left = [x for r, x in zip(own, g, strict=True) if (null_left if r[1][j] == -1 else r[1][j] <= c)]
                        k = len(left)
                        if null_left and not any(r[1][j] == -1 for r in own) or min(k, len(own) - k) < least:
                            continue
                        gain = round(sum(left) ** 2 / k + (sum(g) - sum(left)) ** 2 / (len(own) - k) - sum(g) ** 2 / len(own), 9)
                        if gain > 0 and (found is None or gain > found[0]):
                            found = (gain, j, c, null_left)
        if found is None:
            return middle(r[0] - r[2] for r in own)
        _, j, c, null_left = found
        side = lambda b: null_left if b[j] == -1 else b[j] <= c
        return (side, grow([r for r in own if side(r[1])], level + 1), grow([r for r in own if not side(r[1])], level + 1))

    def value(tree, b):
        while isinstance(tree, tuple):
            tree = tree[1] if tree[0](b) else tree[2]
        return tree

    def loss():
        return round(statistics.fmean((r[0] - r[2]) ** 2 if mean else abs(r[0] - r[2]) for r in held), 9)

    trees, best = [], (loss(), 0)
    for k in range(1, most + 1):
        trees.append(grow(rows, 0))
        for r in rows + held:
            r[2] += rate * value(trees[-1], r[1])
        if loss() < best[0]:
            best = (loss(), k)
        elif k - best[1] >= patience:
            break
    kept = trees[: best[1]]
    return lambda r: start + sum(rate * value(t, binned(r)) for t in kept), best[1]


@pytest.mark.parametrize("objective", ["mean", "median"])
def test_trees_equal_a_loop(spark, objective):
    """Nulls go to the better side; flat columns and columns without values are never split; stopped on held rows."""
    train, valid = made(300, 1), made(120, 2)
    kw = {"rate": 0.5, "most": 8, "depth": 2, "bins": 8, "least": 15, "patience": 3}
    model = T.fit(spark.createDataFrame(train, COLUMNS), FEATURES, "y", objective=objective, valid=spark.createDataFrame(valid, COLUMNS), **kw)
    want, kept = loop(train, valid, objective, *kw.values())
    assert len(model.trees) == kept and kept >= 2
    assert all(s[0] in (0, 1) for t in model.trees for s in t.splits.values())
    got = model.predicted(spark.createDataFrame(valid, COLUMNS)).collect()
    assert np.allclose([r.p for r in got], [want(tuple(r)[:5]) for r in got])


def test_edges(spark):
    df = spark.createDataFrame(made(40, 3), COLUMNS)
    model = T.fit(df, FEATURES, "y", most=3, least=30)
    assert not model.trees and len({r.p for r in model.predicted(df).select("p").collect()}) == 1
    with pytest.raises(ValueError, match="target"):
        T.fit(df.limit(0), FEATURES, "y")
    with pytest.raises(ValueError, match="huber"):
        T.fit(df, FEATURES, "y", objective="huber")

"""Gradient-boosted trees by histograms: each level of a tree is one aggregation over all rows.

Columns are cut into bins once; null is a bin of its own whose side is learnt at each split. A level sums gradients by (node, column,
bin), which is combined before the shuffle; the sums, as many as nodes times columns times bins, choose the splits. Trees are column
expressions, so rows never leave Spark. Sums are compared after rounding, ties take the first column, the lowest bin, nulls right.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What gains and losses are rounded to before they are compared.
DIGITS = 9
NULL_BIN = -1


@dataclass
class Tree:
    """splits: node -> (column, highest bin of the left side, whether null goes left); node n has the children 2n and 2n + 1, the root is 1."""

    splits: dict[int, tuple[int, int, bool]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def at(self, bins: Column, values: bool, node: int = 1) -> Column:
        """The node that a row ends in, or that node's value."""
        if node not in self.splits:
            return F.lit(self.leaves.get(node, 0.0)) if values else F.lit(node)
        column, last, null_left = self.splits[node]
        b = F.get(bins, F.lit(column))
        left = F.when(b == NULL_BIN, F.lit(null_left)).otherwise(b <= last)
        return F.when(left, self.at(bins, values, 2 * node)).otherwise(self.at(bins, values, 2 * node + 1))


@dataclass
class Model:
    features: Sequence[str]
    cuts: list[list[float]]
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def bins(self) -> Column:
        """Each column's bin: how many cuts lie below the value."""
        of = lambda c, cuts: F.when(c.isNull(), NULL_BIN).otherwise(sum((F.when(c > x, 1).otherwise(0) for x in cuts), F.lit(0)))
        return F.array(*[of(F.col(c).cast("double"), x) for c, x in zip(self.features, self.cuts, strict=True)])

    def predicted(self, rows: DataFrame, name: str = "p") -> DataFrame:
        got = rows.withColumn("_bins", self.bins()).withColumn(name, F.lit(self.start))
        for tree in self.trees:
            got = got.withColumn(name, F.col(name) + self.rate * tree.at(F.col("_bins"), True))
        return got.drop("_bins")


def _best(sums: dict[tuple[int, int], tuple[float, int]], columns: int, bins: list[int], least: int) -> tuple[int, int, bool] | None:
    """The split of most gain from (column, bin) -> (sum, rows) of one node; None if none gains."""
    found = None
    for j in range(columns):
        own = [sums.get((j, b), (0.0, 0)) for b in range(bins[j] + 1)]
        null = sums.get((j, NULL_BIN), (0.0, 0))
        total, n = sum(x[0] for x in own) + null[0], sum(x[1] for x in own) + null[1]
        left, m = 0.0, 0
        for b in range(bins[j]):
            left, m = left + own[b][0], m + own[b][1]
            for null_left in (False, True) if null[1] else (False,):
                a, k = (left + null[0], m + null[1]) if null_left else (left, m)
                if min(k, n - k) >= max(1, least):
                    gain = round(a * a / k + (total - a) ** 2 / (n - k) - total * total / n, DIGITS)
                    if gain > 0 and (found is None or gain > found[0]):
                        found = (gain, (j, b, null_left))
    return found and found[1]


def fit(train: DataFrame, features: Sequence[str], target: str, *, objective: str = "mean", rate: float = 0.1, most: int = 100, depth: int = 3, bins: int = 32, least: int = 20, valid: DataFrame | None = None, patience: int = 10) -> Model:
    """A model of train(features, target); rows without a target are left out.

    objective mean: gradients are residuals and leaves their means; median: signs of residuals, and leaves the exact median of theirs.
    With `valid` trees are added until `patience` of them bring no lower mean loss there (squared or absolute); those after the best go.
    """
    if objective not in ("mean", "median"):
        raise ValueError(f"no objective {objective!r}")
    mean, y = objective == "mean", F.col(target).cast("double")
    given = train.where(y.isNotNull())
    levels = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    told = given.agg((F.avg(y) if mean else F.percentile(y, 0.5)).alias("start"), *[F.percentile(F.col(c).cast("double"), levels).alias(f"c{i}") for i, c in enumerate(features)]).first()
    model = Model(list(features), [sorted(set(told[f"c{i}"] or [])) for i in range(len(features))], told["start"], rate)
    if model.start is None:
        raise ValueError("no row has a target")
    widths = [len(x) for x in model.cuts]
    begun = lambda df: df.select(y.alias("y"), model.bins().alias("b"), F.lit(model.start).alias("f"))
    state = begun(given).persist()
    held = begun(valid.where(y.isNotNull())).persist() if valid is not None else None
    loss = F.avg((F.col("y") - F.col("f")) ** 2 if mean else F.abs(F.col("y") - F.col("f")))
    best = (round(held.agg(loss).first()[0], DIGITS), 0) if held is not None else None
    r = F.col("y") - F.col("f")
    for k in range(1, most + 1):
        tree = Tree()
        for level in range(depth):
            rows = state.select(tree.at(F.col("b"), False).alias("node"), (r if mean else F.signum(r)).alias("g"), F.posexplode("b").alias("column", "bin"))
            sums: dict[int, dict] = {}
            for x in rows.where(F.col("node") >= 2**level).groupBy("node", "column", "bin").agg(F.sum("g").alias("s"), F.count("*").alias("n")).collect():
                sums.setdefault(x["node"], {})[x["column"], x["bin"]] = (x["s"], x["n"])
            grown = {n: s for n, x in sums.items() if (s := _best(x, len(widths), widths, least))}
            if not grown:
                break
            tree.splits |= grown
        if not tree.splits:
            break
        value = F.avg(r) if mean else F.percentile(r, 0.5)
        tree.leaves = {x["node"]: x["v"] for x in state.groupBy(tree.at(F.col("b"), False).alias("node")).agg(value.alias("v")).collect()}
        model.trees.append(tree)
        state, held = _stepped(state, tree, rate, k), held and _stepped(held, tree, rate, k)
        if held is not None:
            now = round(held.agg(loss).first()[0], DIGITS)
            model.losses.append(now)
            if now < best[0]:
                best = (now, k)
            elif k - best[1] >= patience:
                break
    state.unpersist()
    if held is not None:
        held.unpersist()
        model.trees = model.trees[: best[1]]
    return model


def _stepped(rows: DataFrame, tree: Tree, rate: float, k: int) -> DataFrame:
    """rows a tree further. Every tenth tree cuts the lineage where a checkpoint folder is set."""
    after = rows.select("y", "b", (F.col("f") + rate * tree.at(F.col("b"), True)).alias("f"))
    after = after.checkpoint() if k % 10 == 0 and rows.sparkSession.sparkContext.getCheckpointDir() else after.persist()
    after.count()
    rows.unpersist()
    return after

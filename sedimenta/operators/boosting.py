"""Boosted trees for counts: Poisson and Tweedie loss with a log link, many models at once.

Rows belong to groups (a fold, a loss), and each group grows its own trees, all in step. Features become bins
once. For each level of a tree the rows are summed up to gradients and Hessians by (group, node, feature, bin),
one grouped aggregate for all nodes of all groups; the splits are then chosen from those few rows, whose number
depends on groups, nodes, features and bins alone. Rows to be predicted ride along without weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import durable


@dataclass(frozen=True)
class Growth:
    """How trees grow: a bin holds about 1 / bins of the rows; `shrink` scales each tree; `ridge` is added to Hessians."""

    trees: int = 12
    depth: int = 3
    bins: int = 24
    shrink: float = 0.2
    ridge: float = 1.0
    least_rows: int = 20
    cut_lineage: int = 3


@dataclass
class Tree:
    """Heaps by group, flat: node i (from 1) of group g splits on feature[g, i] after bin cut[g, i]; value[g, leaf]; cover[g, i]: its training rows."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray


@dataclass
class Ensemble:
    edges: list[list[float]]
    powers: list[float]
    start: list[float]
    growth: Growth
    trees: list[Tree] = field(default_factory=list)


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Quantiles of each feature from one sketch; equal ones once."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"e{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(e or [])) for e in found]


def binned(features: Sequence[str], edges: list[list[float]]) -> Column:
    """An array of bins: 0 for null and NaN, else one more than the number of edges below the value."""

    def of(v: Column, cuts: list[float]) -> Column:
        below = F.size(F.filter(F.lit([float(c) for c in cuts]), lambda e: e < v)) if cuts else F.lit(0)
        return F.when(v.isNull() | F.isnan(v), 0).otherwise(below + 1).cast("int")

    return F.array(*[of(F.col(f).cast("double"), cuts) for f, cuts in zip(features, edges, strict=True)])


def gradients(y: Column, margin: Column, power: Column) -> tuple[Column, Column]:
    """First and second derivative of the deviance by the margin; a power of 1 is Poisson, between 1 and 2 Tweedie."""
    one, two = F.exp((1 - power) * margin), F.exp((2 - power) * margin)
    return two - y * one, (2 - power) * two - (1 - power) * y * one


def deviance(y: Column, mean: Column, power: float) -> Column:
    """The mean unit deviance of Poisson (power 1) or Tweedie (1 to 2) forecasts."""
    mean = F.greatest(mean, F.lit(1e-9))
    if power == 1:
        unit = F.when(y > 0, y * F.ln(y / mean)).otherwise(0.0) - (y - mean)
    else:
        unit = F.greatest(y, F.lit(0.0)) ** (2 - power) / ((1 - power) * (2 - power)) - y * mean ** (1 - power) / (1 - power) + mean ** (2 - power) / (2 - power)
    return F.avg(2 * unit)


def _of(values: np.ndarray, at: Column) -> Column:
    """A literal table looked up by a place from 0."""
    return F.element_at(F.lit(values.tolist()), (at + 1).cast("int"))


def _step(tree: Tree, node: Column, nodes: int) -> Column:
    """The child of a node: 2 * node to the left, one more to the right."""
    at = F.col("_group") * nodes + node
    return 2 * node + (F.element_at("_x", (_of(tree.feature.ravel(), at) + 1).cast("int")) > _of(tree.cut.ravel(), at)).cast("int")


def choose(sums: dict[tuple[int, int], np.ndarray], growth: Growth) -> dict[tuple[int, int], tuple[int, int, np.ndarray, np.ndarray]]:
    """The best split of each (group, node) whose sums are an array (features, bins, [g, h, rows]): (feature, last bin to the left, sums left, sums right).

    None where no split gains or leaves enough rows on both sides. Of equal gains the first feature and bin.
    """
    out = {}
    for key, s in sums.items():
        left = np.cumsum(s, axis=1)
        total = left[:, -1:, :]
        right = total - left
        score = lambda z: z[..., 0] ** 2 / (z[..., 1] + growth.ridge)
        gain = score(left) + score(right) - score(total)
        gain[(left[..., 2] < growth.least_rows) | (right[..., 2] < growth.least_rows)] = -np.inf
        best = gain.max()
        if best > 1e-9:
            f, b = np.argwhere(gain >= best - 1e-9 * abs(best))[0]
            out[key] = (int(f), int(b), left[f, b], right[f, b])
    return out


def grow(rows: DataFrame, features: Sequence[str], target: str, group: str, train: str, powers: Sequence[float], growth: Growth | None = None, to: str = "prediction") -> tuple[DataFrame, Ensemble]:
    """rows with a forecast of each, and the trees.

    group: an int column from 0, one for each of `powers`; train: a boolean column; rows that aren't for training
    or have a null target only get a forecast. Features are numbers; nulls have a bin of their own. A group without
    training rows forecasts zero. Negative targets are an error.
    """
    growth = growth or Growth()
    groups, depth, nodes = len(powers), growth.depth, 1 << growth.depth
    learn = F.coalesce(F.col(train), F.lit(False)) & F.col(target).isNotNull()
    learning = rows.where(learn)
    edges = bin_edges(learning, features, growth.bins)
    mean = {r[0]: (r.m, r.low) for r in learning.groupBy(group).agg(F.avg(F.col(target).cast("double")).alias("m"), F.min(target).alias("low")).collect()}
    if any(low < 0 for _, low in mean.values()):
        raise ValueError("counts can't be negative")
    start = [float(np.log(max(mean[g][0], 1e-6))) if g in mean else -np.inf for g in range(groups)]
    ensemble = Ensemble(edges, list(powers), start, growth)
    table = np.array([s if np.isfinite(s) else -30.0 for s in start])
    now = rows.withColumns({"_group": F.col(group).cast("int"), "_learn": learn, "_y": F.col(target).cast("double"), "_x": binned(features, edges)})
    now = now.withColumn("_margin", _of(table, F.col("_group")))
    width = growth.bins + 1
    for t in range(growth.trees):
        if t % growth.cut_lineage == 0:
            now = durable(now)
        tree = Tree(np.zeros((groups, nodes), np.int64), np.full((groups, nodes), width), np.zeros((groups, nodes)), np.zeros((groups, 2 * nodes)))
        value: dict[tuple[int, int], np.ndarray] = {}
        node = F.lit(1)
        g, h = gradients(F.col("_y"), F.col("_margin"), _of(np.array(powers, float), F.col("_group")))
        for level in range(depth):
            at = now.where("_learn").select("_group", node.alias("_node"), g.alias("g"), h.alias("h"), F.posexplode("_x").alias("f", "b"))
            got = at.groupBy("_group", "_node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).toArrow()
            sums: dict[tuple[int, int], np.ndarray] = {}
            for k, i, f, b, *its in zip(*(c.to_pylist() for c in got.columns), strict=True):
                sums.setdefault((k, i), np.zeros((len(features), width, 3)))[f, b] = its
            for key, s in sums.items():
                value.setdefault(key, s[0].sum(axis=0))
            for (k, i), (f, b, left, right) in choose(sums, growth).items():
                tree.feature[k, i], tree.cut[k, i] = f, b
                value[k, 2 * i], value[k, 2 * i + 1] = left, right
            node = _step(tree, node, nodes)
        for k in range(groups):
            for i in range(1, 2 * nodes):  # a node that isn't split hands all its rows to the left
                tree.cover[k, i] = value[k, i][2] if (k, i) in value else 0 if i % 2 else tree.cover[k, i // 2]
            for leaf in range(nodes):
                i = nodes + leaf
                while i > 1 and (k, i) not in value:
                    i //= 2
                if (k, i) in value:
                    tree.value[k, leaf] = -growth.shrink * value[k, i][0] / (value[k, i][1] + growth.ridge)
        ensemble.trees.append(tree)
        now = now.withColumn("_margin", F.col("_margin") + _of(tree.value.ravel(), F.col("_group") * nodes + node - nodes))
    return now.select(*[F.col(f"`{c}`") for c in rows.columns], F.when(F.col("_margin") < -25, 0.0).otherwise(F.exp("_margin")).alias(to)), ensemble


def predict(ensemble: Ensemble, rows: DataFrame, features: Sequence[str], group: str, to: str = "prediction") -> DataFrame:
    """rows with the forecasts of fitted trees, in one pass and without a shuffle."""
    nodes = 1 << ensemble.growth.depth
    table = np.array([s if np.isfinite(s) else -30.0 for s in ensemble.start])
    now = rows.withColumns({"_group": F.col(group).cast("int"), "_x": binned(features, ensemble.edges)})
    margin = _of(table, F.col("_group"))
    for tree in ensemble.trees:
        node = F.lit(1)
        for _ in range(ensemble.growth.depth):
            node = _step(tree, node, nodes)
        margin = margin + _of(tree.value.ravel(), F.col("_group") * nodes + node - nodes)
    return now.withColumn("_margin", margin).select(*[F.col(f"`{c}`") for c in rows.columns], F.when(F.col("_margin") < -25, 0.0).otherwise(F.exp("_margin")).alias(to))

"""What each feature adds to a boosted forecast: Shapley values of the trees, row by row and on average.

The game of a tree is the usual one: a feature that is known sends the row down its branch, an unknown one sends it down
both, by the shares of the training rows. Values are those of the margin (the logarithm of the forecast), so they add up:
expected margin + contributions = margin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.boosting import Ensemble, Tree, binned


def _leaves(tree: Tree, group: int, nodes: int) -> Iterator[tuple[float, dict[int, tuple[float, list[tuple[int, bool]]]]]]:
    """(value, {feature: (share of rows that its splits send this way, [(cut, to the right)])}) of each leaf that training rows reached."""
    cover = tree.cover[group]
    for leaf in range(nodes, 2 * nodes):
        if not cover[leaf]:
            continue
        path: dict[int, tuple[float, list[tuple[int, bool]]]] = {}
        i = leaf
        while i > 1:
            parent, right = i // 2, bool(i % 2)
            feature = int(tree.feature[group, parent])
            share, splits = path.get(feature, (1.0, []))
            path[feature] = share * cover[i] / cover[parent], [*splits, (int(tree.cut[group, parent]), right)]
            i = parent
        yield float(tree.value[group, leaf - nodes]), path


def expected_margins(ensemble: Ensemble) -> list[float]:
    """The mean margin of each group's training rows by the shares of the leaves; a group without any has the margin of zero rows, -30."""
    nodes, out = 1 << ensemble.growth.depth, []
    for group, start in enumerate(ensemble.start):
        total = start if np.isfinite(start) else -30.0
        for tree in ensemble.trees:
            if tree.cover[group, 1]:
                total += float(tree.value[group] @ tree.cover[group, nodes:]) / tree.cover[group, 1]
        out.append(total)
    return out


def shapley(ensemble: Ensemble, group: int, x: np.ndarray) -> np.ndarray:
    """(rows, features) contributions to the margins of rows whose bins are x (rows, features).

    A leaf's game has the features of its path as players, `depth` at most, so its coalitions are listed.
    """
    nodes, out = 1 << ensemble.growth.depth, np.zeros(x.shape)
    for tree in ensemble.trees:
        for value, path in _leaves(tree, group, nodes):
            follows = {f: np.all([(x[:, f] > cut) == right for cut, right in splits], axis=0).astype(float) for f, (_, splits) in path.items()}
            for f in path:
                others = [j for j in path if j != f]
                for size in range(len(others) + 1):
                    weight = factorial(size) * factorial(len(others) - size) / factorial(len(path))
                    for known in combinations(others, size):
                        reach = np.prod([follows[j] if j in known else np.full(len(x), path[j][0]) for j in others], axis=0) if others else 1.0
                        out[:, f] += value * weight * reach * (follows[f] - path[f][0])
    return out


def contributions(ensemble: Ensemble, rows: DataFrame, features: Sequence[str], group: str, to: str = "contribution") -> DataFrame:
    """rows with an array of each feature's contribution, in the order of features, and <to>_expected, the margin that they add to.

    One pass without a shuffle. Features are binned as the trees were; a null has its bin. A null group has null contributions.
    """

    @F.pandas_udf("array<double>")
    def of(groups: pd.Series, bins: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(groups), dtype=object)
        known = groups.notna().to_numpy()
        for g in np.unique(groups[known].to_numpy(int)):
            at = np.flatnonzero(known & (groups == g).to_numpy())
            for i, values in zip(at, shapley(ensemble, int(g), np.stack(bins.iloc[at].to_list())), strict=True):
                out.iat[i] = values
        return out

    g = F.col(group).cast("int")
    expected = F.element_at(F.lit(expected_margins(ensemble)), g + 1)
    return rows.withColumns({to: of(g, binned(features, ensemble.edges)), f"{to}_expected": expected})


def mean_contributions(explained: DataFrame, features: Sequence[str], keys: Sequence[str], column: str = "contribution") -> DataFrame:
    """(keys..., feature, mean_abs, mean, rows): how much each feature moves the forecasts of each group; one aggregate."""
    each = explained.where(F.col(column).isNotNull()).select(*keys, F.posexplode(column).alias("__at", "__v"))
    means = each.groupBy(*keys, "__at").agg(F.avg(F.abs("__v")).alias("mean_abs"), F.avg("__v").alias("mean"), F.count("*").alias("rows"))
    return means.select(*keys, F.element_at(F.lit(list(features)), F.col("__at") + 1).alias("feature"), "mean_abs", "mean", "rows")

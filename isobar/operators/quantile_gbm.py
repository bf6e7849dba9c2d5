"""Gradient-boosted trees for quantiles, grown level by level from histograms.

All quantile levels are boosted side by side. Rows are binned once and written
with their bins. A level of a round is one aggregate: gradient sums by
(quantile, node, feature, bin), summed before the shuffle, of which the driver
sees quantiles * nodes * features * bins rows. Of two siblings only the smaller
is aggregated; the other is its parent less that. Rows find their node by
expressions. A leaf's value is its residuals' quantile from a sketch of bounded
size, one aggregate for all leaves. Every few rounds the rows are written with
their scores, so plans do not grow with the rounds. The model is a list of
trees and its prediction a column, so scoring stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.operators.boosting import bin_edges, bin_of
from isobar.operators.ladder import LEVELS
from isobar.operators.order_stats import quantiles
from isobar.operators.trees import Tree, as_column, best_split
from isobar.session import scratch_path

#: Rounds after which scores are written with the rows.
WRITE_ROUNDS = 4
#: Accuracy of the leaves' sketches: ranks are off by a share of one over this at most.
ACCURACY = 2_000


@dataclass
class Model:
    levels: Sequence[float]
    base: dict[float, float]
    rate: float
    trees: dict[float, list[Tree]] = field(default_factory=dict)

    def predict(self, level: float) -> Column:
        """The level's quantile; a null feature goes right."""
        out = F.lit(self.base[level])
        for tree in self.trees.get(level, []):
            out = out + self.rate * as_column(tree)
        return out


class _Growing:
    """One quantile's tree of a round: splits by node (children of node k are 2k + 1 and 2k + 2), with the histograms (count, gradient) of its open nodes."""

    def __init__(self) -> None:
        self.splits: dict[int, tuple[int, int]] = {}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.wanted: dict[int, int] = {}

    def node(self, bins: Column, at: int = 0) -> Column:
        """A row's node."""
        if at not in self.splits:
            return F.lit(at)
        feature, edge = self.splits[at]
        return F.when(bins[feature] <= edge, self.node(bins, 2 * at + 1)).otherwise(self.node(bins, 2 * at + 2))

    def tree(self, names: Sequence[str], edges: dict[str, list[float]], values: dict[int, float], at: int = 0) -> Tree:
        if at not in self.splits:
            return values.get(at, 0.0)
        feature, edge = self.splits[at]
        name = names[feature]
        return name, edges[name][edge], self.tree(names, edges, values, 2 * at + 1), self.tree(names, edges, values, 2 * at + 2)


def fit(df: DataFrame, y: str, features: Sequence[str], levels: Sequence[float] = LEVELS, rounds: int = 8, bins: int = 16, rate: float = 0.3, min_rows: int = 5, depth: int = 3) -> Model:
    """Fits on the rows with a label: trees of ``depth`` levels, splits at quantiles of each feature, leaves of ``min_rows`` rows or more."""
    rows = df.where(F.col(y).isNotNull()).select(*features, F.col(y).cast("double").alias("__y"))
    base = quantiles(rows, [], {"q": F.col("__y")}, {"q": levels}).first()["q"]
    if base is None:
        return Model(levels, dict.fromkeys(levels, 0.0), rate)
    edges = bin_edges(rows, features, bins)
    model = Model(levels, dict(zip(levels, base, strict=True)), rate, {q: [] for q in levels})
    rows = _written(rows.select("__y", F.array(*[bin_of(f, edges[f]) for f in features]).alias("__bins"), F.array(*map(F.lit, base)).alias("__scores")))
    fresh: list[list[Column]] = [[] for _ in levels]
    for turn in range(rounds):
        scores = [sum(fresh[k], F.col("__scores")[k]) for k in range(len(levels))]
        now = rows.select("__bins", "__y", *[s.alias(f"s{k}") for k, s in enumerate(scores)])
        grown = _grow(now, levels, features, edges, depth, min_rows)
        if not any(tree.splits for tree in grown):
            break
        nodes = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), tree.node(F.col("__bins")).alias("node"), (F.col("__y") - F.col(f"s{k}")).alias("r")) for k, tree in enumerate(grown)]))
        sketched = now.select(nodes.alias("e")).select("e.*").groupBy("k", "node").agg(F.percentile_approx("r", list(levels), ACCURACY).alias("q")).collect()
        for k, (q, tree) in enumerate(zip(levels, grown, strict=True)):
            values = {r["node"]: r["q"][k] for r in sketched if r["k"] == k}
            model.trees[q].append(tree.tree(features, edges, values))
            # Bins and values are split alike: a value is at or below an edge exactly if its bin is at or below the edge's number.
            leaf = F.create_map(*[F.lit(x) for node, value in values.items() for x in (node, rate * value)])
            fresh[k].append(leaf[tree.node(F.col("__bins"))])
        if (turn + 1) % WRITE_ROUNDS == 0 and turn + 1 < rounds:
            rows = _written(rows.select("__y", "__bins", F.array(*[sum(fresh[k], F.col("__scores")[k]) for k in range(len(levels))]).alias("__scores")))
            fresh = [[] for _ in levels]
    return model


def _written(rows: DataFrame) -> DataFrame:
    at = scratch_path(rows.sparkSession, "binned")
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def _grow(rows: DataFrame, levels: Sequence[float], features: Sequence[str], edges: dict[str, list[float]], depth: int, min_rows: int) -> list[_Growing]:
    """A tree for each quantile from the rows (__bins, __y, and s0, s1, ... their scores)."""
    grown, width = [_Growing() for _ in levels], max(len(e) for e in edges.values()) + 2
    for tree in grown:
        tree.wanted = {0: -1}
    for _ in range(depth):
        asked = [[F.col("node") == node for node in tree.wanted] for tree in grown]
        if not any(asked):
            break
        of = F.array(*[F.struct(F.lit(k).alias("k"), tree.node(F.col("__bins")).alias("node"), F.when(F.col("__y") > F.col(f"s{k}"), q).otherwise(q - 1.0).alias("g")) for k, (q, tree) in enumerate(zip(levels, grown, strict=True)) if tree.wanted])
        wanted = F.lit(False)
        for k, tree in enumerate(grown):
            if tree.wanted:
                wanted = wanted | ((F.col("k") == k) & F.col("node").isin(list(tree.wanted)))
        each = rows.select("__bins", F.explode(of).alias("e")).select("__bins", "e.*").where(wanted)
        sums = each.select("k", "node", "g", F.posexplode("__bins").alias("feature", "bin")).groupBy("k", "node", "feature", "bin").agg(F.count("*").alias("n"), F.sum("g").alias("g")).collect()
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for r in sums:
            count, total = found.setdefault((r["k"], r["node"]), (np.zeros((len(features), width)), np.zeros((len(features), width))))
            count[r["feature"], r["bin"]], total[r["feature"], r["bin"]] = r["n"], r["g"]
        for k, tree in enumerate(grown):
            level: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for node, parent in tree.wanted.items():
                own = found.get((k, node))
                if own is None:
                    continue
                level[node] = own
                if parent >= 0:
                    other = 2 * parent + 1 if node == 2 * parent + 2 else 2 * parent + 2
                    level[other] = tuple(whole - part for whole, part in zip(tree.open[parent], own, strict=True))
            tree.open, tree.wanted = level, {}
            for node, (count, total) in level.items():
                splits = [(best[0], -f, best[1]) for f, name in enumerate(features) if (best := best_split(count[f], total[f], len(edges[name]), min_rows))]
                if splits and max(splits)[0] > 1e-12:
                    _, f, edge = max(splits)
                    tree.splits[node] = -f, edge
                    left = count[-f][: edge + 1].sum()
                    tree.wanted[2 * node + 1 if left <= count[-f].sum() - left else 2 * node + 2] = node
    return grown

"""Connected components of an edge table, without gathering it anywhere.

In each round every node takes its least neighbour, or itself, as label, labels are followed to their roots (each step doubles the
way), and the edges between different roots are what is left for the next round; stars vanish in one. The labels of
the rounds are put one after the other. Minima are pre-aggregated where rows lie, so a node with very many
neighbours costs one row per task; joins leave skewed sides to AQE. Every step is written to the shared folder and replaces
the one before.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, written


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of in-memory edges: each node and the least node of its component."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        m = np.minimum(label[i], label[j])
        np.minimum.at(label, i, m)
        np.minimum.at(label, j, m)
        np.minimum.at(label, old, label)
        while (label[label] != label).any():
            label = label[label]
        if (label == old).all():
            return nodes, nodes[label]


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b); returns (node, label) with the least node of each component as label, for all nodes of edges, as a written table."""
    one = lambda df: df.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now, rounds = written(one(edges), "edges"), []
    while not now.isEmpty():
        ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")
        label = written(now.select(ends).groupBy("e.node").agg(F.least("node", F.min("e.other")).alias("label")), "labels")
        while True:  # to the roots: every label is a node
            up = label.select(F.col("node").alias("label"), F.col("label").alias("up"))
            after = written(label.join(up, "label").select("node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved")), "labels")
            dropped(label)
            done = after.filter("moved").isEmpty()
            label = after.select("node", "label")
            label.written_path = after.written_path
            if done:
                break
        low, high = (label.select(F.col("node").alias(c), F.col("label").alias(f"{c}_")) for c in "ab")
        after = written(one(now.join(low, "a").join(high, "b").select(F.col("a_").alias("a"), F.col("b_").alias("b"))), "edges")
        dropped(now)
        now = after
        rounds.append(label)
    dropped(now)
    if not rounds:
        return written(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0), "labels")
    out = rounds[0]
    for later in rounds[1:]:
        out = out.join(later.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    out = written(out, "components")
    dropped(*rounds)
    return out

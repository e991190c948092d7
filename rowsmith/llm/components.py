"""Connected components: a forest inside a task, and label propagation with shortcuts over a cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import stored


class Forest:
    """Union of places 0 .. n - 1 inside one task; a tree's root is its smallest place."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(p, q):
                self.parent = p
                return p
            p = q

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join a[i] with b[i] for all i."""
        while len(a):
            p = self.roots()
            x, y = p[a], p[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            open_ = lo != hi
            if not open_.any():
                return
            a, b, lo, hi = a[open_], b[open_], lo[open_], hi[open_]
            np.minimum.at(p, hi, lo)
            self.parent = p


def connected(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(id, label) for every id on an edge (``a``, ``b``: longs): the smallest id of its component.

    Each round gives every vertex the smallest label among itself, its neighbours and its label's own vertex (a shortcut, so long
    chains take a logarithmic number of rounds), as joins and one grouped minimum, and is written to shared storage.
    Grouped minima combine before the shuffle, so a hub with many edges is no hot key.
    """
    links = stored(
        edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(
            edges.select(F.col("b").alias("v"), F.col("a").alias("w"))
        ),
        "components-links",
    )
    labels = stored(links.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("label")), "components-labels")
    for _ in range(max_rounds):
        near = links.join(labels.select(F.col("v").alias("w"), "label"), "w").groupBy("v").agg(F.min("label").alias("seen"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "seen").alias("seen"))
        # hook: the old label's vertex learns the smaller label as well
        hooked = (
            step.select(F.col("v").alias("k"), F.col("seen"))
            .unionByName(step.where("seen < label").select(F.col("label").alias("k"), "seen"))
            .groupBy("k")
            .agg(F.min("seen").alias("up"))
        )
        # shortcut: take the label of one's label
        new = hooked.join(hooked.select(F.col("k").alias("up"), F.col("up").alias("upper")), "up", "left").select(
            F.col("k").alias("v"), F.least("up", "upper").alias("label")
        )
        new = stored(new.join(labels.withColumnRenamed("label", "old"), "v"), "components-labels")
        changed = new.where("label < old").limit(1).count()
        labels = new.select("v", "label")
        if not changed:
            return labels.withColumnRenamed("v", "id")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

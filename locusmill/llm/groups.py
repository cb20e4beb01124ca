"""Connected components of a graph given by its edges, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusmill.llm.shared import batch, written


class Forest:
    """Union-find over integers; the smallest member names a group."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


#: Members of a task's union-find at which it hands over its edges and starts anew.
FOREST_NODES = 500_000


def _thinned(edges: DataFrame) -> DataFrame:
    """A forest of each task's edges: one edge for each member, to the smallest of its group."""

    def run(batches):
        forest = Forest()

        def edges_of():
            pairs = [(x, r) for x in forest.parent if (r := forest.find(x)) != x]
            return batch("a long, b long", [p[0] for p in pairs], [p[1] for p in pairs])

        for part in batches:
            for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                forest.join(a, b)
            if len(forest.parent) > FOREST_NODES:
                yield edges_of()
                forest = Forest()
        yield edges_of()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node that has an edge; ``component`` is its smallest node.

    Each round every node takes the smallest label among its own and its neighbours', and then
    the label of that label, so labels move over twice the distance each time. Rounds end when
    no label changes. Sums of a round are combined in the tasks before the shuffle.
    """
    thin = written(_thinned(edges), "edges")
    both = thin.union(thin.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component")
    )
    labels = written(labels, "labels")
    while True:
        far = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        taken = labels.join(far, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        ahead = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = written(
            taken.join(ahead, "next", "left").select("node", "old", F.least("next", "beyond").alias("component")), "labels"
        )
        labels = moved.select("node", "component")
        if moved.where("old != component").isEmpty():
            return labels

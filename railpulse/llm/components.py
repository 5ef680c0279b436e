"""Connected components of a table of links, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import gathered, stored

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in ``links`` (a, b); component is the smallest id reachable.

    Alternates two steps until nothing changes: hang every larger neighbour of a
    node on its smallest neighbour, then every smaller one. A node's smallest
    neighbour comes from an aggregation that combines before it shuffles, and is
    joined back to its links, so Spark can split a node with very many of them.
    Every round ends in a written table, of as many files as the number of links,
    which never grows, calls for. Links of an id to itself or with null are
    ignored; no links give no rows.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v and a is not null and b is not null").distinct(),
        "edges",
    ) if links.columns else links
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = edges.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        edges = stored(gathered(edges, before[0]), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
    return gathered(found, 2 * before[0])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def with_components(rows: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``component_id``: the component of ``key``, or the key itself where nothing links it."""
    found = connected_components(links).withColumnsRenamed({"id": key, "component": "_component"})
    return rows.join(found, key, "left").withColumn("component_id", F.coalesce("_component", key)).drop("_component")


class Forest:
    """Union-find over the few ids of one task; the smallest id of a set is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent.setdefault(a, a)
        self.parent.setdefault(b, b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.parent if self.root(x) != x]

"""Near-duplicate vectors: HNSW graphs per shard, every shard searched by every vector.

Equal vectors are one class. Classes are dealt to shards by a hash, a task builds
the graph of a shard, and blocks of classes search every shard, a task each.
A search whose whole beam lies above the threshold is widened until it reaches
below it, so large groups are found whole. How wide beams begin is set by an audit
for each block and shard: a sample of the block is compared with an exact scan, and
the beam doubled until the recall of links is ``RECALL``, up to an exact scan. Recall
is the mean over queries, and small groups count apart from large ones: queries are
drawn at random until ``AUDITED_SMALL`` have links to fewer nodes than a beam is wide,
as those are never widened. Their own node does not count.
Links are confirmed by cosine in double precision.

A task returns for each class how many vectors it is linked with in the shard, and
a spanning forest of the links it saw, never the links of a group themselves.
Components are the union of all forests.

Defined cases: vectors that are null, of zero length or norm, or with null or
non-finite components, link with nothing; vectors of different dimensions do not
link; repeated vectors link with each other; an empty table gives no rows. A row
without vec_id is compared and counted like any other; a component is named by its
smallest vec_id that is not null, and is null, its rows kept, if it has none.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import small_batches, stored
from railpulse.llm.components import Forest, with_components
from railpulse.llm.hnsw import Graph

THRESHOLD = 0.9
RECALL = 0.99
BEAM = 32
LEAST_SHARDS = 6
SHARD_ROWS = 50_000
AUDITED = 24  # queries of large groups
AUDITED_SMALL = 100  # queries of small groups: one link lost in a hundred passes, two do not
DRAWN = 2048  # queries drawn to find them
DRAW = 256
SLICE = 512  # queries whose links are held at once


def links_of(
    graph: Graph, exact: np.ndarray, queries: np.ndarray, width: int, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links (query, node) at or above the threshold that beams from ``width`` on find.

    ``exact`` and ``queries`` are unit rows in double precision.
    """
    near = threshold - 1e-4
    rows, nodes = [], []
    waiting, beam = np.arange(len(queries)), width
    while len(waiting):
        if beam * 4 >= len(exact):
            row, node = np.nonzero(queries[waiting] @ exact.T >= near)
            rows.append(waiting[row])
            nodes.append(node)
            break
        ids, sims = graph.search(queries[waiting], beam)
        whole = sims[:, -1] < near
        row, place = np.nonzero((sims >= near) & whole[:, None])
        rows.append(waiting[row])
        nodes.append(ids[row, place])
        waiting, beam = waiting[~whole], beam * 4
    row, node = np.concatenate(rows), np.concatenate(nodes)
    sure = np.zeros(len(row), bool)
    for at in range(0, len(row), 1 << 16):
        part = slice(at, at + (1 << 16))
        sure[part] = np.einsum("kd,kd->k", queries[row[part]], exact[node[part]]) >= threshold
    return row[sure], node[sure]


def linked_sample(
    exact: np.ndarray, queries: np.ndarray, threshold: float, itself: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries drawn at random that link with few nodes, and of some that link with many."""
    order = np.random.default_rng(len(queries)).permutation(len(queries))[:DRAWN]
    few, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(order), DRAW):
        part = order[at:at + DRAW]
        near = queries[part] @ exact.T >= threshold
        if itself is not None:
            near[np.arange(len(part)), itself[part]] = False
        counts = near.sum(axis=1)
        few.append(part[(counts > 0) & (counts < BEAM - 1)])
        many.append(part[counts >= BEAM - 1])
        if sum(map(len, few)) >= AUDITED_SMALL:
            break
    return np.concatenate(few)[:AUDITED_SMALL], np.concatenate(many)[:AUDITED]


def audited_width(
    graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, itself: np.ndarray | None = None
) -> tuple[int, float]:
    """The narrowest beam whose recall of links passes on samples of small and of large groups, and the lesser recall.

    ``itself`` names the node of each query where the block is the shard.
    """
    samples = []
    for places in linked_sample(exact, queries, threshold, itself):
        if len(places):
            truth = queries[places] @ exact.T >= threshold
            if itself is not None:
                truth[np.arange(len(places)), itself[places]] = False
            samples.append((queries[places], truth))
    width = BEAM
    while True:
        recall = 1.0 if samples else 0.0
        for sample, truth in samples:
            hit = np.zeros_like(truth)
            hit[links_of(graph, exact, sample, width, threshold)] = True
            recall = min(recall, float(((hit & truth).sum(axis=1) / truth.sum(axis=1)).mean()))
        if recall >= RECALL or width * 4 >= len(exact):
            return width, recall
        width *= 2


def unit_rows(blob: bytes, dim: int) -> np.ndarray:
    found = np.frombuffer(blob, "<f8").reshape(-1, dim)
    # Scaled first, so that squares neither overflow nor vanish.
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) of all vectors (vec_id, embedding)."""
    spark = vectors.sparkSession
    small_batches(spark, 2048)
    values = F.col("embedding").cast("array<double>")
    usable = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0),
        F.lit(False),
    )
    rows = stored(
        vectors.select(
            "vec_id", F.when(usable, F.transform(values, lambda x: x + F.lit(0.0))).alias("embedding")
        ).select("*", F.xxhash64("embedding").alias("_a"), F.hash(F.reverse("embedding")).alias("_b")),
        "vectors",
    )
    newest = rows.agg(F.max("vec_id")).first()[0] or 0
    classes = stored(
        rows.where("embedding is not null").groupBy("_a", "_b").agg(
            F.min(F.struct(F.col("vec_id").isNull().alias("unknown"), "vec_id", "embedding")).alias("first"),
            F.count("*").alias("copies"),
        ).select("_a", "_b", F.coalesce("first.vec_id", F.lit(newest + 1) + F.monotonically_increasing_id()).alias("class"),
                 "first.embedding", "copies", F.size("first.embedding").alias("dim")),
        "vector-classes",
    )
    sizes = [(r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()]
    searched = [_search(classes.where(F.col("dim") == dim), dim, n, threshold) for dim, n in sizes]
    if searched:
        found = stored(functools.reduce(DataFrame.unionByName, searched), "vector-links")
    else:
        found = spark.createDataFrame([], "class long, links long, a long, b long")
    links = found.where("class is not null").groupBy("class").agg(F.sum("links").alias("links"))
    members = with_components(classes.select("class", "_a", "_b", "copies"), found.where("a is not null"), "class")
    members = members.join(links, "class", "left").select(
        "_a", "_b", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("component_id") <= newest, F.col("component_id")).alias("component_id"),
    )
    linked = rows.where("embedding is not null").join(members, ["_a", "_b"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _search(classes: DataFrame, dim: int, count: int, threshold: float) -> DataFrame:
    """Links and forests of the classes of one dimension."""
    spark = classes.sparkSession
    shards = max(1, min(LEAST_SHARDS, -(-count // 64)), -(-count // SHARD_ROWS))
    names = ["shard", "ids", "copies", "vectors"]

    def gather(batches):
        """The shards of a task as one row each: ids, copies and vectors as bytes."""
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            for s in np.unique(shard).tolist():
                held.setdefault(s, []).append(batch.filter(pa.array(shard == s)))
        for s, parts in held.items():
            table = pa.Table.from_batches(parts).sort_by("class")
            values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("embedding").chunks])
            yield pa.RecordBatch.from_arrays([
                pa.array([s], pa.int32()),
                *(pa.array([table.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("class", "copies")),
                pa.array([values.astype("<f8").tobytes()], pa.binary()),
            ], names)

    dealt = classes.select(
        F.pmod(F.xxhash64("class"), F.lit(shards)).cast("int").alias("shard"), "class", "copies", "embedding"
    ).repartition(shards, "shard")
    blocks = stored(dealt.mapInArrow(gather, "shard int, ids binary, copies binary, vectors binary"), "vector-shards")

    def build(batches):
        for batch in batches:
            for row in batch.to_pylist():
                graph = Graph(unit_rows(row["vectors"], dim), zlib.crc32(row["ids"]))
                links = np.concatenate([layer.ravel() for layer in graph.layers]).astype("<i4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]], pa.int32()), pa.array([links.tobytes()], pa.binary()),
                    pa.array([graph.levels.astype("<i4").tobytes()], pa.binary()),
                ], ["shard", "links", "levels"])

    spread = blocks.repartition(shards, "shard")
    graphs = stored(spread.mapInArrow(build, "shard int, links binary, levels binary"), "vector-graphs")

    # Every block of queries meets every shard: two keyed tables, a task-sized piece of work per pair.
    numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    queries = blocks.select(
        F.col("shard").alias("block"), F.explode(numbers).alias("shard"),
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
    )
    indexed = blocks.join(graphs, "shard").select(
        "shard", F.explode(numbers).alias("block"), "ids", "copies", "vectors", "links", "levels"
    )

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                exact = unit_rows(row["vectors"], dim)
                graph = Graph.restored(exact, np.frombuffer(row["levels"], "<i4"), np.frombuffer(row["links"], "<i4"))
                ids, q_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                copies = np.frombuffer(row["copies"], "<i8")
                asked = unit_rows(row["q_vectors"], dim)
                itself = np.arange(len(ids)) if np.array_equal(ids, q_ids) else None
                width, _ = audited_width(graph, exact, asked, threshold, itself)
                linked, forest, roots = np.zeros(len(q_ids), np.int64), Forest(), ids.copy()
                for start in range(0, len(q_ids), SLICE):
                    q, n = links_of(graph, exact, asked[start:start + SLICE], width, threshold)
                    q = q + start
                    other = q_ids[q] != ids[n]
                    q, n = q[other], n[other]
                    linked += np.bincount(q, copies[n], len(q_ids)).astype(np.int64)
                    # Nodes known to be connected count as one, so a large group adds a link per query.
                    for a, b in np.unique(np.column_stack([q_ids[q], roots[n]]), axis=0).tolist():
                        forest.join(a, b)
                    known, place = np.unique(roots[n], return_inverse=True)
                    roots[n] = np.array([forest.root(x) for x in known.tolist()], np.int64)[place]
                some = np.flatnonzero(linked)
                links = forest.links()
                none = [None] * len(links)
                yield pa.RecordBatch.from_arrays([
                    pa.array(q_ids[some].tolist() + none, pa.int64()), pa.array(linked[some].tolist() + none, pa.int64()),
                    pa.array([None] * len(some) + [a for a, _ in links], pa.int64()),
                    pa.array([None] * len(some) + [b for _, b in links], pa.int64()),
                ], ["class", "links", "a", "b"])

    small_batches(spark, 8)
    work = queries.join(indexed, ["shard", "block"]).repartition(shards * shards, "shard", "block")
    found = stored(work.mapInArrow(search, "class long, links long, a long, b long"), "vector-found")
    small_batches(spark, 2048)
    return found

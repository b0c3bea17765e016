"""Hierarchies and dependency graphs, level by level as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_sort, checkpointed, small

#: Rows of one key from which they are not gathered in one task.
HEAVY = 100_000


def _heavy(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys of over HEAVY rows; None if there are none."""
    found = checkpointed(rows.groupBy(key).agg(F.count("*").alias("_c")).where(F.col("_c") > HEAVY).select(key))
    return found if found.limit(1).count() else None


def _met(rows: DataFrame, other: DataFrame, key: str, heavy: DataFrame | None, how: str = "inner") -> DataFrame:
    """`rows` joined to `other`, but those of `heavy` keys stay where they are: what they meet is broadcast.

    That is some row for each of HEAVY rows of the result, or one a key where `other` has no repeats.
    """
    if heavy is None:
        return rows.join(other, key, how)
    many = F.broadcast(heavy)
    usual = by_sort(rows.join(many, key, "left_anti")).join(other.join(many, key, "left_anti"), key, how)
    return usual.unionByName(rows.join(many, key, "left_semi").join(F.broadcast(other.join(many, key, "left_semi")), key, how))


def descendants(edges: DataFrame) -> DataFrame:
    """All (ancestor, node, depth) of parent-child edges (parent, node), by the least depth, however deep.

    Reach doubles each round: a shortest path of more than `span` steps begins with one of exactly `span`,
    so only pairs at that depth are joined on. It is done when there are none. A cycle raises: a node would be
    its own ancestor. Null ends are left out. Each round is written, so jobs run while the result is built. An ancestor
    of very many nodes is not gathered for the join (`_met`).
    """
    known = edges.where(F.col("parent").isNotNull() & F.col("node").isNotNull())
    reach, span = checkpointed(known.select(F.col("parent").alias("ancestor"), "node", F.lit(1).alias("depth")).distinct()), 1
    while True:
        if reach.where(F.col("ancestor") == F.col("node")).limit(1).count():
            raise ValueError("the hierarchy has a cycle")
        front = reach.where(F.col("depth") == span).select("ancestor", F.col("node").alias("via"))
        if not front.limit(1).count():
            return reach
        on = reach.select(F.col("ancestor").alias("via"), "node", (F.col("depth") + span).alias("depth"))
        reach = checkpointed(reach.union(_met(on, front, "via", _heavy(on, "via")).select("ancestor", "node", "depth")).groupBy("ancestor", "node").agg(F.min("depth").alias("depth")))
        span *= 2


def topological_layers(edges: DataFrame) -> DataFrame:
    """The layer of every node of `edges` (front, back): 0 without incoming edges, else one after its latest front.

    Each round takes the nodes that no open edge enters. Edges left without such a node are a cycle, and raise.
    """
    nodes = edges.select(F.col("front").alias("node")).union(edges.select("back")).distinct()
    return _peeled(nodes, edges)


def _peeled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    if edges.where(F.col("front") == F.col("back")).limit(1).count():
        raise ValueError("an edge leads to its own node")
    open_, nodes = checkpointed(edges.select("front", "back").distinct()), checkpointed(nodes)
    heavy = _heavy(open_, "front")
    done, layer = nodes.limit(0).withColumn("layer", F.lit(0)), 0
    while nodes.limit(1).count():
        free = checkpointed(nodes.join(open_.select(F.col("back").alias("node")).distinct(), "node", "left_anti").withColumn("layer", F.lit(layer)))
        if not free.limit(1).count():
            raise ValueError("the graph has a cycle")
        done, layer = done.union(free), layer + 1
        nodes = checkpointed(nodes.join(free, "node", "left_anti"))
        open_ = checkpointed(_met(open_, free.select(F.col("node").alias("front")), "front", heavy, "left_anti"))
    return done


def peel_layers(candidates: DataFrame, edges: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """The order in which objects (node, priority) are taken off: node, layer, place (from 1, by falling priority, then node, in the layer).

    An edge (front, back, confidence, verified) of at least `min_confidence` between candidates puts its front before its back. One
    that is not verified raises: what only an observation says orders nothing. Cycles raise.
    """
    ends = candidates.select("node")
    strong = checkpointed(edges.where(F.col("confidence") >= min_confidence).select("front", "back", "verified"))
    heavy = {side: _heavy(strong, side) for side in ("front", "back")}
    for side, many in heavy.items():
        strong = by_sort(_met(strong, ends.withColumnRenamed("node", side), side, many, "left_semi"))
    strong = checkpointed(strong)
    loose = strong.where(~F.coalesce("verified", F.lit(False))).select("front", "back").orderBy("front", "back").limit(5).collect()
    if loose:
        raise ValueError("edges without verified depth order remain: " + ", ".join(f"{r.front}->{r.back}" for r in loose))
    layers = _peeled(ends.distinct(), strong).join(candidates.select("node", "priority"), "node")
    # A layer is numbered in ranges, each by itself, after the rows of the ranges before it.
    order = [F.desc("priority"), F.col("node")]
    dealt = checkpointed(layers.repartitionByRange("layer", *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("layer", "_range").agg(F.count("*").alias("c"))
    earlier = F.sum("c").over(Window.partitionBy("layer").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    first = checkpointed(sizes.select("layer", "_range", F.coalesce(earlier, F.lit(0)).alias("first")))
    within = F.row_number().over(Window.partitionBy("layer", "_range").orderBy(*order))
    return dealt.join(small(first), ["layer", "_range"]).select("node", "layer", (F.col("first") + within).cast("int").alias("place"))


def stale_closure(needs: DataFrame, stale: DataFrame) -> DataFrame:
    """Nodes that are stale themselves or need, over any number of steps (node needs `needs`), one that is. A round without new nodes ends it."""
    found = checkpointed(stale.select("node").distinct())
    front = found
    while True:
        front = checkpointed(needs.join(front.select(F.col("node").alias("needs")), "needs").select("node").distinct().join(found, "node", "left_anti"))
        if not front.limit(1).count():
            return found
        found = checkpointed(found.union(front))


def rootless(parents: DataFrame) -> DataFrame:
    """Nodes on a cycle of (node, parent), or below one: node. A node without a parent (null), or whose parent is no node, ends there.

    Every node looks twice as far up each round; those that still find an ancestor farther up than there are nodes never end.
    """
    up = checkpointed(parents.where(F.col("parent").isNotNull()).select("node", F.col("parent").alias("up")).distinct())
    reach, most = 1, up.count()
    while reach <= most:
        on = up.select(F.col("node").alias("up"), F.col("up").alias("far"))
        up, reach = checkpointed(up.join(on, "up").select("node", F.col("far").alias("up")).distinct()), reach * 2
    return up.select("node").distinct()

"""Approximate nearest neighbours by inner product: a vantage-point tree for each shard.

Inner product is no metric, so vectors gain one coordinate, sqrt(M^2 - |x|^2) with M the largest
norm of their shard (0 for queries, which are taken at length M): the Euclidean distance of the longer
vectors falls as the inner product rises, and triangle inequalities hold. A shard has vectors of
like norms only (within a factor of two), as else the new coordinate would make all distances alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Rows of a shard and queries of a block, on average: what one task holds at a time.
SHARD_ROWS, BLOCK_QUERIES = 8192, 16384
LEAF_ROWS = 64
#: Exact products worked out at a time.
PRODUCTS = 1 << 14
#: Lower bounds are taken times this much before a subtree is left out. 1 searches exactly.
RELAX = 1.15


class VPTree:
    """Vantage points split their rows at the median distance; leaves hold up to LEAF_ROWS rows."""

    def __init__(self, rows: np.ndarray, seed: int = 7):
        self.rows = rows
        self.nodes: list[tuple] = []
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(rows)))

    def _build(self, at: np.ndarray) -> int:
        node = len(self.nodes)
        if len(at) <= LEAF_ROWS:
            self.nodes.append((None, at))
            return node
        self.nodes.append(())
        point = self.rows[at[self.random.integers(len(at))]]
        far = np.linalg.norm(self.rows[at] - point, axis=1)
        order = np.argsort(far, kind="stable")
        half = len(at) // 2
        parts = []
        for part in (order[:half], order[half:]):
            parts.append((far[part].min(), far[part].max(), self._build(at[part])))
        self.nodes[node] = (point, parts)
        return node

    def search(self, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of largest inner product with each query as found, and the products (-inf and -1: none).

        Rows are of one length M by their last coordinate, which queries have as 0; distances are those of queries scaled to M.
        Products are summed from the first component on, so equal vectors tie, and of ties the first rows are kept.
        A quick product only tells which rows can be among the k at all, with room for its rounding.
        """
        n = len(queries)
        best = np.full((n, k), -np.inf)
        found = np.full((n, k), -1)
        first = np.full(n, -1)
        norm = float(np.einsum("ij,ij->i", self.rows, self.rows).max(initial=0))
        sizes = np.einsum("ij,ij->i", queries, queries)
        slack = 1e-12 * np.sqrt(norm * sizes)
        ratio = np.where(sizes > 0, np.sqrt(norm) / np.sqrt(np.where(sizes > 0, sizes, 1)), 1.0)
        scaled = queries * ratio[:, None]
        self.scanned = 0

        def scan(rows: np.ndarray, who: np.ndarray) -> None:
            self.scanned += len(rows) * len(who)
            quick = queries[who] @ self.rows[rows].T
            q, r = np.nonzero(quick >= (best[who].min(axis=1) - slack[who])[:, None])
            if not len(q):
                return
            exact = np.full(quick.shape, -np.inf)
            for part in range(0, len(q), PRODUCTS):
                i, j = q[part : part + PRODUCTS], r[part : part + PRODUCTS]
                exact[i, j] = np.cumsum(queries[who[i]] * self.rows[rows[j]], axis=1)[:, -1]
            some = np.unique(q)
            who, exact = who[some], exact[some]
            d = np.concatenate([best[who], exact], axis=1)
            i = np.concatenate([found[who], np.where(exact > -np.inf, rows, -1)], axis=1)
            top = np.lexsort((i, -d), axis=1)[:, :k]
            best[who], found[who] = np.take_along_axis(d, top, 1), np.take_along_axis(i, top, 1)

        def descend(node: int, who: np.ndarray) -> None:
            """Each query to the leaf that its distances point at, for a first bound."""
            if not len(who):
                return
            point, rest = self.nodes[node]
            if point is None:
                first[who] = node
                scan(rest, who)
                return
            far = np.linalg.norm(scaled[who] - point, axis=1)
            inner = far < (rest[0][1] + rest[1][0]) / 2
            descend(rest[0][2], who[inner])
            descend(rest[1][2], who[~inner])

        def visit(node: int, who: np.ndarray) -> None:
            point, rest = self.nodes[node]
            if point is None:
                who = who[first[who] != node]
                if len(who):
                    scan(rest, who)
                return
            far = np.linalg.norm(scaled[who] - point, axis=1)
            for low, high, child in rest:
                bound = np.maximum(np.maximum(low - far, far - high), 0) * relax
                worst = np.sqrt(np.maximum(2 * norm - 2 * best[who].min(axis=1) * ratio[who], 0))
                go = who[bound <= worst + 1e-6 * np.sqrt(norm)]  # rounding must not cost a neighbour
                if len(go):
                    visit(child, go)

        descend(self.root, np.arange(n))
        visit(self.root, np.arange(n))
        return best, found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _searcher(k: int, relax: float):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not rows.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        vectors, ids = _matrix(rows.column("embedding")), rows.column("vec_id").to_numpy()
        asked, asked_ids = _matrix(queries.column("embedding")), queries.column("query_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors, ids = vectors[order], ids[order]
        # Equal vectors share a place in the tree; their k + 1 smallest ids are all that a result can need.
        unique, place = np.unique(vectors, axis=0, return_inverse=True)
        place = place.reshape(-1)
        first = np.full(len(unique), len(ids))
        np.minimum.at(first, place, np.arange(len(ids)))
        by_first = np.argsort(first)  # places in the order of their smallest ids, so that ties keep those
        unique, place = unique[by_first], np.argsort(by_first)[place]
        by_place = np.argsort(place, kind="stable")
        begins = np.searchsorted(place[by_place], np.arange(len(unique) + 1))
        norm = np.einsum("ij,ij->i", unique, unique)
        longer = np.concatenate([unique, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1)
        _, found = VPTree(longer).search(np.concatenate([asked, np.zeros((len(asked), 1))], axis=1), k + 1, relax)
        out_q, out_v, out_s = [], [], []
        for q, own, places in zip(asked, asked_ids, found, strict=True):
            places = places[places >= 0]
            score = np.cumsum(unique[places] * q, axis=1)[:, -1]  # summed from the first component on, so equal vectors tie
            some = [by_place[begins[p] : min(begins[p + 1], begins[p] + k + 1)] for p in places]
            v = ids[np.concatenate(some)] if some else np.zeros(0, np.int64)
            s = np.repeat(score, [len(x) for x in some])
            keep = v != own
            v, s = v[keep], s[keep]
            top = np.lexsort((v, -s))[:k]
            out_q.append(np.full(len(top), own))
            out_v.append(v[top])
            out_s.append(s[top])
        return pa.table([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_v)), pa.array(np.concatenate(out_s))], names=names)

    return search


def valid(vector: Column) -> Column:
    """Neither null nor zero, every component there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, relax: float = RELAX, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k rows of `vectors` (vec_id, embedding, ...) of largest inner product with each of `queries`.

    Returns query_id, rank (from 1), vec_id and score, best first, ties to the smaller
    vec_id. Rows are dealt by norm (powers of two), then to shards by a hash of vec_id, and each shard has its own tree;
    a subtree is left out if the triangle inequality's lower bound, times `relax`, is over
    the distance of the kth row so far. Each block of queries meets each shard once, so
    one task holds `shard_rows` rows and `block_queries` queries at most, about.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor
    do rows with a null vec_id. Vectors meet queries of their own length only. Rows under
    the query's vec_id are its own and no candidates; repeated query ids count once. Fewer
    than k candidates: all. Other columns are left out. Empty input: empty output.
    """
    rows = vectors.where(valid(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    asked = queries.where(valid(F.col("embedding")) & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    band = F.coalesce(F.floor(F.log2(F.least(square, F.lit(1e300))) / 2).cast("int"), F.lit(-10_000))
    held = rows.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()  # a double has some 2,000 powers of two
    sizes = {r.band: -(-r.n // shard_rows) for r in held} or {0: 1}
    blocks = max(1, -(-asked.count() // block_queries))
    shards = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))
    keyed = rows.withColumn("band", band).withColumn("shards", shards[F.col("band")])
    keyed = keyed.select("vec_id", "embedding", F.size("embedding").alias("dims"), "band", F.pmod(F.xxhash64("vec_id"), F.col("shards")).alias("shard"))
    keyed = keyed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = asked.select("query_id", "embedding", F.size("embedding").alias("dims"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))
    each = F.array(*(F.struct(F.lit(b).alias("band"), F.lit(n).cast("long").alias("n")) for b, n in sizes.items()))
    dealt = dealt.withColumn("b", F.explode(each)).select("*", "b.band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b.n") - 1)).alias("shard")).drop("b")
    keys = ["dims", "band", "shard", "block"]
    found = keyed.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_searcher(k, relax), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2])) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

"""Operator 9: exact top-k inner-product search with a ball tree per shard.

Vectors are dealt into shards of bounded size by a hash of id and vector, queries into blocks of bounded
size. Each task holds one shard and one block of queries. It builds a ball tree over the shard, orders
nodes by the upper bound q.c + |q| r of their inner products, and leaves out a node whose bound is
below the query's current k-th score. That score is shared in two rounds: a query first searches its
own shard; the k-th score it finds there is the floor with which it searches all others.

Every row counts. Rows that repeat both id and vector are counted before they are dealt and stand for
``k`` + 1 rows at most, which is all that a result can show of them; a query leaves out one row of its own
id and vector, and no other row of its id. A query that is there several times is answered as many times.

Scores are exact integers. Defined results: vectors that are null or hold a null or non-finite
component, and rows without an id, take no part; only vectors of equal length are compared; ties go to
the smaller id; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, a long, b long, vec_id long, score long"


@dataclass(frozen=True)
class Settings:
    k: int = 5
    shard_rows: int = 4096   # vectors in a shard, about
    block_rows: int = 4096   # queries in a block, about
    leaf_rows: int = 256


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component, for the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    valid = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(finite)
    v = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return valid.select(F.col(vec_id).alias("id"), v.alias("v"))


# ------------------------------------------------------------------------------ inside one task
class Ball:
    """A node: centre and radius of its vectors, and two halves or (in a leaf) the vectors' places."""

    __slots__ = ("centre", "radius", "halves", "places")

    def __init__(self, x: np.ndarray, places: np.ndarray, leaf: int):
        own = x[places]
        self.centre = own.mean(axis=0)
        self.radius = float(np.sqrt(((own - self.centre) ** 2).sum(axis=1).max()))
        self.halves, self.places = (), np.sort(places)
        if len(places) > leaf and self.radius > 0:
            # Halve along the direction from the vector farthest from the centre to the one farthest from it.
            a = own[((own - self.centre) ** 2).sum(axis=1).argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            along = (own @ (b - a)).argsort(kind="stable")
            half = len(places) // 2
            self.halves = (Ball(x, places[along[:half]], leaf), Ball(x, places[along[half:]], leaf))

    def bound(self, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        top = q @ self.centre + norm * self.radius
        return top + 1e-9 * np.abs(top) + 1e-6  # never below the true bound through rounding


class Search:
    """Branch and bound of a block of queries over one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, leaf: int, first: np.ndarray | None = None):
        order = ids.argsort(kind="stable")
        self.ids, self.x, self.k = ids[order], x[order], k
        # Of rows that repeat id and vector one is first: the row that a query itself is.
        self.first = np.ones(len(ids), bool) if first is None else first[order]
        self.flat = self.x.astype(np.float64)
        self.root = Ball(self.flat, np.arange(len(ids)), leaf)

    def run(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray):
        """Scores and ids (missing: id -1) of the best k for each query; only scores of at least ``floor`` matter."""
        self.q_ids, self.q, self.floor = ids, q, floor
        self.q_flat = q.astype(np.float64)
        self.norm = np.sqrt((self.q_flat ** 2).sum(axis=1))
        largest = max(np.abs(self.flat).max(initial=0), np.abs(self.q_flat).max(initial=0)) ** 2 * max(1, q.shape[1])
        self.exact = largest < 2 ** 53  # then sums of products are exact in doubles
        self.score = np.full((len(ids), self.k), np.iinfo(np.int64).min, np.int64)
        self.found = np.full((len(ids), self.k), -1, np.int64)
        self.kth = floor.astype(np.float64)
        self.visit(self.root, np.arange(len(ids)))
        return self.score, self.found

    def visit(self, node: Ball, rows: np.ndarray) -> None:
        rows = rows[node.bound(self.q_flat[rows], self.norm[rows]) >= self.kth[rows]]
        if not len(rows):
            return
        if not node.halves:
            self.leaf(node, rows)
            return
        a, b = node.halves
        first = a.bound(self.q_flat[rows], self.norm[rows]) >= b.bound(self.q_flat[rows], self.norm[rows])
        # Each query takes its more promising half first; the other is tested against what that gave.
        self.visit(a, rows[first])
        self.visit(b, rows[~first])
        self.visit(b, rows[first])
        self.visit(a, rows[~first])

    def leaf(self, node: Ball, rows: np.ndarray) -> None:
        k, none = self.k, np.iinfo(np.int64).min
        ids = self.ids[node.places]
        if self.exact:
            got = (self.q_flat[rows] @ self.flat[node.places].T).astype(np.int64)
        else:
            got = (self.q[rows].astype(object) @ self.x[node.places].T.astype(object)).astype(np.int64)
        own = (self.q_ids[rows][:, None] == ids[None, :]) & self.first[node.places][None, :]
        a, b = np.nonzero(own)
        own[a, b] = (self.q[rows[a]] == self.x[node.places[b]]).all(axis=1)
        got[own] = none
        best = np.argsort(-got.astype(np.float64) if self.exact else ~got, axis=1, kind="stable")[:, :k]
        score = np.concatenate([self.score[rows], np.take_along_axis(got, best, 1)], axis=1)
        found = np.concatenate([self.found[rows], np.where(np.take_along_axis(own, best, 1), -1, ids[best])], axis=1)
        order = np.lexsort((found, ~score, found < 0), axis=1)[:, :k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.found[rows] = np.take_along_axis(found, order, 1)
        full = self.found[rows][:, -1] >= 0
        self.kth[rows] = np.where(full, np.maximum(self.score[rows][:, -1], self.floor[rows]), self.floor[rows])


def _matrix(t: pa.Table, name: str = "v") -> np.ndarray:
    v = t.column(name).combine_chunks()
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(t), -1) if len(t) else flat.reshape(0, 0)


def _search(settings: Settings):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = pa.schema([(n, pa.int64()) for n in ("query_id", "a", "b", "vec_id", "score")])
        if not len(vectors) or not len(queries):
            return names.empty_table()
        first = vectors.column("copy").to_numpy() == 1
        tree = Search(vectors.column("id").to_numpy(), _matrix(vectors), settings.k, settings.leaf_rows, first)
        ids, q = queries.column("q_id").to_numpy(), _matrix(queries, "q_v")
        floor = queries.column("q_floor").to_numpy(zero_copy_only=False).astype(np.int64)
        score, found = tree.run(ids, q, floor)
        there = (found >= 0) & (score >= floor[:, None])
        named = [np.repeat(x, settings.k)[there.ravel()] for x in (
            ids, queries.column("q_a").to_numpy(), queries.column("q_b").to_numpy())]
        return pa.table([*named, found[there], score[there]], schema=names)

    return run


def top_k(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of each row of ``vectors``
    (id, v) for which ``is_query`` holds, over all other rows."""
    rows = vectors.groupBy("id", "v").agg(F.count("*").alias("copies")).select(
        "id", "v", "copies", F.size("v").alias("dim"), F.xxhash64("id", "v").alias("a"),
        F.xxhash64(F.lit(1), "id", "v").alias("b"))
    n = max(1, vectors.count())
    shards, blocks = -(-n // settings.shard_rows), max(1, -(-vectors.filter(is_query).count() // settings.block_rows))
    # Vectors of another length are in other shards: only equal lengths meet.
    dealt = rows.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    queries = dealt.filter(is_query).withColumn("block", F.pmod("b", F.lit(blocks)).cast("int"))
    # A shard meets every block of queries.
    shown = F.least("copies", F.lit(settings.k + 1)).cast("int")
    spread = dealt.select("id", "v", "dim", "shard", F.explode(F.sequence(F.lit(1), shown)).alias("copy")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ("dim", "shard", "block")
    low = F.lit(-(2 ** 63)).cast("long")
    search = _search(settings)

    def meet(asked: DataFrame) -> DataFrame:
        asked = asked.toDF(*[f"q_{c}" for c in asked.columns])  # both sides come from the same frame
        left = spread.groupBy(*keys).cogroup(asked.groupBy(*[f"q_{c}" for c in keys]))
        return left.applyInArrow(lambda a, b: search(a, b), FOUND)

    own = meet(queries.select("id", "v", "a", "b", *keys, low.alias("floor")))
    kth = own.groupBy("a", "b").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    floors = kth.filter(F.col("found") >= settings.k).select("a", "b", "least")
    home = F.col("shard")
    others = queries.join(floors, ["a", "b"], "left").select(
        "id", "v", "a", "b", "dim", "block", F.coalesce("least", low).alias("floor"),
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)).alias("shard"))
    both = own.union(meet(others)) if shards > 1 else own
    order = Window.partitionBy("query_id", "a", "b").orderBy(F.desc("score"), "vec_id")
    best = both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
    times = queries.filter("copies > 1").select("a", "b", "copies")
    return best.join(times, ["a", "b"], "left").withColumn(
        "time", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long"))))).select(
        "query_id", "rank", "vec_id", "score")

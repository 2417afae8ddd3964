import math
import random

import numpy as np
from pyspark.sql import functions as F

from cohortkit.llm import topk_search as op


def rows(seed=0, n=230, dim=6):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    out += [(300 + i, [0.5] * dim) for i in range(120)]        # one very common vector
    out += [(500, None), (550, [float("nan")] * dim), (551, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (552, [float("inf")] * dim),
            (600, [1.0, 2.0]), (650, [3.0, -1.0]), (None, [1.0] * dim), out[0], out[0]]
    out += [(50, [9.0] * dim), (50, [9.0] * dim), (50, [-1.0] * dim), (7, [4.0] * dim), (7, [5.0] * dim), (9, [3.0] * dim)]
    out += [(11, [2.0] * dim)] * 9  # one row many times
    return out


def brute(data, k=5):
    v = [(i, [math.floor(256 * np.float64(np.float32(c))) for c in x]) for i, x in data
         if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for at, (q, x) in enumerate(v):
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for o, (c, y) in enumerate(v) if o != at and len(y) == len(x))
            out += [(q, r + 1, c, -y) for r, (y, c) in enumerate(s[:k])]
    return sorted(out)


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash"))
    vectors = op.integer_vectors(df)
    for settings in (op.Settings(), op.Settings(shard_rows=40, block_rows=3, leaf_rows=8)):
        got = op.top_k(vectors, F.col("id") % 50 == 0, settings)
        assert sorted(map(tuple, got.collect())) == brute(data)


def test_rows_that_repeat_an_id_are_kept(spark):
    vectors = spark.createDataFrame([(50, [1, 0]), (7, [1, 0]), (7, [3, 0]), (8, [2, 0])], "id long, v array<long>")
    got = op.top_k(vectors, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(7, 3), (8, 2), (7, 1)]


def test_oracle_with_repeated_ids(spark, tmp_path):
    from .test_oracles import same
    data = [r for r in rows() if r[1] is None or len(r[1]) == 6]
    spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    same(spark, str(tmp_path), "op9_top_k", ["embeddings"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.top_k(op.integer_vectors(df), F.col("id") % 50 == 0).count() == 0


def test_large_components_stay_exact():
    rng = np.random.default_rng(0)
    x = rng.integers(-2 ** 30, 2 ** 30, (300, 4))
    ids = np.arange(300)
    score, found = op.Search(ids, x, 3, 16).run(ids[:5], x[:5], np.full(5, -2 ** 63, np.int64))
    for q in range(5):
        s = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], x[c], strict=True)), c) for c in range(300) if c != q)[:3]
        assert [(-int(a), int(b)) for a, b in zip(score[q], found[q], strict=True)] == s


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5)) * 100
    ball = op.Ball(x, np.arange(500), 10)
    q = rng.normal(size=(20, 5))
    norm = np.sqrt((q ** 2).sum(1))

    def walk(node):
        assert (node.bound(q, norm)[:, None] >= q @ x[node.places].T).all()
        for h in node.halves:
            walk(h)
    walk(ball)

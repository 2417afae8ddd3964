import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import lexical_search as op

from .helpers import frame, prose
from .test_oracles import same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs = sum(n > 0 for _, _, n in held)
    n_terms = sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            if n:
                m = 75 + 25 * n * n_docs // n_terms
                s = sum(w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
                if s > 0:
                    scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    docs = [(r[0], r[1]) for r in prose(n=60)]
    docs += [(5000 + i, "the very same text of many copies w7 w8") for i in range(150)]
    docs += [(6000 + i, " ".join(["w1"] * i + ["w2 É ünïcode A_b-c"])) for i in range(40)]
    docs += [(None, "w3 w3 w3 null id"), (None, "w3 w3 w3 null id"), (7000, "x\x00y\x7fz 0:9 \U0001f600"), (7001, "a" * 5000 + " w9" * 4000)]
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 60)))) for i in range(70)]
    items += [(100, "Very SAME w7 w7 w7"), (101, None), (102, ""), (103, "nothingknown"), (None, "null ID"), (104, "É É 9 y"),
              items[0], (105, items[0][1]), (106, " ".join(f"w{i}" for i in range(400)))]
    return docs, items


@pytest.mark.parametrize("settings", [
    op.Settings(), op.Settings(k=3, round_bytes=900, block_items=9, block_terms=60, block_docs=37, leaf_docs=4, fan=2, first_of=3,
                               chunk_bytes=50)])
def test_matches_brute_force(spark, settings):
    docs, items = corpus()
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("n", F.lit("x")).withColumn("first", F.lit(1))
    right = spark.createDataFrame(items, ITEMS).withColumn("key", F.lit("clash")).withColumn("rank", F.lit(0))
    got = op.search(left, right, settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, settings.k)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], ITEMS)
    assert op.search(docs, items.limit(0)).count() == 0
    assert op.search(docs.limit(0), items).count() == 0
    assert op.search(docs.withColumn("text", F.lit(None).cast("string")), items).count() == 0


def test_oracle_on_awkward_rows(spark, tmp_path):
    docs, items = corpus()
    docs = [r for r in docs if "\x00" not in (r[1] or "")]
    frame(spark, [(d, t, None, None, None) for d, t in docs]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    same(spark, str(tmp_path), "op11_lexical_search", ["documents", "benchmark"])


def block(rng, n_docs=300, n_terms=80):
    sizes = rng.integers(1, 12, n_docs)
    found = [np.sort(rng.choice(n_terms, s, replace=False)) for s in sizes]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(n_docs), np.zeros(n_docs, bool), ends, np.concatenate(found), rng.integers(1, 900, ends[-1])


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    settings = op.Settings(leaf_docs=4, fan=3, k=2)
    ids, null, ends, terms_, values = block(rng)
    docs = op.Documents(ids, null, ends, terms_, values, np.ones(len(terms_), np.int64), settings)
    vectors = [(np.sort(rng.choice(80, 6, replace=False)), rng.integers(1, 50, 6)) for _ in range(50)]
    vectors.append((np.arange(80), np.ones(80, np.int64)))
    items = op.Items(np.arange(51), vectors, settings)
    q, d = items.levels[0], np.zeros((80, 300))
    d[docs.terms, docs.row] = docs.values
    exact = q @ d
    for dl, (_, _, _, nodes) in enumerate(docs.levels):
        width = settings.leaf_docs * settings.fan ** dl
        for il, rows in enumerate(items.levels):
            for node in range(nodes):
                t, v = docs.node(dl, node)
                bound = rows[:, t] @ v
                under = np.maximum.reduceat(exact[:, node * width:(node + 1) * width].max(axis=1), np.arange(0, 51, settings.fan ** il))
                assert (bound >= under).all()
    search = op.Search(items, np.ones(51, np.int64), 2)
    leaves = []
    search.leaf = lambda node, active, own=search.leaf: (leaves.append(len(active)), own(node, active))
    search.run(docs)
    assert (search.best.score == -np.sort(-exact, axis=1)[:, :2]).all()
    assert sum(leaves) < 51 * docs.levels[0][3]  # some pairs of items and leaves were never scored


def test_large_scores_stay_exact():
    settings = op.Settings(k=1)
    big = 2 ** 36 + 1
    items = op.Items(np.arange(1), [(np.arange(2), np.array([big, big + 2]))], settings)
    docs = op.Documents(np.array([4]), np.array([False]), np.array([0, 2]), np.arange(2), np.array([999_999, 999_983]),
                        np.ones(2, np.int64), settings)
    search = op.Search(items, np.ones(1, np.int64), 1)
    search.run(docs)
    assert search.best.score[0, 0] == big * 999_999 + (big + 2) * 999_983

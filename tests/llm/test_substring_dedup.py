import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cohortkit.llm import substring_dedup as op
from cohortkit.llm import words as W

from .helpers import frame, prose, words


def brute(rows, window=35):
    split = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a:a + window])] > 1:
                gone[a:a + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    """Passages of several lengths, put whole or in parts into texts, also twice in one, and periodic runs."""
    rng = random.Random(seed)
    shared = [words(rng, n, 10_000) for n in (34, 35, 36, 50, 120)]
    rows = []
    for i in range(80):
        w = words(rng, rng.randrange(0, 120), 10_000)
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(shared)
            a, at = rng.randrange(0, 5), rng.randrange(0, len(w) + 1)
            w[at:at] = p[a:len(p) - rng.randrange(0, 5)]
        if i % 17 == 0:
            w += ["la"] * 40
        if i % 19 == 0:
            w += ["da", "di", "do"] * 20
        rows.append((i, " ".join(w), "en", "s", 0))
    return rows


def digests(df):
    from pyspark.sql import functions as F
    got = df.select(F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("d"))
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("settings", [op.Settings(), op.Settings(group_rows=2)], ids=["trees", "large partitions"])
@pytest.mark.parametrize("rows", [passages(0), passages(1), prose()], ids=["a", "b", "awkward"])
def test_matches_brute_force(spark, rows, settings):
    assert digests(op.remove_repeats(frame(spark, rows, clash=True).drop("rest"), settings)) == brute(rows)


def test_trees_and_hot_windows_are_both_in_use(spark):
    settings = op.Settings(group_rows=2)
    rows = op.keyed(frame(spark, passages(0)))
    shared = op.shared_anchors(op.anchor_rows(rows, settings), settings).cache()
    assert op.suffix_runs(rows, shared, settings).count() > 0 and op.hot_windows(rows, shared, settings).count() > 0


def test_deep_nodes_of_a_tree():
    rng = np.random.default_rng(3)
    for window in (1, 3, 5):
        runs = [rng.integers(0, 3, rng.integers(window, 12)).astype(np.uint64) for _ in range(30)]
        of, offset = op.tree([r.tobytes() for r in runs], window)
        every = [(i, k, tuple(r[k:k + window])) for i, r in enumerate(runs) for k in range(len(r) - window + 1)]
        seen = Counter(w for _, _, w in every)
        assert list(zip(of.tolist(), offset.tolist(), strict=True)) == [(i, k) for i, k, w in every if seen[w] > 1]


def test_partitions_cut_by_batches(spark):
    # One word changed behind a shared passage: many reaches under the same prefixes.
    rng = random.Random(5)
    passage = words(rng, 90, 10_000)
    rows = [(i, " ".join([f"x{i}", *passage, f"y{i}", *words(rng, 20, 10_000)]), "en", "s", 0) for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        split = op.keyed(frame(spark, rows))
        settings = op.Settings()
        shared = op.shared_anchors(op.anchor_rows(split, settings), settings)
        runs = op.suffix_runs(split, shared, settings).cache()
        found = Counter((r["key"], r["start"]) for r in op.tree_windows(runs, settings).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    every = [(r["key"], r["start"] + i, bytes(r["run"])[8 * i:8 * i + 8 * 35]) for r in runs.collect()
             for i in range(len(r["run"]) // 8 - 34)]
    seen = Counter(w for _, _, w in every)
    assert len(found) > 5000 and found == Counter((k, i) for k, i, w in every if seen[w] > 1)


def test_clashing_names_and_empty_table(spark):
    rows = prose()
    assert digests(op.remove_repeats(frame(spark, rows, clash=True))) == brute(rows)
    assert op.remove_repeats(frame(spark, [])).count() == 0


def test_anchors_are_the_least_prefix_of_each_window():
    rng = np.random.default_rng(0)
    settings = op.Settings()
    for n in (0, 34, 35, 36, 100, 400):
        h = W.mixed(rng.integers(0, 30, n).astype(np.uint64))
        first, last, place = op.anchors(h, settings)
        g = W.grams(h, settings.prefix)
        want = [s + int(np.argmin(g[s:s + 28])) for s in range(max(0, n - 34))]
        got = [p for a, b, p in zip(first, last, place, strict=True) for _ in range(a, b)]
        assert got == want


def test_reach_names_the_words_and_the_place():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 62, 300).astype(np.uint64)
    both = np.concatenate([h[40:200], h])
    begin, end = np.array([5, 0]), np.array([90, 160])
    assert (op._range_hash(both, begin, end) == op._range_hash(h, begin + 40, end + 40)).all()
    assert op._range_hash(both, begin, end)[0] != op._range_hash(both, begin + 1, end)[0]


def test_grams_depend_on_the_window_only():
    h = np.random.default_rng(2).integers(0, 2 ** 62, 120).astype(np.uint64)
    for k in (1, 2, 5, 8, 35):
        assert (W.grams(np.concatenate([h[50:50 + k], h]), k)[0] == W.grams(h, k)[50])
        assert len(W.grams(h, k)) == 121 - k and len(set(W.grams(h, k).tolist())) == 121 - k

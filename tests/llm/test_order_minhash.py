import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortkit.llm import order_minhash as op
from cohortkit.llm import words as W

from .helpers import frame, prose, words


def matches(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_banded_alignment_matches_the_table():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(0, rng.integers(2, 60), rng.integers(0, 150))
        y = list(x)
        for _ in range(rng.integers(0, 40)):
            p = rng.integers(0, len(y) + 1)
            y[p:p + rng.integers(0, 2)] = [99] * rng.integers(0, 2)
        y = np.array(y, x.dtype)
        best = matches(x, y)
        assert op.aligned(x, y, len(x) + len(y) - 2 * best) == best
        assert op.aligned(x, y, max(0, len(x) + len(y) - 2 * best - 5)) <= best
        for least in (0.5, 0.8):
            if len(x) and len(y):
                link, common = op.compared(x.astype(np.uint64), y.astype(np.uint64), least)
                assert link == (best / (len(x) + len(y) - best) >= least - 1e-12) and common >= best


def test_sketches_see_order_and_occurrence():
    seeds = W.mixed(np.arange(1, 41, dtype=np.uint64))
    h = W.mixed(np.arange(1, 300, dtype=np.uint64))
    same, turned = op.sketch(op.labelled(h), seeds), op.sketch(op.labelled(h[::-1].copy()), seeds)
    assert (same == op.sketch(op.labelled(h), seeds)).all() and not (same == turned).any()
    twice = op.labelled(np.concatenate([h[:5], h[:5]]))
    assert len(set(twice.tolist())) == 10 and (twice[:5] == h[:5]).all()
    assert len(op.sketch(op.labelled(h[:1]), seeds)) == 40


def brute(rows, least=0.8):
    """Classes by all pairs of different texts."""
    split = [(t or "").encode().split() for _, t, *_ in rows]
    name = [b" ".join(w) if w else repr(r).encode() for w, r in zip(split, rows, strict=True)]
    texts = {n: w for n, w in zip(name, split, strict=True)}
    root = {n: n for n in texts}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    keys = list(texts)
    grams = {n: [tuple(w[i:i + 5]) for i in range(len(w) - 4)] for n, w in texts.items()}
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = grams[a], grams[b]
            if x and y and len(set(x) & set(y)) >= 0.4 * max(len(set(x)), len(set(y))):
                m = matches(x, y)
                if m / (len(x) + len(y) - m) >= least:
                    root[find(a)] = find(b)
    classes = defaultdict(list)
    for n, r in zip(name, rows, strict=True):
        classes[find(n)].append(r[0])
    least_id = {c: min((i for i in ids if i is not None), default=None) for c, ids in classes.items()}
    return sorted(((r[0], least_id[find(n)]) for n, r in zip(name, rows, strict=True)), key=str)


def family(seed=0, n=120):
    """One text and copies of it with more and more words changed, and some that share a passage only."""
    rng = random.Random(seed)
    base, passage = words(rng, 150, 10_000), words(rng, 40, 10_000)
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(i % 12):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    for i in range(40):
        rows.append((500 + i, " ".join(passage + words(rng, 60, 10_000)), "en", "s", 0))
    return rows


def sub_families(seed=0, groups=60):
    """Edited copies of one text in many groups far from each other's centre: each group has its own set of
    changed places, a chain of three members a few words apart."""
    rng = random.Random(seed)
    base = words(rng, 200, 10_000)
    other = [f"o{i}" for i in range(200)]
    rows = []
    for g in range(groups):
        w = list(base)
        for p in rng.sample(range(0, 200, 5), rng.randrange(0, 11)):
            w[p] = other[p]
        for m in range(3):
            rows.append((3 * g + m, " ".join(w), "en", "s", 0))
            w = list(w)
            for _ in range(4):
                w[rng.randrange(200)] = f"e{rng.randrange(10 ** 6)}"
    return rows


def all_pairs(rows, least=0.8):
    """As ``brute``, with the whole alignment table of ``aligned``; for texts without copies."""
    grams = [W.grams(W.hashed([t.encode().split()])[0], 5) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for i, x in enumerate(grams):
        for j, y in enumerate(grams[:i]):
            if root[i] != root[j]:
                m = op.aligned(x, y, len(x) + len(y))
                if m / (len(x) + len(y) - m) >= least:
                    root = [root[j] if r == root[i] else r for r in root]
    return sorted((r[0], min(q[0] for q, k in zip(rows, root, strict=True) if k == c)) for r, c in zip(rows, root, strict=True))


@pytest.mark.parametrize("seed", [0, 1])
def test_sub_families_far_from_the_centre(spark, seed):
    rows = sub_families(seed)
    got = op.classes(frame(spark, rows)).select("doc_id", "class_id").collect()
    assert sorted(map(tuple, got)) == all_pairs(rows)


def test_pairs_that_agree_in_one_bucket_only_are_open():
    g = W.mixed(np.arange(1, 101, dtype=np.uint64))

    def row(label, sketches):
        return pa.table({"sk": [sketches.tobytes()], "n": pa.array([100], pa.int32()), "label": [label],
                         "band": pa.array([3], pa.int32()), "bits": [op.bitmap(g, 8).tobytes()]})

    x, y = np.arange(40, dtype=np.uint64), np.arange(100, 140, dtype=np.uint64)
    y[6:8] = x[6:8]
    assert op.open_pairs(row(1, x), row(2, y), op.Settings(), True) == ([0], [0])
    assert op.open_pairs(row(1, x), row(1, y), op.Settings(), False) == ([], [])


def test_bitmaps_bound_what_is_shared():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = op.labelled(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64))
        ys = [op.labelled(rng.integers(0, 400, n).astype(np.uint64)) for n in [rng.integers(1, 300)] * 3]
        bound = op.most_shared(len(x), op.bitmap(x, 8), np.array([len(y) for y in ys]), np.stack([op.bitmap(y, 8) for y in ys]))
        assert all(b >= len(np.intersect1d(x, y)) for b, y in zip(bound, ys, strict=True))


@pytest.mark.parametrize("rows", [family(), prose() + [(None, "a b", None, None, None)]], ids=["family", "awkward"])
@pytest.mark.parametrize("settings", [op.Settings(), op.Settings(block_rows=8)], ids=["default", "small blocks"])
def test_classes_match_all_pairs(spark, rows, settings):
    got = op.classes(frame(spark, rows, clash=True), settings).select("doc_id", "class_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(b"%03d" % i, b"%03d" % (i + 1)) for i in range(40)] + [(b"x0", b"x%d" % i) for i in range(1, 9)]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "a binary, b binary")
    got = {bytes(r["v"]): bytes(r["root"]) for r in op.components(spark, df).collect()}
    assert {got[b"%03d" % i] for i in range(1, 41)} == {b"000"} and {got[b"x%d" % i] for i in range(1, 9)} == {b"x0"}
    assert op.components(spark, df.limit(0)).count() == 0


@pytest.fixture
def plans(monkeypatch):
    """(name, plan as it ran) of every table that the operator stores."""
    seen, real = [], op.stored

    def stored(spark, df, name):
        df.collect()
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(spark, df, name)

    monkeypatch.setattr(op, "stored", stored)
    return seen


def test_rounds_of_stars_end_with_the_last_change(spark, plans):
    df = spark.createDataFrame([(bytearray(b"x0"), bytearray(b"x%d" % i)) for i in range(1, 9)], "a binary, b binary")
    assert op.components(spark, df).count() == 8
    assert [n for n, _ in plans] == ["omh-edges"]  # stars from the start: no round


def test_driver_collects_no_broadcasts(spark, plans):
    rows = family() + sub_families(groups=10)
    got = op.classes(frame(spark, [(i, *r[1:]) for i, r in enumerate(rows)]))
    got.collect()
    plans.append(("classes", got._jdf.queryExecution().executedPlan().toString()))
    assert {"omh-buckets", "omh-edges", "omh-rest", "classes"} <= {n for n, _ in plans}
    for name, plan in plans:
        if name not in ("omh-stars", "omh-aligned"):  # word hashes, up to the session's bound
            assert "Broadcast" not in plan, name
    final = [plan.split("== Initial Plan ==")[0] for name, plan in plans if name == "omh-edges"]
    assert max(len([x for x in p.splitlines() if "Exchange hash" in x and "Reused" not in x]) for p in final) <= 6


def test_dedupe_keeps_one_of_each_class(spark):
    rows = family() + [family()[0]] * 2
    docs = frame(spark, rows, clash=True)
    out = op.dedupe(docs)
    assert out.columns == docs.columns
    kept = sorted(r["doc_id"] for r in out.collect())
    assert kept == sorted({c for _, c in brute(rows)})
    assert op.dedupe(frame(spark, [])).count() == 0

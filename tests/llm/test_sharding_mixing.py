import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortkit.llm import hypergeometric as hyp
from cohortkit.llm import mixing, sharding

from .helpers import frame, prose


def test_large_draws_follow_the_small_law(monkeypatch):
    rng = np.random.default_rng(0)
    want = np.array([rng.hypergeometric(30, 50, 20) for _ in range(4000)])
    monkeypatch.setattr(hyp, "NUMPY_LIMIT", 0)
    got = np.array([hyp.draw(rng, 30, 50, 20) for _ in range(4000)])
    assert abs(got.mean() - want.mean()) < 0.15 and abs(got.std() - want.std()) < 0.15
    assert hyp.draw(rng, 10 ** 10, 10 ** 10, 10 ** 9) == pytest.approx(5 * 10 ** 8, rel=1e-3)
    assert hyp.draw(rng, 5, 0, 3) == 3 and hyp.draw(rng, 0, 5, 3) == 0


def test_matrix_margins_are_exact():
    blocks = [0, 7, 100, 33, 1]
    m = np.array(sharding.communication_matrix(blocks, sharding.Settings(shards=3)))
    assert m.sum(1).tolist() == blocks and m.sum(0).tolist() == [47, 47, 47]
    tree = np.array(hyp.split_tree(np.random.default_rng(1), [5, 0, 9, 2], [4, 4, 4, 4]))
    assert tree.sum(0).tolist() == [5, 0, 9, 2] and tree.sum(1).tolist() == [4, 4, 4, 4]


def shards_of(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["shard"]].append(r["slot"])
    return out


def test_shards_are_even_and_slots_gapless(spark):
    rows = prose() + [prose()[5]] * 30
    for settings in (sharding.Settings(), sharding.Settings(block_rows=5, max_blocks=7)):
        got = shards_of(sharding.deal(frame(spark, rows, clash=True), settings))
        assert sum(map(len, got.values())) == len(rows)
        sizes = [len(got.get(j, [])) for j in range(8)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in got.values())
    assert sharding.deal(frame(spark, [])).count() == 0


def test_result_does_not_depend_on_partitions(spark):
    docs = frame(spark, prose())
    key = lambda r: (str(r["row"]), r["shard"], r["slot"])
    a = sorted(map(key, sharding.deal(docs).collect()))
    b = sorted(map(key, sharding.deal(docs.repartition(7)).collect()))
    assert a == b


def test_assignment_is_uniform(spark):
    docs = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = sharding.deal(docs, sharding.Settings(block_rows=100)).collect()
    table = np.zeros((4, 8))
    for r in got:
        table[r["row"]["doc_id"] // 1000, r["shard"]] += 1
    assert ((table - 125) ** 2 / 125).sum() < 60       # 21 degrees of freedom
    pairs = [(r["row"]["doc_id"], r["slot"]) for r in got]
    assert abs(np.corrcoef(np.array(pairs).T)[0, 1]) < 0.06


def test_sharding_query(spark, tmp_path):
    rows = prose()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    from cohortkit.llm.queries import QUERIES
    got = QUERIES["op4_sharding"](spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
        rest -= sum(target[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mix_targets_and_limits(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", rng.choice(["a", "a", "a", "b", "é", "zz", None, "tiny"][:5 + seed]), 0)
            for i in range(3000)]
    rows += [(4000, "one two", "en", "0rare", 0), (4001, None, None, None, None), (4002, "", None, "void", 0), rows[0]]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    from cohortkit.llm.queries import QUERIES
    got = QUERIES["op10_mixing"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, _, s, _ in rows}
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 40, s
    again = QUERIES["op10_mixing"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_output_repeats_documents_as_drawn(spark):
    rows = prose()
    docs = frame(spark, rows, clash=True)
    settings = mixing.Settings(block_rows=3)
    mixed = mixing.mix(docs, settings).collect()
    out = mixing.output(docs, settings)
    assert out.columns == docs.columns
    assert out.count() == sum(len(r["shards"]) for r in mixed)
    slots = Counter(s for r in mixed for s in r["shards"])
    assert all(0 <= s < 8 for s in slots)
    assert mixing.output(frame(spark, [])).count() == 0


def test_blocks_are_split_exactly_among_shards(spark):
    docs = frame(spark, [(i, "a b c", "en", "x" if i % 3 else "y", 0) for i in range(400)])
    settings = mixing.Settings(block_rows=2, shards=4)
    sizes = mixing.measure(docs, settings, "source", "text").select("skey", "size", "h")
    _, blocks, _ = mixing.plan(sizes, settings)
    slots = Counter(s for r in blocks.collect() for s in (r["shards"] or []))
    assert max(slots.values()) - min(slots.values()) <= 1 and len(slots) == 4


def test_many_sources_stay_tables(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), "en", rng.choice([None, "", *(f"s{rng.randrange(40) ** 2 // 40}é" for _ in range(9))]), 0)
            for i in range(1500)] + [(2000, "one", "en", "rare", 0), (2001, None, None, "void", 0)]
    docs = frame(spark, rows, clash=True)
    few, many = mixing.Settings(block_rows=3), mixing.Settings(block_rows=3, max_sources=4)
    a, b = mixing.mix(docs, few).collect(), mixing.mix(docs, many).collect()
    said = lambda got: sorted((r["row"]["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got)
    assert said(a) == said(b) and len(b) == len(rows)
    sizes = mixing.measure(docs, many, "source", "text").select("skey", "size", "h")
    sources, blocks, n = mixing.plan(sizes, many)
    assert n == len({r[3] for r in rows}) > 4 * 4 and sources.count() == n
    held, drawn = Counter(), defaultdict(Counter)
    for r in blocks.collect():
        assert len(r["shards"] or []) == r["passes"] + r["part"]
        held.update(r["shards"] or [])
        drawn[r["skey"]].update(r["shards"] or [])
    assert len(held) == 8 and max(held.values()) - min(held.values()) <= 1
    assert said(mixing.mix(docs.repartition(5), many).collect()) == said(b)
    assert mixing.mix(frame(spark, []), many).count() == 0

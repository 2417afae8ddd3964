"""Operator 11: ranked lexical search, exact, by a dual tree over items and documents.

An item's vector holds, per term, its occurrences times the term's weight; a document's vector holds the
saturated term frequency. All coordinates are integers of at least 0, so the inner product of two nodes'
coordinate maxima is never below the score of any pair under them. Items and documents stand in two
hierarchies; a pair of nodes is descended into only if its bound reaches the weakest k-th score among the
node's items, which rules out whole batches of items against whole batches of documents.

Documents are never shuffled: a task counts the items' terms in its documents and stores narrow vectors;
then tasks search their own documents, block by block, and give the best of each item. The k-th scores
found in one part of the documents (``first_of``) are the floors with which the rest is searched.

The items are the query set. They are dealt into rounds of about ``round_bytes`` of text; what a task or the
driver holds of them (terms, weights, floors) is bounded by that, or by the longest single item. Within a round
they stand in blocks of at most ``block_items`` items and ``block_terms`` terms, each with a hierarchy of its own.

Defined results: null texts hold no term; an item without a document that scores above 0 gives no row; repeated
items are ranked each, repeated documents are listed each, a null doc_id comes after the others among equal
scores; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

#: A-Z become lower case; every other ASCII character but letters and digits parts terms.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
             for b in range(256))


@dataclass(frozen=True)
class Settings:
    k: int = 20
    round_bytes: int = 8 << 20     # of distinct item texts searched in one pass over the documents
    block_items: int = 256
    block_terms: int = 16_384
    block_docs: int = 4096
    block_postings: int = 1 << 20
    leaf_docs: int = 32
    fan: int = 8                   # children of a node, of both trees
    first_of: int = 16             # one document in so many is searched first
    chunk_bytes: int = 1 << 20     # of text split into terms at once


def pieces(text: str | None, limit: int = 1 << 62) -> Iterator[list[bytes]]:
    """The terms of a text, those of about ``limit`` bytes at a time."""
    folded, at = (text or "").encode("utf-8", "surrogatepass").translate(FOLD), 0
    while at < len(folded):
        to = folded.find(b" ", at + limit) if at + limit < len(folded) else -1
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


def terms_of(text: str | None) -> list[bytes]:
    return [t for piece in pieces(text) for t in piece]


# --------------------------------------------------------------------------------- term counts
VECTORS_DDL = "doc_id long, n long, terms array<int>, tfs array<long>, first boolean"


def _summed(keys: np.ndarray, counts: np.ndarray):
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, np.bincount(inverse, weights=counts, minlength=len(keys)).astype(np.int64)


def count_terms(texts: list[str | None], number: dict[bytes, int], limit: int = 1 << 20):
    """n of each text, and the known terms with their counts: (n, ends, terms, counts), text after text."""
    n, width = np.zeros(len(texts), np.int64), max(1, len(number))
    found, held, size = [], [], 0

    def count():
        known = np.fromiter((i for _, w in held for i in map(number.get, w, repeat(-1))), np.int64, size)
        at = np.repeat([i * width for i, _ in held], [len(w) for _, w in held]) + known
        found.append(np.unique(at[known >= 0], return_counts=True))

    for i, text in enumerate(texts):
        for words in pieces(text, limit):
            n[i] += len(words)
            held.append((i, words))
            size += len(words)
            if size * 4 >= limit:
                count()
                held, size = [], 0
    if held:
        count()
    if not found:
        return n, np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs, counts = found[0] if len(found) == 1 else _summed(*map(np.concatenate, zip(*found, strict=True)))
    return n, np.searchsorted(pairs, np.arange(len(texts) + 1) * width), pairs % width, counts


def vectors(docs: DataFrame, number, settings: Settings) -> DataFrame:
    """(doc_id, n, terms, tfs, first) of each document; ``number`` is the broadcast terms of a round."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"),
                       (F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(settings.first_of)) == 0).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            n, ends, terms, counts = count_terms(batch.column("t").to_pylist(), known, settings.chunk_bytes)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                batch.column("first")], ["doc_id", "n", "terms", "tfs", "first"])

    return rows.mapInArrow(run, VECTORS_DDL)


# --------------------------------------------------------------------------------- hierarchies
class Items:
    """A block of items as rows of coordinates, and above them levels of coordinate maxima."""

    def __init__(self, numbers: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], settings: Settings):
        self.numbers, self.fan = numbers, settings.fan
        self.columns = np.unique(np.concatenate([t for t, _ in vectors]))  # sorted terms of the block
        # Sums are exact in doubles as long as no score can pass 2**53.
        largest = max(float(q.sum()) for _, q in vectors) * 1e6
        rows = np.zeros((len(vectors), len(self.columns)), np.float64 if largest < 2 ** 53 else np.int64)
        for i, (t, q) in enumerate(vectors):
            rows[i, np.searchsorted(self.columns, t)] = q
        self.levels = [rows]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append(np.maximum.reduceat(low, np.arange(0, len(low), self.fan), axis=0))

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """The children of nodes of a level."""
        out = (nodes[:, None] * self.fan + np.arange(self.fan)).ravel()
        return out[out < len(self.levels[level - 1])]

    def limits(self, kth: np.ndarray) -> list[np.ndarray]:
        """The weakest k-th score under each node, level by level."""
        out = [kth]
        while len(out[-1]) > 1:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), self.fan)))
        return out


class Documents:
    """A block of documents (sparse, sorted by their strongest terms), and levels of sparse maxima."""

    def __init__(self, ids, null, ends, terms, values, weight, settings: Settings):
        # Documents whose strongest terms agree stand together; those of equal vectors by id.
        n = len(ids)
        row = np.repeat(np.arange(n), np.diff(ends))
        strong = np.lexsort((terms, -weight * values, row))
        best = terms[strong[ends[:-1]]]
        second = terms[strong[np.minimum(ends[:-1] + 1, ends[1:] - 1)]]
        order = np.lexsort((ids, null, np.diff(ends), second, best))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        row = place[row]
        by = np.lexsort((terms, row))
        self.ids, self.null = ids[order], null[order]
        row, terms, values = row[by], terms[by], values[by]
        self.leaf, self.fan = settings.leaf_docs, settings.fan
        self.terms, self.values, self.row = terms, values, row
        self.starts = np.searchsorted(row, np.arange(0, n + self.leaf, self.leaf))
        self.levels, size = [], self.leaf
        node = row // size
        while True:
            by = np.lexsort((terms, node))
            node, terms, values = node[by], terms[by], values[by]
            new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (terms[1:] != terms[:-1])]))
            node, terms, values = node[new], terms[new], np.maximum.reduceat(values, new)
            nodes = int(node[-1]) + 1
            self.levels.append((np.searchsorted(node, np.arange(nodes + 1)), terms, values, nodes))
            if nodes == 1:
                break
            node = node // self.fan

    def node(self, level: int, i: int):
        ends, terms, values, _ = self.levels[level]
        return terms[ends[i]:ends[i + 1]], values[ends[i]:ends[i + 1]]

    def below(self, level: int, i: int) -> range:
        return range(i * self.fan, min((i + 1) * self.fan, self.levels[level - 1][3]))


class Best:
    """The best k documents of each item so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floor = k, np.maximum(floors, 1)
        self.score = np.zeros((len(floors), k), np.int64)
        self.ids = np.zeros((len(floors), k), np.int64)
        self.null = np.ones((len(floors), k), bool)
        self.kth = self.floor.copy()

    def add(self, items: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of all ``items`` (rows) for some documents (columns)."""
        some = (score >= self.kth[items][:, None]).any(axis=1)
        items, score = items[some], score[some]
        if not len(items):
            return
        shape = score.shape
        score = np.concatenate([self.score[items], np.where(score >= self.floor[items][:, None], score, 0)], axis=1)
        ids = np.concatenate([self.ids[items], np.broadcast_to(ids, shape)], axis=1)
        null = np.concatenate([self.null[items], np.broadcast_to(null, shape)], axis=1)
        order = np.lexsort((ids, null, ~score), axis=1)[:, :self.k]
        self.score[items] = np.take_along_axis(score, order, 1)
        self.ids[items] = np.take_along_axis(ids, order, 1)
        self.null[items] = np.take_along_axis(null, order, 1)
        self.kth[items] = np.maximum(self.floor[items], self.score[items][:, -1])


class Search:
    """The dual-tree descent of one block of items into one block of documents after the other."""

    def __init__(self, items: Items, floors: np.ndarray, k: int):
        self.items, self.best = items, Best(floors, k)

    def run(self, docs: Documents) -> None:
        self.docs = docs
        self.limits = self.items.limits(self.best.kth)
        top, root = len(docs.levels) - 1, len(self.items.levels) - 1
        active = np.arange(len(self.items.levels[root]))
        self.visit(top, 0, root, active, self.bound(top, 0, root, active))

    def bound(self, dl: int, node: int, il: int, active: np.ndarray) -> np.ndarray:
        terms, values = self.docs.node(dl, node)
        rows = self.items.levels[il]
        return rows[active[:, None], terms] @ values.astype(rows.dtype)

    def visit(self, dl: int, node: int, il: int, active: np.ndarray, bound: np.ndarray) -> None:
        active = active[bound >= self.limits[il][active]]
        if not len(active):
            return
        if il:
            active, il = self.items.below(il, active), il - 1
        if dl:
            kids = self.docs.below(dl, node)
            bounds = [self.bound(dl - 1, kid, il, active) for kid in kids]
            # The most promising part first: it raises the k-th scores that the others are tested with.
            for i in sorted(range(len(kids)), key=lambda j: -bounds[j].max()):
                self.visit(dl - 1, kids[i], il, active, bounds[i])
            return
        while True:
            active = active[self.bound(0, node, il, active) >= self.limits[il][active]]
            if not il or not len(active):
                break
            active, il = self.items.below(il, active), il - 1
        if len(active):
            self.leaf(node, active)

    def leaf(self, node: int, active: np.ndarray) -> None:
        docs, rows = self.docs, self.items.levels[0]
        a, b = docs.starts[node], docs.starts[node + 1]
        first = node * docs.leaf
        ids, null = docs.ids[first:first + docs.leaf], docs.null[first:first + docs.leaf]
        columns, _ = docs.node(0, node)
        dense = np.zeros((len(columns), len(ids)), rows.dtype)
        dense[np.searchsorted(columns, docs.terms[a:b]), docs.row[a:b] - first] = docs.values[a:b]
        score = (rows[active[:, None], columns] @ dense).astype(np.int64)
        self.best.add(active, score, ids, null)
        self.limits = self.items.limits(self.best.kth)


# -------------------------------------------------------------------------------------- a round
@dataclass
class Round:
    """What tasks know of a round of items: vectors in the order of their keys, weights, corpus size."""

    vectors: list[tuple[np.ndarray, np.ndarray]]   # terms and occurrences times weight
    weights: np.ndarray
    documents: int
    occurrences: int
    floors: np.ndarray

    def blocks(self, settings: Settings) -> Iterator[np.ndarray]:
        """Numbers of items that share a block; items whose heaviest terms agree stand together."""
        def heaviest(i):
            t, q = self.vectors[i]
            return tuple(t[np.lexsort((t, -q))[:3]])
        block, held = [], set()
        for i in sorted((i for i, (t, _) in enumerate(self.vectors) if len(t)), key=lambda i: (heaviest(i), i)):
            own = self.vectors[i][0].tolist()
            if block and (len(block) >= settings.block_items or len(held.union(own)) > settings.block_terms):
                yield np.array(block)
                block, held = [], set()
            block.append(i)
            held.update(own)
        if block:
            yield np.array(block)


FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "item int, doc_id long, score long"


def doc_values(n: np.ndarray, tf: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """The coordinate of a term that occurs ``tf`` times in a document of ``n`` terms."""
    m = 100 - 25 + (25 * n * documents) // occurrences
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _search(known, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r: Round = known.value
        searches = []
        for numbers in r.blocks(settings):
            items = Items(numbers, [r.vectors[i] for i in numbers], settings)
            searches.append(Search(items, r.floors[numbers], settings.k))
        held, docs, postings = [], 0, 0

        def search():
            table = pa.Table.from_batches(held).combine_chunks()
            column = table.column("terms").combine_chunks()
            terms = column.flatten().to_numpy().astype(np.int64)
            tf = table.column("tfs").combine_chunks().flatten().to_numpy()
            sizes = np.diff(column.offsets.to_numpy().astype(np.int64))
            n = table.column("n").to_numpy()
            ids = table.column("doc_id").combine_chunks()
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            row = np.repeat(np.arange(len(n)), sizes)
            values = doc_values(n[row], tf, r.documents, r.occurrences)
            for s in searches:
                at = np.minimum(np.searchsorted(s.items.columns, terms), len(s.items.columns) - 1)
                own = s.items.columns[at] == terms
                if own.any():
                    some, within = np.unique(row[own], return_inverse=True)
                    s.run(Documents(ids[some], null[some], np.searchsorted(within, np.arange(len(some) + 1)), at[own],
                                    values[own], r.weights[terms[own]], settings))

        for batch in batches:
            for a in range(0, len(batch), settings.block_docs):
                part = batch.slice(a, settings.block_docs)
                held.append(part)
                docs += len(part)
                postings += int(part.column("terms").offsets[-1].as_py() - part.column("terms").offsets[0].as_py())
                if docs >= settings.block_docs or postings >= settings.block_postings:
                    search()
                    held, docs, postings = [], 0, 0
        if held:
            search()
        for s in searches:
            there = s.best.score > 0
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(s.items.numbers, settings.k)[there.ravel()], pa.int32()),
                pa.array(s.best.ids[there], pa.int64(), mask=s.best.null[there]),
                pa.array(s.best.score[there], pa.int64())], schema=FOUND)

    return run


def _round(docs: DataFrame, texts: list[str], settings: Settings) -> DataFrame | None:
    """(item, doc_id, score) candidates for the items ``texts``, among them the best of each."""
    spark = docs.sparkSession
    counted = [Counter(terms_of(t)) for t in texts]
    number = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    if not number:
        return None
    narrow = stored(spark, vectors(docs, spark.sparkContext.broadcast(number), settings), "lexical-vectors")
    size = narrow.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not size.docs:
        return None
    # At most one row per term of the round.
    df = narrow.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toPandas()
    weights = np.zeros(len(number), np.int64)
    for t, d in zip(df["term"], df["df"], strict=True):
        weights[t] = math.floor(1000 * math.log((2 * size.docs + 2) / (2 * int(d) + 1)))
    items = []
    for c in counted:
        t = np.array(sorted(number[w] for w in c), np.int64)
        by = {number[w]: n for w, n in c.items()}
        q = np.array([by[i] for i in t.tolist()], np.int64) * weights[t]
        items.append((t[q > 0], q[q > 0]))
    floors = np.ones(len(texts), np.int64)

    def search(part: DataFrame) -> DataFrame:
        known = spark.sparkContext.broadcast(Round(items, weights, size.docs, size.terms, floors))
        # Documents without a term of any item score nothing.
        return part.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs").mapInArrow(
            _search(known, settings), FOUND_DDL)

    first = stored(spark, search(narrow.filter("first")), "lexical-first")
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") == settings.k)
    for row in kth.select("item", "score").toPandas().itertuples():  # at most one row per item of the round
        floors[row.item] = row.score
    return first.unionByName(search(narrow.filter("NOT first")))


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text) for each row of ``items``
    (item_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))
    texts = asked.select("key", "text").distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // settings.round_bytes))
    dealt = texts.withColumn("round", F.pmod(F.xxhash64("key"), F.lit(rounds)))
    out = None
    for i in range(rounds):
        rows = dealt.filter(F.col("round") == i).select("key", "text").orderBy("key").collect()
        found = _round(docs, [r.text for r in rows], settings) if rows else None
        if found is None:
            continue
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
        keys = spark.createDataFrame([(j, r.key) for j, r in enumerate(rows)], "item int, key string")
        best = best.join(keys, "item").select("key", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], "key string, rank int, doc_id long, score long")
    return asked.select("item_id", "key").join(out, "key").select("item_id", "rank", "doc_id", "score")

"""Operator 3: removal of repeated passages with prefix-partitioned suffix trees.

A window is 35 consecutive words; a word goes if it lies in a window whose words also start elsewhere.
In the suffix tree of all texts these windows are the suffixes below internal nodes at least 35 words
deep, so each suffix is cut at that depth. The tree is never held as a whole: its suffixes are partitioned
by prefixes, and only partitions that can have deep nodes get a tree.

1. Every window has one anchor, the smallest of its eight-word hashes (leftmost of equal ones), which
   depends on the window's words only: equal windows have equal anchors at equal places. About one place
   in fifteen is an anchor. A partition is the anchor's eight words, not a suffix's first eight, so that
   the some fifteen suffixes of an anchor travel as one run of words. A partition with one anchor is dropped.
2. The reach of an anchor is all its windows' words, 27 before it and 34 after it at most. Anchors with the
   same reach (128 bits of hash) are copies: all their windows are below deep nodes, and one of them speaks
   for all. A partition where all anchors have one reach needs no tree.
3. The other partitions (the edges of passages) hold one run of words for each reach. If these are at most
   ``group_rows``, a task builds the partition's tree: suffixes sorted by their words and the lengths of the
   prefixes that neighbours have in common, runs of neighbours with 35 or more being the deep nodes.
4. A larger partition is split by longer prefixes, up to the full depth, where a prefix is itself a node:
   its windows are counted by 128 bits of hash, with map-side aggregation.

So a tree has bounded size, no group is collected, and a hot prefix or copy is one row per map task. Texts
are shuffled once, to the places found in them.

Defined results: a null or empty text has no words, and nothing is removed; a text of fewer than 35 words
is kept; overlapping occurrences within one text count; repeated rows are occurrences of their own; the
words of all rows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import small_batches, stored


@dataclass(frozen=True)
class Settings:
    window: int = 35
    prefix: int = 8          # words of the first prefix
    group_rows: int = 2048   # runs of words of one tree, at most


def anchors(h: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first windows, one past the last windows, anchor places): runs of windows with the same anchor.

    The smallest of the ``window - prefix + 1`` prefixes in each window, by doubling, ties to the left.
    """
    g = W.grams(h, settings.prefix)
    n = len(h) - settings.window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    # Places of the minima over 1, 2, 4 ... prefixes; two overlapping runs cover the whole window.
    width, span = settings.window - settings.prefix + 1, 1
    at = np.arange(len(g))
    while span * 2 <= width:
        left, right = at[:-span], at[span:]
        at = np.where(g[right] < g[left], right, left)
        span *= 2
    left, right = at[:n], at[width - span:width - span + n]
    at = np.where(g[right] < g[left], right, left)
    begun = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return begun, np.concatenate([begun[1:], [n]]), at[begun]


def _again(h: np.ndarray) -> np.ndarray:
    """Other hashes of the same words, for the second half of 128 bits."""
    return W.mixed(h ^ W.FACTOR)


def _reach(h: np.ndarray, places: np.ndarray, first: np.ndarray, last: np.ndarray,
           settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hash (two numbers) of the words from an anchor's first window to the end of its last one, and of the
    anchor's place among them. Longer than a window, so equal reaches have equal windows."""
    ends = last - 1 + settings.window
    at = W.mixed((places - first).astype(np.uint64) + np.uint64(1))
    # Sums of scrambled words times powers over a running product give any range in constant time.
    return _range_hash(h, first, ends) ^ at, _range_hash(_again(h), first, ends) ^ at


def _range_hash(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of h[begin:end]: polynomials from prefix sums of h * F**i, brought to a common power by the
    inverse of F**begin (F is odd, so it has one modulo 2**64)."""
    n = len(h)
    inverse = np.uint64(pow(int(W.FACTOR), -1, 2 ** 64))
    up, down = np.full(n + 1, W.FACTOR, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mixed(h) * up[:n])])
    return W.mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * W.FACTOR)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, key2, rest, t): the text, the other columns, and 128 bits of hash of the row. Rows with equal
    keys are equal in every column that can be hashed, and so are their results."""
    hashed = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(F.xxhash64(F.lit(3), *hashed).alias("key"), F.xxhash64(F.lit(33), *hashed).alias("key2"),
                       (F.struct(*others) if others else F.lit(0)).alias("rest"), F.col(f"`{text}`").alias("t"))


def anchor_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """(key, key2, prefix, reach, reach2): of each text with windows, the hashes of its anchors in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ends = W.hashed([W.split(t) for t in batch.column("t").to_pylist()])
            row, sizes, prefix, reach, reach2 = [], [0], [], [], []
            for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                h = hashes[a:b]
                first, last, place = anchors(h, settings)
                if len(place):
                    row.append(k)
                    sizes.append(len(place))
                    prefix.append(W.grams(h, settings.prefix)[place])
                    one, two = _reach(h, place, first, last, settings)
                    reach.append(one)
                    reach2.append(two)
            if row:
                offsets = pa.array(np.cumsum(sizes), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).view(np.int64)))
                         for x in (prefix, reach, reach2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row)), batch.column("key2").take(pa.array(row)), *lists],
                    ["key", "key2", "prefix", "reach", "reach2"])

    return rows.select("key", "key2", "t").filter("t is not null").mapInArrow(
        run, "key long, key2 long, prefix array<long>, reach array<long>, reach2 array<long>")


def shared_anchors(found: DataFrame, settings: Settings) -> DataFrame:
    """(key, key2, whole, open, hot): of each text, the numbers of the anchors whose reach is found again, of
    those whose windows belong to a tree, and of those in partitions too large for one."""
    each = found.select("key", "key2", F.posexplode(F.arrays_zip("prefix", "reach", "reach2")).alias("i", "x")).select(
        "key", "key2", "i", "x.*")
    one = F.xxhash64("key", "key2", "i")
    nodes = each.groupBy("prefix", "reach", "reach2").agg(F.count("*").alias("n"), F.min(one).alias("speaker"))
    # A prefix that one suffix has is a leaf, and dropped.
    inner = nodes.groupBy("prefix").agg(F.sum("n").alias("of"), F.count("*").alias("reaches")).filter("of > 1")
    below = nodes.join(inner, "prefix").select("prefix", "reach", "reach2", "n", "speaker", "reaches")
    # Where a prefix has several reaches, one anchor speaks for each reach in the tree.
    speaks = (F.col("reaches") > 1) & (one == F.col("speaker"))
    flags = each.join(below, ["prefix", "reach", "reach2"]).select(
        "key", "key2", "i", (F.col("n") > 1).alias("whole"), (speaks & (F.col("reaches") <= settings.group_rows)).alias("open"),
        (speaks & (F.col("reaches") > settings.group_rows)).alias("hot")).filter("whole or open or hot")
    return flags.groupBy("key", "key2").agg(
        *[F.collect_set(F.when(F.col(c), F.col("i"))).alias(c) for c in ("whole", "open", "hot")])


def _chosen(rows: DataFrame, shared: DataFrame, which: str) -> DataFrame:
    """The texts with anchors in the column ``which`` of ``shared``, and these anchors."""
    asked = shared.filter(F.size(which) > 0).select("key", "key2", F.col(which).alias("chosen"))
    # The other columns stay, so that all joins of the texts read the same exchange.
    return rows.join(asked.hint("shuffle_hash"), ["key", "key2"]).select("key", "key2", "rest", "t", "chosen")


def _hashed_once(batch: pa.RecordBatch, seen: set) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, word hashes, anchors asked for) of the rows of a batch; of rows equal in every column, which a
    task gets together, only the first."""
    hashes, ends = W.hashed([W.split(t) for t in batch.column("t").to_pylist()])
    names = zip(batch.column("key").to_pylist(), batch.column("key2").to_pylist(), strict=True)
    for k, (name, chosen) in enumerate(zip(names, batch.column("chosen").to_pylist(), strict=True)):
        if name not in seen:
            seen.add(name)
            yield k, hashes[ends[k]:ends[k + 1]], np.sort(np.array(chosen))


def suffix_runs(rows: DataFrame, shared: DataFrame, settings: Settings) -> DataFrame:
    """(key, key2, start, prefix, run): for each anchor of a tree, where its windows begin, its prefix and the
    word hashes of its ``run`` of suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            row, starts, prefixes, runs = [], [], [], []
            for k, h, chosen in _hashed_once(batch, seen):
                first, last, place = anchors(h, settings)
                row += [k] * len(chosen)
                starts.append(first[chosen])
                prefixes.append(W.grams(h, settings.prefix)[place[chosen]])
                runs += [h[a:b].tobytes() for a, b in zip(first[chosen], last[chosen] - 1 + settings.window, strict=True)]
            if row:
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(take), batch.column("key2").take(take),
                     pa.array(np.concatenate(starts).astype(np.int32)),
                     pa.array(np.concatenate(prefixes).view(np.int64)), pa.array(runs, pa.binary())],
                    ["key", "key2", "start", "prefix", "run"])

    return _chosen(rows, shared, "open").mapInArrow(run, "key long, key2 long, start int, prefix long, run binary")


def hot_windows(rows: DataFrame, shared: DataFrame, settings: Settings) -> DataFrame:
    """(key, key2, start, fp, fp2): each window of the anchors in partitions too large for a tree, with its
    128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            row, starts, one, two = [], [], [], []
            for k, h, chosen in _hashed_once(batch, seen):
                first, last, _ = anchors(h, settings)
                at = _ranges(first[chosen], last[chosen])
                row.append(np.full(len(at), k))
                starts.append(at.astype(np.int32))
                one.append(W.grams(h, settings.window)[at])
                two.append(W.grams(_again(h), settings.window)[at])
            if row:
                take = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(take), batch.column("key2").take(take), pa.array(np.concatenate(starts)),
                     *[pa.array(np.concatenate(x).view(np.int64)) for x in (one, two)]],
                    ["key", "key2", "start", "fp", "fp2"])

    return _chosen(rows, shared, "hot").mapInArrow(run, "key long, key2 long, start int, fp long, fp2 long")


def tree(runs: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, offset) of the suffixes below nodes at least ``window`` words deep, in the suffix tree of the
    first ``window`` words of the suffixes of ``runs``. As arrays: the sorted suffixes and, of neighbours,
    how many words they begin with in common; a node spans neighbours with as many or more."""
    flat = np.frombuffer(b"".join(runs), np.uint64)
    ends = np.cumsum([len(r) // 8 for r in runs])
    begin = np.concatenate([[0], ends[:-1]])
    at = _ranges(begin, ends - window + 1)  # suffixes with at least ``window`` words
    suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, window)[at])
    order = np.argsort(suffix.view(np.dtype((np.void, 8 * window))).ravel(), kind="stable")
    equal = suffix[order[1:]] == suffix[order[:-1]]
    common = np.where(equal.all(axis=1), window, equal.argmin(axis=1))
    deep = np.concatenate([[False], common >= window, [False]])
    found = np.sort(at[order[deep[1:] | deep[:-1]]])
    of = np.searchsorted(ends, found, side="right")
    return of, found - begin[of]


def tree_windows(partitions: DataFrame, settings: Settings) -> DataFrame:
    """(key, key2, start) of the windows below deep nodes of the trees of ``partitions`` (key, key2, start,
    prefix, run)."""
    kind = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("start", pa.int32())])

    def windows(part: pa.Table) -> pa.RecordBatch:
        of, offset = tree(part.column("run").to_pylist(), settings.window)
        take = pa.array(of)
        start = part.column("start").to_numpy()[of] + offset
        return pa.RecordBatch.from_arrays(
            [part.column(c).take(take).combine_chunks() for c in ("key", "key2")] + [pa.array(start.astype(np.int32))], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Batches hold several small partitions; the last one may go on in the next batch.
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = pa.concat_tables([rest, part]) if rest is not None else part
            prefix = part.column("prefix").to_numpy()
            cut = int(np.searchsorted(prefix, prefix[-1])) if len(prefix) else 0
            if cut:
                yield windows(part.slice(0, cut))
            rest = part.slice(cut).combine_chunks()
        if rest is not None and len(rest):
            yield windows(rest)

    return partitions.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(run, "key long, key2 long, start int")


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges first[i]:last[i], end to end."""
    sizes = last - first
    if not sizes.sum():
        return np.zeros(0, np.int64)
    return np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text in ``rest``; ``n_words``, ``n_removed``, and ``kept``, the words
    that stay, joined by one space."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = keyed(docs, text)
    found = stored(spark, anchor_rows(rows, settings), "anchors")
    shared = stored(spark, shared_anchors(found, settings), "shared-anchors")
    windows = tree_windows(suffix_runs(rows, shared, settings), settings)
    if not shared.filter(F.size("hot") > 0).isEmpty():
        hot = hot_windows(rows, shared, settings)
        again = hot.groupBy("fp", "fp2").agg(F.count("*").alias("n")).filter("n > 1").select("fp", "fp2")
        windows = windows.union(hot.join(again, ["fp", "fp2"], "left_semi").select("key", "key2", "start"))
    starts = windows.groupBy("key", "key2").agg(F.collect_set("start").alias("starts"))
    marks = shared.select("key", "key2", "whole").join(starts, ["key", "key2"], "left")
    # The texts are dealt out by key once: all joins read the same exchange.
    joined = rows.join(marks.hint("shuffle_hash"), ["key", "key2"], "left").select("rest", "t", "whole", "starts")
    kind = joined.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [W.split(t) for t in batch.column("t").to_pylist()]
            hashes, ends = W.hashed(texts)
            whole, single = batch.column("whole").to_pylist(), batch.column("starts").to_pylist()
            removed, kept = [], []
            for words, a, b, w, s in zip(texts, ends, ends[1:], whole, single, strict=False):
                gone = 0
                if w or s:
                    first, last, _ = anchors(hashes[a:b], settings)
                    cover = np.zeros(len(words) + 1, np.int64)
                    at = np.array(w or [], np.int64)
                    begin = np.concatenate([first[at], np.array(s or [], np.int64)])
                    end = np.concatenate([last[at] - 1, np.array(s or [], np.int64)]) + settings.window
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, end, -1)
                    out = np.cumsum(cover)[:-1] > 0
                    gone = int(out.sum())
                    words = [x for x, o in zip(words, out.tolist(), strict=True) if not o]
                removed.append(gone)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(np.diff(ends), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], ["rest", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, f"rest {kind}, n_words long, n_removed long, kept string")

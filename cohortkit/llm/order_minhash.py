"""Operator 5: near-duplicate documents by order MinHash and banded alignment.

Shingles are five consecutive words, labelled with their occurrence number in the document. For each of
``sketches`` hash functions the two smallest labelled shingles are kept in text order, so a sketch agrees
only where both texts hold the same shingles in the same order. ``bands`` pairs of sketches are the
buckets. The similarity of a pair is that of its aligned shingles, M / (a + b - M) for M shingles matched
in order, computed by a bit-parallel alignment inside the band that the threshold leaves open.

First every member of a bucket is aligned with the bucket's most connected text (its centre). A member
that these links leave outside the centre's component then meets the bucket's other members in blocks of
bounded size. A pair is passed over only if it is known to be in one component, or if it cannot be similar:
a bitmap of each text's shingles gives an upper bound of what two texts share. Of each block the pairs that
would join its components (a forest) are aligned first, and where one of them fails all the block's open
pairs. So no bucket is capped, no group is gathered in one task, and links are not lost behind a centre.
Classes are the connected components, by alternating large-star and small-star rounds.

Equal texts (word for word) are one text from the start, so copies are never paired with each other.

The driver's memory goes with the stages and tasks it keeps account of. So joins are merge joins, which need
neither the job that collects a broadcast on the driver nor its copy there (but for the word hashes of
``verify``: a broadcast of up to the session's bound deals the pairs of a large centre to all tasks), a round of
stars has five shuffles, and rounds end as soon as every component is a star.

Defined results: a null text, or one without a word, is alike only to rows equal in every column; texts
of one to four words only to texts with equal words; repeated rows are copies; other columns do not
matter. A class is named by its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import small_batches, stored


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    sketches: int = 40
    bands: int = 20          # of two sketches each
    bits: int = 8            # of the bitmap, at least, for each shingle
    block_rows: int = 1024   # members of one side of a block
    seed: int = 5


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join that sends nothing through the driver."""
    return left.join(right.hint("merge"), on, how)


# --------------------------------------------------------------------------------- sketches
def labelled(g: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by their occurrence number."""
    order = np.argsort(g, kind="stable")
    same = np.concatenate([[False], g[order][1:] == g[order][:-1]])
    if not same.any():
        return g
    place = np.arange(len(g))
    begun = np.maximum.accumulate(np.where(same, 0, place))
    occurrence = np.zeros(len(g), np.uint64)
    occurrence[order] = (place - begun).astype(np.uint64)
    return np.where(occurrence > 0, W.mixed(g + occurrence * W.FACTOR), g)


def sketch(g: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed, one number for the two labelled shingles with the smallest hashes, in text order."""
    out = np.empty(len(seeds), np.uint64)
    step = max(1, 200_000 // len(g))  # rows at a time: memory stays bounded for very long texts
    for a in range(0, len(seeds), step):
        v = W.mixed(g[None, :] ^ seeds[a:a + step, None])
        rows = np.arange(len(v))
        first = v.argmin(axis=1)
        v[rows, first] = np.iinfo(np.uint64).max
        second = v.argmin(axis=1) if len(g) > 1 else first
        out[a:a + step] = W.mixed(g[np.minimum(first, second)] * W.FACTOR + g[np.maximum(first, second)])
    return out


def bitmap(g: np.ndarray, bits: int) -> np.ndarray:
    """A bit for each labelled shingle, in a power of two of words with at least ``bits`` bits a shingle."""
    wide = 1 << max(0, (bits * len(g) - 1).bit_length() - 6)
    v = W.mixed(g)
    out = np.zeros(wide, np.uint64)
    np.bitwise_or.at(out, ((v >> np.uint64(6)) & np.uint64(wide - 1)).astype(np.int64), np.uint64(1) << (v & np.uint64(63)))
    return out


def most_shared(n: int, bits: np.ndarray, others_n: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bounds of the shingles that a text of ``n`` shingles shares with each of the ``others``: a bit
    that only one of two bitmaps has stands for at least one shingle that the other text lacks."""
    wide = min(len(bits), others.shape[1])
    bits = np.bitwise_or.reduce(bits.reshape(-1, wide), axis=0)
    others = np.bitwise_or.reduce(others.reshape(len(others), others.shape[1] // wide, wide), axis=1)
    both = np.bitwise_count(others & bits).sum(axis=1, dtype=np.int64)
    return np.minimum(n - int(np.bitwise_count(bits).sum()),
                      others_n - np.bitwise_count(others).sum(axis=1, dtype=np.int64)) + both


def signatures(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, tid, n, sk, bits): hash of the whole row, 128-bit hash of the words, their number, the
    sketches, the bitmap of the shingles."""
    hashed = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.lit(5), *hashed).alias("h"),
                       F.col(f"`{text}`").alias("t"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, h long, tid binary, n int, sk binary, bits binary"
    seeds = W.mixed(np.arange(1, settings.sketches + 1, dtype=np.uint64) * np.uint64(2 ** 32 + settings.seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [W.split(t) for t in batch.column("t").to_pylist()]
            hashes, ends = W.hashed(texts)
            tids, sketches, bitmaps = [], [], []
            for words, h, a, b in zip(texts, batch.column("h").to_pylist(), ends, ends[1:], strict=False):
                named = b" ".join(words) if words else b"\x00%d" % h
                tids.append(xxhash.xxh3_128_digest(named))
                g = W.grams(hashes[a:b], settings.shingle)
                g = labelled(g)
                sketches.append(sketch(g, seeds).tobytes() if len(g) else None)
                bitmaps.append(bitmap(g, settings.bits).tobytes() if len(g) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(tids, pa.binary()),
                 pa.array(np.diff(ends), pa.int32()), pa.array(sketches, pa.binary()), pa.array(bitmaps, pa.binary())],
                ["doc_id", "h", "tid", "n", "sk", "bits"])

    return rows.mapInArrow(run, kind)


def buckets(texts: DataFrame, settings: Settings) -> DataFrame:
    """(tid, band, key) for each band of each text with a sketch; key is a hash of two sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sk = np.frombuffer(b"".join(batch.column("sk").to_pylist()), np.uint64).reshape(len(batch), settings.bands, -1)
            key = sk[:, :, 0]
            for i in range(1, sk.shape[2]):
                key = W.mixed(key * W.FACTOR + sk[:, :, i])
            tid = np.repeat(np.array(batch.column("tid").to_pylist(), dtype=object), settings.bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tid, pa.binary()), pa.array(np.tile(np.arange(settings.bands, dtype=np.int32), len(batch))),
                 pa.array(key.ravel().view(np.int64))], ["tid", "band", "key"])

    return texts.select("tid", "sk").filter("sk is not null").mapInArrow(run, "tid binary, band int, key long")


# ------------------------------------------------------------------------------- verification
def aligned(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """How many items of ``x`` and ``y`` match in order, along paths inside the band; exact if at most
    ``band`` items stay unmatched.

    Bits of ``v`` are the steps of one column of the alignment table (0: one more match). Rows are taken
    in strips; a strip works on the bits its band can reach, as one integer.
    """
    n = len(x)
    v = (1 << n) - 1
    if not n or not len(y):
        return 0
    band = int(band)
    strip = max(64, band)
    names = x.tolist()
    for a in range(0, len(y), strip):
        b = min(len(y), a + strip)
        low, high = max(0, a - band), min(n, b + band)
        if low >= high:
            break
        where: dict[int, int] = {}
        for i in range(low, high):
            where[names[i]] = where.get(names[i], 0) | (1 << (i - low))
        full = (1 << (high - low)) - 1
        part = (v >> low) & full
        for c in y[a:b].tolist():
            hit = where.get(c)
            if hit:
                u = part & hit
                part = ((part + u) | (part - u)) & full
        v = (v & ~(full << low)) | (part << low)
    return n - v.bit_count()


def compared(x: np.ndarray, y: np.ndarray, least: float) -> tuple[bool, int]:
    """Is the aligned similarity of two shingle sequences at least ``least``? And how many shingles do
    they have in common, in any order?"""
    a, b = len(x), len(y)
    need = int(np.ceil(least / (1 + least) * (a + b) - 1e-9))  # matches that the similarity takes
    m = min(a, b)
    differ = np.flatnonzero(x[:m] != y[:m])
    head = int(differ[0]) if len(differ) else m
    x, y, m = x[head:], y[head:], m - head
    differ = np.flatnonzero(x[::-1][:m] != y[::-1][:m])
    tail = int(differ[0]) if len(differ) else m
    x, y = x[:len(x) - tail], y[:len(y) - tail]
    (p, cp), (q, cq) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(p, q, assume_unique=True, return_indices=True)
    common = head + tail + int(np.minimum(cp[i], cq[j]).sum())
    if common < need:  # no alignment matches more
        return False, common
    return head + tail >= need or head + tail + aligned(x, y, a + b - 2 * need) >= need, common


def word_hashes(docs: DataFrame, text: str = "text") -> DataFrame:
    """(tid, w): the 64-bit word hashes of each text that has shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [W.split(t) for t in batch.column("t").to_pylist()]
            hashes, ends = W.hashed(texts)
            small = (hashes >> np.uint64(32)).astype(np.uint32)  # 32 bits tell the words of two texts apart
            tids = [xxhash.xxh3_128_digest(b" ".join(w)) for w in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tids, pa.binary()),
                 pa.array([small[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())],
                ["tid", "w"])

    return docs.select(F.col(f"`{text}`").alias("t")).filter("t is not null").mapInArrow(run, "tid binary, w binary")


def verify(pairs: DataFrame, docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """The ``pairs`` (a, b) with ``link``: is their similarity high enough?"""
    named = word_hashes(docs, text).filter(F.octet_length("w") >= 4 * settings.shingle)
    # Copies of a text are alike: one of them is enough, chosen before the join.
    named = named.groupBy("tid").agg(F.first("w").alias("w"))
    left = named.select(F.col("tid").alias("a"), F.col("w").alias("wa"))
    right = named.select(F.col("tid").alias("b"), F.col("w").alias("wb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "wa", "wb")

    def shingles(w: bytes) -> np.ndarray:
        return W.grams(W.mixed(np.frombuffer(w, np.uint32).astype(np.uint64)), settings.shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            out = []
            for b, wa, wb in zip(*(batch.column(c) for c in ("b", "wa", "wb")), strict=True):
                if b.as_py() != last:  # rows of one centre mostly follow each other
                    last, kept = b.as_py(), shingles(wb.as_py())
                out.append(compared(shingles(wa.as_py()), kept, settings.similarity)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())], ["a", "b", "link"])

    return both.mapInArrow(run, "a binary, b binary, link boolean")


# --------------------------------------------------------------------------------- candidates
def centres(bucket: DataFrame) -> DataFrame:
    """Buckets of two texts or more with their most connected text: (tid, band, key, centre, size)."""
    sizes = bucket.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = merged(bucket, sizes, ["band", "key"])
    weight = shared.groupBy("tid").agg(F.sum("size").alias("weight"))
    weighed = merged(shared, weight, "tid")
    best = weighed.groupBy("band", "key").agg(F.max(F.struct("weight", "tid"))["tid"].alias("centre"))
    return merged(shared, best, ["band", "key"])


def open_pairs(lost: pa.Table, members: pa.Table, settings: Settings, forest: bool) -> tuple[list[int], list[int]]:
    """Places in ``lost`` and in ``members`` of the pairs of one block that are in different components, meet
    in no earlier band, and may be similar; with ``forest`` only such as would join components."""
    share = settings.similarity / (1 + settings.similarity)
    sx, sy = (np.frombuffer(b"".join(t.column("sk").to_pylist()), np.uint64).reshape(len(t), -1) for t in (lost, members))
    nx, ny = (t.column("n").to_numpy().astype(np.int64) for t in (lost, members))
    _, label = np.unique(np.concatenate([t.column("label").to_numpy() for t in (lost, members)]), return_inverse=True)
    lx, ly = label[:len(lost)], label[len(lost):]
    root = np.arange(label.max() + 1)
    band = lost.column("band")[0].as_py()
    deep = sx.shape[1] // settings.bands
    bits = [np.frombuffer(b, np.uint64) for b in lost.column("bits").to_pylist()]
    by_width: dict[int, list[int]] = {}
    raw = members.column("bits").to_pylist()
    for j, b in enumerate(raw):
        by_width.setdefault(len(b), []).append(j)
    sets = [(np.array(js), np.frombuffer(b"".join(raw[j] for j in js), np.uint64).reshape(len(js), -1))
            for js in by_width.values()]
    out_i, out_j = [], []
    for i in range(len(lost)):
        for places, others in sets:
            need = np.ceil(share * (nx[i] + ny[places]) - 1e-9)  # matches that the similarity takes
            at = np.flatnonzero((np.minimum(nx[i], ny[places]) >= need) & (root[ly[places]] != root[lx[i]]))
            if not len(at):
                continue
            same = sy[places[at], :band * deep] == sx[i, :band * deep]
            met = same.reshape(len(at), band, deep).all(axis=2).any(axis=1)
            at = at[~met]
            at = at[most_shared(int(nx[i]), bits[i], ny[places[at]], others[at]) >= need[at]]
            js = places[at]
            if forest and len(js):
                roots, first = np.unique(root[ly[js]], return_index=True)
                js = js[first]
                root[np.isin(root, roots)] = root[lx[i]]
            out_i += [i] * len(js)
            out_j += js.tolist()
    return out_i, out_j


def remaining(starred: DataFrame, labels: DataFrame, texts: DataFrame, settings: Settings,
              again: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of a text outside the component of its bucket's centre with the bucket's other texts, and
    the bucket (band, key), by blocks of ``block_rows`` texts on either side: a forest of each block, or all
    open pairs of the buckets ``again``. ``labels`` (tid, label) are the components known so far."""
    own = F.coalesce("label", F.xxhash64("tid"))
    centre = labels.select(F.col("tid").alias("centre"), F.col("label").alias("centre_label"))
    wide = merged(merged(starred.filter("size > 2").filter("tid <> centre"), labels, "tid", "left"), centre, "centre", "left").select(
        "tid", "band", "key", "size", own.alias("label"), (own != F.coalesce("centre_label", F.xxhash64("centre"))).alias("lost"))
    if again is not None:
        wide = merged(wide, again, ["band", "key"], "left_semi")
    counts = wide.groupBy("band", "key").agg(F.sum(F.col("lost").cast("int")).alias("n_lost")).filter("n_lost > 0")
    sk = texts.select("tid", "sk", "bits", (F.col("n") - (settings.shingle - 1)).alias("n"))
    every = merged(wide, counts, ["band", "key"]).select(
        "tid", "band", "key", "label", "lost",
        F.ceil(F.col("n_lost") / settings.block_rows).cast("int").alias("lost_blocks"),
        F.ceil(F.col("size") / settings.block_rows).cast("int").alias("blocks"))

    def block(n):
        return F.pmod(F.xxhash64("tid"), F.col(n)).cast("int")

    left = every.filter("lost").select(
        "tid", "label", "band", "key", block("lost_blocks").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    right = every.select(
        "tid", "label", "band", "key", block("blocks").alias("j"),
        F.explode(F.sequence(F.lit(0), F.col("lost_blocks") - 1)).alias("i"))
    at, forest = ["band", "key", "i", "j"], again is None
    kind = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("band", pa.int32()), ("key", pa.int64())])

    def run(lost: pa.Table, members: pa.Table) -> pa.Table:
        members = members.rename_columns([c.removeprefix("m_") for c in members.column_names])
        if not len(lost) or not len(members):
            return kind.empty_table()
        i, j = open_pairs(lost, members, settings, forest)
        one = lost.take(pa.array(i, pa.int64()))
        return pa.Table.from_arrays(
            [one.column("tid"), members.column("tid").take(pa.array(j, pa.int64()))] + [one.column("band"), one.column("key")], schema=kind)

    left, right = merged(left, sk, "tid"), merged(right, sk, "tid")
    right = right.select(*[F.col(c).alias("m_" + c) for c in right.columns])
    met = left.groupBy(*at).cogroup(right.groupBy(*["m_" + c for c in at])).applyInArrow(
        lambda x, y: run(x, y), "a binary, b binary, band int, key long")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "band", "key")


# ---------------------------------------------------------------------------------- components
def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each edge end's component, by alternating stars until every
    component is a star around its smallest vertex; every round is written to the shared folder."""
    def unfinished(e: DataFrame) -> bool:
        """Is an end below two others, or both below one and above one? Each edge goes from ``u`` to a smaller ``v``."""
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("end"))
        met = ends.groupBy("end.x").agg(F.sum("end.up").alias("up"), F.max("end.down").alias("down"))
        return met.agg(F.max((F.col("up") + F.col("down") > 1) & (F.col("up") > 0))).collect()[0][0] or False

    edges = stored(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
                   .distinct(), "omh-edges")
    while unfinished(edges):
        # Large star: every larger neighbour of x is tied to x's smallest neighbour (or x itself).
        near = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")),
                                              F.struct(F.col("v").alias("x"), F.col("v").alias("y")))).alias("near"))
        least = near.groupBy(F.col("near.x").alias("v")).agg(F.min("near.y").alias("m"))
        large = merged(edges, least, "v").select("u", F.col("m").alias("v"))
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = merged(large, lowest, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(spark, small.select("e.u", "e.v").filter("u <> v").distinct(), "omh-edges")
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))


def links(docs: DataFrame, sigs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """(a, b): pairs of different texts that are in one class; every class is connected by them."""
    spark = docs.sparkSession
    texts = sigs.filter("sk is not null").groupBy("tid").agg(
        F.first("sk").alias("sk"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    starred = stored(spark, centres(buckets(texts, settings)), "omh-buckets")
    star = starred.filter(F.col("tid") != F.col("centre")).select(
        F.col("tid").alias("a"), F.col("centre").alias("b")).distinct()
    checked = stored(spark, verify(star, docs, settings, text), "omh-stars")

    def labelled_by(edges: DataFrame) -> DataFrame:
        near = edges.select(F.col("v").alias("tid"), F.xxhash64("root").alias("label"))
        return near.union(edges.select(F.col("root").alias("tid"), F.xxhash64("root").alias("label")).distinct())

    def aligned_pairs(pairs: DataFrame, seen: DataFrame) -> DataFrame:
        """The pairs that are not ``seen`` (a < b), aligned."""
        return stored(spark, verify(merged(pairs.select("a", "b").distinct(), seen, ["a", "b"], "left_anti"),
                                    docs, settings, text), "omh-aligned")

    known = components(spark, checked.filter("link"))
    seen = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    forest = stored(spark, remaining(starred, labelled_by(known), texts, settings), "omh-rest")
    if forest.isEmpty():
        return known.select(F.col("v").alias("a"), F.col("root").alias("b"))
    joined = aligned_pairs(forest, seen)
    found = known.select(F.col("v").alias("a"), F.col("root").alias("b")).union(joined.filter("link").select("a", "b"))
    # Buckets with a pair of the forest that is no link: all their pairs still between components.
    failed = stored(spark, merged(forest, joined.filter("link"), ["a", "b"], "left_anti").select("band", "key").distinct(),
                    "omh-failed")
    if failed.isEmpty():
        return found
    known = components(spark, found)
    more = remaining(starred, labelled_by(known), texts, settings, failed)
    seen = seen.union(joined.select("a", "b")).distinct()
    return known.select(F.col("v").alias("a"), F.col("root").alias("b")).union(
        aligned_pairs(more, seen).filter("link").select("a", "b"))


def classes(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, class_id) for each row of ``docs``, with the hash ``h`` of the row."""
    spark = docs.sparkSession
    small_batches(spark)
    sigs = stored(spark, signatures(docs, settings, doc_id, text), "omh-signatures")
    roots = components(spark, links(docs, sigs, settings, text))
    named = merged(sigs.groupBy("tid").agg(F.min("doc_id").alias("least")), roots.withColumnRenamed("v", "tid"), "tid", "left").select(
        "tid", F.coalesce("root", "tid").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("class_id"))
    return merged(sigs.select("doc_id", "h", "tid"), merged(named, least, "root").select("tid", "root", "class_id"),
                  "tid").select("doc_id", "h", "root", "class_id")


def dedupe(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest doc_id (null last)."""
    found = classes(docs, settings, doc_id, text)
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h"))["h"].alias("keep"))
    hashed = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.xxhash64(F.lit(5), *hashed).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Rows equal in every column are one document.
    return merged(rows, kept.select(F.col("keep").alias("h")), "h", "left_semi").groupBy("h").agg(
        F.first("row").alias("row")).select("row.*")

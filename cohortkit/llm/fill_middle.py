"""Operator 12: fill-in-the-middle transformation, with unit ends found by SWAR words.

A text is a run of units (lines, or code points). The texts of a batch lie end to end as UTF-8; that buffer
is viewed as 64-bit words, and arithmetic on whole words sets the high bit of every byte that ends a unit.
Counting the bits of each word and summing them gives, at once for all texts, the number of ends before any
byte (rank). The byte of the k-th end (select) is found by a binary search over those sums and, inside the
word, by summing its marks over the bytes below and counting the bytes whose sum is below k.

Two numbers per text, from a hash of its key and not from the run, choose where the prefix and the middle
end; two more choose the form: ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle).

Defined results: null and empty texts, and those that hold one of the three sentinels, stay plain; a null key
hashes as the empty text; repeated rows are cut alike; other columns are carried in ``row``. Memory follows
``chunk_bytes`` or the longest single text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches


@dataclass(frozen=True)
class Settings:
    seed: str = "7:"             # put before the key, and hashed with it
    unit: str = "line"           # or "char"
    rate: int = 100              # texts of a hundred that are transformed
    spm_rate: int = 50           # of these, how many of a hundred put the suffix first
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    chunk_bytes: int = 8 << 20   # texts looked at together


def draws(key: Column, settings: Settings = Settings()) -> list[Column]:
    """Four numbers of 32 bits from the key: the first groups of eight digits of its SHA-256."""
    digest = F.sha2(F.concat(F.lit(settings.seed), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


# ------------------------------------------------------------------------- words of eight bytes
def _each(byte: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


ONES, LOW, HIGH = _each(0x01), _each(0x7F), _each(0x80)
EIGHT, SEVEN, ONE = np.uint64(8), np.uint64(7), np.uint64(1)


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as 64-bit words, the last one filled up with zeros, and a word of zeros after it."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def equal_marks(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of each byte that equals ``byte``. Exact: no carry leaves a byte."""
    x = words ^ _each(byte)
    return ~(((x & LOW) + LOW) | x | LOW)


def char_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that ends a code point: the byte after it does not go on with one."""
    inner = words & ~(words << ONE) & HIGH  # 10xxxxxx
    after = inner >> EIGHT
    after[:-1] |= inner[1:] << np.uint64(56)
    return ~after & HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word, bits = at >> 3, (at & 7).astype(np.uint64) * EIGHT
        below = (ONE << bits) - ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the k-th mark, counted from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        # Each byte of ``sums`` holds the marks of the word up to it.
        sums = (self.marks[word] >> SEVEN) * ONES
        wanted = (k - self.before[word]).astype(np.uint64) * ONES
        reached = ((sums | HIGH) - wanted) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def cuts(data: np.ndarray, ends: np.ndarray, h: np.ndarray, unit: str):
    """For texts that lie end to end in ``data`` between ``ends``: units, and for h1 and h2 (columns of ``h``)
    the bytes at which prefix and middle end, and the code points of both."""
    words = as_words(data)
    start, end = ends[:-1], ends[1:]
    chars = Marks(char_marks(words))
    if unit == "char":
        marks = chars
        n = marks.rank(end) - marks.rank(start)
    else:
        marks = Marks(equal_marks(words, 0x0A))
        n = marks.rank(end) - marks.rank(start)
        # What follows the last line feed is a unit too.
        n += (end > start) & (data[np.maximum(end - 1, 0)] != 0x0A) if len(data) else 0
    picks = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    first, places = marks.rank(start), []
    for pick in picks.T:
        at = end.copy()
        inner = pick < n
        at[inner] = np.where(pick[inner] == 0, start[inner],
                             marks.select(np.maximum(first[inner] + pick[inner], 1)) + 1)
        places.append(at)
    p, m = places
    low, mid, top = chars.rank(start), chars.rank(p), chars.rank(m)
    return n, p, m, mid - low, top - mid


RESULT = pa.schema([("n", pa.int64()), ("form", pa.string()), ("output", pa.string()),
                    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])


def _offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins in the array's bytes, with the end last."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def transform_texts(texts: pa.Array, h: np.ndarray, settings: Settings) -> list[pa.Array]:
    """The result's columns for texts without nulls and their four numbers each."""
    offsets = _offsets(texts)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = offsets - offsets[0]
    n, p, m, prefix_chars, middle_chars = cuts(data, ends, h, settings.unit)
    marks = [s.encode() for s in (settings.prefix, settings.suffix, settings.middle)]
    whole, forms, outputs = data.tobytes(), [], []
    for i in range(len(texts)):
        a, b, c, z = int(ends[i]), int(p[i]), int(m[i]), int(ends[i + 1])
        if a == z or h[i, 2] % 100 >= settings.rate or any(whole.find(s, a, z) >= 0 for s in marks):
            form, out = "plain", whole[a:z]
        elif h[i, 3] % 100 < settings.spm_rate:
            form, out = "spm", b"".join([marks[1], whole[c:z], marks[0], whole[a:b], marks[2], whole[b:c]])
        else:
            form, out = "psm", b"".join([marks[0], whole[a:b], marks[1], whole[c:z], marks[2], whole[b:c]])
        forms.append(form)
        outputs.append(out)
    plain = np.array([f == "plain" for f in forms], bool)
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()),
            pa.array(outputs, pa.binary()).cast(pa.string()),
            pa.array(prefix_chars, pa.int64(), mask=plain), pa.array(middle_chars, pa.int64(), mask=plain)]


def _chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes, or one row."""
    at = 0
    reach = np.concatenate([[0], np.cumsum(sizes)])
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(reach, reach[at] + limit, side="right")) - 1)
        yield at, to
        at = to


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs`` in the struct ``row``; ``n`` units, ``form``, ``output``, and the code points of
    prefix and middle (null where plain)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"),
                       *[d.alias(f"h{i}") for i, d in enumerate(draws(F.col(f"`{key}`"), settings))])
    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(
        "n long, form string, output string, prefix_chars long, middle_chars long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.stack([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            texts = batch.column("t")
            for a, b in _chunks(np.diff(_offsets(texts)), settings.chunk_bytes):
                done = transform_texts(texts.slice(a, b - a), h[a:b], settings)
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), *done], ["row", *RESULT.names])

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The exact text again, from output and form. A sentinel can neither be in the parts nor arise where a
    part meets one, so the output falls into four pieces, the first one empty."""
    pattern = "|".join(re.sub(r"(\W)", r"\\\1", s) for s in (settings.prefix, settings.suffix, settings.middle))
    parts = F.split(output, pattern, -1)
    psm = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
    spm = F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

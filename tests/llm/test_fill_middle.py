import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import fill_middle as op

from .helpers import frame, prose

UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "char": re.compile(r"(?s).")}


def brute(key, text, s=op.Settings()):
    text = text or ""
    units = UNITS[s.unit].findall(text)
    digest = hashlib.sha256(f"{s.seed}{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or s.prefix in text or s.suffix in text or s.middle in text or h[2] % 100 >= s.rate:
        return n, "plain", text, None, None
    if h[3] % 100 < s.spm_rate:
        return n, "spm", s.suffix + suf + s.prefix + pre + s.middle + mid, len(pre), len(mid)
    return n, "psm", s.prefix + pre + s.suffix + suf + s.middle + mid, len(pre), len(mid)


def awkward():
    rows = [(i, t, None, None, None) for i, t in enumerate([
        "\n", "\n\n\n", "a", "a\n", "\na", "a\nb\r\nc", "<\nS>\n<P\n>", "say <P> here\nb", "x<M>", "<S>", "é\n\U0001f600\nñ\n",
        "\x0b\n\x8a\nĊ\nਊ", "line\n" * 3000, "long" * 50_000, "one line\x85still", "\x00\n\x00", "<P\n>\n<S\n><"])]
    return [*rows, (None, "a\nb\nc\nd", None, None, None), *prose(n=12)]


@pytest.mark.parametrize("settings", [op.Settings(), op.Settings(unit="char", chunk_bytes=64),
                                      op.Settings(seed="x", rate=60, spm_rate=0, prefix="[(", suffix="\\S+", middle="^$|")])
def test_matches_brute_force(spark, settings):
    rows = awkward()
    df = frame(spark, rows, clash=True).withColumn("n", F.lit("clash")).withColumn("form", F.lit(1)).withColumn("h0", F.lit(2))
    got = op.transform(df, settings=settings).select(
        "row.doc_id", "row.text", "n", "form", "output", "prefix_chars", "middle_chars",
        op.restored(F.col("output"), F.col("form"), settings).alias("again")).collect()
    want = [(r[0], r[1], *brute(r[0], r[1], settings), r[1] or "") for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert op.transform(frame(spark, [])).count() == 0


def test_marks_rank_and_select():
    rng = random.Random(4)
    for size in [0, 1, 7, 8, 9, 15, 16, 17, 200]:
        data = np.frombuffer(bytes(rng.choice([0, 9, 10, 11, 0x8A, 255, 138]) for _ in range(size)), np.uint8)
        marks = op.Marks(op.equal_marks(op.as_words(data), 0x0A))
        places = np.flatnonzero(data == 0x0A)
        at = np.arange(size + 1)
        assert marks.rank(at).tolist() == [int((places < i).sum()) for i in at]
        assert marks.select(np.arange(1, len(places) + 1)).tolist() == places.tolist()


def test_code_points_end_where_the_next_begins():
    text = "aé\U0001f600€\n" * 9
    data = np.frombuffer(text.encode(), np.uint8)
    marks = op.Marks(op.char_marks(op.as_words(data)))
    ends = np.cumsum([len(c.encode()) for c in text])
    assert marks.rank(ends).tolist() == list(range(1, len(text) + 1))
    assert (marks.select(np.arange(1, len(text) + 1)) + 1).tolist() == ends.tolist()


def test_sliced_and_large_arrays():
    texts = ["no", "a\nb\nc", "", "d\ne"]
    h = np.array([[1, 2, 0, 99]] * 2, np.int64)
    for kind in (pa.string(), pa.large_string()):
        done = op.transform_texts(pa.array(texts, kind).slice(1, 2), h, op.Settings())
        assert [c.to_pylist() for c in done] == [[3, 0], ["psm", "plain"], ["<P>a\n<S>c<M>b\n", ""], [2, None], [2, None]]

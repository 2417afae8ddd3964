"""Small documents that hold the awkward cases, and frames of them."""

import random

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like the operators' own.
CLASH = "row string, t string, key long, h long, kept string, shard int, size long, ids string, found string, spans string, rest string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def prose(seed=0, n=40):
    """(doc_id, text, lang, source, n_chars) rows: copies, near copies, shared passages, odd white space,
    null and empty texts, a very long text, repeated rows and a null source."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    texts = []
    for i in range(n):
        body = words(rng, rng.randrange(1, 200))
        if i % 4 == 0:
            at = rng.randrange(len(body))
            body[at:at] = passage
        texts.append(rng.choice([" ", "\n", "\t ", "\x0b"]).join(body))
    texts += [texts[3], texts[3], texts[0].replace("\n", " "), "", None, " \n\t", "one two", "x" * 5000,
              " ".join(words(rng, 20_000, 5000)), "a b c " * 80, "é è ñ \U0001f600 ok\x1cno"]
    near = texts[2].split() if len(texts[2].split()) > 60 else words(rng, 120)
    texts += [" ".join(near), " ".join([*near[:50], "changed", *near[51:]])]
    rows = [(i, t, rng.choice(["en", "fr", None, "xx"]), rng.choice(["s0", "s1", "S2", None]), len(t or ""))
            for i, t in enumerate(texts)]
    return [*rows, rows[1], rows[1], (None, texts[1], None, None, None)]


def frame(spark, rows, clash=False):
    kind = T.StructType.fromDDL(DOCS)
    df = spark.createDataFrame(rows, kind)
    if clash:
        from pyspark.sql import functions as F
        for f in T.StructType.fromDDL(CLASH):
            df = df.withColumn(f.name, F.lit("1").cast(f.dataType))
    return df

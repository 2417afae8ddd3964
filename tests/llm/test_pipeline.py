import random

import corpus_pipeline as pipeline
from cohortkit.llm.queries import ORACLE, QUERIES

from .helpers import frame, words

def labelled(spark, folder):
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(210, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        w = words(rng, 120, 10_000)
        text = " ".join(w)
        if i % 10 == 0:
            text += " token=abcdefabcdef12345678"
        rows.append((i, text, "xx", f"s{i % 3}", len(text)))
    rows += [(100 + i, r[1].replace(r[1].split()[60], "edited", 1), "xx", r[3], r[4]) for i, r in enumerate(rows[:5])]
    rows.append((210, " ".join(f"%{i}## $*{i * 7}" for i in range(80)), "xx", "s0", 0))  # unlike the language's reference
    return rows + [(200, "too short", "xx", "s0", 9), (201, None, None, None, None), (202, "", "en", None, 0), rows[7]]


def test_stages_hand_on_what_they_keep(spark, tmp_path):
    docs = frame(spark, corpus())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labelled(spark, tmp_path)
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mix", "tokens"]
    ids = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "tokens":
            assert docs.columns == COLUMNS
        ids.append(sorted(r["doc_id"] for r in docs.collect()))
        if name == "secrets":
            assert docs.filter("text like '%abcdefabcdef%'").count() == 0
            assert docs.filter("text like '%[SECRET]%'").count() == 6
    assert ids[0] == sorted([*range(60), *range(100, 105), 7])       # short, empty, null and odd texts are gone
    assert ids[1] == list(range(60)) == ids[2]                        # copies and near copies are gone
    assert set(ids[3]) <= set(range(60)) and len(ids[3]) == len(ids[4])
    run = pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in run.collect()) == ids[4]


def test_stages_take_empty_input_and_other_columns(spark, tmp_path):
    from pyspark.sql import functions as F
    labelled(spark, tmp_path)
    for docs in (frame(spark, []), frame(spark, corpus()[:3]).withColumn("row", F.lit("x"))):
        for _, stage in pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.count()


def test_every_operator_has_its_query():
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in QUERIES) == 1
    assert set(ORACLE) <= set(QUERIES)

"""The queries that SQL can express give what DuckDB gives on the same tables, awkward rows included."""

import duckdb
import pytest

from cohortkit.llm.queries import ORACLE, QUERIES

from .helpers import frame, prose


def same(spark, folder, key, tables):
    con = duckdb.connect()
    for t in tables:
        path = f"{folder}/{t}.parquet" if folder.startswith("/root") else f"{folder}/{t}.parquet/part-*.parquet"
        con.sql(f"create view {t} as select * from read_parquet('{path}')")
    res = con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    got = QUERIES[key](spark, folder)
    assert sorted(names) == sorted(got.columns)
    rows = sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)
    assert rows == sorted(res.fetchall(), key=str)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_given_tables(spark, key):
    same(spark, "/root/testdata/sf0.001", key, ["documents", "embeddings", "conversations", "pages", "benchmark", "labels"])


@pytest.mark.parametrize("key", sorted(k for k in ORACLE if k[:4] in ("op1_", "op2_", "op3_", "op12")))
def test_awkward_documents(spark, tmp_path, key):
    rows = [*prose(), (990, "token=abcdefabcdef1234 " * 3 + "\n" + "the of and " * 60, "en", "s", 0)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(45)] + [(3, 1, 0), (None, 1, 0), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    same(spark, str(tmp_path), key, ["documents", "labels"])

import duckdb

from cohortkit.llm import chat_format as op
from cohortkit.llm.queries import ORACLE, QUERIES

LOG = "conv_id long, turn long, role string, text string"


def log():
    full = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "ok")]
    rows = [(c, i, r, t) for c, n in ((1, 1), (2, 2), (3, 4), (4, 4), (9, 3)) for i, (r, t) in enumerate(full[:n])]
    rows += [(5, i, r, t) for i, (r, t) in enumerate([("user", "hi"), ("assistant", "different")])]
    rows += [(6, 0, None, None), (6, 1, "user", ""), (7, 3, "user", "hi"), (7, 5, "assistant", "hello"), (7, 9, "user", "x" * 50_000)]
    rows += [(8, 0, "user", "tie a"), (8, 0, "user", "tie b"), (8, 0, "user", "tie a"), (None, 0, "user", "no id"), (10, None, "user", "q")]
    rows += [(None, 1, "user", "a"), (None, 1, "user", "b"), (None, 1, "user", "b"), (None, 4, "user", "hi"), (None, 0, "user", "q")]
    # Different turns that would read alike if role and text were only put one after the other.
    rows += [(11, 0, "user\nhi", "there"), (12, 0, "user", "hi\nthere"), (12, 1, "user", "more")]
    rows += [(13, 0, "us", "erhi"), (14, 0, "user", "hi"), (14, 1, "x", "y")]
    return rows


def brute(rows):
    by = {}
    for i, (c, turn, role, text) in enumerate(rows):
        by.setdefault(("row", i) if c is None else (c,), []).append((turn, role, text))
    import hashlib
    said = {}
    for c, turns in by.items():
        turns = [(t, r if r is not None else "unknown", x or "") for t, r, x in turns]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
        said[c] = [(r, x) for _, r, x in turns]
    out = []
    for c, s in said.items():
        if any(len(o) > len(s) and o[:len(s)] == s for o in said.values()):
            continue
        if any(o == s and (len(d), d) < (len(c), c) for d, o in said.items() if d != c):
            continue
        out.append((c[0] if len(c) == 1 else None, len(s), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in s)))
    return sorted(out, key=str)


def test_maximal_conversations(spark):
    df = spark.createDataFrame(log(), LOG)
    got = sorted(map(tuple, op.render(df).collect()), key=str)
    assert got == brute(log())
    kept = {g[0] for g in got}
    assert {3, 11, 12, 13, 14} <= kept and not kept & {1, 2, 4, 9}


def test_oracle_and_extra_columns(spark, tmp_path):
    df = spark.createDataFrame(log(), LOG).selectExpr("*", "'x' as n", "1 as a", "2 as what")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = sorted(con.sql(ORACLE["op8_chat_format"]).fetchall(), key=str)
    assert sorted(map(tuple, QUERIES["op8_chat_format"](spark, str(tmp_path)).collect()), key=str) == want


def test_empty_log(spark):
    assert op.render(spark.createDataFrame([], LOG)).count() == 0

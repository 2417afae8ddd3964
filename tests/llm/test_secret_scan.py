import hashlib
import random
import re

from cohortkit.llm import secret_scan as op

from .helpers import frame, prose

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def secret_texts():
    rng = random.Random(1)
    parts = ["password=", "PassWD : ", "secret\"='", "Token:", "api_key = ", "APIKEY=", "tokentoken: ", "AKIA", "akia", "é", "😀",
             "deadbeef" * 3, "ABCDEFGHIJ12345678", "short", " ", "\n", "x" * 15, "0123456789abcdef", "AKIAAKIA", "\"", "'", "=", "passwor",
             "ghp_" + "a1B2" * 10, "-----BEGIN RSA PRIVATE KEY-----", "AIza" + "x" * 35, "xoxb-1234567890-abc"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(400)]


def test_trigram_query_holds_for_every_match():
    texts = secret_texts()
    for rule in op.RULES:
        query = op.trigram_query(rule.pattern)
        for t in texts:
            if re.search(rule.pattern, t, re.ASCII):
                assert any(all(g in t.lower() for g in term) for term in query), (rule.kind, t)
    assert op.trigram_query(r"[0-9a-f]{16,}") == op.ALWAYS
    assert op.trigram_query(r"abcd|xyz+") == {frozenset({"abc", "bcd"}), frozenset({"xyz"})} or \
        op.trigram_query(r"abcd|xyz+") == op.ALWAYS


def test_spans_match_brute_force_on_whole_texts(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*secret_texts(), *(r[1] for r in prose())])]
    rows += [rows[0], rows[0], (None, rows[5][1], None, None, None)]
    docs = frame(spark, rows, clash=True)
    got = op.scan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [x for x in r["found"] if x["ord"] < 3]
        assert ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in own) == base_spans(r["row"]["text"])


def test_query_digests(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*secret_texts()[:60], None, ""])]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    from cohortkit.llm.queries import QUERIES
    got = {r["doc_id"]: r for r in QUERIES["op1_secret_scan"](spark, str(tmp_path)).collect()}
    for i, t, *_ in rows:
        assert got[i]["base_sha256"] == hashlib.sha256(base_spans(t).encode()).hexdigest()
        assert got[i]["n_assign"] == base_spans(t).count("assign:")


def test_redact_masks_spans_and_keeps_the_rest(spark):
    rows = [(1, "a token=abcdefabcdef1234567890 b", "en", "s", 31), (2, "clean", "en", "s", 5), (3, None, None, None, None),
            (4, "é " + "deadbeef" * 2 + " AKIA" + "Z" * 16, "en", "s", 0)]
    out = {r["doc_id"]: r for r in op.redact(frame(spark, rows)).collect()}
    assert out[1]["text"] == "a [SECRET] b" and out[1]["n_chars"] == len("a [SECRET] b")
    assert out[2]["text"] == "clean" and out[3]["text"] is None
    assert out[4]["text"] == "é [SECRET] [SECRET]"
    assert op.redact(frame(spark, [])).count() == 0


def test_ghp_and_key_headers_are_added_spans(spark):
    text = "x ghp_" + "a1B2c3D4" * 5 + " -----BEGIN RSA PRIVATE KEY-----"
    found = op.scan(frame(spark, [(1, text, None, None, 0)])).collect()[0]["found"]
    assert [x["kind"] for x in found] == ["github", "private_key"]


def test_main_path_has_no_python_node(spark):
    plan = op.scan(frame(spark, prose()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

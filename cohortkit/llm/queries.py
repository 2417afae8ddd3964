"""The operators' queries over the driver's tables: ``opN_<name>`` and, where SQL can say it, its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import oracles
from .common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    from . import secret_scan as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("found", lambda x: x["ord"] < len(op.BASE))

    def count(i):
        return F.size(F.filter("found", lambda x: x["ord"] == i)).cast("long").alias(f"n_{op.BASE[i].kind}")

    return op.scan(docs).select(
        F.col("row.doc_id").alias("doc_id"), count(0), count(1), count(2),
        F.sha2(op.digest(base), 256).alias("base_sha256"), op.digest(F.col("found")).alias("spans"))


@query
def op2_quality_rules(spark, sf_dir):
    from . import quality_rules as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    references = op.fit(docs, table(spark, sf_dir, "labels"))
    return op.judge(docs, references=references).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query
def op7_bpe(spark, sf_dir):
    import public_tokenizers

    from . import bpe as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = op.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_main_text(spark, sf_dir):
    from . import html_text as op
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return op.extract(pages).select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), "text",
                                    F.length("text").cast("long").alias("n_chars"))


@query
def op9_top_k(spark, sf_dir):
    from . import topk_search as op
    vectors = op.integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return op.top_k(vectors, F.col("id") % 50 == 0)


ORACLE["op9_top_k"] = """
WITH valid AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND c.rid <> q.rid AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query
def op4_sharding(spark, sf_dir):
    from . import sharding as op
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    return op.deal(docs).select("row.*", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                                F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_chat_format(spark, sf_dir):
    from . import chat_format as op
    return op.render(table(spark, sf_dir, "conversations"))


ORACLE["op8_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), 'row ' || row_number() OVER ()) AS conv, turn,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), said AS (
  SELECT conv_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv) AS n_turns,
         list({'role': role, 'text': text}) OVER (
           PARTITION BY conv ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turns
  FROM turns WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text))
), kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, turns FROM said AS whole
  WHERE n = n_turns AND NOT EXISTS (SELECT 1 FROM said AS longer
                                    WHERE longer.n = whole.n AND longer.turns = whole.turns AND longer.n < longer.n_turns)
  GROUP BY n_turns, turns
)
SELECT conv_id, n_turns, array_to_string(list_transform(
  turns, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), '') AS chat
FROM kept
"""


@query
def op10_mixing(spark, sf_dir):
    from . import mixing as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    settings = op.Settings()
    # The result needs no text: words are counted once, and what follows reads the narrow rows.
    narrow = stored(spark, op.measure(docs, settings).select(
        F.col("row.doc_id").alias("doc_id"), "skey", "size", "h"), "mix-documents")
    return op.mix_measured(narrow.select(F.struct("doc_id").alias("row"), "skey", "size", "h"),
                           narrow.select("skey", "size", "h"), settings).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op5_order_minhash(spark, sf_dir):
    from . import order_minhash as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.classes(docs).select("doc_id", "class_id")


@query
def op3_substring_dedup(spark, sf_dir):
    from . import substring_dedup as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.remove_repeats(docs).select(F.col("rest.doc_id").alias("doc_id"), "n_words", "n_removed",
                                          F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_lexical_search(spark, sf_dir):
    from . import lexical_search as op
    return op.search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                     table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query
def op12_fill_middle(spark, sf_dir):
    from . import fill_middle as op
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op.transform(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(op.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op13_warc(spark, sf_dir):
    from . import warc_archive as op
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = op.archive(pages, f"{checkpoint_dir(spark)}/cohortkit-warc-{uuid.uuid4().hex}")
    return op.read(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                 F.col("refers_to_page").alias("refers_to"))


ORACLE["op1_secret_scan"] = oracles.secret_scan_sql()
ORACLE["op2_quality_rules"] = oracles.quality_rules_sql()
ORACLE["op3_substring_dedup"] = oracles.substring_dedup_sql()
ORACLE["op12_fill_middle"] = oracles.fill_middle_sql()
ORACLE["op13_warc"] = oracles.warc_sql()
ORACLE["op11_lexical_search"] = oracles.lexical_search_sql()

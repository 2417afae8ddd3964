import base64
import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import warc_archive as op
from cohortkit.llm.queries import QUERIES

from .test_oracles import same

PAGES = "page_id long, url string, html string"


def pages():
    rows = [(i, f"https://site{i % 3}.test/p/{i}", f"<p>page {i}</p>") for i in range(20)]
    rows += [(100 + i, "https://same.test/", "<p>the same</p>") for i in range(30)]
    rows += [(200, None, None), (201, "u", ""), (202, "https://x.test/a b\r\nEvil: 1", "\r\n\r\nWARC/1.0\r\n\r\n"),
             (203, "é", "é\U0001f600 \x00 text"), (204, "long", "x" * 300_000), (None, "no id", "<p>page 3</p>"),
             (None, "no id", "only without id"), (None, "no id", "only without id")]
    return [*rows, rows[0], rows[49]]


def brute(rows):
    out, by = [], {}
    for i, (page, _, html) in enumerate(rows):
        by.setdefault(html or "", []).append((page is not None, page or 0, i))
    for payload, found in by.items():
        keep = max(found)
        raw = payload.encode()
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for has, page, i in found:
            kept = (has, page, i) == keep
            out.append((page if has else None, len(raw), sha, "response" if kept else "revisit",
                        None if kept or not keep[0] else keep[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("settings", [op.Settings(), op.Settings(file_bytes=700, chunk_bytes=50), op.Settings(file_records=3)])
def test_pages_through_archives(spark, tmp_path, settings):
    df = spark.createDataFrame(pages(), PAGES).repartition(3).withColumn("file", F.lit("clash")).withColumn("ordinal", F.lit(1))
    index = op.archive(df, f"file://{tmp_path}/a", settings)
    back = op.read(index, settings=settings)
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to_page").collect()
    assert sorted(map(tuple, got), key=str) == brute(pages())
    # Every response gives its text back; each revisit names a response by its id.
    texts = sorted((r.page_id is not None, r.page_id or 0, r.payload.decode()) for r in back.filter("record_type = 'response'").collect())
    by = {(p[0] is not None, p[0] or 0): p[2] or "" for p in pages()}
    assert all(by[a, b] == t for a, b, t in texts if a)
    ids = {r.record_id for r in back.filter("record_type = 'response'").collect()}
    assert all(r.refers_to in ids for r in back.filter("record_type = 'revisit'").collect())
    assert back.select("record_id").distinct().count() == len(pages())
    assert not os.path.exists(f"{tmp_path}/a/whole")


def test_members_and_index(spark, tmp_path):
    listing = op.write(spark.createDataFrame(pages(), PAGES).coalesce(1), f"{tmp_path}/w")
    index = op.normalise(listing, f"{tmp_path}/n", op.revisits(listing)).orderBy("ordinal").collect()
    assert len({r.file for r in index}) == 1 and [r.ordinal for r in index] == list(range(len(pages())))
    source = listing.first().file
    with open(source, "rb") as f:
        whole = gzip.GzipFile(fileobj=f).read()
    with open(index[0].file, "rb") as f:
        data = f.read()
    # The members lie end to end, each one a record; without the revisits they say what the whole stream said.
    assert index[0].offset == 0 and index[-1].offset + index[-1].length == len(data)
    assert all(a.offset + a.length == b.offset for a, b in zip(index, index[1:], strict=False))
    plain = op.normalise(listing.select("file"), f"{tmp_path}/p").first().file
    with open(plain, "rb") as f:
        assert gzip.GzipFile(fileobj=f).read() == whole
    assert gzip.decompress(data[index[3].offset:index[3].offset + index[3].length]).startswith(b"WARC/1.0\r\nWARC-Type: ")
    uri = [r.target_uri for r in index if r.target_uri and r.target_uri.startswith("https://x.test")]
    assert uri == ["https://x.test/a%20b%0D%0AEvil:%201"]


def foreign():
    def rec(kind, block, extra=""):
        return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{kind}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n"
                .encode() + block + b"\r\n\r\n")
    return [rec("warcinfo", b"software: x\r\n"), rec("resource", b"", "WARC-Target-URI:  a:b \r\n"),
            rec("metadata", b"\x00\xff" * 5000), rec("request", b"GET / HTTP/1.1\r\n\r\n")]


def test_foreign_archives(spark, tmp_path):
    records = foreign()
    whole = b"".join(records)
    made = {
        "plain.warc": whole, "one.warc.gz": gzip.compress(whole), "members.warc.gz": b"".join(map(gzip.compress, records)),
        "padded.warc.gz": gzip.compress(whole) + b"\0" * 700, "empty.warc.gz": b"", "cut.warc.gz": gzip.compress(whole)[:-30],
        "short.warc": whole[:-60], "odd.warc": b"<html>" * 3, "damaged.warc.gz": gzip.compress(records[0]) + b"\x1f\x8bxxxxxxxxxxxxxxxx",
        "late.warc": whole + b"garbage that is no record"}
    for name, data in made.items():
        with open(f"{tmp_path}/{name}", "wb") as f:
            f.write(data)
    files = spark.createDataFrame([(f"{tmp_path}/{n}",) for n in made], "file string")
    index = op.normalise(files, f"{tmp_path}/out", settings=op.Settings(chunk_bytes=64))
    by = {}
    for r in index.collect():
        by.setdefault(os.path.basename(r.source), []).append((r.ordinal, r.record_type, r.target_uri, r.problem and r.problem[:7]))
    good = [(0, "warcinfo", None, None), (1, "resource", "a:b", None), (2, "metadata", None, None), (3, "request", None, None)]
    for name in ("plain.warc", "one.warc.gz", "members.warc.gz", "padded.warc.gz"):
        assert by[name] == good, name
    assert "empty.warc.gz" not in by
    assert by["cut.warc.gz"][-1] == (None, None, None, "cut off") and by["cut.warc.gz"][:-1] == good[:len(by["cut.warc.gz"]) - 1]
    assert by["short.warc"] == [*good[:3], (None, None, None, "cut off")]
    assert by["odd.warc"] == [(None, None, None, "not a r")]
    assert by["damaged.warc.gz"] == [good[0], (None, None, None, "not a r")]
    assert by["late.warc"] == [*good, (None, None, None, "not a r")]
    back = {(r.record_type, bytes(r.payload)) for r in op.read(index).collect()}
    assert ("metadata", b"\x00\xff" * 5000) in back and ("resource", b"") in back


def test_wrong_digest_is_an_error():
    whole = op.record("0" * 32, 1, "u", b"text", op.digest(b"other"), "2024-01-01T00:00:00Z")
    with pytest.raises(op.NotWarc):
        op.read_record(gzip.compress(whole))


def test_small_blocks_hold_little():
    source = io.BytesIO(gzip.compress(b"WARC/1.0\r\nContent-Length: 4000000\r\n\r\n" + b"\0" * 4_000_000 + b"\r\n\r\n"))
    stream = op.Stream(source, op.Settings(chunk_bytes=1000))
    assert stream.header() and max(len(p) for p in stream.take(4_000_000)) <= 2000
    assert stream.header() is None


def test_empty_table(spark, tmp_path):
    index = op.archive(spark.createDataFrame([], PAGES), f"{tmp_path}/e")
    assert index.count() == 0 and op.read(index).count() == 0


def test_oracle_on_awkward_pages(spark, tmp_path):
    spark.createDataFrame([r for r in pages() if "\x00" not in (r[2] or "")], PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    same(spark, str(tmp_path), "op13_warc", ["pages"])
    assert QUERIES["op13_warc"](spark, str(tmp_path)).columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

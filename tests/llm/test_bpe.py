import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortkit.llm import bpe

from .helpers import frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def enc():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def texts():
    rng = random.Random(3)
    out = ["Hello, thonder's <|endoftext|>ÉÀ İ Σας\x1c x\x85y it's12 ***", "", "a" * 70 + "!" * 40, "日本語 مرحبا 🎉🎉 é́ it'll we've I'm",
           "<|startoftext|><|endoftext|>a<|endoftext|", "   x　y", "don't DON'T ' 's"]
    out += ["".join(rng.choice("abcdeinthsr '!") for _ in range(300)) for _ in range(100)]
    out += ["".join(chr(rng.choice([rng.randint(32, 700), rng.randint(0x3000, 0x9fff), rng.randint(0x1f300, 0x1f6ff)]))
                    for _ in range(150)) for _ in range(60)]
    return out


def test_encodes_as_the_library_does(enc):
    lib = Tokenizer.from_file(PATH)
    for t in texts():
        ids = enc.encode(t).tolist()
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids == want, t
        assert enc.decode(ids) == lib.decode(want, skip_special_tokens=False)


def test_every_code_point_as_the_library_has_it(enc):
    lib = Tokenizer.from_file(PATH)
    # Beyond the third plane, where no letters are assigned, one in 97 (all of them agree, which takes two minutes).
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x33500 or c % 97 == 0)]
    # Beside a letter, a digit and a sign, so that the class of each shows.
    said = [f"a{chr(c)}1{chr(c)}!" for c in points]
    for at in range(0, len(said), 50_000):
        part = said[at:at + 50_000]
        for t, want in zip(part, lib.encode_batch_fast(part, add_special_tokens=False), strict=True):
            assert enc.encode(t).tolist() == want.ids, t
        enc.forget()


def test_fuzzed_texts_as_the_library_has_them(enc):
    lib = Tokenizer.from_file(PATH)
    rng = random.Random(11)
    kinds = [(32, 0x250), (0x300, 0x370), (0x370, 0x600), (0x1c80, 0x1cc0), (0x1e00, 0x2100), (0xa640, 0xa800), (0xac00, 0xac80),
             (0x10500, 0x10e00), (0x11300, 0x11400), (0x16d00, 0x16e00), (0x1e900, 0x1e960), (0x1f300, 0x1f700), (9, 33)]
    texts = ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(1, 40))) for _ in range(20_000)]
    for t, want in zip(texts, lib.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert enc.encode(t).tolist() == want.ids, t
    enc.forget()


def test_small_caches_change_nothing(enc, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    with open(PATH, encoding="utf-8") as f:
        small = bpe.Encoder(f.read())
    for t in texts()[:40]:
        assert small.encode(t) == enc.encode(t)


def test_query_over_awkward_rows(spark, tmp_path):
    rows = prose() + [(1000 + i, t, "en", "s", 0) for i, t in enumerate(texts()[:20])]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    from cohortkit.llm.queries import QUERIES
    got = QUERIES["op7_bpe"](spark, str(tmp_path)).collect()
    lib = Tokenizer.from_file(PATH)
    want = []
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_other_columns_and_empty_tables(spark):
    docs = frame(spark, prose()[:3], clash=True)
    out = bpe.encode(docs, PATH)
    assert out.select("row.*").columns == docs.columns
    assert out.select("row.*").count() == 3
    assert bpe.encode(frame(spark, []), PATH).count() == 0

"""Operator 7: exact BPE encoding by per-prefix dynamic programming, and decoding.

The tokens that end at a position come from an automaton over the vocabulary whose links lead from each
match to its longest suffix that is a token too (the Aho-Corasick form of a suffix automaton). For every prefix
of a piece exactly one of them is the last token of the prefix's encoding: the one that is compatible
with the last token of what stands before it. Following these last tokens back from the end gives the
same ids as merging step by step, in time linear in the piece.

Two tokens are compatible if merging their joint symbols leaves both as they are. A merge across
their border would need a token on the right edge of the first and one on the left edge of the second
while both are still unmerged, so only the two edges of their merge trees are compared.

Defined results: a null or empty text has no ids and decodes to the empty string; repeated rows encode
alike; all other columns are carried in the struct ``row`` and cannot clash.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import small_batches

END = "\n"  # stands for the end-of-word suffix; no byte symbol is a line feed
CACHED = 600_000  # words (and pieces, pairs) kept during a task, per generation; only speed depends on it


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself where it is
    printable, otherwise the next free code point from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    symbols, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b], free = chr(free), free + 1
    return [symbols[b] for b in range(256)]


def character_classes() -> dict[str, str]:
    """White space, letters and numbers by the tokenizers library's own Unicode tables, each as the inside of a
    character class: runs of these among all code points in their order."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    out = {}
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        runs = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(points)
        out[name] = "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run, _ in runs)
    return out


def composed_otherwise() -> set[str]:
    """Characters at which the library, whose normalization follows another Unicode version, may compose or order
    a text otherwise than this Python: each combining one is tried before the highest class, each pair by itself."""
    nfc, out = normalizers.NFC(), set()
    for c in map(chr, [*range(0x300, 0xD800), *range(0xE000, sys.maxunicode + 1)]):
        parts = unicodedata.decomposition(c)
        tried = [f"a\u0345{c}"] if unicodedata.combining(c) else []
        if parts and not parts.startswith("<"):
            tried.append("".join(chr(int(x, 16)) for x in parts.split()))
        for text in tried:
            if nfc.normalize_str(text) != unicodedata.normalize("NFC", text):
                out |= {c, text[-1]}
    return out


class Memo(dict):
    """A dictionary in two generations: when the young one is full it becomes the old one."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encoder for a tokenizer file with an NFC/space/lower-case normalizer, a splitting pattern, byte
    symbols and an end-of-word suffix."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: s for s, i in vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if self.steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unsupported normalizer {self.steps}")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # White space is what Unicode says it is; Python's \s also takes the separators 1C to 1F.
        for name, chars in character_classes().items():
            pattern = pattern.replace(name, chars)
        self.pieces = re.compile(pattern)
        # Texts with characters that this Python and the library know differently are folded by the library.
        strange = composed_otherwise()
        self.high = re.compile("[\u0378-\U0010ffff]")  # all below are known alike
        self.strange = Memo(lambda c: c in strange or unicodedata.category(c) == "Cn")
        self.folded = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.odd = regex.compile("[\x1c-\x1f]")
        self.space = regex.compile(r"\p{White_Space}+")
        self.symbols = dict(enumerate(byte_symbols()))

        def unit(s):
            return s[:-len(suffix)] + END if s.endswith(suffix) else s

        ids = {unit(s): i for s, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (unit(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[ids[a], ids[b]] = rank
            self.parts.setdefault(ids[a + b], (ids[a], ids[b], rank))
        self.right = {i: self._edge(i, 1) for i in ids.values()}
        self.left = {i: self._edge(i, 0) for i in ids.values()}
        self.together = Memo(self._compatible)
        self.found = ahocorasick.Automaton()
        for s, i in ids.items():
            if self._whole(i):
                self.found.add_word(s, (len(s.rstrip(END)), i))
        self.found.make_automaton()
        self.words = Memo(self._word)
        self.ids_of = Memo(lambda piece: array("i", self._piece(piece)).tobytes())

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens on one edge of a token's merge tree, each with the rank of the merge that ends it."""
        out, gone = [(token, float("inf"))], None
        while token in self.parts:
            gone, token = self.parts[token][2], self.parts[token][side]
            out.append((token, gone))
        return out

    def _whole(self, token: int) -> bool:
        """Does the token's own text encode to the token? Its two parts must and must meet only then."""
        if token not in self.parts:
            return True
        a, b, rank = self.parts[token]
        return self._whole(a) and self._whole(b) and not self._crossed(a, b, rank)

    def _crossed(self, p: int, t: int, before: float = float("inf")) -> bool:
        """Does some merge across the border of p and t come first (and before rank ``before``)?

        Of two equal merges the left one goes first, hence the strict and the weak comparison.
        """
        rank, xs, ys = self.rank, self.right[p], self.left[t]
        i = j = 0
        while True:
            # Back in time: of the two tokens at the border, the one that was merged last is taken apart.
            x, gone_x = xs[i]
            y, gone_y = ys[j]
            m = rank.get((x, y))
            if m is not None and m < gone_x and m <= gone_y and m < before:
                return True
            born_x = xs[i + 1][1] if i + 1 < len(xs) else -1
            born_y = ys[j + 1][1] if j + 1 < len(ys) else -1
            if born_x > born_y:
                i += 1
            elif born_y >= 0:
                j += 1
            else:
                return False

    def _compatible(self, pair: int) -> bool:
        return not self._crossed(pair >> 20, pair & 0xFFFFF)

    def _piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():
            s = piece  # these bytes are their own symbols
        else:
            s = piece.encode().decode("latin-1").translate(self.symbols)
        n = len(s)
        last = [-1] * (n + 1)  # of each prefix: its last token ...
        back = [0] * (n + 1)   # ... and where that begins
        together = self.together
        for end, (size, token) in self.found.iter(s + END):
            at = end + 1
            if at > n:
                at = n        # the token takes the end of the word, and with it the last symbol
            elif at == n:
                continue      # the last symbol always carries the end of the word
            if last[at] < 0:
                start = at - size
                if not start or last[start] >= 0 and together[last[start] << 20 | token]:
                    last[at], back[at] = token, start
        out, at = [], n
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def _word(self, word: str) -> bytes:
        """Ids, as 32-bit integers, of a run without white space."""
        pieces = self.pieces.findall(word)
        if len(pieces) == 1:
            return array("i", self._piece(pieces[0])).tobytes()  # kept with the word
        return b"".join([self.ids_of[piece] for piece in pieces])

    def decode(self, ids) -> str:
        """Without a decoder in the file, tokens are joined by one space."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    def _plain(self, text: str, ids: list) -> None:
        if any(self.strange[c] for c in set(self.high.findall(text))):
            text = self.folded.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")  # lower case goes by character, not by its place in a word
            text = text.lower()
        words = self.words
        parts = filter(None, self.space.split(text)) if self.odd.search(text) else text.split()
        ids += [words[w] for w in parts]

    def encode(self, text: str | None) -> array:
        """The ids of a whole text."""
        ids: list[bytes] = []
        at = 0
        if text and self.special is not None and "<" in text:
            for m in self.special.finditer(text):
                self._plain(text[at:m.start()], ids)
                ids.append(array("i", [self.added[m[0]]]).tobytes())
                at = m.end()
        if text:
            self._plain(text[at:], ids)
        return array("i", b"".join(ids))

    def forget(self) -> None:
        """Give back what was kept: an idle worker holds the vocabulary only."""
        for memo in (self.words, self.ids_of, self.together):
            memo.clear()
            memo.old = {}


_ENCODERS: dict[int, Encoder] = {}  # of this worker, by the hash of the tokenizer's content


def encoder(content: str) -> Encoder:
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(content)
    return _ENCODERS[key]


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in the struct ``row``, the ids of the whole text, and ``decoded``, the
    text that the ids stand for. ``tokenizer`` is the file's path on the driver; its content (a few MB,
    whatever the data) is broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("t"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content.value)
        try:
            for batch in batches:
                done = [enc.encode(t) for t in batch.column("t").to_pylist()]
                ends = np.cumsum([0, *map(len, done)])
                ids = np.frombuffer(b"".join([a.tobytes() for a in done]), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                decoded = pa.array([enc.decode(a) for a in done], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("row"), lists, decoded], ["row", "ids", "decoded"])
        finally:
            enc.forget()

    return rows.mapInArrow(run, schema)

"""Operator 1: secret scan through a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams (an OR of ANDs). The
index holds a posting (trigram, document key) for each trigram that some query names and a document
contains. Postings are intersected by document: grouping by the document key, never by the trigram,
so a trigram that a third of all documents hold makes no hot group, and a document's postings are
combined before the shuffle. Only candidate documents are verified with the expression. A rule
without a mandatory trigram (``hex``) scans every document.

Defined results: a null text is empty and has no span; repeated rows give the same spans; a key
collision only adds a candidate, which the verification then judges; other columns stay as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

try:  # the parser's module name since Python 3.11
    from re import _constants as sre, _parser as parser
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str         # understood alike by Java and by the trigram derivation
    group: int = 0       # this group of the match ...
    min_length: int = 1  # ... must be that long


# Fixed patterns. The first three are the base kinds; hex matches only runs of 16 or more, which are
# the runs of [0-9a-f]+ that are long enough, and access likewise (a shorter run holds no longer one).
BASE = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                   r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + ADDED
MASK = "[SECRET]"
MAX_STRINGS = 64  # a set of literal alternatives larger than this is cut into separate conditions

# ------------------------------------------------------------------ regex -> Boolean trigram query
Query = frozenset  # of frozensets of trigrams: an OR of ANDs; an empty AND holds for every text
ALWAYS: Query = frozenset([frozenset()])


def _simplest(terms) -> Query:
    """Without the ANDs that a shorter one implies."""
    return frozenset(t for t in terms if not any(o < t for o in terms))


def _both(a: Query, b: Query) -> Query:
    return _simplest({x | y for x in a for y in b})


def _literals(strings: set[str]) -> Query:
    """One of these strings occurs; trigrams are of the lower-cased text."""
    grams = (frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in {s.lower() for s in strings})
    return _simplest(set(grams))


def _choices(items) -> set[str] | None:
    """The characters of a class, or None when it is too wide to enumerate."""
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(chr(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            out.update(map(chr, range(arg[0], arg[1] + 1)))
        else:
            return None
    return {c.lower() for c in out}


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """(all strings the nodes match, or None; a condition that holds wherever they match)."""
    strings: set[str] | None = {""}
    whole, query = True, ALWAYS

    def flush():
        nonlocal strings, whole, query
        query, strings, whole = _both(query, _literals(strings)), {""}, False

    for op, arg in nodes:
        if op is sre.LITERAL:
            found, inner = {chr(arg).lower()}, ALWAYS
        elif op is sre.IN:
            found, inner = _choices(arg), ALWAYS
        elif op is sre.SUBPATTERN:
            found, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            found = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            inner = _simplest(set().union(*(p[1] for p in parts)))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            found, inner = _walk(body)
            if found is not None and high is not sre.MAXREPEAT and high <= 2:
                found = set().union(*({"".join([s] * n) for s in found} for n in range(low, high + 1)))
            else:
                found, inner = None, inner if low else ALWAYS
        else:
            found, inner = None, ALWAYS
        if found is None:
            flush()
            query = _both(query, inner)
        elif len(strings) * len(found) > MAX_STRINGS:
            flush()
            strings = found
        else:
            strings = {a + b for a in strings for b in found}
    if whole:
        return strings, _literals(strings)
    return None, _both(query, _literals(strings))


def trigram_query(pattern: str) -> Query:
    """OR of ANDs of trigrams that any text matching ``pattern`` satisfies (in lower case)."""
    return _walk(parser.parse(pattern, re.ASCII))[1]


# ------------------------------------------------------------------------------- index and lookup
def _numbered(rules) -> list[str]:
    """The trigrams that the rules' queries name, in order; their places are their ids."""
    return sorted({g for r in rules for term in trigram_query(r.pattern) for g in term})


def postings(keyed: DataFrame, rules=RULES) -> DataFrame:
    """The inverted index of ``keyed`` (key, t): one row (gram, key) for each named trigram in a text."""
    low = keyed.select("key", F.lower("t").alias("low"))
    held = [F.when(F.contains("low", F.lit(g)), F.lit(i).cast("short")) for i, g in enumerate(_numbered(rules))]
    return low.select(F.explode(F.array_compact(F.array(*held))).alias("gram"), "key")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(key, cand): bit i of ``cand`` is set if the document's postings satisfy the query of rule i."""
    grams = _numbered(rules)
    words = range(-(-len(grams) // 60))
    sets = index.groupBy("key").agg(*[
        F.bit_or(F.when((F.col("gram") >= 60 * w) & (F.col("gram") < 60 * (w + 1)),
                        F.expr(f"shiftleft(1L, gram - {60 * w})")).otherwise(F.lit(0).cast("long"))).alias(f"set{w}")
        for w in words])
    number = {g: i for i, g in enumerate(grams)}

    def holds(term) -> Column:
        masks = [sum(1 << (number[g] - 60 * w) for g in term if number[g] // 60 == w) for w in words]
        tests = [F.col(f"set{w}").bitwiseAND(F.lit(m).cast("long")) == m for w, m in enumerate(masks) if m]
        return _all(tests)

    bits = [F.when(_any([holds(t) for t in trigram_query(r.pattern)]), F.lit(1 << i)).otherwise(F.lit(0))
            for i, r in enumerate(rules) if trigram_query(r.pattern) != ALWAYS]
    total = bits[0]
    for b in bits[1:]:
        total = total + b
    return sets.select("key", total.alias("cand")).filter("cand > 0")


def _all(tests):
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _any(tests):
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


# ------------------------------------------------------------------------------------- verification
SPAN = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Spans (code points, end exclusive) of the rule's leftmost non-overlapping matches.

    The pieces between the matches and the matches themselves, laid end to end, give the offsets.
    """
    def place(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        ok = F.length(F.regexp_extract(x["hit"], rule.pattern, rule.group)) >= rule.min_length
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"),
                                F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    pairs = let(hits, lambda h: F.zip_with(F.slice(gaps, F.lit(1), F.size(h)), h,
                                           lambda g, m: F.struct(g.alias("gap"), m.alias("hit"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(pairs, zero, place, lambda acc: acc["out"])


def scan(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in the struct ``row``, its text ``t`` (null: empty) and its ``found`` spans,
    ordered by start, then by the rules' order."""
    hashed = [f"`{n}`" for n, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.xxhash64(*hashed).alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest")
                       if len(docs.columns) > 1 else F.lit(None).alias("rest"),
                       F.col(f"`{text}`").isNull().alias("no_text"))
    hit = candidates(postings(rows.select("key", "t"), rules), rules)
    # The candidate side is narrow and has a key once, so the texts need no sort to be joined.
    both = rows.join(hit.hint("shuffle_hash"), "key", "left")
    found = []
    for i, rule in enumerate(rules):
        if trigram_query(rule.pattern) == ALWAYS:
            test = F.col("t").rlike(rule.pattern)
        else:
            test = F.coalesce(F.col("cand"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0
        found.append(F.when(test, spans_of(F.col("t"), rule, i)).otherwise(F.array().cast(SPAN)))
    kept = [F.when(F.col("no_text"), F.lit(None)).otherwise(F.col("t")).alias(c) if c == text
            else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return both.select(F.struct(*kept).alias("row"), "t", F.sort_array(F.concat(*found)).alias("found"))


def digest(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules=RULES, text: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by ``mask``; a column
    ``n_chars``, if there, counts the new text."""
    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        piece = F.substring(F.col("t"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["parts"], F.array(piece, F.lit(mask)))).otherwise(acc["parts"])
                        .alias("parts"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    clean = F.aggregate("found", zero, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(F.col("t"), (acc["at"] + 1).cast("int"), F.length("t"))))
    changed = F.size("found") > 0
    out = scan(docs, rules, text).withColumn("clean", F.when(changed, clean))
    cols = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.when(changed, F.col("clean")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length("clean")).otherwise(value).cast(docs.schema[c].dataType)
        cols.append(value.alias(c))
    return out.select(*cols)

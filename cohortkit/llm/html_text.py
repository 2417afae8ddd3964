"""Operator 6: main text of web pages by line-block distribution.

Markup is stripped into lines: each block element is a line, and the edge of a sectioning element
leaves empty lines. Elements that by their tag or role are page furniture (menus, headers, adverts ...)
are emptied, as are containers whose class or id says so, unless one holds nine tenths of the page's text;
the heaviest article element is never emptied, others go by their class (comments often are articles). Inside an
article the id of a section counts only if it says comments: renderers make ids from headings. Text lengths are summed over sliding windows of lines; the sums
surge where a run of text begins and dive where it ends. Without an article or main element, the innermost
element around all dense runs is the article's, and every run in it is kept, as is text that stands directly
in an element around it. Around a single dense run that is the nearest element below the body that has other
text too, if there is one. With an article or main element only the runs in such elements count, and the
article's element is not left to look for other text.

A tag ends at the first ``>`` outside a quoted value; a quote counts only right after ``=``, and one that is never
closed ends with its tag. Each character is looked at a bounded number of times.

Defined results: a null, empty or text-free page gives the empty string; unclosed comments, scripts
and tags end with the page; repeated rows give the same text; other columns are carried in ``row``.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

# Elements whose content is no text of the article.
EMPTIED_TAGS = frozenset("""head title script style noscript template nav header footer aside form button select
    option textarea input svg iframe object canvas audio video dialog menu figure-controls""".split())
#: Their content is not markup: it ends only at their own end tag.
RAW_TAGS = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Each of these is a block, so a line.
BLOCK_TAGS = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
#: The edges of these leave empty lines, so a run of text ends there.
SECTION_TAGS = frozenset("article aside body div footer form header main nav section table".split())
#: Parts of class and id names (and roles) of page furniture.
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead footer cookie cookies consent notice
    gdpr popup modal overlay newsletter subscribe subscription signup share sharing social related recommended
    comment comments disqus replies respond widget toolbar pagination pager login search copyright disclaimer
    complementary contentinfo form dialog alert""".split())
#: A name that begins like this says what the page has, not what the element is.
NOT_ITSELF = frozenset("has with no without is not".split())
NEVER_EMPTIED = frozenset(("html", "body", "main"))
#: Only these are furniture by their class or id.
CONTAINER_TAGS = frozenset("div section ul ol dl table article center details fieldset span a li tr td".split())
#: Words for what readers wrote.
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
BLANK = re.compile(r"[\s/]*")
ATTRIBUTE_NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
UNQUOTED = re.compile(r"[^\s>]*")
COMMENT_END = re.compile("--!?>")
#: Class words and ids that end like furniture and are none.
CONTENT_NAMES = frozenset(("long-form", "short-form"))


@dataclass(frozen=True)
class Settings:
    window: int = 3        # lines summed together
    dense: int = 80        # characters of a block of a dense run (or half of the heaviest run's block)


class Tags:
    """The markup of a page, piece by piece."""

    def __init__(self, page: str):
        self.page, self.n = page, len(page)
        self.none_after: dict[str, int] = {}  # a quote that was looked for in vain from here on

    def _quote(self, quote: str, at: int) -> int:
        if at >= self.none_after.get(quote, self.n + 1):
            return -1
        found = self.page.find(quote, at)
        if found < 0:
            self.none_after[quote] = at
        return found

    def attributes(self, at: int) -> tuple[int, dict[str, str], bool]:
        """(where the tag that goes on at ``at`` ends, its attributes, is it closed by itself); the page's end
        if the tag has none."""
        page, n, out = self.page, self.n, {}
        while True:
            at = BLANK.match(page, at).end()
            if at >= n:
                return n, out, False
            if page[at] == ">":
                return at + 1, out, page[at - 1] == "/"
            m = ATTRIBUTE_NAME.match(page, at)
            name, at, value = m[0].lower(), m.end(), ""
            if m := EQUALS.match(page, at):
                at = m.end()
                quote = page[at:at + 1]
                end = self._quote(quote, at + 1) if quote in ("'", '"') else -2
                if end >= 0:
                    value, at = page[at + 1:end], end + 1
                elif end == -1:
                    end = page.find(">", at)
                    end = n if end < 0 else end
                    value, at = page[at + 1:end], end
                else:
                    m = UNQUOTED.match(page, at)
                    value, at = m[0], m.end()
            out.setdefault(name, value)

    def next(self, at: int) -> tuple[int, int, str, bool, dict[str, str], bool] | None:
        """(begin, end, tag or empty, is it an end tag, attributes, closed by itself) of the next markup."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            after = page[at + 1:at + 2]
            if after.isascii() and after.isalpha():
                m = NAME.match(page, at + 1)
                end, attributes, closed = self.attributes(m.end())
                return at, end, m[0].lower(), False, attributes, closed
            if after == "/" and (m := NAME.match(page, at + 2)):
                return at, self.attributes(m.end())[0], m[0].lower(), True, {}, False
            if page.startswith("<!--", at):
                empty = next((len(x) for x in ("<!-->", "<!--->") if page.startswith(x, at)), 0)
                m = None if empty else COMMENT_END.search(page, at + 4)
                return at, at + empty if empty else m.end() if m else self.n, "", False, {}, False
            if after and after in "!?/":
                end = page.find(">", at)
                return at, self.n if end < 0 else end + 1, "", False, {}, False
            at += 1
        return None

    def raw_end(self, tag: str, at: int) -> int:
        """Where an element whose content is no markup ends."""
        m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(self.page, at)
        return self.attributes(m.end())[0] if m else self.n


def _is_furniture(tag: str, attributes: dict[str, str]) -> bool:
    """Is the element page furniture, whatever it holds?"""
    if tag in EMPTIED_TAGS:
        return True
    if tag in NEVER_EMPTIED or not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return _furniture_word(attributes.get("role", "")) is not None


def _furniture_word(value: str) -> str | None:
    """The word of a class, id or role that says furniture."""
    for word in value.lower().split():
        if word.replace("_", "-") in CONTENT_NAMES:
            continue
        parts = [p for p in re.split(r"[^a-z]+", word) if p]
        if parts and parts[0] not in NOT_ITSELF:
            for part in (parts[0], parts[-1]):
                if part in FURNITURE:
                    return part
    return None


def _is_suspect(tag: str, attributes: dict[str, str], inside: int) -> bool:
    """Does the class or id say that the element is furniture?"""
    if tag not in CONTAINER_TAGS or not attributes:
        return False
    if _furniture_word(attributes.get("class", "")):
        return True
    word = _furniture_word(attributes.get("id", ""))
    return word is not None and (tag != "section" or not inside or word in COMMENT_WORDS)


class Line(NamedTuple):
    """A line, and the innermost elements around it by their numbers in page order (0: the page)."""

    text: str
    section: int     # sectioning element
    inside: int      # article or main element
    suspect: int     # element that is furniture by class or id
    article: int     # article element


class Elements:
    """The elements that matter, by number: what stands around each, and the last number inside it."""

    def __init__(self):
        self.count = 0
        self.section = {0: 0}             # sectioning element -> the one around it
        self.suspect: dict[int, int] = {}
        self.article: dict[int, int] = {}
        self.last: dict[int, int] = {}

    def holds(self, outer: int, x: int) -> bool:
        return outer <= x <= self.last.get(outer, self.count)

    def around(self, a: int, b: int) -> int:
        """The innermost sectioning element around ``a`` that holds ``b`` (after it) too."""
        while not self.holds(a, b):
            a = self.section[a]
        return a


def lines_of(page: str, gap_lines: int) -> tuple[list[Line], Elements]:
    """The lines of a page; ``gap_lines`` empty ones where a sectioning element begins or ends."""
    lines: list[Line] = []
    pending: list[str] = []
    stack: list[tuple] = []  # tag, its number, and what held outside of the element
    opened: dict[str, int] = {}
    state = (False, 0, 0, 0, 0)  # emptied, and the last four of a line
    elements, tags = Elements(), Tags(page)
    at, n = 0, len(page)

    def end_line(gap: bool) -> None:
        text = " ".join(html.unescape("".join(pending)).split())
        pending.clear()
        if text:
            lines.append(Line(text, *state[1:]))
        if gap:
            lines.extend([Line("", *state[1:])] * gap_lines)

    while at < n:
        m = tags.next(at)
        if not state[0]:
            pending.append(page[at:m[0] if m else n])
        if m is None:
            break
        _, at, tag, is_end, attributes, closed = m
        if not tag:
            continue
        if is_end:
            if not opened.get(tag):
                if tag in BLOCK_TAGS and not state[0]:
                    end_line(False)
                continue
            if tag in BLOCK_TAGS and not state[0]:
                end_line(tag in SECTION_TAGS)
            while stack:
                name, number, outside = stack.pop()
                opened[name] -= 1
                elements.last[number] = elements.count
                if outside[3] != state[3] and name not in BLOCK_TAGS and not state[0]:
                    end_line(False)
                state = outside
                if name == tag:
                    break
            if tag in SECTION_TAGS and not state[0]:
                end_line(True)
            continue
        if tag in BLOCK_TAGS and not state[0]:
            end_line(tag in SECTION_TAGS)
        if tag in VOID_TAGS or closed and tag not in BLOCK_TAGS and tag not in RAW_TAGS:
            continue
        if tag in RAW_TAGS:
            at = tags.raw_end(tag, at)
            continue
        elements.count += 1
        number = elements.count
        stack.append((tag, number, state))
        opened[tag] = opened.get(tag, 0) + 1
        emptied, section, inside, suspect, article = state
        if not emptied and _is_furniture(tag, attributes):
            emptied = True
        elif not emptied and _is_suspect(tag, attributes, inside):
            elements.suspect[number], suspect = suspect, number
        if (emptied, suspect) != (state[0], state[3]) and not state[0] and tag not in BLOCK_TAGS:
            end_line(False)
        if tag in SECTION_TAGS:
            if tag != "body":
                elements.section[number], section = section, number
            if tag in ("article", "main"):
                inside = number
            if tag == "article":
                elements.article[number], article = article, number
        state = (emptied, section, inside, suspect, article)
    if not state[0]:
        end_line(False)
    return (_without_furniture(lines, elements) if elements.suspect else lines), elements


def _summed(parents: dict[int, int], own: Counter) -> Counter:
    """What each element holds with all in it: an element comes before those in it."""
    for x in sorted(parents, reverse=True):
        own[parents[x]] += own[x]
    return own


def _without_furniture(lines: list[Line], elements: Elements) -> list[Line]:
    """Empty the lines in elements that are furniture by their class or id, but for the heaviest article and an
    element with more than nine tenths of the page's text."""
    held, articles, whole = Counter(), Counter(), 0
    for line in lines:
        whole += len(line.text)
        held[line.suspect] += len(line.text)
        articles[line.article] += len(line.text)
    held, articles = _summed(elements.suspect, held), _summed(elements.article, articles)
    heaviest = max(elements.article, key=lambda x: (articles[x], -x), default=None)
    gone = {0: False}
    for x, outer in sorted(elements.suspect.items()):
        own = x != heaviest if x in elements.article else 10 * held[x] <= 9 * whole
        gone[x] = own or gone[outer]
    return [line._replace(text="") if gone[line.suspect] else line for line in lines]


def runs_of(sizes: list[int], window: int) -> list[tuple[int, int]]:
    """[surge, dive) of each run of text: it begins at the line where the sums of ``window`` sizes rise
    from zero, and ends where the sum of the next ``window`` sizes is zero again."""
    n, runs, begun = len(sizes), [], None
    ahead = sum(sizes[:window])
    for i, size in enumerate(sizes):
        if begun is None and size:
            begun = i
        elif begun is not None and not ahead:
            runs.append((begun, i))
            begun = None
        ahead += (sizes[i + window] if i + window < n else 0) - size
    return runs if begun is None else [*runs, (begun, n)]


def main_text(page: str | None, settings: Settings = Settings()) -> str:
    """The article's blocks in page order, joined by one space."""
    if not page:
        return ""
    lines, elements = lines_of(page, settings.window)
    sizes = [len(line.text) for line in lines]
    runs = runs_of(sizes, settings.window)
    if not runs:
        return ""
    # With an article or main element only the runs in such elements count.
    runs = [r for r in runs if lines[r[0]].inside] or runs

    def weight(run):
        a, b = run
        return max(sum(sizes[i:i + settings.window]) for i in range(a, b))
    # The blocks of lines tell which runs are the article's.
    best = max(runs, key=lambda r: (sum(sizes[r[0]:r[1]]), weight(r)))
    least = min(settings.dense, weight(best) / 2)
    dense = [lines[r[0]].section for r in runs if weight(r) >= least]
    home = elements.around(min(dense), max(dense))
    if len(dense) == 1:
        # The nearest element around it with other text, but not beyond the article's own element, or the body.
        others = [lines[a].section for a, b in runs if (a, b) != best]
        before = max((x for x in others if x < home), default=-1)
        after = min((x for x in others if x > elements.last.get(home, elements.count)), default=elements.count + 1)
        outer, top = home, lines[best[0]].inside
        while outer != top and elements.section[outer]:
            outer = elements.section[outer]
            if before >= outer or elements.holds(outer, after):
                home = outer
                break
    kept = []
    for a, b in runs:
        section = lines[a].section
        if elements.holds(home, section) or elements.holds(section, home):
            kept += [line.text for line in lines[a:b] if line.text]
    return " ".join(kept)


def extract(pages: DataFrame, content: str = "html", settings: Settings = Settings()) -> DataFrame:
    """All columns of ``pages`` in the struct ``row``, and ``text``, the main text of the page."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                        F.col(f"`{content}`").alias("page"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, settings) for p in batch.column("page").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, schema)

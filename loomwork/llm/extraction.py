"""Main text of web pages by two passes of rules over their blocks."""

from __future__ import annotations

import bisect
import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .texts import map_batches

# Names of HTML.
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video select textarea button form".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())  # their content isn't markup
SITE = frozenset("nav header footer aside menu dialog".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = HIDDEN | SITE | MAIN | HEADINGS | frozenset(
    "address blockquote body br caption center dd details div dl dt fieldset figcaption figure hgroup hr html legend li"
    " ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Words in class, id and role that site furniture goes by.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist"
    " consent contentinfo cookie cookies copyright disqus footer gdpr header login masthead menu menubar modal nav navbar"
    " navigation newsletter notice overlay pager pagination popup promo promoted promotion related replies reply reviews search"
    " share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
MAIN_NAMES = frozenset("article main".split())
# Frequent words of the corpus's languages.
STOP_WORDS = frozenset(
    "a an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on or"
    " our she so than that the their them they this to was we were what when which who will with would you your"
    " als am auf auch aus bei bin das dass dem den der des die durch ein eine einem einen einer es für hat ich im ist"
    " mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war wenn werden wie wir zu zum zur"
    " au aux avec ce ces cette dans de du elle en est et être il ils je la le les leur lui mais ne nous on ou par pas"
    " plus pour qu que qui sa se ses son sont sur un une vous"
    " al como con del el ella ellos era esta este fue ha hay las lo los más me muy nos o para pero por si sin sobre su"
    " sus también te tiene todo una unos y ya".split()
)

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/><]*)")
_SPECIAL = re.compile(r">|=\s*[\"']")  # a quote that follows no equals sign is part of a name
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # of postComments: post, Comments
_HIDDEN_ATTRIBUTE = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    """Words of a short block, and densities of stop words and of links, in per cent.

    A block is bad if it lies in site furniture, or more than ``max_links`` of
    its characters are link text.  It is good if it has ``long_words`` or more
    and ``min_stops`` of them are stop words; in the page's own article or main
    part ``main_words`` are enough.  What is neither is ambiguous: a long one with
    few stop words is bad, but ambiguous too in the main part; a short one takes
    the label of its nearest decided neighbours, and in a main part where nothing
    is decided it is good.
    """

    long_words: int = 10
    min_stops: int = 15
    main_words: int = 4
    max_links: int = 40


@dataclass
class Block:
    text: str
    link_chars: int
    furniture: bool
    main: bool
    heading: bool
    label: str = ""  # good, bad or short


def _kind(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is hidden, site furniture, or the main part."""
    names = [{w.lower() for w in _PARTS.findall(n)} for m in _NAMES.findall(attributes) for n in m.split()] if "=" in attributes else []
    hidden = tag in HIDDEN or bool(attributes and _HIDDEN_ATTRIBUTE.search(attributes))
    # in one compound name, such as article-comments, furniture wins
    main = tag in MAIN or any(n & MAIN_NAMES and not n & FURNITURE for n in names)
    furniture = tag in SITE or (tag not in ("html", "body") and not main and any(n & FURNITURE for n in names))
    return hidden, furniture, main


class _Scanner:
    """Tags of a page, in time proportional to its length whatever it holds.

    Where no tag can end, because quotes or the page do not, that is kept, so
    nothing is looked through twice for the same end.
    """

    def __init__(self, page: str):
        self.page = page
        self.dead: list[tuple[int, int]] = []  # sorted spans; a tag that reaches one outside of quotes has no end
        self.last_end = page.rfind(">")

    def _end(self, at: int) -> int:
        """Where the tag that is open at ``at`` ends; -1 if it does not."""
        seen: list[tuple[int, int]] = []
        while at <= self.last_end:
            i = bisect.bisect_right(self.dead, (at, len(self.page))) - 1
            if i >= 0 and at <= self.dead[i][1]:
                break
            match = _SPECIAL.search(self.page, at)
            if match is None:
                seen.append((at, len(self.page)))
                break
            if match[0] == ">":
                return match.start()
            seen.append((at, match.start()))
            close = self.page.find(match[0][-1], match.end())
            if close < 0:
                break
            at = close + 1
        for span in seen:
            bisect.insort(self.dead, span)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Of the next tag or comment from ``at`` on: begin, end, slash, name (empty for comments), attributes."""
        page = self.page
        while True:
            begin = page.find("<", at)
            if begin < 0:
                return None
            if page.startswith("<!--", begin):
                end = page.find("-->", begin + 4)
                return begin, len(page) if end < 0 else end + 3, "", "", ""
            if page.startswith(("<!", "<?"), begin) and begin < self.last_end:
                return begin, page.index(">", begin) + 1, "", "", ""
            if begin > self.last_end:
                return None
            name = _NAME.match(page, begin + 1)
            end = self._end(name.end()) if name else -1
            if end >= 0:
                return begin, end + 1, name[1], name[2].lower(), page[name.end() : end]
            at = begin + 1


def blocks_of(page: str) -> list[Block]:
    """Runs of text between tags of block elements, with what they lie in.

    End tags that close nothing are left out of account; one that does closes
    everything opened since.  An element without an end goes on to its parent's.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, hidden, furniture, main
    open_: Counter[str] = Counter()  # how often each tag is on the stack
    hidden = furniture = main = 0
    links, link_from = 0, -1
    texts: list[str] = []
    link_chars = 0

    def close_block() -> None:
        nonlocal texts, link_chars
        text = " ".join(entities.unescape("".join(texts)).split())
        if text:
            heading = any(t in HEADINGS for t, *_ in stack[-3:])
            blocks.append(Block(text, link_chars, furniture > 0 and not (heading and main), main > 0, heading))
        texts, link_chars = [], 0

    def add(text: str) -> None:
        nonlocal link_chars
        if text and not hidden:
            texts.append(text)
            if links:
                link_chars += len("".join(text.split()))

    scanner, at = _Scanner(page), 0
    while True:
        found = scanner.next(at)
        if found is None:
            add(page[at:])
            break
        begin, after, end, tag, attributes = found
        add(page[at:begin])
        at = after
        if not tag:
            continue
        if tag == "a":
            links = max(0, links - 1) if end else 1
            continue
        if tag not in BLOCKS:
            if not end and tag in RAW:
                at = _after_raw(page, tag, at)
            continue
        close_block()
        if tag in VOID:
            continue
        if not end:
            if tag == "p":  # a paragraph ends where the next one begins
                while stack and stack[-1][0] == "p":
                    name, h, f, m = stack.pop()
                    open_[name] -= 1
                    hidden, furniture, main = hidden - h, furniture - f, main - m
            kind = _kind(tag, attributes)
            stack.append((tag, *kind))
            open_[tag] += 1
            hidden, furniture, main = hidden + kind[0], furniture + kind[1], main + kind[2]
            if tag in RAW:
                at = _after_raw(page, tag, at)
        elif open_[tag]:
            links = 0
            while True:
                name, h, f, m = stack.pop()
                open_[name] -= 1
                hidden, furniture, main = hidden - h, furniture - f, main - m
                if name == tag:
                    break
    close_block()
    return blocks


def _after_raw(page: str, tag: str, at: int) -> int:
    """Where the end tag of an element without markup inside begins."""
    match = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
    return match.start() if match else len(page)


def classify(blocks: list[Block], rules: Rules) -> None:
    """First pass: label what can be decided by itself; second: let neighbours decide the rest."""
    for b in blocks:
        words = [w.lower() for w in _WORD.findall(b.text)]
        n = len(b.text.split())
        chars = len(b.text) - b.text.count(" ")
        if b.furniture or 100 * b.link_chars > rules.max_links * chars:
            b.label = "bad"
        elif b.heading or n < (rules.main_words if b.main else rules.long_words):
            b.label = "short"
        else:
            stops = sum(w in STOP_WORDS for w in words)
            many = 100 * stops >= rules.min_stops * max(1, len(words))
            b.label = "good" if many else "short" if b.main else "bad"
    # nearest decided block before and after each; furniture is no neighbour of the main part
    decided = [b.label for b in blocks]
    before = _nearest(blocks, decided, range(len(blocks)))
    after = _nearest(blocks, decided, range(len(blocks) - 1, -1, -1))
    for i, b in enumerate(blocks):
        if decided[i] == "short":
            (left, l_at), (right, r_at) = before[i], after[i]
            if left == right:
                b.label = left or ("good" if b.main else "bad")
            elif not left or not right:
                b.label = left or right
            elif b.heading:  # a heading belongs to what follows it
                b.label = right
            else:
                b.label = left if i - l_at < r_at - i else right if r_at - i < i - l_at else "good"


def _nearest(blocks: list[Block], decided: list[str], order: range) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = [("", -1)] * len(blocks)
    last: dict[bool, tuple[str, int]] = {True: ("", -1), False: ("", -1)}
    for i in order:
        b = blocks[i]
        out[i] = last[b.main]
        if decided[i] != "short":
            for inside in (True, False):
                if not inside or b.main and not b.furniture:
                    last[inside] = (decided[i], i)
    return out


def main_text(page: str, rules: Rules = Rules()) -> str:
    """The good blocks in page order, one space apart."""
    blocks = blocks_of(page)
    classify(blocks, rules)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: Rules = Rules()
) -> DataFrame:
    """``id_col, url_col, text, n_chars`` for every row.

    Null or empty pages have empty text; a page without good blocks as well.
    Repeated rows get equal results; other columns are not looked at.  Pages
    are read one at a time, whole.
    """
    rows = pages.select(id_col, url_col, html_col)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h or "", rules) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [id_col, url_col, "text", "n_chars"],
        )

    fields = [rows.schema[0], rows.schema[1], StructField("text", StringType()), StructField("n_chars", LongType())]
    return map_batches(rows, of, StructType(fields))

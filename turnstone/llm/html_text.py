"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. In the first pass a block is
decided by what it holds and where it stands: text in a page region that is
not the article (menus, headers, footers, sidebars, notices, adverts, forms,
comments) or mostly made of links is boilerplate; a long block with a good
share of stop words is text. Everything else - short blocks, headings, lists of
names, shouting - stays undecided, and in the second pass takes the label of
its nearest decided neighbour, text winning a tie. Blocks inside an article or
main element look at neighbours inside it only, and are text if there is no
decided one.

Stop words are known for four languages. If they decide no block of a page to
be text, its long blocks that are not mostly links are text by their length
alone; scripts written without spaces count two code points as a word. A page
that has no text even so keeps its undecided blocks, which then have nothing
to inherit but the label of a menu.

A quoted attribute value may hold ``>``. A quote that never closes, or that
closes in the middle of a word, opens no value: the tag ends at the next
``>``. The work is linear in the page's length.

Classes and ids of html, body, main and article name no region, nor does what
follows no-, has- or with- in a class. An element with the class or id of a
region and a form are wrappers, not regions, if they hold the main element, all
articles of the page and no smaller part of its long text blocks than is
outside, or most of these blocks while no article outside has one; their blocks
are judged like others. Adverts, consent and comments need the main element or
the articles, comments the main element. Hidden parts, scripts, styles,
templates, frames, drawings and the head are never text.

Character references are decoded, white space inside a block becomes one space,
and the kept blocks are joined by one space in page order. Nothing else is
dropped or cut.

Defined cases: a null or empty page gives an empty text; unclosed tags close at
the end of the page; repeated rows give equal texts. Other columns than
page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_WORDS = 12
STOP_SHARE = 0.2
LINK_SHARE = 0.5

OPEN = re.compile(r"<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)|<[!?/]")
TAG_END = re.compile(r""">|=\s*+(["'])""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORD = re.compile(r"[^\W\d_]+")
#: letters of scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Han
UNSPACED = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]")

BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section select summary table "
            "tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template iframe svg head".split())
REGION = set("nav footer aside button select menu dialog".split())
INSIDE = set("article main".split())
#: what may follow the closing quote of a value
QUOTE_ENDS = ("", " ", "\t", "\n", "\r", "\f", "/", ">")
#: an open element of these is closed by the next one of the group
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|side-?bar|comments?|respond|cookies?|consent|notices?|gdpr|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"signup|login|popup|modal|overlay|widget|pagination|pager|toolbar|masthead|disclaimer|copyright|legal|tags)(?:$|[\s_-])", re.I)
HEADER = re.compile(r"(?:^|[_-])header(?:$|[_-])")
#: what follows these in a class says what the page has or lacks
MODIFIER = re.compile(r"(?:^|[_-])(?:no|has|have|with|without)[_-]")
#: never a wrapper for its long blocks alone
STRICT = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|sponsor\w*|cookies?|consent|gdpr|(comments?|respond))(?:$|[_-])")
ROLE = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar".split())

#: stop words (fixed values)
STOP = frozenset((
    "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all "
    "were when we there can an your which their said if do will each about how up out them then she many some so "
    "der die das und in zu den ist von mit sich des auf für nicht ein eine als auch es an werden aus er hat dass sie nach "
    "wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch dem im "
    "de la le les et des en un une du est que pour qui dans sur pas au par ce plus il ne se son avec sont ou aux elle "
    "el los las y del que en por con para una su al lo como más pero sus le ya o este sí porque esta entre cuando").split())


class _Block:
    __slots__ = ("parts", "links", "boiler", "wraps", "home")

    def __init__(self, boiler, wraps, home):
        self.parts, self.links, self.boiler, self.wraps, self.home = [], 0, boiler, wraps, home


class _Wrap:
    """A region by class, id or form, which may turn out to hold the page's text."""
    __slots__ = ("strict", "comments", "main", "articles", "long", "long_home")

    def __init__(self, strict, comments):
        self.strict, self.comments = strict, comments
        self.main, self.articles, self.long, self.long_home = False, 0, 0, 0


def _names(value: str) -> list[str]:
    """The classes or ids of an attribute, each up to its first modifier."""
    return [MODIFIER.split(x)[0] for x in value.split()]


def _region(name: str, attributes: str, inside: bool) -> bool | _Wrap | None:
    """True for a region, a wrap for what may be one, else None."""
    if name in ("html", "body"):
        return None
    if name in REGION or (name == "header" and not inside):
        return True
    named, wrap = [], name == "form"
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").strip().lower()
        if key in ("class", "id"):
            if name not in INSIDE:
                named += [x for x in _names(value) if NAMED.search(x) or (not inside and HEADER.search(x))]
        elif key == "role":
            if value in ROLE:
                return True
            wrap = wrap or value == "form"
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    if not named and not wrap:
        return None
    strict = [m for m in map(STRICT.search, named) if m]
    return _Wrap(bool(strict), any(m[1] for m in strict))


def _tags(page: str):
    """Tags and comments in order: start, end, whether it closes, name in lower case (empty for none), attributes."""
    last = page.rfind(">")  # what opens after it is no tag
    at, quotes = 0, True
    while m := OPEN.search(page, at):
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            yield m.start(), at, False, "", ""
            continue
        if at > last:
            continue
        end = page.find(">", at)
        if m[2] and quotes:
            seek = at
            while t := TAG_END.search(page, seek):
                if not t[1]:
                    end = t.start()
                    break
                close = page.find(t[1], t.end())
                if close < 0 or page[close + 1:close + 2] not in QUOTE_ENDS:
                    end = page.find(">", t.end())
                    break
                seek = close + 1
            else:  # the values run to the end of the page: from here on quotes are text like other
                quotes = False
        if end < 0:
            continue
        attributes = page[at:end] if m[2] else ""
        at = end + 1
        skip = yield m.start(), at, bool(m[1]), (m[2] or "").lower(), attributes
        if skip is not None:
            at = skip
            yield


def blocks(page: str) -> tuple[list[_Block], int]:
    """The page's blocks in order, and the number of its articles outside regions."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, tuple, int]] = []  # name, region, wraps, article it lies in
    counted = 0
    links = articles = at = 0
    block = None

    def text(t):
        nonlocal block
        if not t:
            return
        if block is None:
            top = stack[-1] if stack else ("", False, (), 0)
            block = _Block(*top[1:])
            out.append(block)
        t = html.unescape(t) if "&" in t else t
        block.parts.append(t)
        if links:
            block.links += len(t)

    last = page.rfind(">") + 1
    tags = _tags(page)
    for begin, end, closing, name, attributes in tags:
        text(page[at:begin])
        at = end
        if not name:
            continue
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if name in RAW and not closing:
            if attributes.endswith("/"):
                continue
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at, last)
            if name == "head" and not stop:
                stop = re.compile(r"(?=<body\b)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            tags.send(at)
            continue
        if name == "a":
            links = 0 if closing else 1
        if name in BLOCK:
            block = None
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                before = stack[-1][1:3]
                if any(x[0] in BLOCK for x in stack[depth:]):
                    block = None
                del stack[depth:]
                if before != (stack[-1][1:3] if stack else (False, ())):
                    block = None
        elif name not in VOID and not attributes.endswith("/"):
            closes = SELF_CLOSING.get(name)
            if closes and stack and stack[-1][0] in closes:
                stack.pop()
            _, region, wraps, home = stack[-1] if stack else ("", False, (), 0)
            inside = home > 0
            if name in INSIDE:
                articles += 1
                home = articles if not inside else home
            found = None if region else _region(name, attributes, inside)
            if name in INSIDE and not region and found is not True:
                counted += not inside
                for x in wraps:
                    x.main = x.main or name == "main"
                    x.articles += not inside
            if found is not None:
                region, wraps = (True, wraps) if found is True else (False, (*wraps, found))
            if name in BLOCK or found is not None:
                block = None
            stack.append((name, region, wraps, home))
    text(page[at:])
    return out, counted


def _is_boilerplate(wrap: _Wrap, articles: int, long: int, long_home: int) -> bool:
    """Whether a wrap is a region, given the page's articles, long text blocks and those of them in articles."""
    outside = long - wrap.long
    if wrap.main:
        return False
    if wrap.articles and wrap.articles == articles and not wrap.comments:
        return wrap.long < outside
    return wrap.strict or wrap.long <= outside or long_home > wrap.long_home


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found, articles = blocks(page)
    judged: list[tuple[_Block, str, bool | None]] = []
    unknown: list[int] = []  # long blocks without enough stop words
    for b in found:
        t = " ".join("".join(b.parts).split())
        if not t:
            continue
        label = None
        if b.boiler or b.links > LINK_SHARE * len(t):
            label = False
        else:
            words = [w.lower() for w in WORD.findall(t)]
            if len(words) >= LONG_WORDS and sum(w in STOP for w in words) >= STOP_SHARE * len(words):
                label = True
            elif max(len(words), len(UNSPACED.findall(t)) // 2) >= LONG_WORDS:
                unknown.append(len(judged))
        judged.append((b, t, label))
    if not any(label for _, _, label in judged):
        for i in unknown:
            judged[i] = (*judged[i][:2], True)
    long = long_home = 0
    for b, _, label in judged:
        if label:
            long, long_home = long + 1, long_home + (b.home > 0)
            for x in b.wraps:
                x.long, x.long_home = x.long + 1, x.long_home + (b.home > 0)
    regions: dict[int, bool] = {}  # by identity; the blocks keep the wraps alive
    for b, _, _ in judged:
        for x in b.wraps:
            if id(x) not in regions:
                regions[id(x)] = _is_boilerplate(x, articles, long, long_home)
    kept: list[tuple[str, bool | None, int]] = [  # text, label (None: undecided), article
        (t, False if any(regions[id(x)] for x in b.wraps) else label, b.home) for b, t, label in judged]
    if not any(label for _, label, _ in kept):
        return " ".join(t for t, label, _ in kept if label is None)
    n = len(kept)
    before, after = _nearest(kept, range(n)), _nearest(kept, range(n - 1, -1, -1))
    out = []
    for i, (t, label, _) in enumerate(kept):
        if label is None:
            (d0, l0), (d1, l1) = before[i], after[i]
            label = l0 if d0 < d1 else l1 if d1 < d0 else (l0 or l1)
        if label:
            out.append(t)
    return " ".join(out)


def _nearest(kept, order):
    """For each block, distance to and label of the last decided block of its article on one side."""
    found = [(1 << 60, True)] * len(kept)
    last: dict[int, tuple[int, bool]] = {}
    for i in order:
        _, label, home = kept[i]
        if home in last:
            found[i] = (abs(i - last[home][0]), last[home][1])
        if label is not None and (label or not home):
            last[home] = (i, label)
    return found


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in column], pa.string())

    text = F.arrow_udf(run, T.StringType())(pages["html"])
    return pages.select(pages["page_id"], pages["url"], text.alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))

"""Main text of HTML pages by two-pass block rules (operator 5).

A page is read once, tag by tag, into blocks: runs of text between
block-level tags, with their length, words, stop words, link characters and
containers.  Scripts, styles, forms' controls and the head hold no text;
menus, page headers, footers, sidebars, notices, adverts, forms and comments
are recognised by element, role, class or id.  Of a class or id only whole
tokens count: a hint word, alone or with words of place and form
(``site-footer``, ``cookie-notice``, ``sidebar-1``), not any compound
(``has-sidebar``, ``legal-news``); an ``article`` or ``main`` inside a plain
element with such a token is not part of it.  A form that holds an article, the
page's title, header, menu or footer wraps the page and is no container; an
``aside`` with a quote's class inside an article is the article's own.  Formulas
(``math``) are text.

Pass one decides a block from itself: boilerplate containers, many link
characters or a copyright line are bad; long blocks with few link characters, and
middle-sized ones with enough stop words, are good; other short ones stay
open, and so do linked headings of an article and its paragraphs that are not all
link.  Pass two labels each open block like its nearest decided neighbours; if they
differ, the nearer one, then the one in the same container, then the one before
(of a heading: the one after) decides.  The bounds of an article (``article``, ``main``) count as good
neighbours, so a page of short lines keeps them.

Edge cases: a null or empty page, or one without good blocks, gives the empty
string; unclosed and truncated markup is read as far as it goes (an unclosed
tag at the end is dropped; a head or title that is not closed ends at the
first element or text that only a body holds); rows with null or repeated ids are extracted each;
an empty table gives an empty result.  Pages are read whole and further
columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.quality_rules import ALL_WORDS

STOP_WORDS = frozenset(ALL_WORDS)
LONG, MIDDLE = 200, 70                # characters
MAX_LINKS, MIN_STOP = 0.25, 0.15      # shares of characters / words
MOST_LINKS = 0.9                      # of an article's own paragraph

# fixed values: elements of HTML
_SKIP = frozenset("script style head title noscript template svg annotation annotation-xml iframe object embed audio "
                  "video canvas select button textarea input datalist".split())
_HEAD = frozenset("head title".split())
_IN_HEAD = frozenset("html head title base basefont bgsound link meta noscript script style template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                   "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_BAD = frozenset("nav footer aside menu dialog".split())     # forms: see _WRAPPED
_MAIN = frozenset("article main".split())
_PLAIN = frozenset("div span center font table tbody tr td".split())     # hold an article as well as anything else
_HINT = re.compile(
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|overlay|notices?|"
    r"sidebar\d*|side|nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|topbar|toolbar|comments?|disqus|"
    r"repl(?:y|ies)|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|pagination|pager|"
    r"widget|copyright|legal|disclaimer|skip", re.I)
# words of place and form that may stand before and after a hint word in one token
_BEFORE = frozenset("site page main global top bottom left right primary secondary sub mobile desktop sticky fixed "
                    "post entry article blog user js id the google div".split())
_AFTER = frozenset("container wrapper wrap outer inner box bar list links link item items section area block blocks button "
                   "buttons btn icon icons form field panel col column row slot unit group widget widgets header heading "
                   "title body content contents text meta author thread top bottom left right primary secondary main "
                   "posts articles stories media to".split())
# topics as well as parts of a page: "legal-content" and "page-search" may be the page itself
_TOPIC = frozenset("search legal social related share sharing notice notices copyright disclaimer login signup side "
                   "subscribe promo banner".split())
_OWN = frozenset("page main body content contents text title".split())
_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
# a quote opens a value only right behind "="; elsewhere it is a character like others
_TAG = re.compile(r"""<!--.*?(?:-->|$)|<(?:(/?)([A-Za-z][A-Za-z0-9:-]*+)"""
                  r"""((?:[^<>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+(?=>)|[^<>]*+)>|[!?][^>]*>)""", re.S)
_ATTR = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_CUT = re.compile(r"<(?:[A-Za-z/!?][^>]*)?$")
_RAW = frozenset("script style textarea".split())
_WRAPPED = frozenset("article main h1 header nav footer".split())      # in a form: it wraps the page
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADING | frozenset("p blockquote figcaption dd".split())
_QUOTE = re.compile(r"(?:^|[-_])(?:pull[-_]?)?quotes?(?:$|[-_])", re.I)
_OWNED = re.compile(r"[^\w©]*(?:[Cc]opyright\s*)?©\s*(?:[Cc]opyright\s*)?(?:\d{4}|[A-Z])")
_DATED = re.compile(r"©\D{0,40}(?:19|20)\d\d|(?:19|20)\d\d\s*©")


@dataclass
class Block:
    text: str
    links: int                        # characters inside links
    container: int                    # number of the enclosing article or section
    inside: bool                      # within an article or main element
    bad: bool                         # within a boilerplate container
    label: str = ""
    tag: str = ""                     # innermost block element
    form: int = 0                     # number of the enclosing form


@lru_cache(1 << 14)
def _hinted(token: str) -> bool:
    """Whether a class token or an id names a boilerplate container."""
    parts = [p for p in re.split(r"[-_]+", token.lower()) if p]
    hits = [k for k, p in enumerate(parts) if _HINT.fullmatch(p)]
    if not hits:
        return False
    rest = [p for k, p in enumerate(parts) if k not in hits]
    if _OWN.intersection(rest) and all(parts[k] in _TOPIC for k in hits):
        return False
    return (all(p in _BEFORE for p in parts[:hits[0]])
            and all(p in _BEFORE or p in _AFTER or p[0].isdigit() or k in hits
                    for k, p in enumerate(parts[:hits[-1]]) if k > hits[0])
            and all(p in _AFTER or p[0].isdigit() for p in parts[hits[-1] + 1:]))


def _named(attrs: str) -> bool:
    """Whether a class token or the id of the attributes is a hint."""
    return "=" in attrs and any(_hinted(token) for name, a, b, c in _ATTR.findall(attrs)
                                if name.lower() in ("class", "id") for token in (a or b or c).split())


def _boilerplate(tag: str, attrs: str, in_main: bool) -> str:
    """``hard`` for a boilerplate element or role, ``hint`` for a plain element
    with a hint token, else the empty string."""
    if tag == "aside" and in_main and any(name.lower() == "class" and any(map(_QUOTE.search, (a or b or c).split()))
                                          for name, a, b, c in _ATTR.findall(attrs)):
        return ""                                 # a pull quote is the article's own text
    if tag in _BAD or (tag == "header" and not in_main):
        return "hard"
    if "=" not in attrs or tag in ("html", "body", "article", "main"):
        return ""
    for name, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if (name == "role" and value in _ROLE) or (name == "aria-hidden" and value == "true"):
            return "hard"
    if _named(attrs):
        return "hint" if tag in _PLAIN else "hard"
    return ""


def blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page in page order."""
    out: list[Block] = []
    # open elements: name, boilerplate, main, hints outside an article that are put aside
    stack: list[tuple[str, str, bool, int]] = []
    hard = hints = main = links = skipping = 0
    container = containers = 0
    form = forms = 0
    wrappers: set[int] = set()        # forms around the page itself
    opened: Counter[str] = Counter()  # open elements by name
    shapes: list[str] = []            # open block elements
    ends: dict[str, int] = {}         # next end tag of an element without text, len(page): none
    held: list[str] = []
    linked: list[str] = []
    at = 0

    def close() -> None:
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            if text:
                inside = " ".join(_html.unescape("".join(linked)).split()) if linked else ""
                out.append(Block(text, len(inside), container, main > 0, hard + hints > 0,
                                 tag=shapes[-1] if shapes else "", form=form))
            held.clear()
            linked.clear()

    def ended(name: str) -> bool:
        """Whether an end tag of the name follows."""
        if ends.get(name, -1) < pos:
            m = re.compile(rf"</{name}\b", re.I).search(page, pos)
            ends[name] = m.start() if m else len(page)
        return ends[name] < len(page)

    def text_to(end: int) -> None:
        if skipping and stack[-1][0] == "head" and page[at:end].strip():
            leave(len(stack) - 1)                 # text ends an open head
        if not skipping and end > at:
            part = page[at:end]
            held.append(part)
            if links:
                linked.append(part)

    def leave(k: int) -> None:
        nonlocal hard, hints, main, links, skipping, container, form
        while len(stack) > k:
            name, was_bad, was_main, aside = stack.pop()
            opened[name] -= 1
            if name in _BLOCK:
                shapes.pop()
            if name == "form":
                form = 0
            hard -= was_bad == "hard"
            hints += aside - (was_bad == "hint")
            main -= was_main
            links -= name == "a"
            skipping -= name in _SKIP
            if was_main or name == "section":
                container = 0

    page = _CUT.sub("", page)
    pos = 0
    while True:
        m = _TAG.search(page, pos)
        if m is None:
            break
        if skipping and stack and stack[-1][0] in _RAW:
            # raw text: only its own end tag counts
            end = re.compile(rf"</{stack[-1][0]}\b[^>]*>", re.I).search(page, pos)
            if end is None:
                at = pos = len(page)
                break
            leave(len(stack) - 1)
            at = pos = end.end()
            continue
        text_to(m.start())
        at = pos = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if not m[1] and name not in _IN_HEAD:
            while stack and stack[-1][0] in _HEAD:
                leave(len(stack) - 1)             # an open head ends where the body begins
        if name in _BLOCK:
            close()
        elif name == "br" and not skipping:
            held.append(" ")
        if m[1]:
            if opened[name]:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                leave(k)
        elif name in _SKIP and name not in _HEAD and name not in _RAW and not ended(name):
            pass                                  # never closed: it hides nothing
        elif name not in _VOID and not m[3].endswith("/"):
            if name in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                leave(len(stack) - 1)             # implied end
            is_main = name in _MAIN
            is_bad = _boilerplate(name, m[3], main > 0)
            aside = hints if is_main and not _named(m[3]) else 0
            stack.append((name, is_bad, is_main, aside))
            opened[name] += 1
            if name in _BLOCK:
                shapes.append(name)
            if name == "form" and not form:
                forms += 1
                form = forms
            elif name in _WRAPPED and form:
                wrappers.add(form)
            hard += is_bad == "hard"
            hints += (is_bad == "hint") - aside
            main += is_main
            links += name == "a"
            skipping += name in _SKIP
            if is_main or name == "section":
                containers += 1
                container = containers
    text_to(len(page))
    close()
    for b in out:
        b.bad = b.bad or (b.form > 0 and b.form not in wrappers)
    return out


def _first_pass(b: Block, stop_words: frozenset) -> str:
    n = len(b.text)
    if b.bad or (n < LONG and (_OWNED.match(b.text) or (not b.inside and _DATED.search(b.text)))):
        return "bad"
    if b.links > MAX_LINKS * n:
        # the article's headings and prose may hold links, a paragraph that is one link may not
        own = (b.tag == "h1" or (b.inside and b.tag in _HEADING)
               or (b.inside and b.tag in _PROSE and b.links <= MOST_LINKS * n))
        return "" if own else "bad"
    if n >= LONG:
        return "good"
    if n >= MIDDLE:
        words = b.text.lower().split()
        if sum(w.strip(".,;:!?\"'()") in stop_words for w in words) >= MIN_STOP * len(words):
            return "good"
    return ""


def classify(found: list[Block], stop_words: frozenset = STOP_WORDS) -> list[Block]:
    """Label the blocks ``good`` or ``bad``."""
    for b in found:
        b.label = _first_pass(b, stop_words)
    n = len(found)
    first_pass = [b.label for b in found]
    # nearest decided block and nearest block outside an article, before and after each
    near = ([-1] * n, [n] * n)
    bound = ([-1] * n, [n] * n)
    for side, order, none in ((0, range(n), -1), (1, range(n - 1, -1, -1), n)):
        decided = outside = none
        for i in order:
            near[side][i], bound[side][i] = decided, outside
            decided = i if first_pass[i] else decided
            outside = outside if found[i].inside else i
    for i, b in enumerate(found):
        if b.label:
            continue
        sides = []
        for side, pick in ((0, max), (1, min)):
            j, edge = near[side][i], bound[side][i]
            # a heading belongs to what follows, other blocks to what went before
            rank = side if b.tag not in _HEADING else 1 - side
            if b.inside and pick(j, edge) == edge:          # the article's bound is nearer
                sides.append((abs(edge - i), 0, rank, "good"))
            elif 0 <= j < n:
                sides.append((abs(j - i), int(found[j].container != b.container), rank, first_pass[j]))
        b.label = min(sides)[3] if sides else "good"
    return found


def main_text(page: str | None, stop_words: frozenset = STOP_WORDS) -> str:
    """The good blocks of a page, joined by blank lines."""
    if not page:
        return ""
    return "\n\n".join(b.text for b in classify(blocks(page), stop_words) if b.label == "good")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: a map, no shuffle."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")

"""HTML pages as blocks of words, each with the zone it stands in."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

ARTICLE, PLAIN, CHROME = 0, 1, 2

# Fixed names of HTML
#: Elements whose content is no text of the page; the second kind only if they are closed, as browsers show the rest.
RAW = frozenset("script style textarea title".split())
EMBEDDED = frozenset("noscript template svg math iframe object select".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
HOLDERS = BREAKS - {"hr"}
CHROME_TAGS = frozenset("nav footer aside form menu dialog search button".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu".split())
#: Chrome that stays so around an article.
STICKY_TAGS = frozenset("nav footer aside".split())
STICKY_ROLES = frozenset("navigation contentinfo complementary".split())
#: Elements that a form holds only if it is wrapped around the page.
PAGE_PARTS = frozenset("article main nav header footer".split())
#: Words in a class or id that tell what a container is for; a comment container hides its articles.
COMMENT_WORDS = frozenset("comment comments reply replies respond discussion disqus".split())
CHROME_WORDS = frozenset("sidebar related nav navbar navigation menu breadcrumb breadcrumbs footer masthead".split())
LOOSE_WORDS = frozenset("ad ads adbox advert advertisement advertising sponsor sponsored promo banner cookie "
                        "cookies consent notice popup modal newsletter subscribe subscription signup share "
                        "sharing social paywall".split())
#: Other words in the name of a comment container.
HOLDER_WORDS = frozenset("area block body box container content div form inner item items li list post reader "
                         "section thread threads user wrap wrapper".split())
#: A name with one of these tells what a container has, lacks or shows, not what it is.
STATE_WORDS = frozenset("has have with without no not open opened closed enabled disabled".split())
STATE_LAYOUT = re.compile(r"content[-_]+sidebar")

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
REST = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
QUOTES = re.compile(r"""["'>]""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
ASCII_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
HIDING_STYLE = re.compile(r"(?:^|;)display:none(?![\w-])")


@lru_cache(4096)
def _named(names: str) -> tuple[bool, bool, bool, bool]:
    """Whether class and id name a comment container, and other chrome: by a whole name, by a part, or loosely."""
    comment = whole = part = loose = False
    for name in names.split():
        words = set(re.split(r"[^a-z]+", name)) - {""}
        if words & STATE_WORDS or STATE_LAYOUT.search(name):
            continue
        if words & COMMENT_WORDS:
            comment |= words <= COMMENT_WORDS | HOLDER_WORDS
            part = True
        whole |= bool(words & CHROME_WORDS) and words <= CHROME_WORDS
        part |= bool(words & CHROME_WORDS)
        loose |= bool(words & LOOSE_WORDS)
    return comment, whole, part, loose


def _purpose(tag: str, rest: str, in_article: bool, in_main: bool) -> tuple[bool, bool, bool, bool]:
    """Whether an element opens an article, is chrome, stays so around an article, is chrome only as a form."""
    if tag in ("body", "html"):
        return False, False, False, False
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(rest) if rest else ():
        found.setdefault(name.lower(), value.strip("\"'").lower())
    comment, whole, part, loose = _named(f"{found.get('class', '')} {found.get('id', '')}")
    role = found.get("role", "")
    hidden = ("hidden" in found or found.get("aria-hidden") == "true" or tag == "dialog" and "open" not in found
              or bool(HIDING_STYLE.search("".join(found.get("style", "").split()))))
    firm = tag in STICKY_TAGS or role in STICKY_ROLES or comment or hidden
    if tag in ("article", "main") or role in ("main", "article"):
        main = tag == "main" or role == "main"
        chrome = comment or whole and not main or firm and tag not in ("article", "main")
        return not chrome, chrome, chrome, False
    chrome = firm or role in CHROME_ROLES or part or loose or tag == "header" and not (in_article or in_main)
    # inside an article, what a container names aside from it has no article of the page
    sticky = firm or part and in_article
    return False, chrome or tag in CHROME_TAGS, sticky, tag == "form" and not chrome


class TagEnds:
    """Where tags end whose quotes do not close, for pages that have such: all of them in one pass."""

    def __init__(self, page: str):
        found = [(m.start(), m[0]) for m in QUOTES.finditer(page)]
        self._places = [at for at, _ in found]
        self._ends = [-1] * (len(found) + 1)  # of a tag that is outside of quotes at this mark
        later = {'"': -1, "'": -1}
        for i in range(len(found) - 1, -1, -1):
            at, mark = found[i]
            if mark == ">":
                self._ends[i] = at
            else:
                self._ends[i] = self._ends[later[mark] + 1] if later[mark] >= 0 else -1
                later[mark] = i

    def after(self, at: int) -> int:
        """Place of the ``>`` outside of quotes that ends a tag open at ``at``, or -1."""
        return self._ends[bisect_left(self._places, at)]


def marks(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Begin, end, whether it closes, name and attributes of every tag; comments have no name.

    An element whose content is no text of the page is one mark with all of it. A page is passed
    once, whatever it holds: what was not found behind one place is not looked for again behind a later one.
    """
    size, ends = len(page), None
    last = page.rfind(">")
    lower = None
    missing: set[str] = set()  # elements that are not closed any more
    at = page.find("<")
    while at >= 0:
        end, name, rest, closes = -1, "", "", False
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
        elif found := NAME.match(page, at) if at < last else None:
            begin = found.end()
            if ends is None:
                whole = REST.match(page, begin)
                end = whole.end() if whole else 0
                if not end:
                    ends = TagEnds(page)
            if ends is not None:
                end = ends.after(begin) + 1
            if end:
                closes, name, rest = bool(found[1]), found[2].lower(), page[begin:end - 1]
                if not closes and (name in RAW or name in EMBEDDED):
                    lower = lower if lower is not None else page.lower()
                    if len(lower) != size:  # lower case may be longer; places then are those of ASCII letters
                        lower = page.translate(ASCII_LOWER)
                    close = -1 if name in missing else lower.find(f"</{name}", end)
                    tail = page.find(">", close) if close >= 0 else -1
                    if tail >= 0:
                        end, name = tail + 1, ""
                    else:
                        missing.add(name)
                        if name in RAW:
                            end, name = size, ""
            else:  # quotes do not close: markup without a name up to the next bracket
                end = page.find(">", begin) + 1
        elif page.startswith(("<!", "<?"), at) and at < last:
            end = page.find(">", at) + 1
        if end > 0:
            yield at, end, closes, name, rest
        at = page.find("<", end if end > 0 else at + 1)


def blocks(page: str | None) -> Iterator[tuple[int, list[str]]]:
    """(zone, words) of the blocks in page order."""
    for zone, _, words in contained_blocks(page):
        yield zone, words


def contained_blocks(page: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """(zone, container, words) of the blocks in page order; character references are decoded.

    The container of a block in chrome is the outermost element that makes it so; its number is 0 elsewhere.

    An ``article`` or ``main`` counts as such inside other chrome too, for names of containers are weak
    evidence and some sites wrap the page in a form; not so in comments, ``nav``, ``footer``,
    ``aside`` and hidden elements. A form around parts of the page (an article, menu, header ...) is no chrome.
    Elements know their parent, so the time is linear in the page however deep it is nested.
    """
    page = page or ""
    # one entry per element: parent, article, chrome, sticky, form, inside an article, inside an article or main
    elements: list[tuple] = [(-1, False, False, False, False, False, False)]
    around_parts = [False]
    stack: list[tuple[str, int]] = []
    open_names: dict[str, int] = {}
    found: list[tuple[int, list[str]]] = []
    parts: list[str] = []
    at = 0

    def flush() -> None:
        words = entities.unescape("".join(parts)).split()
        parts.clear()
        if words:
            found.append((stack[-1][1] if stack else 0, words))

    def pop() -> str:
        name, _ = stack.pop()
        open_names[name] -= 1
        return name

    for begin, end, closes, tag, rest in marks(page):
        parts.append(page[at:begin])
        at = end
        if tag == "br":
            parts.append(" ")
        if tag not in BREAKS and tag not in CHROME_TAGS:
            continue
        flush()
        if closes:
            if open_names.get(tag):
                while pop() != tag:
                    pass
        elif (tag in HOLDERS or tag in CHROME_TAGS) and not rest.endswith("/"):
            if stack and stack[-1][0] == "p":
                pop()
            if stack and tag == stack[-1][0] and tag in ("li", "td", "th", "tr", "dd", "dt", "option"):
                pop()
            parent = stack[-1][1] if stack else 0
            *_, in_article, in_either = elements[parent]
            article, chrome, sticky, form = _purpose(tag, rest, in_article, in_either)
            if article or tag in PAGE_PARTS:
                above = parent
                while above > 0 and not around_parts[above]:
                    around_parts[above] = True
                    above = elements[above][0]
            elements.append((parent, article, chrome, sticky, form,
                             in_article or article and tag == "article", in_either or article))
            around_parts.append(False)
            stack.append((tag, len(elements) - 1))
            open_names[tag] = open_names.get(tag, 0) + 1
    parts.append(page[at:])
    flush()

    zones = [(PLAIN, False, 0)]  # with whether chrome is such that an article inside does not count
    for number, (parent, article, chrome, sticky, form, *_) in enumerate(elements[1:], 1):
        place, held, container = zones[parent]
        if chrome and place != CHROME and not (form and around_parts[number]):
            place, held, container = CHROME, sticky, number
        elif chrome and sticky:
            held = True
        elif article and (place != CHROME or not held):
            place, container = ARTICLE, 0
        zones.append((place, held, container))
    for element, words in found:
        place, _, container = zones[element]
        yield place, container, words

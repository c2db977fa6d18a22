"""The blocks of one HTML page: their text, their path of elements, and what role they play."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import xxhash

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr br img".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}}

#: Elements whose text is never shown or never main text.
SILENT = set("head script style template noscript iframe object svg canvas audio video select button textarea".split())
FURNITURE = set("nav aside footer form menu dialog".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
MAIN = {"article", "main"}
MAIN_WORDS = set("article content entry main post story".split())
#: Words of class and id names that mark what surrounds an article.
JUNK_WORDS = set(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promotion "
    "recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "widget".split()
)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")

DROPPED, BODY, OTHER, OUTSIDE = range(4)
#: What a main area is: an element with a name such as content, a main element, an article.
NAMED, MAIN_AREA, ARTICLE = 1, 2, 3


#: Stands for a text among the labels of an element's children.
TEXT = "#text"


def hashed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


class _Element:
    """An element; path: a hash of its label and those around it, children: the labels of what it shows, in order."""

    __slots__ = ("tag", "up", "path", "level", "children", "silent", "junk", "main", "depth")

    def __init__(self, tag: str, up: _Element | None, label: str, silent: bool, junk: bool, main: int, depth: int = 0):
        self.tag, self.up, self.silent, self.junk, self.main, self.depth = tag, up, silent, junk, main, depth
        self.path, self.level = (hashed(f"{up.path}/{label}"), up.level + 1) if up else (0, 0)
        self.children: list[str] = []


class Page(HTMLParser):
    """Blocks [path, text, junk, main, depth] of a page in order, and the elements that may show something.

    junk: inside furniture.  depth: how many forms and junk-named elements are
    around it, which may be wrappers of the whole page.  main: the kind of the
    main area it is in, 0 without one; an area ends where depth grows.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.articles: list[int] = []  # depth of each outermost article
        self.stack = [_Element("", None, "", False, False, 0)]
        self.elements = self.stack[:]
        self.text: list[str] = []
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        self.text = []
        if text:
            top = self.stack[-1]
            self.blocks.append([top.path, text, top.junk, top.main, top.depth])
            top.children.append(TEXT)

    def _junk(self, tag: str, attrs: dict[str, str | None], inside: bool) -> tuple[bool, bool]:
        """Whether an element is furniture by its tag or role, and whether a form or by its names."""
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        words = set(_WORD.findall(names))
        role = (attrs.get("role") or "").lower()
        if tag == "form":
            return role in ROLES - {"form"}, True
        if tag in FURNITURE or tag == "header" and not inside or role in ROLES:
            return True, False
        if tag in ("html", "body", "main"):
            return False, False
        if tag == "article":  # its names may be topics: only one that begins with such a word, as comment-body
            words = {w.group() for w in map(_WORD.match, names.split()) if w}
        found = words & JUNK_WORDS
        if inside or tag in MAIN or words & MAIN_WORDS:
            found -= {"header"}  # an article's own heading
        return False, bool(found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        top = self.stack[-1]
        if tag == "br" or tag == "wbr":
            self.text.append(" " if tag == "br" else "")
            return
        if tag in INLINE or top.silent and tag in VOID:
            return
        self._flush()
        if tag in CLOSES_P:
            self._end("p", {"article", "section", "div", "td", "th", "li", "blockquote", "body"})
        if tag in SAME:
            for other in SAME[tag]:
                self._end(other, HOLDS[tag])
        top = self.stack[-1]
        if tag in VOID:
            return
        names = dict(attrs)
        words = (names.get("class") or "").lower().split()
        label = ".".join([tag, *sorted(w for w in words if not any(c.isdigit() for c in w))])
        main = top.main
        furniture, wrapper = self._junk(tag, names, main > 0)
        junk, depth = top.junk or furniture, top.depth + wrapper
        if wrapper:
            main = 0
        named = tag in ("div", "section") and set(_WORD.findall((names.get("id") or "").lower() + " " + " ".join(words))) & MAIN_WORDS
        if not junk:
            if tag == "article":
                if main < ARTICLE and not any(e.main == ARTICLE and e.depth == depth for e in self.stack):
                    self.articles.append(depth)
                main = ARTICLE
            elif main < MAIN_AREA and (tag == "main" or (names.get("role") or "").lower() == "main"):
                main = MAIN_AREA
            elif not main and named and not wrapper:
                main = NAMED
        element = _Element(tag, top, label, top.silent or tag in SILENT, junk, main, depth)
        self.stack.append(element)
        if not element.silent:
            top.children.append(label)
            self.elements.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def _end(self, tag: str, fence: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in fence:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE and tag not in VOID:
            self._end(tag, set())

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].silent:
            self.text.append(data)

    def states(self) -> list[int]:
        """What each block is: dropped by its role, in the main area, outside it, or of a page without one.

        Articles and main elements are the main area, all of them; without one,
        named areas are.  Those inside wrappers count, from the least depth
        that has one, if no article is outside wrappers and what is outside is
        shorter; a main element, or the only article, where no other main area is.
        """
        size: dict[tuple[int, int], int] = {}
        for _, text, junk, main, depth in self.blocks:
            if not junk:
                size[depth, main] = size.get((depth, main), 0) + len(text)

        def held(depth: int, *kinds: int) -> int:
            return sum(size.get((depth, k), 0) for k in kinds)

        deep = 0
        if not held(0, ARTICLE):
            outside = held(0, NAMED, MAIN_AREA) or held(0, 0)
            strong = [d for d, main in sorted(size) if d and main >= MAIN_AREA]
            weak = [d for d, main in sorted(size) if d and main == NAMED]
            for d in (strong or weak)[:1]:
                sure = not held(0, NAMED, MAIN_AREA) and (held(d, MAIN_AREA) or strong and self.articles.count(d) == 1)
                if sure or held(d, NAMED, MAIN_AREA, ARTICLE) >= outside:
                    deep = d
        used = {0, deep}
        least = MAIN_AREA if any(held(d, MAIN_AREA, ARTICLE) for d in used) else NAMED
        area = any(held(d, NAMED, MAIN_AREA, ARTICLE) for d in used)
        out = []
        for _, _, junk, main, depth in self.blocks:
            if junk or depth not in used or depth and not main:
                out.append(DROPPED)
            elif not area:
                out.append(OTHER)
            else:
                # beside an article in a wrapper, what a main area outside it holds
                out.append(BODY if main >= least or deep and main else OUTSIDE)
        return out

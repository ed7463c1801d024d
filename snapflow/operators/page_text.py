"""Raw text of a card page by element class, run inside Arrow tasks.

Kept to what column expressions cannot do on markup that is not well-formed XML:
element nesting, entities and NFKC. Typing and rules are column expressions.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

# Elements without content, and elements whose text is not page text.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_NO_TEXT = frozenset(("script", "style", "template"))
# Class names and elements that a card record asks for; no others are indexed.
_ASKED = frozenset(
    "name pay <span> etc foot <strong> nation <img> skill_wrap desc info_line info_ab position txt value height weight"
    " physical skill tdefault_wrap tspecial_wrap selector_item data_wrap_playerinfo <li> ab".split()
)

# Markup in its regular form. A page with anything else in it goes through the
# standard parser, which is many times slower.
_BLANK = " \t\n\r\f\v"
_SPACE = r"[ \t\n\r\f]"  # what separates attributes; a no-break space does not
_ATTRIBUTE = rf"""{_SPACE}+([a-zA-Z_:][\w:.-]*)(?:{_SPACE}*={_SPACE}*("[^"]*"|'[^']*'|[^\s"'=<>`/]+))?"""
_ATTRIBUTES = re.compile(_ATTRIBUTE)
# What may hold a "<" that starts no tag, or is regular only as a whole.
_WHOLE = re.compile(
    rf"""
      <(?P<code>script|style)(?P<attrs>(?:{_ATTRIBUTE})*){_SPACE}*>
      [^<]*(?:<(?!/(?i:script|style)|!--)[^<]*)*</(?P=code)>
    | <title>(?P<title>[^<]*)</title>
    | <!--(?!-?>)[^-]*(?:-(?!-)[^-]*)*-->
    """,
    re.VERBOSE,
)
_MARKS = ("\0", "\1", "\2")  # a comment, a title, and a script or style, once found whole
_TAG = re.compile(
    rf"""
      /(?P<end>[a-zA-Z][a-zA-Z0-9]*){_SPACE}*
    | (?!(?i:script|style|textarea|title|iframe|xmp|noembed|noframes|noscript|plaintext)\b)
      (?P<start>[a-zA-Z][a-zA-Z0-9]*)(?P<attrs>(?:{_ATTRIBUTE})*){_SPACE}*(?P<empty>/?)
    | \x02(?P<code>script|style)(?P<code_attrs>(?:{_ATTRIBUTE})*)
    | (?P<nothing>\x00|!(?i:doctype)[^<>]*)
    """,
    re.VERBOSE,
)
_START, _END, _EMPTY, _NOTHING, _IRREGULAR = range(5)


def _attributes(tag: str, text: str) -> dict:
    """Attributes of a regular tag, read only where one is asked for."""
    if "class" not in text.lower() and tag != "img":
        return {}
    found = {}
    for name, value in _ATTRIBUTES.findall(text):
        bare = value[1:-1] if value[:1] in ('"', "'") else value
        found[name.lower()] = unescape(bare) if value else None
    return found


def _element(tag: str, attrs: dict) -> tuple[str, list[str], dict, list[str]]:
    """Tag, class names and attributes of an element, and the names it is indexed by."""
    classes = (attrs.get("class") or "").split()
    return tag, classes, attrs, [n for n in (f"<{tag}>", *dict.fromkeys(classes)) if n in _ASKED]


@lru_cache(maxsize=1 << 14)
def _tag(head: str) -> tuple[int, tuple | str | None]:
    """What stands between "<" and ">": its kind with the element, or the name of the one it ends. Most recur on every page."""
    if head == "\1":
        return _START, _element("title", {})
    m = _TAG.fullmatch(head)
    if m is None:
        return _IRREGULAR, None
    if m["end"]:
        return _END, m["end"].lower()
    if m["nothing"]:
        return _NOTHING, None
    tag = (m["start"] or m["code"]).lower()
    made = _element(tag, _attributes(tag, m["attrs"] if m["start"] else m["code_attrs"]))
    return (_EMPTY if m["empty"] or tag in _VOID else _START), made


def _marked(m: re.Match) -> str:
    if m["code"]:
        return f"<\2{m['code']}{m['attrs']}></{m['code']}>"
    return "<\0>" if m["title"] is None else f"<\1>{m['title']}</title>"


class Page:
    """Elements in page order with their class names, extent and text."""

    def __init__(self, html: str):
        if not self._read_regular(html):
            self._clear()
            feeder = _Feeder(self)
            feeder.feed(html)
            feeder.close()
        self.break_text()
        while self._open:
            self._shut(self._open.pop())

    def _clear(self) -> None:
        self.elements: list[tuple[str, list[str], dict, list[str]]] = []
        self.parents, self.last, self.text_from, self.text_to = [], [], [], []
        self.texts: list[str] = []
        self.by_name: dict[str, list[int]] = {name: [] for name in _ASKED}
        self._open: list[int] = []
        self._pending: list[str] = []

    @property
    def tags(self) -> list[str]:
        return [e[0] for e in self.elements]

    @property
    def classes(self) -> list[list[str]]:
        return [e[1] for e in self.elements]

    def _read_regular(self, html: str) -> bool:
        """Read a regular page, tag by tag; False for any other."""
        self._clear()
        if any(mark in html for mark in _MARKS):
            return False
        elements, texts, now_open = self.elements, self.texts, self._open
        leading, *pieces = _WHOLE.sub(_marked, html).split("<")
        if leading:
            self.add_text(leading if "&" not in leading else unescape(leading))
            self.break_text()
        for piece in pieces:
            head, closed, text = piece.partition(">")
            kind, made = _tag(head)
            if kind == _IRREGULAR or not closed:
                return False
            if kind == _END:
                if now_open and elements[now_open[-1]][0] == made:
                    node = now_open.pop()
                    self.last[node], self.text_to[node] = len(elements), len(texts)
                else:
                    self._end_outer(made)
            elif kind != _NOTHING:
                self._add(made, kind == _START)
            if text and not (now_open and elements[now_open[-1]][0] in _NO_TEXT):
                if "&" in text:
                    text = unescape(text)
                texts.append(text if text.strip(_BLANK) else "\n" if "\n" in text else " ")
        return True

    def break_text(self) -> None:
        if self._pending:
            text = "".join(self._pending)
            self._pending.clear()
            self.texts.append(text if text.strip(_BLANK) else "\n" if "\n" in text else " ")

    def _shut(self, node: int) -> None:
        self.last[node] = len(self.elements)
        self.text_to[node] = len(self.texts)

    def _add(self, element: tuple[str, list[str], dict, list[str]], stays_open: bool) -> None:
        node, at = len(self.elements), len(self.texts)
        self.elements.append(element)
        self.parents.append(self._open[-1] if self._open else -1)
        self.last.append(node + 1)
        self.text_from.append(at)
        self.text_to.append(at)
        for name in element[3]:
            self.by_name[name].append(node)
        if stays_open:
            self._open.append(node)

    def _end_outer(self, tag: str) -> None:
        if any(self.elements[n][0] == tag for n in self._open):
            while True:
                node = self._open.pop()
                self._shut(node)
                if self.elements[node][0] == tag:
                    break

    def start(self, tag: str, attrs: dict) -> None:
        self.break_text()
        self._add(_element(tag, attrs), tag not in _VOID)

    def end(self, tag: str) -> None:
        self.break_text()
        self._end_outer(tag)

    def add_text(self, text: str) -> None:
        if not (self._open and self.elements[self._open[-1]][0] in _NO_TEXT):
            self._pending.append(text)

    def all(self, *names: str, within: int | None = None) -> list[int]:
        """Elements carrying all of ``names`` (class names or ``<tag>``), in page order."""
        hits = self.by_name[names[0]] if len(names) == 1 else min((self.by_name[n] for n in names), key=len)
        if within is not None:
            hits = hits[bisect_right(hits, within):bisect_left(hits, self.last[within])]
        if len(names) == 1:
            return hits
        return [h for h in hits if all(n in self.elements[h][3] for n in names)]

    def inside(self, outer: tuple[str, ...], *names: str) -> list[int]:
        """Elements below any element carrying the names in ``outer``."""
        found = [self.all(*names, within=o) for o in self.all(*outer)]
        return found[0] if len(found) == 1 else sorted({h for hits in found for h in hits})

    def attr(self, node: int, name: str) -> str | None:
        return self.elements[node][2].get(name)

    def text(self, node: int) -> str:
        return "".join(self.texts[self.text_from[node]:self.text_to[node]])

    def pieces(self, node: int, sep: str = " ") -> str:
        parts = [t.strip() for t in self.texts[self.text_from[node]:self.text_to[node]]]
        return parts[0] if len(parts) == 1 else sep.join(filter(None, parts))


class _Feeder(HTMLParser):
    """The standard parser, for pages that are not regular."""

    def __init__(self, page: Page):
        super().__init__(convert_charrefs=True)
        self.page = page

    def handle_starttag(self, tag, attrs):
        self.page.start(tag, dict(attrs))

    def handle_startendtag(self, tag, attrs):
        self.page.start(tag, dict(attrs))
        if tag not in _VOID:
            self.page.end(tag)

    def handle_endtag(self, tag):
        self.page.end(tag)

    def handle_data(self, data):
        self.page.add_text(data)

    def handle_comment(self, data):
        self.page.break_text()

    def handle_decl(self, decl):
        self.page.break_text()


def card_text(html: str | None) -> dict | None:
    """One page as the raw card record; None for a page that cannot be read."""
    try:
        page = Page(html or "")
    except AssertionError:  # the standard parser gives up on broken declarations
        return None

    def first(nodes: list[int]) -> int | None:
        return nodes[0] if nodes else None

    def joined(nodes: list[int]) -> str | None:
        return page.pieces(nodes[0]) if nodes else None

    def pairs(items: list[int]):
        for item in items:
            txt = first(page.all("txt", within=item))
            value = first(page.all("value", within=item))
            if txt is not None and value is not None:
                yield page.text(txt).strip(), value

    name = first(page.all("name"))
    pay = first(page.inside(("pay",), "<span>"))
    foot = first(page.all("etc", "foot"))
    strong = None if foot is None else first(page.all("<strong>", within=foot))
    nation_img = first(page.inside(("etc", "nation"), "<img>"))
    images = [] if nation_img is None else [nation_img]
    traits = []
    for span in page.inside(("skill_wrap",), "<span>"):
        if "skill_wrap" not in page.elements[page.parents[span]][1]:
            continue
        img = first(page.all("<img>", within=span))
        desc = first(page.all("desc", within=span))
        if img is not None and desc is not None:
            images.append(img)
            traits.append({"name": page.text(desc).strip(), "image_url": page.attr(img, "src")})
    return {
        "name": None if name is None else page.text(name).strip(),
        "positions": [
            {"position": p, "value": page.text(v).strip()}
            for p, v in pairs(page.inside(("info_line", "info_ab"), "position"))
        ],
        "pay": None if pay is None else page.text(pay).strip(),
        "height": joined(page.all("etc", "height")),
        "weight": joined(page.all("etc", "weight")),
        "body_type": joined(page.all("etc", "physical")),
        "skill": joined(page.all("etc", "skill")),
        "foot": None if foot is None else page.pieces(foot),
        "foot_strong": None if strong is None else page.pieces(strong, ""),
        "nation_name": joined(page.inside(("etc", "nation"), "txt")),
        "nation_image": None if nation_img is None else page.attr(nation_img, "src"),
        "traits": traits,
        "clubs": [page.pieces(n, "") for n in page.inside(("tdefault_wrap",), "selector_item")],
        "relations": [page.pieces(n, "") for n in page.inside(("tspecial_wrap",), "selector_item")],
        "stats": [
            {"label": unicodedata.normalize("NFKC", label), "value": page.pieces(v)}
            for label, v in pairs(page.inside(("data_wrap_playerinfo",), "<li>", "ab"))
        ],
        "image_without_src": any(page.attr(i, "src") is None for i in images),
    }

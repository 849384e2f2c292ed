"""The blocks and element subtrees of one web page: a small tolerant HTML reader.

It keeps what the extraction needs: which elements are open, the text of the
blocks, and a digest of each subtree. Unclosed and misnested tags are closed
as browsers do for paragraphs, list items, table parts and the like.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from hashlib import blake2b

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Kinds of elements, as HTML defines them. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                           "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search "
                           "section summary table ul".split())
#: Start tags that close open elements, up to a limit.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
          "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"})}

# What belongs to the page and not to its article: elements, roles, and words of classes and ids. Fixed values.
DROPPED = frozenset("aside audio button canvas datalist dialog embed fieldset footer form head iframe input map menu "
                    "nav noembed noframes noscript object optgroup option script search select style svg "
                    "template textarea title video xmp".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                          "search toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs captcha comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split())
#: Within an article only a whole class or id tells: a compound may name a part of its text ("related-work").
#: These compounds don't.
DROPPED_NAMES = DROPPED_WORDS | frozenset(
    "comment-form comment-list comment-respond comments-area comments-list comments-section newsletter-signup "
    "related-articles related-posts related-stories share-bar share-buttons site-footer site-header social-share "
    "user-comments".split())
#: Dropped outside the article only, which may have a header of its own.
DROPPED_OUTSIDE = frozenset(["header"])
ARTICLE_DROPPED = frozenset("ad ads advert advertisement card comment comments promo promoted recommended related replies "
                            "reply sponsored teaser".split())
MAIN_WORDS = frozenset("article-body article-content article-text content entry-content main main-content "
                       "post-body post-content story-body".split())
#: Beginnings of names that tell of a layout, not of what an element is.
LAYOUT = ("has-", "with-", "no-", "without-")
_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "main", "dropped", "hash", "path", "start")

    def __init__(self, tag, main, dropped, key, start, above=b""):
        self.tag, self.main, self.dropped, self.start = tag, main, dropped, start
        key = key.encode(errors="replace")
        self.hash = blake2b(key, digest_size=8)
        self.path = blake2b(key, digest_size=8, key=above).digest()     # of all elements down to here


def _attributes(text: str) -> dict[str, str]:
    out = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _names(attributes: dict[str, str]) -> list[str]:
    return f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()


def _dropped(tag: str, attributes: dict[str, str], claim: int) -> bool:
    """``claim`` is that of the element around it (:func:`_main`)."""
    inside = claim >= 2
    names = [n for n in _names(attributes) if not n.startswith(LAYOUT)]
    words = set(names) if claim == 3 else {w for n in names for w in _WORD.findall(n)}
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return bool(words & ARTICLE_DROPPED)
    role = attributes.get("role", "").lower()
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True
    if not inside and (tag in DROPPED_OUTSIDE or words & DROPPED_OUTSIDE):
        return True
    if inside and role == "banner":
        return False
    return role in DROPPED_ROLES or bool(words & (DROPPED_NAMES if claim == 3 else DROPPED_WORDS))


def _main(tag: str, attributes: dict[str, str]) -> int:
    """How strongly an element claims to be the article: 3, 2, 1 or 0."""
    if tag == "article" or attributes.get("itemprop") == "articleBody":
        return 3
    if tag == "main" or attributes.get("role", "").lower() in ("main", "article"):
        return 2
    return int(tag in ("div", "section", "td") and bool(MAIN_WORDS.intersection(_names(attributes))))


class Page:
    """``blocks``: (text, claim, dropped) in page order; ``subtrees``: (digest, path, in the
    article, first block, after the last block) of the element subtrees with text. A path
    is a hash of the kinds and names of the elements from the root down to the subtree's."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, bool]] = []
        self.subtrees: list[tuple[int, int, bool, int, int]] = []
        self._stack = [Element("", 0, False, "", 0)]
        self._count: Counter = Counter()     # of the open elements by tag
        self._text: list[str] = []
        self._held: list[tuple[int, list[str]]] = []   # text that a dropped element interrupts
        self._read(source)
        while len(self._stack) > 1:
            self._close()
        self._flush()

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(html.unescape("".join(self._text)).split())
        self._text = []
        if text:
            top = self._stack[-1]
            top.hash.update(blake2b(text.encode(errors="replace"), digest_size=8).digest())
            self.blocks.append((text, top.main, top.dropped))

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        top = self._stack[-1]
        main = max(top.main, _main(tag, attributes))
        dropped = top.dropped or _dropped(tag, attributes, top.main)
        key = f"{tag} {' '.join(sorted(_names(attributes)))}"
        self._stack.append(Element(tag, main, dropped, key, len(self.blocks), top.path))
        self._count[tag] += 1

    def _close(self) -> None:
        e = self._stack[-1]
        if e.tag not in INLINE or len(self._stack) == 2 or e.dropped != self._stack[-2].dropped:
            self._flush()
        self._stack.pop()
        self._count[e.tag] -= 1
        digest = e.hash.digest()
        self._stack[-1].hash.update(digest)
        if len(self.blocks) > e.start and e.tag not in ("html", "body"):
            number = lambda x: int.from_bytes(x, "little", signed=True)
            self.subtrees.append((number(digest), number(e.path), self._stack[-1].main >= 2, e.start, len(self.blocks)))
        if self._held and self._held[-1][0] == len(self._stack):
            self._text = self._held.pop()[1] + self._text

    def _close_to(self, at: int) -> None:
        while len(self._stack) > at:
            self._close()

    def _find(self, tags, limits) -> int | None:
        """The place of the lowest open element of ``tags`` above any of ``limits``."""
        found = None
        if not any(self._count[t] for t in tags):
            return None
        for at in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[at].tag
            if tag in limits:
                break
            if tag in tags:
                found = at
        return found

    def _start(self, tag: str, text: str) -> None:
        attributes = _attributes(text) if text.strip(" /\t\r\n\f") else {}
        if tag == "br":
            self._text.append(" ")
            return
        if tag in INLINE:
            # only one that is dropped matters: its text is not its block's
            if tag not in VOID and _dropped(tag, attributes, self._stack[-1].main):
                self._flush_part()
                self._open(tag, attributes)
            return
        self._flush()
        if tag in ENDS_PARAGRAPH:
            at = self._find({"p"}, {"table", "td", "th", "button", "object", "caption"})
            if at:
                self._close_to(at)
        if tag in CLOSES:
            at = self._find(*CLOSES[tag])
            if at:
                self._close_to(at)
        if tag not in VOID:
            self._open(tag, attributes)

    def _flush_part(self) -> None:
        """A dropped element within a line of text: the text before it is kept apart from its own."""
        if self._text and not self._stack[-1].dropped:
            self._held.append((len(self._stack), self._text))
            self._text = []

    def _end(self, tag: str) -> None:
        if not self._count[tag]:
            if tag == "p":
                self._flush()
            return
        if tag in INLINE:
            for at in range(len(self._stack) - 1, 0, -1):
                if self._stack[at].tag == tag:
                    self._close_to(at)
                    return
                if self._stack[at].tag not in INLINE:
                    return
            return
        self._flush()
        self._close_to(next(i for i in range(len(self._stack) - 1, 0, -1) if self._stack[i].tag == tag))

    def _read(self, source: str) -> None:
        at = 0
        while True:
            mark = _MARK.search(source, at)
            if not mark:
                self._text.append(source[at:])
                return
            if mark.start() > at:
                self._text.append(source[at:mark.start()])
            at = mark.end()
            tag = mark.group(2) or mark.group(5)
            if not tag:
                if mark.group().startswith("<![CDATA["):
                    self._text.append(html.escape(mark.group()[9:].removesuffix("]]>"), quote=False))
                continue
            tag = tag.lower()
            if mark.group(1) or mark.group(4):
                self._end(tag)
                continue
            text = mark.group(3) or mark.group(6) or ""
            if tag in RAW and not text.endswith("/"):
                # its content is no markup: skipped, as all of these are dropped
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            self._start(tag, text)

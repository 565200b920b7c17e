"""Blocks of a web page, each with the zone it lies in.

One pass over the tags finds blocks and regions; a region is an element that may bound text or chrome. A second pass over the
regions, parents first, decides their zones. Both take time linear in the length of the page, whatever its markup.

* Menus, headers, footers, asides, dialogs and the like are chrome, and so are regions that a class, id or role names so.
* Such a name counts only as a whole: every part of it must be a mark or a plain word of layout, so `ad-slot` is one and
  `has-sidebar` or `category-search-engines` are not. It never counts on headings, `html` and `body`.
* A name other than that of reader comments is only a hint. It is dropped where the page has no other article than those in
  such regions, and where the region holds more than half of the article's words, or of the page's without an article.
* Chrome by element that has no end of its own ends where an article starts.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import lru_cache

CHROME_ZONE, OPEN_ZONE, ARTICLE_ZONE = range(3)
PLAIN, ELEMENT, HINT, COMMENT, ARTICLE = range(5)

START = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
# Quotes count only after an equals sign. Possessive, so that a tag is scanned once.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|))*+)>""")
BARE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "object"}
WHOLE = {"script", "style", "textarea", "title", "iframe"}  # hold all that follows if their end is missing
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
CHROME = {"nav", "header", "footer", "aside", "dialog", "menu", "button", "select"}
MAIN = {"article", "main"}
HEADINGS = {f"h{k}" for k in range(1, 7)}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover"
    " mstyle mspace mpadded mphantom semantics annotation".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end can be left out, and the open ones that they end. They bound a region only with a name of chrome.
LOOSE = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "option": {"option"}, "rt": {"rt", "rp"}, "rp": {"rt", "rp"},
    **{name: {"thead", "tbody", "tfoot", "tr", "td", "th", "colgroup", "p"} for name in ("thead", "tbody", "tfoot")},
    "colgroup": {"colgroup"}, "html": set(), "body": set(), "head": set(),
}
COMMENTS = set("comment comments disqus reply replies respond".split())
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo cookie cookies consent gdpr notice"
    " popup modal overlay newsletter subscribe signup sidebar nav navbar navigation menu breadcrumb breadcrumbs header"
    " masthead footer share sharing social related widget pagination search complementary contentinfo dialog".split()
)
# Words of layout that may stand beside a mark.
LAYOUT = set(
    "site page global top bottom left right main primary secondary inner outer sticky fixed mobile desktop slot box block"
    " bar area section container wrapper wrap panel unit list item items link links button buttons form thread icons"
    " toolbar row column col group posts articles js".split()
)


@lru_cache(1 << 12)
def mark_of(names: str) -> int:
    """HINT, COMMENT or PLAIN for the value of a class, id or role."""
    found = PLAIN
    for name in names.split():
        parts = set(filter(None, re.split(r"[^a-z]+", name)))
        marks, comments = parts & MARKS, parts & COMMENTS
        if (marks or comments) and parts <= MARKS | COMMENTS | LAYOUT:
            found = max(found, COMMENT if comments else HINT)
    return found


def region_kinds(name: str, attributes: str) -> list[int]:
    """The regions that a start tag opens, outermost first."""
    found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in NAMES.finditer(attributes)] if "=" in attributes else []
    mark = PLAIN if name in HEADINGS else max((mark_of(value) for _, value in found), default=PLAIN)
    kinds = [mark] if mark else [ELEMENT] if name in CHROME else [HINT] if name == "form" else []
    if name in MAIN or ("role", "main") in found:
        kinds.append(ARTICLE)
    return kinds


class _Reader:
    """Open elements, regions and blocks while the tags of a page go by."""

    def __init__(self) -> None:
        self.parents, self.kinds, self.closed = [0], [PLAIN], [False]
        self.open: list[list] = []  # name, region around it, loose elements opened in it (inline ones only)
        self.count: Counter[str] = Counter()
        self.now = 0
        self.text: list[str] = []
        self.blocks: list[tuple[int, list[str]]] = []

    def end_block(self) -> None:
        tokens = "".join(self.text).split()
        self.text.clear()
        if tokens:
            self.blocks.append((self.now, tokens))

    def push(self, name: str, kinds: list[int]) -> None:
        self.open.append([name, self.now, 0])
        self.count[name] += 1
        for kind in kinds:
            self.parents.append(self.now)
            self.kinds.append(kind)
            self.closed.append(False)
            self.now = len(self.kinds) - 1

    def pop(self, by_name: bool = False) -> None:
        name, around, _ = self.open.pop()
        self.count[name] -= 1
        if by_name:
            while self.now != around:
                self.closed[self.now] = True
                self.now = self.parents[self.now]
        self.now = around

    def close(self, name: str) -> None:
        while self.open[-1][0] != name:
            self.pop()
        self.pop(by_name=True)

    def pop_loose(self, names: set[str], but: str = "") -> None:
        while self.open and self.open[-1][0] in names and self.open[-1][0] != but:
            self.pop()

    def inline(self, name: str, ends: bool, attributes: str) -> None:
        """Inline elements are of interest only with a name of chrome, and those of the same name inside such."""
        if ends:
            if self.count[name]:
                self.end_block()
                self.close(name)
            return
        if name == "a" and self.count[name]:
            self.end_block()
            self.close(name)
        kinds = region_kinds(name, attributes)
        if kinds or self.count[name]:
            self.end_block()
            self.push(name, kinds)

    def loose(self, name: str, ends: bool, attributes: str) -> None:
        if ends:
            if self.open and self.open[-1][0] in INLINE:
                if self.open[-1][2]:
                    self.open[-1][2] -= 1
                    return
                self.pop()  # the element around it ends
            self.pop_loose(LOOSE[name], but=name)
            if self.open and self.open[-1][0] == name:
                self.pop(by_name=True)
            return
        self.pop_loose(LOOSE[name])
        kinds = region_kinds(name, attributes) if LOOSE[name] else []
        if kinds:
            self.push(name, kinds)
        elif self.open and self.open[-1][0] in INLINE:
            self.open[-1][2] += 1

    def block(self, name: str, ends: bool, attributes: str) -> None:
        if not ends:
            self.pop_loose({"p"})
            self.push(name, region_kinds(name, attributes))
        elif self.count[name]:
            self.close(name)


def _read(page: str) -> _Reader:
    """All tags of a page. A tag without an end is text."""
    reader, at, after = _Reader(), 0, 0
    tags, endless = TAG, set()  # RAW names that have no end tag any more
    while start := START.search(page, after):
        begin = start.start()
        if page[begin + 1] in "!?":
            name, comment = "", page.startswith("<!--", begin)
            after = page.find("-->" if comment else ">", begin + (4 if comment else 2))
            if after < 0:
                if not comment:
                    break  # no tag can end any more
                after = len(page)
            after = min(len(page), after + (3 if comment else 1))
        else:
            tag = tags.match(page, begin)
            if not tag and tags is TAG:
                # Quotes reach beyond the last end of a tag. From here on they mean nothing, so that no text is read again.
                tags = BARE
                tag = tags.match(page, begin)
            if not tag:
                break
            name, after = tag[2].lower(), tag.end()
        if begin > at:
            reader.text.append(entities.unescape(page[at:begin]))
        at = after
        if not name:
            continue
        ends, attributes = bool(tag[1]), tag[3]
        if name == "br":
            reader.text.append(" ")
        elif name in INLINE:
            if not attributes and not reader.count.get(name):
                continue
            reader.inline(name, ends, attributes)
        else:
            reader.end_block()
            if name in RAW:
                if not ends and not attributes.rstrip().endswith("/") and name not in endless:
                    found = ENDS[name].search(page, at)
                    if found:
                        at = after = found.start()
                    elif name in WHOLE:
                        at = after = len(page)
                    else:
                        endless.add(name)
            elif name in LOOSE:
                reader.loose(name, ends, attributes)
            elif name not in VOID:
                reader.block(name, ends, attributes)
    reader.text.append(entities.unescape(page[at:]))
    reader.end_block()
    return reader


def _drop_hints(reader: _Reader) -> None:
    """Make hints plain regions that hold the only articles, or more than half of an article or page."""
    parents, kinds = reader.parents, reader.kinds
    every = range(1, len(kinds))
    if HINT not in kinds:
        return
    fixed, hinted, article = [False] * len(kinds), [False] * len(kinds), [0] * len(kinds)
    for r in every:
        p, kind = parents[r], kinds[r]
        fixed[r] = fixed[p] or kind == COMMENT or kind == ELEMENT and reader.closed[r]
        hinted[r] = hinted[p] or kind == HINT
        article[r] = article[p] or (r if kind == ARTICLE and not fixed[r] and not hinted[r] else 0)
    free = any(article)
    holds, words = [k == ARTICLE and not f for k, f in zip(kinds, fixed)], [0] * len(kinds)
    for r, tokens in reader.blocks:
        words[r] += 0 if fixed[r] else len(tokens)
    for r in reversed(every):
        holds[parents[r]] |= holds[r]
        words[parents[r]] += words[r]
    for r in every:
        if kinds[r] == HINT:
            most = (article[r] or not free) and 2 * words[r] > words[article[r]]
            if most or not free and holds[r]:
                kinds[r] = PLAIN


def read_blocks(page: str) -> tuple[bool, list[tuple[int, list[str]]]]:
    """Whether the page has an article, and its blocks with their zone, in order."""
    reader = _read(page)
    _drop_hints(reader)
    parents, kinds = reader.parents, reader.kinds
    hard, soft, inside = ([False] * len(kinds) for _ in range(3))
    for r in range(1, len(kinds)):
        p, kind = parents[r], kinds[r]
        hard[r] = hard[p] or kind in (HINT, COMMENT) or kind == ELEMENT and reader.closed[r]
        soft[r] = kind != ARTICLE and (soft[p] or kind == ELEMENT)
        inside[r] = not hard[r] and (inside[p] or kind == ARTICLE)

    def zone(r: int) -> int:
        return CHROME_ZONE if hard[r] or soft[r] else ARTICLE_ZONE if inside[r] else OPEN_ZONE

    return any(inside), [(zone(r), tokens) for r, tokens in reader.blocks]

"""Tags and text blocks of one HTML page, in page order.

Tolerant of what pages hold in practice: unclosed paragraphs and list items, tags cut off
at the end, quoted '>' in attributes, raw script and style.  A block is the text between
two block-level tags; phrase tags and line breaks do not end one.
"""

from __future__ import annotations

import html
import re

import xxhash

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
PHRASE = frozenset("abbr acronym b bdi bdo big br cite code data dfn em font i kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
SPACING = frozenset("br td th img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements whose start ends an open element of the first kind, looked for no further up than the second kind
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
          "option": ({"option"}, {"select"})}
INLINE = PHRASE | {"a", "img", "label", "ins", "del", "td", "th"}

# elements and words of class, id and role that mark what is not the article
ASIDE_TAGS = frozenset("nav footer aside form script style noscript template iframe object svg canvas button select option "
                       "textarea input fieldset head title dialog menu audio video map".split())
ASIDE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion promoted "
                        "aside side nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager "
                        "footer masthead topbar toolbar sidebar rail widget complementary contentinfo banner "
                        "notice notices cookie cookies consent gdpr alert dialog modal popup overlay "
                        "comment comments disqus replies reply respond discussion "
                        "form search login signup subscribe subscription newsletter "
                        "share sharing social related recommended recommendations teaser teasers hidden".split())
HEADER_WORDS = frozenset("header pageheader siteheader".split())
ARTICLE_WORDS = frozenset("articlebody article-body article-content post-content post-body entry-content story-body".split())
MAIN_WORDS = frozenset("main content main-content article post entry story".split())
ROLES = {"navigation": "nav", "search": "search", "alertdialog": "dialog", "main": "main", "article": "articlebody"}

_MARKUP = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+(?:>|\Z)|/?[a-zA-Z][^>]*+(?:>|\Z))""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\s(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TELLING = re.compile(r"\s(?:class|id|role|itemprop|hidden|aria-hidden|style)(?=[\s=>/])", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s/>=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_WHOLE = (1 << 64) - 1
PLAIN, ASIDE = 0, -1
MAIN, ARTICLE = 1, 2


class Tag:
    """What a page needs to know of one start tag; equal tags share one."""

    __slots__ = ("name", "token", "zone", "header")

    def __init__(self, raw: str):
        self.name = _NAME.match(raw).group(1).lower()
        marks = [(k.lower(), a or b or c) for k, a, b, c in _MARKS.findall(raw)] if "=" in raw else []
        self.token = " ".join([self.name, *(f"{k}={v}" for k, v in marks if self.name not in ("html", "body") or k != "class")])
        words, whole = set(), set()
        for k, v in marks:
            for value in v.split():
                value = ROLES.get(value.lower(), value) if k == "role" else value
                whole.add(value.lower())
                words.update(w.lower() for w in _WORD.findall(value))
        framed = self.name in ("html", "body")
        self.header = self.name == "header" or bool((words | whole) & HEADER_WORDS)
        if self.name in ASIDE_TAGS or (not framed and ((words | whole) & ASIDE_WORDS or _HIDDEN.search(raw))):
            self.zone = ASIDE
        elif self.name == "article" or whole & ARTICLE_WORDS:
            self.zone = ARTICLE
        elif self.name == "main" or (whole & MAIN_WORDS and not framed):
            self.zone = MAIN
        else:
            self.zone = PLAIN


class Block:
    """Text between two block-level tags: its zone (ASIDE to ARTICLE), whether it is a heading, and how much of it is links."""

    __slots__ = ("text", "zone", "heading", "linked")

    def __init__(self, text: str, zone: int, heading: bool, linked: int):
        self.text, self.zone, self.heading, self.linked = text, zone, heading, linked

    @property
    def prose(self) -> bool:
        return self.zone != ASIDE and 2 * self.linked < len(self.text)


_tags: dict[str, Tag] = {}
_paths: dict[tuple[int, str], int] = {}


def _tag(raw: str) -> Tag:
    if "=" in raw and not _TELLING.search(raw):
        raw = _NAME.match(raw).group()  # no mark among the attributes: as the bare element
    if len(raw) > 64:
        return Tag(raw)
    found = _tags.get(raw)
    if found is None:
        if len(_tags) > 4096:
            _tags.clear()
        found = _tags[raw] = Tag(raw)
    return found


def _hash(path: int, token: str) -> int:
    """Hash of a token under the elements it stands in."""
    if len(token) > 200:
        return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), path)
    found = _paths.get((path, token))
    if found is None:
        if len(_paths) > 65536:
            _paths.clear()
        found = _paths[(path, token)] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), path)
    return found


def page_blocks(page: str | None) -> tuple[list[int], dict[int, Block]]:
    """(tokens, blocks): the page's tokens in order, each a hash of a tag or of a block's text with the names of the
    elements around it, and the blocks by their place among the tokens.  A null page has none."""
    tokens: list[int] = []
    blocks: dict[int, Block] = {}
    stack: list[tuple[str, int, int, bool]] = []  # name, path, zone, heading
    pieces: list[str] = []
    state = {"link": -1, "linked": 0}

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                path, zone, heading = stack[-1][1:] if stack else (0, PLAIN, False)
                blocks[len(tokens)] = Block(text, zone, heading, min(state["linked"], len(text)))
                tokens.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), ~path & _WHOLE))
        state["linked"] = 0

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            name, _, _, _ = stack.pop()
            tokens.append(_hash(stack[-1][1] if stack else 0, "/" + name))
        if state["link"] > depth:
            state["link"] = -1

    def write(text: str) -> None:
        if text:
            if "&" in text:
                text = html.unescape(text)
            pieces.append(text)
            if state["link"] >= 0:
                state["linked"] += len(text.strip())

    page, at = page or "", 0
    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            write(page[at:])
            break
        write(page[at:found.start()])
        raw, at = found.group(), found.end()
        if raw[1] in "!?":
            continue
        if raw[1] == "/":
            name = _NAME.match(raw).group(1).lower()
            if name in INLINE:
                if name == "a":
                    state["link"] = -1
                elif name in SPACING:
                    pieces.append(" ")
                if stack and stack[-1][0] == name:  # one that was set apart
                    close(len(stack) - 1)
            else:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if depth is None:
                    flush()
                else:
                    close(depth)
            continue
        tag = _tag(raw)
        name = tag.name
        if name in SPACING:
            pieces.append(" ")
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "a":
            state["link"] = len(stack)
        if name in INLINE and tag.zone != ASIDE:
            continue
        if name in CLOSES:
            kinds, limit = CLOSES[name]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in limit:
                    break
                if stack[i][0] in kinds:
                    close(i)
                    break
        if name not in INLINE and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        flush()
        path, zone, heading = stack[-1][1:] if stack else (0, PLAIN, False)
        tokens.append(_hash(path, tag.token))
        if name in VOID or raw.endswith("/>") and name in ASIDE_TAGS:
            continue
        inner = zone if zone == ASIDE else tag.zone if tag.zone in (ASIDE, ARTICLE) else max(zone, tag.zone)
        if tag.header and inner == PLAIN:  # the site's header, not that of an article
            inner = ASIDE
        stack.append((name, _hash(path, name), inner, heading or name in HEADINGS))
    close(0)
    return tokens, blocks

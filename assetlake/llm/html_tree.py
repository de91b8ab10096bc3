"""HTML as a tree of structural elements and text leaves, and pages with labelled parts to learn from."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

# Element names of HTML by their part in the layout.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp".split())
HIDDEN = RAW | frozenset("noscript template iframe svg math select datalist object canvas audio video button".split())
KINDS = (
    "leaf body p heading li list article main nav header footer aside form table cell quote figure section div other inline"
).split()
TAGS = {
    "body": "body html", "p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "li": "li dt dd", "list": "ul ol dl menu dir",
    "article": "article", "main": "main", "nav": "nav", "header": "header", "footer": "footer address", "aside": "aside",
    "form": "form fieldset dialog search legend", "table": "table thead tbody tfoot tr caption", "cell": "td th",
    "quote": "blockquote pre", "figure": "figure figcaption details summary", "section": "section", "div": "div center",
}
# Beginnings of class, id and role words that tell what an element is for.
WORDS = {
    "menu": "nav menu breadcrumb toolbar tabs pagination pager topbar toc",
    "head": "header masthead branding logo hero banner",
    "foot": "footer copyright legal colophon imprint contentinfo",
    "side": "sidebar aside widget related recommend popular trending secondary complementary more rail",
    "notice": "notice cookie consent gdpr alert modal popup newsletter subscribe paywall signup overlay toast privacy warning",
    "ad": "ad ads adv advert advertisement adslot sponsor sponsored promo promotion dfp outbrain taboola",
    "comment": "comment comments reply replies respond disqus discussion feedback",
    "share": "share sharing social follow tags meta byline",
    "form": "form login search input contact",
    "text": "content article post entry story main body text prose page document copy",
}
GROUPS = list(WORDS)
#: Words that only count as a whole: their beginnings are too common.
WHOLE_WORDS = frozenset("ad ads adv more meta tags page body main text post head menu copy form search".split())
STARTS = {word: GROUPS.index(group) for group, words in WORDS.items() for word in words.split()}
KIND = {tag: KINDS.index(kind) for kind, tags in TAGS.items() for tag in tags.split()}
LEAF, INLINE_KIND, OTHER = KINDS.index("leaf"), KINDS.index("inline"), KINDS.index("other")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=[\x20\x09-\x0D]*+(?:\"[^\"]*+\"|'[^']*+')?)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
MARKS = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|aria-label|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
HEADING = re.compile(r"h[1-6]")
# An element that opens inside one of the first ends it, unless one of the second lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


def purposes(attributes: str) -> tuple[tuple[int, ...], str | None]:
    """The groups of ``WORDS`` that an element's marks speak of, and its label if it has one."""
    found, label = set(), None
    for name, *values in MARKS.findall(attributes):
        value = "".join(values)
        if name.lower() == "data-label":
            label = value
            continue
        for part in PARTS.findall(value):
            part = part.lower()
            if part in STARTS:
                found.add(STARTS[part])
            elif part not in WHOLE_WORDS:
                for size in range(len(part) - 1, 4, -1):
                    if part[:size] in STARTS and part[:size] not in WHOLE_WORDS:
                        found.add(STARTS[part[:size]])
                        break
    return tuple(sorted(found)), label


@dataclass
class Page:
    """A page's nodes in page order. Node 0 is the page; ``end`` is one past a node's last descendant."""

    parent: list[int] = field(default_factory=lambda: [-1])
    kind: list[int] = field(default_factory=lambda: [KINDS.index("body")])
    marks: list[tuple[int, ...]] = field(default_factory=lambda: [()])
    end: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    main: list[bool] = field(default_factory=lambda: [False])
    text: dict[int, str] = field(default_factory=dict)
    links: dict[int, int] = field(default_factory=dict)
    block: dict[int, int] = field(default_factory=dict)

    def add(self, parent: int, kind: int, marks: tuple[int, ...], main: bool) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.marks.append(marks)
        self.end.append(len(self.parent))
        self.depth.append(self.depth[parent] + 1)
        self.main.append(main)
        return len(self.parent) - 1

    def words_of(self, kept) -> str:
        """The text of the leaves for which ``kept`` is true: white space within a block as one space, then the blocks."""
        blocks: dict[int, str] = {}
        for node, text in self.text.items():
            if kept[node]:
                blocks[self.block[node]] = blocks.get(self.block[node], "") + text
        return " ".join(t for t in (" ".join(b.split()) for b in blocks.values()) if t)


def parse(source: str, labelled: bool = False, plain: bool = False) -> Page:
    """The tree of a page; any input has one, tags that are cut off at its end are dropped.

    With ``labelled`` the ``data-label`` attributes (main or other, inherited) are read; they are never a feature.
    ``plain`` reads article and main as div. Scripts, styles, form controls and embedded media have no text.
    """
    page = Page()
    stack: list[tuple[str, int]] = [("", 0)]
    open_tags: dict[str, int] = {}
    block, at, linked = 0, 0, False
    pending: list[str] = []
    link_size = 0

    def flush(new_block: bool):
        nonlocal block, link_size
        if pending:
            text = "".join(pending)
            if text.strip():
                _, node = stack[-1]
                leaf = page.add(node, LEAF, (), page.main[node])
                page.text[leaf], page.links[leaf], page.block[leaf] = text, link_size, block
            elif page.text and not new_block:
                last = next(reversed(page.text))
                if page.block[last] == block:
                    page.text[last] += " "
            pending.clear()
        link_size = 0
        if new_block:
            block += 1

    def close(to: int):
        while len(stack) > to:
            tag, node = stack.pop()
            open_tags[tag] -= 1
            page.end[node] = len(page.parent)

    def place(tags, barrier) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in barrier:
                return None
        return None

    size = len(source)
    while at < size:
        start = source.find("<", at)
        if start < 0:
            start = size
        token = TOKEN.match(source, start) if start < size else None
        if token is None and start < size:
            start += 1  # a lone sign
        if start > at:
            text = source[at:start]
            text = html.unescape(text) if "&" in text else text
            pending.append(text)
            link_size += len(text) if linked else 0
        at = start if token is None else token.end()
        if token is None or token[2] is None:
            continue
        tag = token[2].lower()
        if plain and tag in ("article", "main"):
            tag = "div"
        elif HEADING.fullmatch(tag):
            tag = "h1"  # the end of any heading ends the open one
        if token[1]:
            if tag == "a":
                linked = False
            if open_tags.get(tag):
                flush(tag not in INLINE)
                close(place({tag}, ()))
                linked = linked and tag in INLINE
            elif tag == "p" or tag not in INLINE:
                flush(True)
            continue
        if tag in HIDDEN:
            flush(tag not in INLINE)
            ending = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(source, at)
            if ending:
                at = ending.end()
            elif tag in RAW:
                at = size
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush(True)
            continue
        if tag == "a":
            linked = True
        marks, label = purposes(token[3]) if "=" in token[3] else ((), None)
        if tag in INLINE:
            if not marks and not (labelled and label):
                continue
            flush(False)
            kind = INLINE_KIND
        else:
            flush(True)
            kind = KIND.get(tag, OTHER)
            if open_tags.get("p"):
                to = place({"p"}, {"td", "th", "li"})
                if to is not None:
                    close(to)
            if tag in ENDS:
                tags, barrier = ENDS[tag]
                if any(open_tags.get(t) for t in tags):
                    to = place(tags, barrier)
                    if to is not None:
                        close(to)
                        if tag == "tr":
                            to = place({"tr"}, {"table"})
                            if to is not None:
                                close(to)
        if token[3].rstrip().endswith("/") and kind == OTHER:
            continue
        parent = stack[-1][1]
        main = label == "main" if labelled and label else page.main[parent]
        stack.append((tag, page.add(parent, kind, marks, main)))
        open_tags[tag] = open_tags.get(tag, 0) + 1
    flush(True)
    close(1)
    page.end[0] = len(page.parent)
    return page


class Writer:
    """Seeded pages of many layouts whose parts carry ``data-label``: labels are known because the page is made of them."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        letters = "aeiounrstlmdk"
        self.words = ["".join(self.rng.choice(letters) for _ in range(self.rng.randrange(2, 9))) for _ in range(400)]

    def pick(self, text: str) -> str:
        return self.rng.choice(text.split("|"))

    def sentence(self, low=1, high=18) -> str:
        words = [self.rng.choice(self.words) for _ in range(self.rng.randrange(low, high))]
        text = " ".join(words).capitalize()
        return text.replace(" ", ", ", 1) + "." if self.rng.random() < 0.3 else text + self.pick(".|.|.|!|?")

    def prose(self, most=8) -> str:
        parts = [self.sentence() for _ in range(self.rng.randrange(1, most))]
        if self.rng.random() < 0.3:
            parts[0] = f"{self.pick('<b>|<em>|<i>')}{parts[0]}{self.pick('</b>|</em>|</i>|')}"
        if self.rng.random() < 0.3:
            parts.append(f'<a href="/x">{self.sentence(1, 4)}</a>')
        return " ".join(parts)

    def links(self) -> str:
        items = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in self.rng.sample(self.words, self.rng.randrange(2, 9)))
        return self.pick("<ul>|<ol>|<ul class='x1'>") + items + "</ul>"

    def named(self, names: str) -> str:
        """A div or section whose class, id or role is one of ``names``."""
        attribute = self.pick("class|id|class|class|role")
        name = self.pick(names)
        extra = self.pick("||-1| block| x2|_wrap| col-4")
        return f'<{self.pick("div|div|div|section")} {attribute}="{name}{extra}" data-label="other">'

    def within(self, opening: str, *parts: str) -> str:
        return f"{opening}{''.join(parts)}</{opening[1:].split('>')[0].split()[0]}>"

    def other(self, inside: bool) -> str:
        """One part that is not main text."""
        r = self.rng
        which = r.choice("menu crumbs head foot side notice ad ad comment share form".split())
        three = [f'<a href="/">{w}</a>' for w in r.sample(self.words, 3)]
        title, note = f"<h3>{self.sentence(1, 4)}</h3>", r.choice(["{}", "<p>{}</p>"]).format(self.prose(4))
        if which == "menu":
            return self.within(r.choice(['<nav data-label="other">', self.named("nav|menu|main-menu|navbar|toc")]), self.links())
        if which == "crumbs":
            return self.within(self.named("breadcrumb|breadcrumbs|pagination"), " &raquo; ".join(three))
        if which == "head":
            named = self.named("masthead|site-header|branding|page-header")
            opening = named if inside or r.random() < 0.5 else '<header data-label="other">'
            return self.within(opening, title, f"<p>{self.sentence(1, 7)}</p>")
        if which == "foot":
            opening = r.choice(['<footer data-label="other">', self.named("footer|copyright|site-footer|legal")])
            return self.within(opening, self.pick("&copy; |(c) |"), self.sentence(1, 6), " &middot; ", self.prose(3))
        if which == "side":
            opening = r.choice(['<aside data-label="other">', self.named("sidebar|related|widget|related-posts|popular")])
            return self.within(opening, title, r.choice([self.links(), note]))
        if which == "notice":
            return self.within(self.named("cookie-notice|notice|alert|consent-banner|newsletter|popup|gdpr|subscribe"), note)
        if which == "ad":
            body = r.choice([note, f"<a href='/buy'>{self.sentence(2, 9)}</a>"])
            return self.within(self.named("ad|ads|advert|ad-slot|sponsored|promo|advertisement|adBox"), body)
        if which == "comment":
            said = [
                self.within(f'<{self.pick("div|li|article")} class="comment">', f"<b>{r.choice(self.words)}</b>", note)
                for _ in range(r.randrange(1, 5))
            ]
            return self.within(self.named("comments|comment-list|discussion|replies"), title, *said)
        if which == "share":
            return self.within(self.named("share|social|share-buttons|follow-us"), *three)
        return self.within('<form action="/s" data-label="other">', f"<label>{self.sentence(1, 4)}</label>", note, '<input name="q">')

    def main_block(self) -> str:
        which = self.rng.random()
        if which < 0.08:
            line = self.sentence(1, 5)
            return "".join(f"<p>{line}</p>" for _ in range(self.rng.randrange(2, 16)))
        if which < 0.62:
            return f"<p>{self.prose()}" + self.pick("</p>|</p>|</p>|")
        if which < 0.7:
            return self.within(f"<h{self.rng.randrange(2, 5)}>", self.sentence(1, 8))
        if which < 0.76:
            return "<ul>" + "".join(f"<li>{self.prose(3)}</li>" for _ in range(self.rng.randrange(1, 5))) + "</ul>"
        if which < 0.8:
            return f"<blockquote><p>{self.prose(4)}</p></blockquote>"
        if which < 0.84:
            return f"<pre>{self.sentence()}\n  {self.sentence()}</pre>"
        if which < 0.88:
            return f"<table><tr><th>{self.sentence(1, 3)}</th><td>{self.sentence(1, 6)}</td></tr></table>"
        if which < 0.92:
            return f"<figure><img src='x'><figcaption>{self.sentence()}</figcaption></figure>"
        return f"<p><b>{self.sentence()}<br><p>{self.prose()}</p>"

    def page(self) -> str:
        r = self.rng
        head = f"<!DOCTYPE html><html><head><title>{self.sentence()}</title><style>p{{x:1}}</style><script>if(a<b)c()</script></head><body>"
        blocks = [self.main_block() for _ in range(r.choice([0, 1, 2, 4, 8, 14]) + r.randrange(2))]
        if r.random() < 0.8 or not blocks:
            blocks.insert(0, r.choice(["<h1>{}</h1>", "<h1 class='title'>{}</h1>", "<header><h1>{}</h1></header>"]).format(self.sentence(1, 12)))
        for _ in range(r.choice([0, 0, 1, 2])):
            blocks.insert(r.randrange(len(blocks) + 1), self.other(True))
        name = self.pick('article|main|div class="content"|div class="post-body"|div id="article"|section class="entry"|div class="x3"|div|section|td')
        body = "".join(blocks)
        if name == "td":
            body = f'<table><tr><td data-label="main">{body}</td></tr></table>'
        else:
            body = f'<{name} data-label="main">{body}</{name.split()[0]}>'
        if r.random() < 0.3:
            body = f'<{self.pick("main|div")}{self.pick("| class=wrap| id=page")}>{body}'
        parts = [self.other(False) for _ in range(r.randrange(1, 5))] + [body] + [self.other(False) for _ in range(r.randrange(1, 5))]
        out = head + "".join(parts) + "</body></html>"
        return out[: r.randrange(len(out) // 2, len(out))] if r.random() < 0.1 else out


def labelled_pages(count: int, seed: int) -> list[str]:
    """``count`` pages of different layouts with labelled parts; the same for the same seed."""
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]

"""Main-text extraction by a tree-structured graphical model (operator 3).

Every block element of a page is a binary variable (content or not).  Node
potentials come from tag role, class and id words, the zone around, text length
and link share;
parent-child potentials from how labels pass from parent to child.  Both are
counted, with add-one smoothing, on the labelled pages below.  Sum-product
messages go up from the leaves and down from the root, which is exact on a
tree, and blocks whose content marginal passes one half are the main text.

Pages are independent rows: one scan, no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from riskframe.llm.words import slices

#: Fixed roles of tags; tags not listed are inline and belong to the block around them.
ROLES = {
    "main": "article main", "text": "p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt td th caption",
    "list": "ul ol li dl menu", "box": "div section body html table tbody thead tfoot tr figure details summary center fieldset address hgroup",
    "nav": "nav", "head": "header", "foot": "footer", "side": "aside dialog", "form": "form button select textarea label option legend",
}
ROLE = {tag: role for role, tags in ROLES.items() for tag in tags.split()}
DROPPED = frozenset("head script style noscript template svg iframe object canvas audio video title".split())
#: Start tags that may stand in a head; any other one ends it (its end tag may be left out).
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of these when it meets one before any element of the second set.
CLOSES = {**{t: ("p", "") for t in ROLE}, "li": ("p li", "ul ol menu"), "dt": ("p dt dd", "dl"), "dd": ("p dt dd", "dl"),
          "tr": ("p td th tr", "table"), "td": ("p td th", "table tr"), "th": ("p td th", "table tr"),
          "option": ("option", "select")}
#: Fixed words in class, id and role that hint at the kind of a block: the first kind in this order that occurs.
HINTS = {
    "ad": r"\b(ads?|advert\w*|sponsor\w*|promo\w*|banner)\b", "comment": r"comment|reply|replies|discuss|disqus|respond",
    "notice": r"cookie|notice|consent|gdpr|alert|popup|modal|newsletter|subscri|paywall|privacy", "side": r"side|widget|related|recommend|trending|popular|tags?\b",
    "nav": r"nav|menu|bread|crumb|pagination|pager|skip|toc\b", "share": r"share|social|follow", "edge": r"header|footer|masthead|copyright|legal|top\b|bottom",
    "form": r"form|search|login|signup", "content": r"content|article|post|entry|story|main|body|text",
}
HINT = {k: re.compile(v) for k, v in HINTS.items()}
#: Labelled pages: blocks marked with ``gold`` (and only those) are content.
LABELLED = (
    "<body><nav><ul><li><a>Home</a></li><li><a>World</a></li><li><a>Sport</a></li></ul></nav><div class=ad>Buy this today and save much money now.</div>"
    "<article gold><h1 gold>A title</h1><p gold>Long text about something that happened in the town yesterday, told in many words.</p><p gold>Short.</p>"
    "<ul gold><li gold>First point of the story</li><li gold>Second point</li></ul><blockquote gold>He said so himself.</blockquote></article>"
    "<footer>Copyright, all rights reserved by the makers of this page.</footer></body>",
    "<body><header><h1><a>Site</a></h1><p>The best site there is</p><form><input><button>Search</button></form></header><main gold><article gold><h2 gold>Title here</h2>"
    "<div gold><p gold>Some words that make a paragraph of a story, long enough to look like one of them.</p><p gold>And more words follow here.</p>"
    "<pre gold>code line</pre><table gold><tr gold><td gold>Cell one</td><td gold>Cell two</td></tr></table></div></article></main>"
    "<aside><h3>Related</h3><ul><li><a>Another story you may like</a></li><li><a>More</a></li></ul></aside><footer><p>Contact</p><div><a>Terms</a></div></footer></body>",
    "<body><div id=header><div class=menu><a>Start</a> <a>About</a></div></div><div class=cookie-notice><p>We use cookies to make this page better for you.</p><button>Accept</button></div>"
    "<div id=content gold><h1 gold>Heading</h1><p gold>Plain paragraph with a fair number of words and <a>one link</a> inside of it, then the end.</p><p gold>Yes.</p>"
    "<div class=share><a>Tweet</a></div><div gold><p gold>Another paragraph, deeper in the page than the one before it was.</p></div></div>"
    "<div class=sidebar><h3>Popular</h3><p>Ten things that you did not know about the sea and its many fish.</p></div>"
    "<div id=comments><h3>Comments</h3><div class=comment><p>I liked this story very much, thanks to the author for writing it.</p></div><form><textarea></textarea><label>Name</label></form></div></body>",
    "<body><div class=post gold><h1 gold>Post</h1><div class=entry gold><p gold>Today I went out and saw many things which I will tell you about in this post.</p>"
    "<h3 gold>Part two</h3><p gold>And then it rained, so I went home again and wrote.</p><ol gold><li gold>One</li></ol></div></div>"
    "<section class=comments><h2>2 replies</h2><article class=comment><p>First of all I want to say that this is a rather long comment of a reader.</p></article>"
    "<article class=comment><p>Me too!</p></article></section><div class=newsletter><p>Subscribe to our letter and never miss a post again.</p><form><input></form></div></body>",
    "<body><div class=banner><p>Big sale this week only, do not miss it.</p></div><section gold><h1 gold>Section title</h1><p gold>Text of the section, as long as a paragraph tends to be, with a comma or two, and a full stop.</p></section>"
    "<section class=related><h2>Read next</h2><ul><li><a>A</a></li><li><a>B</a></li></ul></section><div class=ad>Advert text with several words in it to read.</div></body>",
    "<body><article gold><header><p>By someone, at noon</p></header><h1 gold>Inside</h1><p gold>The text of the article stands here and goes on for a while until it ends.</p><aside>See also the other page on this matter.</aside>"
    "<div class=ad>Sponsored words that nobody asked for.</div><p gold>It then goes on after the advert, as if nothing had happened in between.</p><footer>Filed under things</footer></article></body>",
    "<body><article gold><header><h2>The Paper</h2><p>Written by a person on a day in May</p></header><section gold><h1 gold>Head</h1><p gold>First of many paragraphs, this one has some more words than others have.</p></section>"
    "<form><p>Type your mail here to get our letter each day</p><label>Mail</label><button>Send</button></form><section gold><p gold>The second section goes on from here, still part of the story.</p></section>"
    "<aside class=sidebar><h4>More</h4><p>Side words that are as long as any paragraph of the story could be, or longer.</p></aside><footer><p>Posted in the news, all rights kept by the owner.</p></footer></article></body>",
    "<body><header><div><p>Welcome to the site of the whole town and its people</p></div></header><main gold><section gold><h2 gold>One</h2><div gold><p gold>Words of the story, some of them long and some of them short.</p></div></section>"
    "<section gold><h2 gold>Two</h2><p gold>Words.</p><dl gold><dt gold>Term</dt><dd gold>What the term means</dd></dl></section><section class=comments><p>A reader says that all of this is wrong, and gives no reason for it.</p></section>"
    "<aside><div><p>Other pages of ours that you may like to read as well as this one</p></div></aside></main><footer><div><p>Write to us at the town hall, or come by on any day of the week.</p></div></footer></body>",
    "<body><nav><a>In</a><a>Out</a></nav><form><p>Please sign in before you read this page of ours</p><input><label>Name</label></form><dialog><p>This page keeps data about you, is that fine with you or not?</p><button>Yes</button></dialog>"
    "<article gold><h1 gold>A plain one</h1><div gold><div gold><p gold>Deep in the page there is a paragraph, and it has many words in it.</p></div></div><aside><p>By the way, here is something else.</p></aside></article><footer>The end of the page</footer></body>",
    "<body><div><h1 gold>No classes at all</h1><p gold>This page has no classes, yet its paragraphs are long enough to be told from the rest of the page around them.</p><p gold>Bye now.</p></div><div><a>One</a> <a>Two</a> <a>Three</a></div></body>",
)


class _Tree(HTMLParser):
    """Block elements with parents, features' raw material, and text runs in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.attrs, self.chars, self.linked, self.gold = [-1], ["html"], [""], [0], [0], [False]
        self.runs: list[tuple[int, list[str]]] = []
        self.stack: list[tuple[str, int]] = [("html", 0)]
        #: Places of block elements in the stack, and for each how often every inline tag is open right inside it.
        self.blocks: list[int] = [0]
        self.inline: list[Counter] = [Counter()]
        self.open = Counter()   # block elements by tag
        #: The block made for text that stands in the body itself, until a block element ends it.
        self.loose: int | None = None
        self.links, self.html = 0, html
        #: Open elements from the outermost dropped one inwards; none outside of dropped elements.
        self.dropped: list[str] = []
        self.last_end: dict[str, tuple[int, int]] = {}
        self.feed(html[:_end_of_tags(html)])
        self.close()

    def handle_starttag(self, tag, attrs):
        if self.dropped and self._ends_dropped(tag):
            self.dropped = []
        if self.dropped or tag in DROPPED:
            if tag not in VOID:
                self.dropped.append(tag)
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self._text(" ")
            if tag == "hr":
                self.loose = None
            return
        if tag in CLOSES:
            ends, stops = (x.split() for x in CLOSES[tag])
            self._close(ends, stops)
        if tag in ROLE and tag not in ("html", "body"):
            self.loose = None
            node = self._node(tag, " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower(),
                              any(k == "gold" for k, _ in attrs))
            self.blocks.append(len(self.stack))
            self.inline.append(Counter())
            self.open[tag] += 1
            self.stack.append((tag, node))
        elif tag not in ("html", "body"):
            self.stack.append((tag, self.stack[-1][1]))
            self.inline[-1][tag] += 1
            self.links += tag == "a"

    def _node(self, tag: str, attrs: str, gold: bool) -> int:
        for column, v in ((self.parent, self.stack[-1][1]), (self.tag, tag), (self.attrs, attrs), (self.gold, gold),
                          (self.chars, 0), (self.linked, 0)):
            column.append(v)
        return len(self.tag) - 1

    def _unclosed(self, tag: str) -> bool:
        """No end tag of ``tag`` follows the current place."""
        if tag not in self.last_end:
            at = max((m.start() for m in re.finditer(rf"</{tag}(?![\w-])", self.html, re.I)), default=-1)
            self.last_end[tag] = (self.html.count("\n", 0, at) + 1, at - self.html.rfind("\n", 0, at) - 1) if at >= 0 else (0, 0)
        return self.getpos() > self.last_end[tag]

    def _ends_dropped(self, tag: str) -> bool:
        """Whether a start tag ends the dropped element: a head at the first body-level tag, and one without
        an end tag at the next block, where no enclosing block is left that could end it."""
        top, inner = self.dropped[0], self.dropped[-1]
        if top == "head":
            return tag == "body" or (tag not in IN_HEAD and (inner == "head" or (tag in ROLE and self._unclosed(inner))))
        return tag in ROLE and len(self.blocks) == 1 and self._unclosed(top)

    def set_cdata_mode(self, elem, **kw):
        """Raw text runs to the end tag; an iframe or title that lacks one is read like any other element."""
        if elem not in ("iframe", "title") or not self._unclosed(elem):
            super().set_cdata_mode(elem, **kw)

    def _close(self, ends, stops):
        """Pop to the outermost element of ``ends`` above any element of ``stops`` or any other block."""
        cut = None
        for at in range(len(self.blocks) - 1, 0, -1):
            if self.stack[self.blocks[at]][0] not in ends:
                break
            cut = self.blocks[at]
        if cut is not None:
            self._pop(cut)

    def _pop(self, cut: int):
        for tag, _ in self.stack[cut:]:
            self.links -= tag == "a"
            if tag not in ROLE:
                self.inline[-1][tag] -= 1       # inline tags above the last block; those of popped blocks go with them
        while self.blocks[-1] >= cut:
            self.open[self.stack[self.blocks.pop()][0]] -= 1
            self.inline.pop()
            self.loose = None
        del self.stack[cut:]

    def handle_endtag(self, tag):
        if tag in self.dropped:
            while self.dropped.pop() != tag:
                pass
            return
        if tag in ("html", "body", "head"):
            self.dropped = []
            return
        if tag in ROLE:
            at = next(i for i in reversed(self.blocks) if self.stack[i][0] == tag) if self.open[tag] else None
        elif self.dropped or not self.inline[-1][tag]:
            return      # no such element is open inside the innermost block
        else:
            at = next(i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == tag)
        if at is not None:
            self.dropped = []
            self._pop(at)

    def handle_startendtag(self, tag, attrs):
        if tag not in DROPPED:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_data(self, data):
        if self.dropped == ["head"] and data.strip():
            self.dropped = []
        if not self.dropped:
            self._text(data)

    def _text(self, data):
        node = self.stack[-1][1]
        n = len(data.strip())
        if node == 0:       # text of the body itself is a block of its own
            if self.loose is None:
                if not n:
                    return
                self.loose = self._node("p", "", False)
            node = self.loose
        self.chars[node] += n
        if self.links:
            self.linked[node] += n
        if self.runs and self.runs[-1][0] == node:
            self.runs[-1][1].append(data)
        else:
            self.runs.append((node, [data]))


def _end_of_tags(html: str) -> int:
    """Where a tag starts that the page's end cuts off; such a tag is no text."""
    found = re.compile(r"<[A-Za-z/!?]").search(html, html.rfind(">") + 1)
    return found.start() if found else len(html)


@lru_cache(maxsize=4096)
def _hint(attrs: str) -> str:
    return next((k for k, pattern in HINT.items() if pattern.search(attrs)), "none") if attrs else "none"


def _zones(t: _Tree) -> list[str]:
    """For every node, the kind of the nearest element around it (or itself) that sets a zone apart."""
    zones = ["none"]
    for i in range(1, len(t.tag)):
        role, hint = ROLE.get(t.tag[i], "box"), _hint(t.attrs[i])
        own = role if role in ("nav", "head", "foot", "side", "form") else hint if hint not in ("none", "content") else ""
        zones.append(own or zones[t.parent[i]])
    return zones


def _features(t: _Tree, i: int, zone: str) -> tuple[str, ...]:
    share = t.linked[i] / t.chars[i] if t.chars[i] else -1.0
    size = t.chars[i]
    return ("role=" + ROLE.get(t.tag[i], "box"), "hint=" + _hint(t.attrs[i]), "zone=" + zone,
            "links=" + ("none" if share < 0 else "low" if share < 0.4 else "high"),
            "size=" + ("0" if not size else "short" if size < 60 else "long"))


@lru_cache(maxsize=1)
def model() -> tuple[dict, list[list[float]], float]:
    """(log potential pairs by feature, log parent-child potentials, log prior of a root's child) from LABELLED."""
    seen, total, link, values = Counter(), Counter(), Counter(), {}
    for html in LABELLED:
        t = _Tree(html)
        zones = _zones(t)
        for i in range(1, len(t.tag)):
            y, up = t.gold[i], t.parent[i]
            total[y] += 1
            link[t.gold[up], y] += 1
            for f in _features(t, i, zones[i]):
                seen[f, y] += 1
                values.setdefault(f.split("=")[0], set()).add(f)
    node = {f: [math.log((seen[f, y] + 1) / (total[y] + len(fs) + 1)) for y in (False, True)]
            for fs in values.values() for f in fs}
    # Pairwise potentials are ratios to independence, since node potentials carry the class sizes.
    whole = sum(total.values())
    pair = [[math.log((link[a, b] + 1) / (link[a, False] + link[a, True] + 2) / ((total[b] + 1) / (whole + 2)))
             for b in (False, True)] for a in (False, True)]
    prior = [math.log((total[y] + 1) / (whole + 2)) for y in (False, True)]
    return node, pair, prior


@lru_cache(maxsize=4096)
def _potential(features: tuple[str, ...]) -> tuple[float, float]:
    node, _, prior = model()
    return tuple(p + sum(node.get(f, (0.0, 0.0))[y] for f in features) for y, p in enumerate(prior))


def _sum(a: float, b: float) -> float:
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def marginals(t: _Tree) -> list[float]:
    """Content marginal of every node: messages up (children have larger numbers), then down."""
    pair = model()[1]
    n, zones = len(t.tag), _zones(t)
    own = [[0.0, -30.0]] + [list(_potential(_features(t, i, zones[i]))) for i in range(1, n)]
    up = [[0.0, 0.0] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        for a in (0, 1):
            up[i][a] = _sum(pair[a][0] + own[i][0], pair[a][1] + own[i][1])
        for a in (0, 1):
            own[t.parent[i]][a] += up[i][a]
    full = [own[0]] + [None] * (n - 1)
    out = [0.0] * n
    for i in range(1, n):
        above = [full[t.parent[i]][a] - up[i][a] for a in (0, 1)]
        full[i] = [own[i][b] + _sum(above[0] + pair[0][b], above[1] + pair[1][b]) for b in (0, 1)]
        out[i] = 1.0 / (1.0 + math.exp(min(700.0, full[i][0] - full[i][1])))
        shift = max(full[i])
        full[i] = [x - shift for x in full[i]]
    return out


def main_text(html: str | None) -> tuple[str, int, float]:
    """(main text, blocks kept, least marginal among them) of one page."""
    if not html:
        return "", 0, 1.0
    t = _Tree(html)
    p = marginals(t)
    kept = [(" ".join("".join(parts).split()), p[i]) for i, parts in t.runs if p[i] > 0.5]
    kept = [(text, q) for text, q in kept if text]
    return "\n".join(text for text, _ in kept), len(kept), min((q for _, q in kept), default=1.0)


def _extract(batches):
    for b in slices(batches, "html", 8 << 20):
        got = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array([g[0] for g in got], pa.string()),
             pa.array([len(g[0]) for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
             pa.array([g[2] for g in got], pa.float64())],
            names=["page_id", "url", "text", "n_chars", "n_blocks", "least_marginal"])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_blocks, least_marginal.

    Reads page_id, url and html only, so other columns may have any name.
    NULL and empty pages, and pages without content, have an empty text;
    broken markup is read as far as it goes; repeated rows give equal rows; an
    empty table an empty result.
    """
    return pages.selectExpr("cast(page_id AS bigint) AS page_id", "cast(url AS string) AS url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long, n_blocks long, least_marginal double")

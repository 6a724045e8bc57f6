"""Main text of web pages by tag-path ratios.

A page is read into blocks of text (what stands between block-level tags), each at the end of a
root-to-leaf path of tags. Blocks of one path share its ratios: characters outside links a block, and
punctuation marks a block. Both are smoothed along the page by a Gaussian, averaged over each
path again, and fused; paths whose fused score reaches a share of the mean (weighted by text) are
content. The element that holds most of what they hold is the article, and its blocks are the text,
in page order; paths of it that are links for the most part are menus.

Parts that say what they are never count: elements such as nav, footer and form, roles, hidden
parts, and classes or ids with a word such as sidebar or comments.

No row leaves its task; a page must fit in one.
"""

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import lean

#: Paths count as content from this share of the mean score, weighted by text.
SHARE = 0.25
#: The article is the smallest element that holds so much of the content's text.
MOST = 0.6
#: Paths with more of their text in links are menus.
LINKS = 0.8
#: The Gaussian's weights for a block and its neighbours.
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)

# Elements of HTML by kind, and words that name what is no article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
IN_HEAD = set("base link meta script style title noscript template".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr td th caption figcaption".split())
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
NOT_TEXT = set("head title script style noscript template nav footer aside form button select textarea iframe object svg canvas audio video map menu dialog".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status".split())
WORDS = set(
    """nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar toolbar
    ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promotion banner
    cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login
    social share sharing sharebar related recommended recommendations comment comments commentlist reply replies respond disqus discussion
    pagination pager copyright legal disclaimer skip search searchform""".split()
)
OTHERS = set("comment comments reply ad ads advert sponsored promo related recommended".split())
STATES = set("has is with without no".split())
OWN_HEAD = set("article entry post story content".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
MARKS = ".,;:!?…。、，；：！？"

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page(HTMLParser):
    """The blocks of a page: element, text, characters outside links, and punctuation marks of each."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        # elements: parent, tag, path and whether it is left out by what it is (1) or is called (2)
        self.parent, self.tag, self.path, self.out = [-1], [""], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.open = [0]
        self.blocks: list[tuple[int, str, int, int]] = []
        self.parts: list[tuple[str, bool]] = []
        self.linked = False
        self.feed(html)
        self.close()
        self._end_block()

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                free = sum(len(t.strip()) for t, linked in self.parts if not linked)
                self.blocks.append((self.open[-1], text, free, sum(map(text.count, MARKS))))
            self.parts = []
        self.linked = False

    def _push(self, tag: str, out: int) -> None:
        up = self.open[-1]
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(self.path[up] if tag in INLINE else self.paths.setdefault((self.path[up], tag), len(self.paths) + 1))
        self.out.append(out)
        self.open.append(len(self.tag) - 1)

    def _close(self, tags: set, fences: set) -> None:
        """Close the open element nearest to the top that is one of tags, unless one of fences is nearer."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in tags:
                del self.open[k:]
                return
            if tag in fences:
                return

    def _left_out(self, tag: str, attrs: dict) -> int:
        if tag in NOT_TEXT or "hidden" in attrs or attrs.get("aria-hidden") == "true" or (attrs.get("role") or "").strip().lower() in ROLES or _HIDDEN.search(attrs.get("style") or ""):
            return 1
        inside = any(self.tag[e] == "article" for e in self.open)
        if tag == "header":
            return 0 if inside else 1
        if tag in ("html", "body", "main"):
            return 0
        names = [[w.lower() for w in _WORD.findall(x)] for a in ("class", "id") for x in (attrs.get(a) or "").split()]
        words = {w for x in names if x and x[0] not in STATES for w in x}
        found = words & (OTHERS if tag == "article" else WORDS)
        if found == {"header"} and (inside or words & OWN_HEAD):
            return 0
        return 2 if found else 0

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "br":
            self.parts.append((" ", self.linked))
            return
        inline = tag in INLINE
        if not inline or tag == "img":
            top = self.tag[self.open[-1]]
            if top == "head" and tag not in IN_HEAD:
                self.open.pop()
        if not inline:
            self._end_block()
            if tag in ENDS_P:
                self._close({"p"}, ENDS_P - {"p"} | {"td", "th", "li", "button"})
            if tag in CLOSES:
                self._close_run(CLOSES[tag], FENCES[tag])
        if tag in VOID:
            return
        if tag == "a":
            self.linked = True
        out = self._left_out(tag, attrs) if attrs or not inline else 0
        if inline and not out and not self.out[self.open[-1]]:
            return
        if inline and self.parts:
            # an inline part that is left out: the text before it is kept apart from it, in one block
            self._push(tag, out)
            return
        if tag in ("article", "main") and out == 0:
            for e in self.open:  # what holds the article is not left out for its name
                if self.out[e] == 2:
                    self.out[e] = 0
        self._push(tag, out)

    def _close_run(self, tags: set, fences: set) -> None:
        while True:
            n = len(self.open)
            self._close(tags, fences)
            if len(self.open) == n:
                return

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in INLINE:
            self._end_block()

    def handle_endtag(self, tag):
        if tag == "a":
            self.linked = False
        if tag in INLINE:
            for k in range(len(self.open) - 1, 0, -1):
                above = self.tag[self.open[k]]
                if above == tag:
                    del self.open[k:]
                    return
                if above not in INLINE:
                    return
            return
        self._end_block()
        if tag in VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[k]] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        top = self.open[-1]
        if self.tag[top] in INLINE and self._out(top):
            return
        self.parts.append((data, self.linked))

    def _out(self, element: int) -> bool:
        while element:
            if self.out[element]:
                return True
            element = self.parent[element]
        return False


def scores(path: np.ndarray, length: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The fused score of each block's path, from the blocks' paths, lengths and punctuation, in page order."""
    _, at = np.unique(path, return_inverse=True)
    n = np.bincount(at)
    weight = np.convolve(np.ones(len(at)), KERNEL, "full")[2:-2]
    smooth = []
    for x in (length, marks):
        ratio = (np.bincount(at, x) / n)[at]
        near = np.convolve(ratio, KERNEL, "full")[2:-2] / weight
        smooth.append(np.bincount(at, near) / n)
    return (smooth[0] * (1 + smooth[1]))[at]


def main_blocks(html: str | None) -> list[str]:
    """The blocks of the article of a page, in page order. Null and empty pages have none."""
    if not html:
        return []
    page = Page(html)
    out = np.array(page.out) > 0
    inside = np.array(page.parent)
    for e in range(1, len(out)):
        out[e] |= out[inside[e]]
    blocks = [b for b in page.blocks if not out[b[0]]]
    if not blocks:
        return []
    element = np.array([e for e, *_ in blocks])
    path = np.array(page.path)[element]
    length, marks = (np.array([b[k] for b in blocks], float) for k in (2, 3))
    score = scores(path, length, marks)
    whole = np.array([len(b[1]) for b in blocks], float)
    chosen = score >= SHARE * (np.average(score, weights=length) if length.any() else 0)
    # what each element holds of the chosen text, from the leaves up
    holds = np.bincount(element[chosen], whole[chosen], len(out))
    for e in range(len(out) - 1, 0, -1):
        holds[inside[e]] += holds[e]
    home = 0
    for e in range(1, len(out)):  # elements come after those that hold them
        if inside[e] == home and holds[e] >= MOST * holds[0] and page.tag[e] not in LEAVES:
            home = e
    # the article that it is part of, if the page names one; else the heading before it belongs to it
    up = home
    while up:
        if page.tag[up] == "article":
            home = up
        up = inside[up]
    within = np.zeros(len(out), bool)
    within[home] = True
    for e in range(home + 1, len(out)):
        within[e] = within[inside[e]]
    mine = within[element]
    if not any(page.tag[e] == "h1" for e in element[mine]):
        above, up = set(), int(home)
        while up > 0:
            up = int(inside[up])
            above.add(up)
        first = int(np.argmax(mine))
        for k in range(first - 1, -1, -1):
            if page.tag[element[k]] == "h1" and int(inside[element[k]]) in above:
                mine[k] = True
                break
    _, at = np.unique(path, return_inverse=True)
    free = np.bincount(at, length) / np.maximum(np.bincount(at, whole), 1)
    heading = np.array([bool(re.fullmatch("h[1-6]", page.tag[e])) for e in element])
    menu = (free[at] < 1 - LINKS) & ~heading
    return [b[1] for b, m, x in zip(blocks, mine, menu, strict=True) if m and not x]


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key (as long), url, text and n_chars (code points): a row for each row of pages.

    Blocks are joined by a newline, white space within one is one space, character references are
    decoded. Null and empty pages, and those without any text, have the empty text; pages whose text
    is all menus, too. Null and repeated keys are kept as they are; an empty table gives no rows.
    """
    given = pages.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                text = ["\n".join(main_blocks(h)) for h in part["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["key"], part["url"], pa.array(text, pa.string())], names=["key", "url", "text"])

    found = given.mapInArrow(lean(run), "key long, url string, text string")
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))


#: The article element of these tables' pages, by its markup.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' ', 'g'), '</?b>', '', 'g') AS a FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(p|h1)>'), lambda x: trim(regexp_replace(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#(x27|39);', '''', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b FROM a),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(b, lambda x: x <> ''), chr(10)), '') AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""

"""Main text by tag-path ratios: pages of several makes, awkward tables, and the whole query."""

import re
from html import unescape

import numpy as np
import pytest

from gridloom.llm import queries, tagpaths
from tests.llm.helpers import with_clashes

SF = "/root/testdata/sf0.001"

P = ["The committee met on Tuesday, after months of delay, to settle the matter.", "Nobody, it seems, had read the report; few had even opened it.", "A vote is expected in the autumn. Until then, little will change."]
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul></nav>'
BODY = "".join(f"<p>{p}</p>" for p in P)
WHOLE = ["Council talks", *P]


def text(html):
    return tagpaths.main_blocks(html)


LAYOUTS = {
    "article": f"<html><head><title>x</title></head><body>{NAV}<article><h1>Council talks</h1>{BODY}</article><footer>&copy; All rights reserved, 2020.</footer></body></html>",
    "divs": f'<body><div id="top-menu"><a href="/">Home</a> <a href="/w">World</a></div><div class="wrap"><div class="post"><h1>Council talks</h1>{BODY}</div><div class="sidebar"><p>Read this, too: ten ways to sleep well, every single night.</p></div></div></body>',
    "comments": f'<body><main><h1>Council talks</h1>{BODY}<section id="comments"><h2>Comments</h2><article class="comment"><p>I have said so for years, and nobody listened to me; a shame, truly, for all of us here.</p></article></section></main></body>',
    "forms": f'<body><header><p>The Daily News, since 1900.</p></header><div><h1>Council talks</h1>{BODY}<form><p>Your name, please.</p><input name=a><button>Send</button></form></div><aside>Weather: sunny, mild.</aside></body>',
    "notices": f'<body><div class="cookie-notice"><p>We use cookies, as everyone does; click to agree, please.</p></div><div><div><h1>Council talks</h1>{BODY}</div></div><div role="alert">Breaking: storm, now.</div></body>',
    "unclosed": f'<body>{NAV}<div class=main><h1>Council talks<p>{P[0]}<p><b>{P[1]}<p>{P[2]}</div><div class="ad"><p>Buy now, pay later.',
    "scripts": f'<body><script>var a = "<p>not, text.</p>";</script><style>p {{ color: red; }}</style><!-- <p>gone, too.</p> --><div><h1>Council <em>talks</em></h1>{BODY}</div><noscript><p>Please, enable scripts.</p></noscript>',
    "hidden": f'<body><div hidden><p>Not seen, at all, by anyone.</p></div><article class="has-sidebar"><h1>Council\n talks</h1>{BODY}<p style="display: none">Nor this, ever.</p><div aria-hidden="true">Nor that.</div></article>',
    "menu without a name": f'<body><div><h1>Council talks</h1>{BODY}<ul><li><a href="/1">First other story</a></li><li><a href="/2">Second other story</a></li></ul></div></body>',
    "heading outside": f"<body>{NAV}<div><h1>Council talks</h1><div>{BODY}</div></div></body>",
    "bad name around the article": f'<body class="menu-open"><div class="search-layout">{NAV}<article><h1>Council talks</h1>{BODY}</article></div></body>',
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert text(LAYOUTS[name]) == WHOLE


def test_blocks_and_references():
    assert text("<article><h1>A&amp;B</h1><p>x&nbsp;&#233;&eacute;\n\t y<br>z <a href='/'>li</a>nk<b>ed</b></p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>") == ["A&B", "x éé y z linked", "one", "two", "c1", "c2"]
    assert text("only text, no tags at all") == ["only text, no tags at all"]
    assert text("<p>a <span class='ad'>buy <span>this</span> now</span> b</p>") == ["a b"]
    assert text("<<<>>> & &amp <p") != [] and text(None) == [] and text("") == [] and text("<nav><a>x</a></nav>") == []


def test_words_without_marks_and_short_articles():
    assert text("<body><article><h1>Ein</h1><p>Ein</p></article><div class='ad'>A long advert, with marks, and more of them; buy it.</div></body>") == ["Ein", "Ein"]
    assert text(f"<body>{NAV}<div><p>no marks here but words enough to tell it from a menu of links</p><p>and once more words without marks in a row that goes on</p></div></body>") == ["no marks here but words enough to tell it from a menu of links", "and once more words without marks in a row that goes on"]


def test_scores_follow_the_definition():
    """Aggregate by path, smooth along the page, average by path again, fuse."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 12))
        path, size, marks = rng.integers(0, 4, n), rng.integers(1, 200, n).astype(float), rng.integers(0, 9, n).astype(float)
        fused = []
        for x in (size, marks):
            ratio = [np.mean([x[j] for j in range(n) if path[j] == path[i]]) for i in range(n)]
            near = []
            for i in range(n):
                w = {j: np.exp(-0.5 * (i - j) ** 2) for j in range(max(0, i - 2), min(n, i + 3))}
                near.append(sum(w[j] * ratio[j] for j in w) / sum(w.values()))
            fused.append([np.mean([near[j] for j in range(n) if path[j] == path[i]]) for i in range(n)])
        want = [a * (1 + b) for a, b in zip(*fused, strict=True)]
        assert np.allclose(tagpaths.scores(path, size, marks), want)


def test_a_page_of_a_megabyte():
    page = f"<body>{NAV}<article>" + "".join(f"<p>{p} {k}.</p>" for k in range(4000) for p in P) + "</article>" + "<div>" * 3000
    assert len(text(page)) == 12000


def test_whole_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op12_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


def test_awkward_tables(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", LAYOUTS["article"]), (4, "u", LAYOUTS["divs"]), (4, None, LAYOUTS["divs"]), (5, "u", "<p>\x00 \U0001f600</p>")]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string")).withColumnRenamed("n", "text")
    got = tagpaths.extract(df).collect()
    whole = "\n".join(WHOLE)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted([(1, None, "", 0), (2, "u", "", 0), (None, "u", whole, len(whole)), (4, "u", whole, len(whole)), (4, None, whole, len(whole)), (5, "u", "\x00 \U0001f600", 3)], key=key)
    assert tagpaths.extract(df.limit(0)).count() == 0

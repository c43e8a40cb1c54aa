import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendora.llm import html_content as H
from vendora.llm.queries import QUERIES

P1 = "A first paragraph with quite a number of words that tell a story about things."
P2 = "The second one goes on for a while &amp; says caf&eacute; &#8212; and more of what came before it."
D2 = "The second one goes on for a while & says café — and more of what came before it."

PAGES = {
    "divs without article": (
        f"<body><div id=header><a href=/>Home</a></div><div class='side-bar sidebar'><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>"
        f"<div class=content><h2>Title</h2><p>{P1}<p>{P2}<p>So.<div class='comments'><p>Great post, thank you so much for writing it all down!</p></div></div>"
        f"<div class=cookie-notice>We use cookies to make this site work for you and for us.</div></body>",
        f"Title\n{P1}\n{D2}\nSo.",
    ),
    "article with header, form, aside and ad": (
        f"<main><article><header><h1>Head</h1></header><p>{P1}</p><div class='ad-box'>Buy now, it is cheap and good.</div>"
        f"<form><label>Name</label><input></form><aside>See also this and that.</aside><p>{P2}</p></article></main><footer>Imprint</footer>",
        f"Head\n{P1}\n{D2}",
    ),
    "white space, breaks and inline tags": (f"<article><p>  a\n\t<b>b</b>c <i>d</i><br>e</p>\n<p>{P1}</p></article>", f"a bc d\ne\n{P1}"),
    "unclosed": (f"<nav><a href=x>x</a></nav><article><h1>T</h1><p><b>{P1}<br><p>{P2}<script>var x = '<p>no</p>';</script>", f"T\n{P1}\n{D2}"),
    "list and table": (f"<article><p>{P1}</p><ul><li>one</li><li>two</li></ul><table><tr><td>c1<td>c2</table></article>", f"{P1}\none\ntwo\nc1\nc2"),
    "hidden": (f"<article><p>{P1}</p><p hidden>no</p><div style='display: none'>nor this</div></article>", P1),
    "empty": ("", ""),
    "only menu": ("<nav><a href=a>a</a></nav>", ""),
    "plain": ("just text", "just text"),
    "stray ends": (f"</div></p><article></b><p>{P1}</i></p></article></article>", P1),
}


@pytest.mark.parametrize("name", list(PAGES))
def test_page(name):
    page, text = PAGES[name]
    assert H.main_text(page) == text


SPLIT = {
    "two sections": (
        f"<body><div><a href=/>Home</a></div><div class=content><h1>Title</h1><section><h2>One</h2><p>{P1}<p>{P2}<p>{P1}</section>"
        f"<section><h2>Two</h2><p>{P1}<p>{P1}</section></div><div><a href=/more>More</a></div></body>",
        f"Title\nOne\n{P1}\n{D2}\n{P1}\nTwo\n{P1}\n{P1}",
    ),
    "long list": (f"<div class=content><p>{P1}<p>{P2}<ul><li>{P1}<li>{P2}<li>{P1}</ul></div>", f"{P1}\n{D2}\n{P1}\n{D2}\n{P1}"),
    "list of all long lines": (f"<div><p>In short:<ul><li>{P1 * 4}<li>{P1 * 4}</ul><p>So.</div>", f"In short:\n{P1 * 4}\n{P1 * 4}\nSo."),
    "quote": (f"<body><div><p>{P1}<blockquote><p>{P2}<p>{P2}</blockquote></div></body>", f"{P1}\n{D2}\n{D2}"),
    "main beside article": (f"<main><article><h1>T</h1><p>{P1}<p>{P2}<p>{P1}<p>{P2}</article><p>{P1}<p>{P2}</main>", f"T\n{P1}\n{D2}\n{P1}\n{D2}\n{P1}\n{D2}"),
}


@pytest.mark.parametrize("name", list(SPLIT))
def test_content_in_several_containers_is_whole(name):
    page, text = SPLIT[name]
    assert H.main_text(page) == text


DOUBTFUL = ["related-work", "story-rail", "legal-news", "post-share-price", "alert-system", "promo-video-story", "login-tutorial"]


@pytest.mark.parametrize("name", DOUBTFUL)
def test_a_word_of_a_name_does_not_decide_alone(name):
    page = f"<nav><a href=a>Menu</a></nav><article><h1>T</h1><p>{P1}</p><div class='{name}'><p>{P1}</p><p>{P2}</p></div><p>So.</p></article>"
    assert H.main_text(page) == f"T\n{P1}\n{P1}\n{D2}\nSo."
    # The same name around links and scraps: the ratios say that it is none of the text.
    scraps = "".join(f"<li><a href=x{i}>More {i}</a> now" for i in range(5))
    page = f"<article><h1>T</h1><p>{P1}</p><p>{P2}</p><div class='{name}'><ul>{scraps}</ul></div><p>{P1}</p><p>{P2}</p></article>"
    assert H.main_text(page) == f"T\n{P1}\n{D2}\n{P1}\n{D2}"


@pytest.mark.parametrize("name", ["ad-box", "cookie-notice", "commentList", "post-comments", "sidebar x1", "related-posts", "site-footer"])
def test_plain_names_mark(name):
    page = f"<div class=a><h1>T</h1><p>{P1}</p><div class='{name}'><p>{P1}</p></div><p>{P2}</p></div>"
    assert H.main_text(page) == f"T\n{P1}\n{D2}"


LINKS = "".join(f"<li><a href=/{i}>Place {i}</a>" for i in range(6))
BODY = f"<h1>T</h1>{f'<p>{P1}<p>{P2}' * 5}<p>So.</p>"
TEXT = "T\n" + f"{P1}\n{D2}\n" * 5 + "So."


def test_neutral_names():
    """Menus and notices beside the region, and boxes of links in it, whatever they are called."""
    menu, said = f"<div class=x1><ul>{LINKS}</ul></div>", "<div class=x2>We use small files to make this site work for you.</div>"
    assert H.main_text(f"<body>{menu}<div class=x3>{BODY}</div>{said}</body>") == TEXT
    assert H.main_text(f"<body><div class=x3>{BODY}{menu}</div>{said}{menu}</body>") == TEXT
    # A list of words and links is not mostly links, and in an article links are text.
    assert H.main_text(f"<body><div>{BODY}<ul><li>{P1} <a href=x>Here</a></ul></div></body>") == f"{TEXT}\n{P1} Here"
    assert H.main_text(f"<article>{BODY}<ul><li><a href=x>Source</a></ul></article>") == f"{TEXT}\nSource"
    # A box with the heading is no box beside.
    headed = BODY.replace("<h1>T</h1>", "<h2>U</h2>")
    assert H.main_text(f"<body><div><h1>T</h1></div><div>{headed}</div></body>") == "T\nU\n" + TEXT[2:]


def test_the_method_decides(monkeypatch):
    """Without clusters, the same page gives more."""
    page = f"<body><div class=x1><ul>{LINKS}</ul></div><div class=x3>{BODY}</div><div class=x2>Small files are used.</div></body>"
    assert H.main_text(page) == TEXT
    monkeypatch.setattr(H, "threshold", lambda values: -1.0)
    monkeypatch.setattr(H, "BESIDE", 0.0)
    assert H.main_text(page) != TEXT


def test_fed_in_pieces(monkeypatch):
    want = {k: H.main_text(v[0]) for k, v in PAGES.items()}
    monkeypatch.setattr(H, "FEED", 7)
    for k, (page, _) in PAGES.items():
        if "script" not in page:
            assert H.main_text(page) == want[k]


def test_smoothing_and_threshold():
    flat = H.smoothed(np.full(9, 4.0))
    assert np.allclose(flat, 4.0)
    spread = H.smoothed(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert spread.argmax() == 3 and np.allclose(spread, spread[::-1])
    assert 1 < H.threshold(np.array([0.0, 1, 0, 50, 60])) < 50
    assert H.threshold(np.array([3.0, 3.0])) < 3


def test_odd_rows(spark):
    rows = [(1, "u", PAGES["unclosed"][0], "x"), (1, "u", PAGES["unclosed"][0], "x"), (None, None, None, None), (2, "", "<p>" + "é " * 200_000, "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df).collect()
    assert [r.n_chars for r in got] == [len(r.text) for r in got]
    assert sorted(r.text[:9] for r in got) == sorted(["", "T\nA first", "T\nA first", "é é é é é"])
    assert max(r.n_chars for r in got) == 399_999
    assert H.extract(df.filter(F.lit(False))).count() == 0


def plain(page):
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page or "", re.S)[1]
    parts = [html.unescape(re.sub(r"<[^>]*>", "", p)) for p in re.split(r"</?(?:p|h1|br)>", body)]
    return "\n".join(x for p in parts if (x := re.sub(r"\s+", " ", p).strip()))


def test_query_equals_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages)
    assert sorted(map(tuple, QUERIES["op10_html_content"](spark, sf).collect())) == want

import numpy as np
import pytest

from mattercat.llm import main_text
from mattercat.llm.html_blocks import blocks

STORY = ["The harbour was quiet when the first boats came in, and nobody spoke for a while on the long pier.",
         "Later the wind rose &amp; turned;\n   the <b>old</b> lamps <a href='/x'>were lit</a> one by one.",
         "It is said that every ship which left that night came back, though few believe it today."]
WANT = ("The harbour was quiet when the first boats came in, and nobody spoke for a while on the long pier. "
        "Later the wind rose & turned; the old lamps were lit one by one. "
        "It is said that every ship which left that night came back, though few believe it today.")
BODY = "".join(f"<p>{s}</p>" for s in STORY)
AROUND = ("<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><header><h2>Site</h2></header>"
          "<nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav><div class='cookie-notice'>We use cookies.</div>%s"
          "<div id=comments><p>First comment, which is long enough to look like text of the article itself, honestly.</p></div>"
          "<aside>More to read</aside><form><input><button>Go</button></form><footer>&copy; 2024 All rights reserved.</footer></body></html>")


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div>%s</div>", "<div itemprop=articleBody>%s</div>", "%s"])
def test_article_without_the_rest(wrap):
    assert main_text.page_text(AROUND % (wrap % BODY)) == WANT


def test_broken_pages():
    assert main_text.page_text("<article><p>One<p>Two <b>bold") == "One Two bold"
    assert main_text.page_text("<article>One<!-- never closed <p>x</p>") == "One"
    assert main_text.page_text("<article>One<script>x()") == "One"
    assert main_text.page_text("<article><p>a < b &lt;i&gt; &#233;&nbsp;&amp;amp;</p></article><p cut") == "a < b <i> é &amp;"
    assert main_text.page_text("") == "" and main_text.page_text("<nav>x</nav>") == ""


def test_blocks_know_what_is_around():
    found = blocks("<div class='A b'><p>x<br>y</p>z</div>")
    assert [(b.text, [n for n, _ in b.around]) for b in found] == [("x y", ["div", "p"]), ("z", ["div"])]
    assert found[0].around[0][1] == "a b"


def test_surges_and_dives():
    lengths = np.array([0, 5, 0, 0, 200, 0, 90, 120, 0, 0, 0, 10, 0])
    keep = main_text.surges(lengths, 3, 86, 0, 2)
    assert keep.tolist() == [False] * 4 + [True] * 4 + [False] * 5


def test_short_articles_on_unmarked_pages():
    long = "A paragraph of an article that is long enough to be a surge all by itself, with words to spare."
    end = "<footer>Imprint</footer><footer>Contact</footer>"
    for body, want in ((f"<p>{long}</p>", long), (f"<h1>Title</h1><p>{long}</p>", f"Title {long}")):
        assert main_text.page_text(f"<html><body><nav>Home</nav>{body}{end}</body></html>") == want
    menu = "<div class='ad'>x</div>" * 4
    page = f"<html><body><p>{long}</p><p>{long}</p><p>{long}</p>{menu}<p>{long}</p>{end}</body></html>"
    assert main_text.page_text(page) == " ".join([long] * 4)


def test_query_shape_and_edge_cases(spark):
    rows = [(None, None, None, "k"), (1, "u", "", "k"), (1, "u", "", "k"), (2, "v", AROUND % BODY, "k"), (3, "w", "<p>" + "long text " * 60_000, "k")]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 0), (1, 0), (1, 0), (2, len(WANT)), (3, 599_999)]
    assert main_text.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_given_pages_keep_their_articles(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in main_text.main_text(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", source[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(h1|p|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(plain).split())

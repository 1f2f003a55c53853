"""HTML extraction on the given pages against a restatement with the
standard library's parser, and pages that once lost text."""

import time
from html.parser import HTMLParser

import pytest

from estatelens.llm import html_extract
from estatelens.llm.queries import op8_html_extract

SF = "/root/testdata/sf0.01"


class Restated(HTMLParser):
    """Text of the articles of pages that are nested as they should be, but
    for unclosed p and b."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.line, self.article, self.skip = [], [], 0, 0

    def flush(self):
        line = " ".join("".join(self.line).split())
        self.line.clear()
        if line:
            self.lines.append(line)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.line.append(" ")
        elif tag in html_extract.BLOCKS:
            self.flush()
        self.article += tag == "article"
        self.skip += tag in ("aside", "nav", "form", "header", "footer", "script", "style")

    def handle_endtag(self, tag):
        if tag in html_extract.BLOCKS:
            self.flush()
        self.article -= tag == "article"
        self.skip -= tag in ("aside", "nav", "form", "header", "footer", "script", "style")

    def handle_data(self, data):
        if self.article and not self.skip:
            self.line.append(data)


def restated(page):
    p = Restated()
    p.feed(page or "")
    p.close()
    p.flush()
    return "\n".join(p.lines)


@pytest.fixture(scope="module")
def given(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    return sorted((i, restated(h)) for i, h in pages)


def test_given_pages(spark, given):
    assert sorted((r["page_id"], r["text"]) for r in op8_html_extract(spark, SF).collect()) == given


def test_given_pages_without_lists(spark, given, monkeypatch):
    """Menus, adverts and footers go without any list of tags or words."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for name in ("OTHER_TAGS", "OTHER_ROLES", "OTHER_WORDS", "COMMENT_WORDS"):
        monkeypatch.setattr(html_extract, name, frozenset())
    got = sorted((r["page_id"], "\n".join(t for _, t in html_extract.parse(r["html"] or "")[1])) for r in pages)
    assert got == given


def texts(spark, pages, **options):
    rows = [(i, f"http://one.host/{i}", h) for i, h in enumerate(pages)]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **options).collect()
    return [r["text"] for r in sorted(out, key=lambda r: r["page_id"])]


def test_articles_that_share_text(spark):
    page = "<article><h1>Notice</h1><p>All of this text is the article.</p><p>v{}</p></article>"
    assert texts(spark, [page.format(i) for i in range(2)]) == [f"Notice\nAll of this text is the article.\nv{i}" for i in range(2)]
    near = texts(spark, [page.format(i) for i in range(30)])  # near copies are no template, however many
    assert near == [f"Notice\nAll of this text is the article.\nv{i}" for i in range(30)]
    house = "<article><p>Read our other pieces.</p><p>{}</p></article>"
    own = [f"The text of piece {i} is longer than that line." for i in range(25)]
    assert texts(spark, [house.format(t) for t in own]) == own
    assert texts(spark, [house.format(t) for t in own[:19]]) == ["Read our other pieces.\n" + t for t in own[:19]]


def test_names_are_weak(spark):
    pages = ['<article class="post related-works"><p>Kept.</p></article>', '<article><p id="share-price">It rose.</p><div class="search-history">Told</div></article>',
             '<article><p>Text</p><div class="ad-box">buy</div><ul id="shareButtons"><li>Tweet</ul></article>',
             '<article class="comment"><p>Only this.</p></article>',
             '<article><p>Piece</p><article class="comment">said</article></article><article class="user-comment"><p>said too</p></article>']
    assert texts(spark, pages) == ["Kept.", "It rose.\nTold", "Text", "Only this.", "Piece"]


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "</i>" * 100_000, "<i><p>" + "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 200_000, "<div><b>" + "<hr>" * 200_000,
    "<dt><dl>" + "<div>" * 60_000 + "<dd></dd>" * 60_000, "<a \"" * 200_000, "<li>" * 250_000, "x<" * 300_000, "<p>" * 300_000, "&amp;" * 200_000,
    "<!--" * 250_000, "<a b='" * 150_001], ids=range(12))
def test_hostile_pages_are_linear(page):
    best = min(_timed(page) for _ in range(2))
    assert best < 4  # some 1 MB; a quadratic parser takes minutes


def _timed(page):
    t = time.perf_counter()
    html_extract.parse(page)
    return time.perf_counter() - t


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(empty).columns == ["page_id", "url", "text"] and html_extract.extract(empty).count() == 0

"""Main text of pages against a parser's walk and by hand."""

from html.parser import HTMLParser

import pytest

from cartero.llm import common, extract, queries

SMALL = "/root/testdata/sf0.001"
ONE = ("The committee said on Monday that it was for the people of the town to decide which of the plans they would like to "
       "have built, and that the money for it is not a problem at all.")
TWO = ("It is not the first time that the town has had to choose, and by the look of it this will not be the last one; he and "
       "his friends have been at this for years, on and off, as they like to say.")


class Walk(HTMLParser):
    """What stands inside the article element, block by block."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.handle_starttag(tag, [])
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def walked(html):
    page = Walk()
    page.feed(html or "")
    page.close()
    return "\n".join(t for t in (" ".join("".join(b).split()) for b in page.blocks) if t)


def test_pages_against_a_walk_of_their_elements(spark):
    common.ship(spark)
    pages = common.table(spark, SMALL, "pages")
    want = {r["page_id"]: (r["url"], walked(r["html"])) for r in pages.collect()}
    got = queries.QUERIES["op11_main_text"](spark, SMALL)
    assert dict(got.dtypes) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    rows = got.collect()
    assert len(rows) == len(want)
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""),
    (f"<p>{ONE}<p>{TWO}", f"{ONE}\n{TWO}"),
    # no article element: links, a sidebar, comments and a notice of rights go
    (f'<div id="top"><a href=/>Home</a> | <a href=/x>News</a></div><div class="content"><h2>Town plans</h2><p>{ONE}<p>{TWO}</div>'
     f'<div class=sidebar><p>{ONE}</p></div><div id="comments"><p>{TWO}</p></div><div>© 2024 All rights of the site</div>',
     f"Town plans\n{ONE}\n{TWO}"),
    # inside an article: notices, forms, asides, comments and footers go, lists and short blocks stay
    (f'<main><article><header><h1>Head &amp; tail</h1><p>By the Author</p></header><div class="cookie-notice">We use cookies on this '
     f'site.</div><p>{ONE} <a href=x>a link</a></p><ul><li>one</li><li>two</li></ul><form><label>Mail</label><button>Send</button></form>'
     f'<aside>{TWO}</aside><section class="comments"><article class="comment"><p>{TWO}</p></article></section><footer>Tags</footer></article></main>',
     f"Head & tail\n{ONE} a link\none\ntwo"),
    (f"<form id=aspnet><nav>menu</nav><article><h1>T</h1><p>{ONE}</article></form>", f"T\n{ONE}"),
    (f'<script>var a="<p>{ONE}</p>"</script><style>p{{}}</style><!-- <p>{TWO} --><p>{ONE}', ONE),
    (f"<article><p>&nbsp;a&nbsp;&nbsp;b\n\t&#65; &lt;i&gt; &copy</p><p>{ONE}</p><p hidden>x</p></article>", f"a b A <i> ©\n{ONE}"),
    (f"<article><p>one<br>line</p><p>{ONE}</p></article>", f"one line\n{ONE}"),
    ("<div><p>" + "Ala ma kota i psa, lecz nikt nie wie kiedy. " * 8 + "</p></div><div><a href=x>linki</a></div>",
     ("Ala ma kota i psa, lecz nikt nie wie kiedy. " * 8).strip()),  # no stop words known: length and links decide
    (f'<p>a < b and 3 > 2 <b class="x>unclosed {ONE}<p>{TWO}', f"a < b and 3 > 2 unclosed {ONE}\n{TWO}"),
])
def test_rules(html, want):
    assert extract.main_text(html) == want


def test_hostile_and_long_markup():
    for html in ('<a href="' * 20_000, "<p" * 50_000, "<!--" * 20_000, "<div>" * 20_000 + "x", "<b>" * 3000 + "</p>" * 3000, "<td>" * 20_000,
                 "<script>" * 20_000, "<a b='" * 9_999):
        extract.main_text(html)
    long = "<article>" + "".join(f"<p>{i} {ONE}</p>" for i in range(8_000)) + "</article>"  # over 1 MB
    assert extract.main_text(long).count("\n") == 7_999
    short = "<article>" + "<p>x</p>" * 60_000 + "</article>"
    assert len(extract.main_text(short)) == 119_999


def test_null_rows_repeats_and_clashing_columns(spark):
    common.ship(spark)
    rows = [(1, None, None, "clash", 5), (None, "u", f"<p>{ONE}", "clash", 6), (1, None, None, "clash", 5), (2, "u", "", None, 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in extract.extract(pages).collect())
    assert got == [("1", None, "", 0), ("1", None, "", 0), ("2", "u", "", 0), ("None", "u", ONE, len(ONE))]
    assert extract.extract(pages.limit(0)).collect() == []

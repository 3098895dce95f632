import random
from collections import Counter
from html.parser import HTMLParser

import pytest

from ledgerloom.llm import html_text as ht
from ledgerloom.llm.base import read

PAGE = ('<!DOCTYPE html><html><head><title>no</title><script>var a="</p>";</script></head><body>'
        '<header>top</header><nav><ul><li><a href="/a">one</a></li></ul></nav><!-- ad <p>x</p> -->'
        '<div class="ad">buy</div><article><h1>Head &amp; shoulders</h1><p><b>bold\n\t text.<br><p>a<i>b</i>c &eacute;'
        '&#x41;</p></article><div id="comments"><p>me too</p></div><footer>&copy; x')


def test_one_page():
    assert ht.extract(PAGE, set()) == "Head & shoulders bold text. abc éA"


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt; text", "plain < text"), ("<p>a<p>b", "a b"),
    ("<div>a<div class='cookie-banner'>no</div>b</div>", "a b"), ("a<b>b</b> c<br>d", "ab c d"),
    ("<form>x</form><main>m<aside>s</aside><form>f</form></main>", "m"), ("<P>UP</P><STYLE>p{}</STYLE>", "UP"),
    ("1 < 2 <", "1 < 2 <"), ("<p title='a>b'>q</p>", "q"), ("<ul><li>x<li>y</ul>", "x y"), ("<script>never closed", ""),
    ("<div>" * 3000 + "deep", "deep"), ("<p>" + "w " * 100_000, ("w " * 100_000).strip()),
])
def test_odd_markup(html, text):
    assert ht.extract(html, set()) == text


@pytest.mark.parametrize("html,text", [
    ("<div class='layout no-sidebar'><article>a</article></div>", "a"),
    ("<div class='has-sidebar'><div>a</div></div><p>other words", "a other words"),
    ("<div class='page with-header'><article>a</article></div>", "a"),
    ("<div class='widget'><div><article>a</article></div></div><footer>f", "a"),
    ("<div id=comments><p>all the text of the page</p></div><p>q", "q"),
    ("<div class=menu><p>all the text of the page</p></div><p>q", "all the text of the page q"),
    ("<article>a short story<section class='comments'><p>long comment one</p><p>long comment two</p></section></article>",
     "a short story"),
    ("<p>a short story</p><div id='comments'><article>long comment one</article><p>long comment two</p></div>", "a short story"),
    ("<main>story<article itemprop=comment>c</article><div itemtype='https://schema.org/Comment'>d</div></main>", "story"),
    ("<div class='search-results'>a</div><div class='no-comments'>b</div><div class='with-ads'>c</div>", "a b c"),
    ("<article><div class='entry-header'><h1>head</h1></div>body text</article>", "head body text"),
    ("<article><div class='header'><h1>head</h1></div>body text</article>", "head body text"),
    ("<div class='flex hidden lg:block'>a</div><p>body text", "a body text"),
    ("<p title='hidden gem' data-x='class=ad'>a</p><p>body text", "a body text"),
    ("<div hidden>a</div><div aria-hidden=true>b</div><div style='display: none'>c</div><p>body text", "body text"),
    ("<div class='x ad'>a</div><div class=share-buttons>b</div><div id=site-footer>c</div><p>body text", "body text"),
    ("<main><p>long body text</p><div class=comments><article>c</article></div></main>", "long body text"),
])
def test_marks(html, text):
    assert ht.extract(html, set()) == text


@pytest.mark.parametrize("name", """user-comments post-comments comment-thread newsletter-signup ad-slot adsbygoogle
    related-stories sponsored-content notice--warning commentsList site_footer top-nav cookie-banner""".split())
def test_marks_inside_an_article(name):
    html = f"<article><p>the story</p><div class='x {name}'><p>" + "no part of it " * 9 + "</p></div></article>"
    big = name in "related-stories notice--warning site_footer top-nav cookie-banner"
    assert ht.extract(html.replace("the story", "the story " * 20 if big else "the story"), set()) \
        == ("the story " * 20).strip() if big else "the story"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_templates_of_a_host(spark):
    def page(i, extra=""):
        return f"<body><div><p>Site motto, always alike</p></div><div><p>story {i} " + "word " * 30 + f"</p></div>{extra}</body>"
    rows = [(i, f"https://www.A.example:80/{i}", page(i)) for i in range(20)]
    rows += [(100 + i, f"http://b.example/{i}", page(i)) for i in range(3)]
    got = {r.page_id: r.text for r in ht.extract_text(pages(spark, rows)).collect()}
    assert len(got) == 23
    for i in range(20):
        assert got[i] == f"story {i} " + ("word " * 30).strip()
    assert all(got[100 + i].startswith("Site motto") for i in range(3))


def test_copied_articles_are_kept(spark):
    rows = [(i, f"http://a.example/{i}", PAGE) for i in range(50)]
    got = ht.extract_text(pages(spark, rows)).collect()
    assert {r.text for r in got} == {"Head & shoulders bold text. abc éA"} and len(got) == 50


@pytest.mark.parametrize("page", [
    "<body><div><p>{0} one</p><p>{0} two</p><p>{0} three</p></div></body>",
    "<body><article><section>{0} one</section><div>{0} two</div><section>{0} three</section></article><div>{1}</div></body>"])
def test_copies_without_article_or_in_sections_are_kept(spark, page):
    def html(story, i):
        return page.format(f"story {story} " + "word " * 9, i).replace("<body>", "<body><div>Site motto</div><div>Terms</div>")
    rows = [(i, f"http://a.example/{i}", html(i // 20, i)) for i in range(120)]
    got = {r.page_id: r.text for r in ht.extract_text(pages(spark, rows)).collect()}
    for i in range(120):
        own = f"story {i // 20} " + "word " * 9
        assert got[i] == f"{own}one {own}two {own}three"


def test_templates_of_a_part_of_a_large_host(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><p>a long story {i}</p>" + "<div>Our shop</div>" * (i < 8) + "</article>")
            for i in range(1000)]
    got = ht.extract_text(pages(spark, rows)).collect()
    assert sorted(r.text for r in got) == sorted(f"a long story {i}" for i in range(1000))


def test_odd_rows(spark):
    rows = [(1, None, None), (1, "no host", "<p>x"), (None, "http://h/", ""), (1, None, None)]
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in ht.extract_text(
        pages(spark, rows).withColumnRenamed("page_id", "hashes"), key="hashes").collect())
    assert got == {(1, None, "", 0): 2, (1, "no host", "x", 1): 1, (None, "http://h/", "", 0): 1}
    assert ht.extract_text(pages(spark, [])).count() == 0


class Plain(HTMLParser):
    """Text of the article by the standard library's parser; nothing of the operator."""
    PARTS = frozenset("article h1 h2 p br div section ul ol li table tr td blockquote".split())

    def __init__(self, inside="article"):
        super().__init__(convert_charrefs=True)
        self.inside, self.depth, self.out = inside, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == self.inside
        if tag in self.PARTS:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == self.inside
        if tag in self.PARTS:
            self.out.append(" ")

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def article(html):
    p = Plain()
    p.feed(html or "")
    p.close()
    return " ".join("".join(p.out).split())


def test_query_over_whole_table(spark, sf):
    """The given pages hold their main text in one article."""
    rows = [tuple(r) for r in read(spark, sf, "pages").select("page_id", "html").collect()]
    got = ht.op8_html_extraction(spark, sf).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((k, article(t)) for k, t in rows)
    assert all(r.n_chars == len(r.text) for r in got)


def test_generated_sites_with_known_text(spark):
    """Pages put together from a known story and what surrounds it on each site."""
    rng = random.Random(8)
    vocab = "sun moon river stone caf\u00e9 na\u00efve 42 stra\u00dfe tree".split()

    def say(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    rows, want = [], {}
    for site in range(4):
        fixed = [f"<div><p>motto of site {site} {say(5)}</p></div>", f"<section><h2>Topics {site}</h2><p>{say(9)}</p></section>",
                 f"<div class='box-{site}'><ul><li>{say(3)}</li><li>{say(2)}</li></ul></div>"]
        junk = ["<nav><ul><li>Home<li>News</ul></nav>", "<header><h1>Site</h1></header>", "<aside>side</aside>",
                "<div class='ad-slot'><p>buy now</p></div>", "<div id=cookie-banner>accept</div>", "<form>mail<input></form>",
                "<script>var p='<p>x</p>'</script>", "<style>p{}</style>", "<!-- <p>hidden</p> -->", "<footer>&copy;</footer>",
                "<div hidden>unseen</div>"]
        for i in range(30):
            parts = [say(rng.randint(20, 40)) for _ in range(rng.randint(1, 4))]
            story = "".join(rng.choice(["<p>{}</p>", "<div><p>{}</p></div>", "<p>{}<br>", "<blockquote>{}</blockquote>"]).format(
                t.replace("caf\u00e9", rng.choice(["caf&eacute;", "caf&#233;", "caf\u00e9"]))) for t in parts)
            own = f"page{site}x{i}"
            comments = f"<div class='user-comments'><p>{say(60)} {own}</p><p>{say(50)}</p></div>"
            around = rng.sample(junk, 5) + fixed
            rng.shuffle(around)
            cut = rng.randint(0, len(around))
            body = f"<h1>{own}</h1>{story}"
            if site % 2:
                body = f"<article>{body}{comments}</article>"
            else:
                body += comments
            page = f"<html><head><title>t</title></head><body>{''.join(around[:cut])}{body}{''.join(around[cut:])}</body></html>"
            key = site * 100 + i
            rows.append((key, f"https://site{site}.example/{i}", page))
            want[key] = " ".join([own, *parts])
    got = {r.page_id: r.text for r in ht.extract_text(pages(spark, rows)).collect()}
    assert got == want


def test_a_menu_on_a_third_of_all_pages(spark, monkeypatch):
    rows = [(i, f"http://{'big' if i % 3 == 0 else f's{i}'}.example/{i}", f"<div>Our big menu</div><p>story number {i} and more of it</p>")
            for i in range(300)]
    got = {r.page_id: r.text for r in ht.extract_text(pages(spark, rows)).collect()}
    assert got == {i: ("" if i % 3 == 0 else "Our big menu ") + f"story number {i} and more of it" for i in range(300)}

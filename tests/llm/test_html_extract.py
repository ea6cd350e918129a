import html
import re

import helpers
from conftest import SF_ORACLE
from respawn.llm import html_extract as op

PAGES = "page_id long, url string, html string"


def run(spark, rows, **how):
    return {r.page_id: r for r in op.extract(spark.createDataFrame(rows, PAGES), **how).collect()}


def text_of(page):
    return op.main_text(op.parse(page)[0], set())


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    got = {r.page_id: r for r in op.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_markup():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a < b) x("</p>")</script></head>
      <body class="has-sidebar"><header><h1>Site</h1></header><div id="cookieNotice">We use cookies</div><nav><ul><li>Home<li>News</ul></nav>
      <aside>side</aside><div class="content"><!-- hidden <p>no</p> --><p>One&nbsp;two &amp; &#8364;&lt;b&gt;<p>Three <b>fo</b>ur<br>five
      <ul><li>x<li>y</ul><table><tr><td>a<td>b</table><span hidden>no</span><div class="share-buttons">Share</div>
      <section id="comments"><article class="comment">Nice!</article></section></div><form>Subscribe</form><footer>&copy;</footer></body></html>"""
    assert text_of(page) == "One two & €<b>\nThree four five\nx\ny\na\nb"
    assert text_of("<article><header><h1>Head</h1></header><p>body</p><footer>by me</footer></article><p>after</p>") == "Head\nbody"
    assert text_of("<main><p>in main</p></main><p>out</p>") == "in main"
    assert text_of("just text &eacute; < 5 <b>bold") == "just text é < 5 bold"
    assert text_of('<p title="a > b">q</p><p title="open>z</p>') .startswith("q")
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("<textarea>no</textarea><p>yes</p></article></p></div>") == "yes"


def test_templates_of_a_host_go(spark):
    plain = "<body><div><b>Best site ever {n}</b> since 1999</div><div><p>Text number {n} of this page</p></div><div>All rights of {n}</div></body>"
    rows = [(i, f"http://Host.example/{i}", plain.format(n=chr(97 + i) * 3).replace("Best site ever " + chr(97 + i) * 3, "Best site ever")) for i in range(12)]
    rows += [(100, "http://other.example/1", "<body><div><b>Best site ever</b> since 1999</div><p>alone</p></body>"), (101, None, "<div><b>Best site ever</b> since 1999</div>")]
    got = run(spark, rows)
    for i in range(12):
        assert got[i].text == f"Text number {chr(97 + i) * 3} of this page\nAll rights of {chr(97 + i) * 3}" and got[i].host == "host.example"
        assert got[i].n_templates == 2
    assert got[100].text == "Best site ever since 1999\nalone" and got[101].text == "Best site ever since 1999"


def test_repeated_articles_stay(spark):
    """The same article on every page of a host, or nearly the same, is no template; what recurs in different articles is."""
    page = "<div>seen {i} times</div><article><p>Told again and again</p><p>and once more</p>{own}</article>"
    got = run(spark, [(i, "http://h/", page.format(i="x" * i, own="")) for i in range(1, 11)])
    assert all(r.text == "Told again and again\nand once more" for r in got.values())
    got = run(spark, [(i, "http://h/", page.format(i="x" * i, own=f"<p>Own {chr(97 + i)}</p>")) for i in range(1, 11)])
    assert all(got[i].text == f"Told again and again\nand once more\nOwn {chr(97 + i)}" for i in range(1, 11))


def test_templates_inside_articles(spark):
    """Paragraphs, lists, figures and boxes that recur in the different articles of a host go; switched off, they stay."""
    own = "<h2>Introduction</h2><p>This story {n} is about {n} and goes on for quite a while about {n}</p><ul><li>see {n}</li></ul><p>It ends with {n}, as all stories do</p>"
    notes = "<p>Join our list today</p><ul><li>one</li><li>two</li></ul><figure><figcaption>Our logo</figcaption></figure><div class=x>Read more</div>"
    for k, page in enumerate((f"<article>{own}{notes}</article>", f"<div class=layout><div>{own}{notes}</div></div>")):
        rows = [(i, f"http://h{k}/{i}", page.format(n=(chr(97 + i % 26) + chr(97 + i // 26)) * 3)) for i in range(30)]
        got, off = run(spark, rows), run(spark, rows, min_pages=1000)
        for i in range(30):
            n = (chr(97 + i % 26) + chr(97 + i // 26)) * 3
            want = f"Introduction\nThis story {n} is about {n} and goes on for quite a while about {n}\nsee {n}\nIt ends with {n}, as all stories do"
            assert got[i].text == want and off[i].text == want + "\nJoin our list today\none\ntwo\nOur logo\nRead more", (k, got[i].text)


def test_odd_rows(spark):
    rows = [(1, "http://h/", None), (2, None, ""), (3, "not a url", "<"), (None, "http://h/", "<p>x"), (4, "http://h/", "<p>x"), (4, "http://h/", "<p>x"),
            (5, "http://h/", "<p>" + "long " * 100000), (6, "ftp://u:p@H.x:21/a", "&#0;&#x110000;&bogus;ok"), (7, "http://h", "<![CDATA[x]]><?php ?><p>y")]
    df = helpers.clashing(spark.createDataFrame(rows, PAGES))
    out = op.extract(df)
    got = out.collect()
    assert len(got) == len(rows) and sorted(r.page_id for r in got if r.page_id is not None) == [1, 2, 3, 4, 4, 5, 6, 7]
    by = {r.page_id: r for r in got}
    assert (by[1].text, by[2].text, by[4].text, by[None].text) == ("", "", "x", "x") and by[5].n_chars == 5 * 100000 - 1
    assert by[6].host == "h.x" and by[6].text.endswith("ok") and by[7].text.endswith("y")
    assert op.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_copied_pages_keep_their_story(spark):
    """A third of a host's pages are copies of one page laid out in divs; some copies differ in a word outside the story."""
    story = "<p>The story begins</p><div class=x><p>It goes on for a while in a box of its own</p></div><p>and ends</p>"
    pages = [f"<body><article><div class=post-body>{story}</div></article></body>", f"<body><div class=layout><div>{story}</div></div></body>",
             f"<body><div>seen by {{i}}</div><div class=layout><div>{story}</div></div></body>", f"<body><article><i>{{i}}</i><div class=post-body>{story}</div></article></body>"]
    for k, page in enumerate(pages):
        rows = [(i, f"http://h{k}/{i}", page.format(i=chr(97 + i))) for i in range(10)]
        rows += [(100 + i, f"http://h{k}/x{i}", f"<body><div>About us</div><p>other {chr(97 + i)}</p></body>") for i in range(20)]
        got = run(spark, rows)
        for i in range(10):
            assert got[i].text.endswith("The story begins\nIt goes on for a while in a box of its own\nand ends"), (k, got[i].text)
        assert all(got[100 + i].text == f"other {chr(97 + i)}" for i in range(20))


def test_marks_inside_an_article_are_whole_names():
    page = """<article><header class="entry-header"><h1>Title</h1></header><h2 id="related-work">Related work</h2><section id="search-results"><p>Found</p></section>
      <p class="alert">Mind this</p><div id="social-impact"><p>Impact</p></div><div class="related-posts"><p>no</p></div><div class="share"><p>no</p></div>
      <section id="comments"><p>no</p></section><div class="ad banner">no</div><nav>no</nav></article>"""
    assert text_of(page) == "Title\nRelated work\nFound\nMind this\nImpact"
    assert text_of(page.replace("article>", "main>")) == text_of(page)
    assert text_of('<div class="search-results"><p>no</p></div><article><p>yes</p></article>') == "yes"


def test_names_of_adverts_comments_and_notices():
    gone = ["<div class=reader-comments>no</div>", "<div id=user-comments>no</div>", "<section class=article-comments>no</section>", "<div class=ad-slot>no</div>",
            "<div class='advert-unit big'>no</div>", "<div id=site-notice>no</div>", "<p class=advert>no</p>", "<ul class=share-links><li>no</ul>", "<ol class=commentlist><li>no</ol>"]
    for x in gone:
        assert text_of(f"<article><p>yes</p>{x}<p>end</p></article>") == "yes\nend", x
        assert text_of(f"<body><div><p>yes</p>{x}<p>end</p></div></body>") == "yes\nend", x
    for x in ("<h2 id=legal>keep</h2>", "<p class=related>keep</p>", "<h2 id=comments>keep</h2>", "<p class=alert>keep</p>", "<p id=why-we-removed-comments>keep</p>"):
        assert text_of(f"<body><div><p>yes</p>{x}<p>end</p></div></body>") == "yes\nkeep\nend", x
        assert text_of(f"<article><p>yes</p>{x}<p>end</p></article>") == "yes\nkeep\nend", x


def test_a_teaser_is_not_the_story():
    story = "<p>The story has many words and goes on</p><p>until it ends</p>"
    assert text_of(f"<main>{story}<article><p>Read this too</p></article></main>") == "The story has many words and goes on\nuntil it ends\nRead this too"
    assert text_of(f"<article><p>Read</p></article><div class=content>{story}</div>") == "The story has many words and goes on\nuntil it ends"
    assert text_of(f"<main><div>Around</div><article>{story}</article></main>") == "The story has many words and goes on\nuntil it ends"


def test_trees_hold_no_hashes():
    """A page's hashes are stored once, beside its tree: a tree of many small elements takes less than eight bytes for each."""
    names = ["".join(chr(97 + i // 26 ** k % 26) for k in range(3)) for i in range(4000)]
    page = "<body><main>" + "".join(f"<div><p>{name}</p></div>" for name in names) + "</main></body>"
    tree, hashes, scopes, _ = op.parse(page)
    assert len(tree) < 8 * 2 * 4000 and len(set(hashes)) == len(set(hashes[:len(scopes)])) + len(hashes[len(scopes):])
    same = op.main_text(tree, {1}, hashes)
    assert same == op.main_text(tree, set()) and same.count("\n") == 3999

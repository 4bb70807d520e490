from tickloom.llm import html
from tickloom.llm.common import table

NONE = {"constant": set(), "root": ""}


def text(page):
    return html.main_text(page, NONE)


def test_blocks_references_and_white_space():
    page = "<html><body><p>Hi <b>you</b>r<br>a&amp;b &nbsp; c\n d</p><ul><li>one<li>two</ul><div>t1<p>p2</div>tail</body>"
    assert text(page) == "Hi your a&b c d\none\ntwo\nt1\np2\ntail"


def test_what_is_not_the_article_goes():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>h</header><nav><a>n</a></nav>
    <div class="cookie-notice">we use cookies</div><div id="sidebar"><p>side</p></div><!-- <p>gone</p> -->
    <main><article><h1>Head</h1><p>One<p>Two <i>three</i><script>var t="</p>"; if (a < b) x();</script></p>
    <div class="ad">buy</div><form><input value="x"><button>go</button></form><blockquote>Quote</blockquote>
    <section id="comments"><article class="comment"><p>first!</p></article></section></article></main>
    <aside>more</aside><div role="complementary">c</div><footer>f</footer></body></html>"""
    assert text(page) == "Head\nOne\nTwo three\nQuote"


def test_attributes_are_read_by_name():
    for attribute in ('aria-hidden="false"', 'title="the hidden garden"', 'href="/hidden-gems"', 'href="?id=search"',
                      "href=/x?role=search", 'data-id="search"', "data-class='ad'", 'alt="a class=ad"'):
        assert text(f"<p {attribute}>kept</p><p>next</p>") == "kept\nnext", attribute
    for attribute in ("hidden", 'HIDDEN=""', "x=1 hidden", 'style="display: none"', "class=ad", "id='search'", 'role="search"'):
        assert text(f"<p {attribute}>gone</p><p>next</p>") == "next", attribute


def test_marks_do_not_drop_what_holds_the_article():
    story = "<h1>Head</h1><p>One two three</p>"
    side = '<div class="sidebar"><article><p>Teaser that is longer than the story</p></article></div><div id="ads">buy</div>'
    for page in (
        f'<body class="has-sidebar"><article>{story}</article>{side}</body>',
        f'<html id="search"><body class="search">{story}{side[-23:]}</body></html>',
        f'<div id="page" class="with-header"><main>{story}</main>{side}</div>',
        f'<div id="page" class="with-header"><div>{story}</div><div id="ads">buy</div></div>',
        f'<div class="overlay">{story}<div id="ads">buy</div></div>',
        f'<main class="with-sidebar">{story}</main>{side}',
        f'<article class="post with-comments">{story}<div class="comments-area"><article class="comment">first</article></div></article>',
        f'<article>{story}</article><article class="comment"><p>a comment that is longer than the story</p></article>',
        f'{story}<div id="comments"><p>a comment that is longer than the whole of the story</p></div>',
        f'<div>{story}</div><span class="ad">buy</span>',
    ):
        assert text(page) == "Head\nOne two three", page


def test_broken_markup():
    assert text("<article><p>a < b and c > d<p>x</article") == "a < b and c > d\nx</article"
    assert text("<p>open <b>bold<p>next") == "open bold\nnext"
    assert text("<p>a</p><script>never closed <p>b") == "a"
    assert text("<p title='<p>'>quoted</p>") == "quoted"
    assert text("") == "" and text("&lt;p&gt;") == "<p>"


def test_tree_matching_aligns_equal_labels_in_order():
    a, b = (html.tree(html.Page(x)) for x in ("<div><p>1</p><ul></ul><p>2</p></div>", "<div><p>2</p><p>3</p></div>"))
    score, pairs = html.match_trees(a, b)
    assert score == 4 and [(x.label, y.label) for x, y in pairs] == [("#", "#"), ("div", "div"), ("p", "p"), ("p", "p")]


def test_constant_nodes_are_template_and_varying_ones_content():
    page = lambda i: f"<body><div class=top>Same on all</div><div class=x><p>Body {i} {'word ' * i}</p><p>Share this</p></div><div>Imprint</div></body>"
    wrapper = html._wrapper(__import__("json").dumps(html.induce([page(i) for i in range(1, 9)])))
    assert html.main_text(page(20), wrapper) == "Body 20 " + ("word " * 20).strip()


def test_copies_of_a_page_do_not_make_its_text_template():
    page = lambda i: f"<body><article><p>{'the same long story ' * 20}</p></article><footer>{i}</footer></body>"
    assert html.induce([page(i) for i in range(9)])["constant"] == []


def test_template_is_counted_over_all_distinct_pages(spark):
    def page(i, kind, story=None):
        story = story or f"Story {i} {'word ' * (i % 7)}end"
        return f"<body><div class={kind}><div class=x><p>{story}</p><p>Share {kind}</p></div></div></body>", story

    rows = [("http://copied/", *page(i, "a")) for i in range(40) for _ in range(30)]
    rows += [("http://two/", *page(i, "a" if i % 5 < 3 else "b")) for i in range(100)]
    rows += [("http://rare/", *page(i, "b" if i % 40 == 0 else "a")) for i in range(300)]
    rows += [("http://same/", *page(i, "a", "one story")) for i in range(9)]
    short = "<body><div class=a><article><p>{}</p><div class=y><p>{}</p></div></article></div></body>"
    rows += [("http://short/", short.format(f"S{i}", "The same long imprint " * 20), f"S{i}") for i in range(12)]
    bare = "<body><div class=a><p>{}</p><p>and {}</p></div><div class=y><p>{}</p></div></body>"
    rows += [("http://bare/", bare.format(f"S{i}" * 9, i, "The same " * 6), f"{f'S{i}' * 9}\nand {i}") for i in range(12)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string, want string")
    got = {r.page_id: r for r in html.with_text(pages).collect()}
    assert len(got) == len(rows)
    for r in got.values():
        assert r.text == r.want + ("\nShare a" if r.url == "http://same/" else ""), r


def test_root_is_counted_over_all_distinct_pages(spark):
    """One page in ten has the story, too few to show in a few pages; on the others only the print date varies."""

    def page(i):
        story = f"Story {i} {'word ' * 400}end" if i % 10 == 0 else "Read on"
        return f"<body><div class=b><p>{story}</p></div><div class=z>Printed {i}</div></body>", story if i % 10 == 0 else f"Printed {i}"

    rows = [(i, "http://stubs/", *page(i)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, want string")
    for r in html.with_text(pages).collect():
        assert r.text == r.want, r.page_id


def test_roots_are_those_of_all_pairs(spark):
    from collections import Counter
    from itertools import permutations
    from random import Random

    rng, rows, want = Random(3), [], {}
    for host in range(12):
        found = []
        for i in range(rng.choice([1, 2, 9])):
            blocks = "".join(
                f"<div class=c{rng.randrange(3)}><p>{rng.choice(['same', 'other', f'own {i}', f'own {i} ' * 5])}</p></div>"
                for _ in range(rng.randrange(1, 5))
            )
            markup = f"<body>{blocks}<div class=id><p>{'the page ' * 30}{i}</p></div></body>" if host % 2 else f"<body>{blocks}{i}</body>"
            rows.append((f"h{host}", markup))
            found.append(html.nodes(html.Page(markup)))
        distinct = {(layout, article): set(blocks) for layout, article, blocks in found}
        varied = Counter()
        for a, b in permutations(distinct.values(), 2):
            there, keys = {x[1] for x in b}, {x[0] for x in b}
            for key, path, up, chars in a:
                if path in there and key not in keys:
                    varied[up] += chars
        if varied:
            want[f"h{host}"] = max(sorted(varied), key=varied.get)
    pages = spark.createDataFrame(rows, "host string, html string")
    got = {r.host: r.root for r in html.roots(html.distinct_pages(pages)).collect()}
    assert got == want and len(want) > 4


def test_pages_of_the_test_table(spark):
    import re
    from html import unescape

    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in html.extracted(pages).collect()}
    assert len(got) == pages.count()
    for p in pages.collect():
        article = re.search("<article>(.*?)</article>", p.html, re.S)[1].replace("<br>", " ").replace("<b>", "")
        want = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert got[p.page_id].text == "\n".join(x for x in want if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url

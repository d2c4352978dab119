import json
import random
import time
import xml.etree.ElementTree as ET
from collections import defaultdict

from pyspark.sql import functions as F

from driftline.llm import html_text as h


def texts(source):
    page = h.Page(source)
    best = max((b.level for b in page.blocks), default=0)
    return [b.text for b in page.blocks if b.level == best > -2]


def test_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">X</a></li></ul></nav>
    <!-- ad <p>no</p> --><div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>One\n two&nbsp;three.<br><p>Four <i>fi</i>ve &lt;six&gt; &#233;</p>
    <div class="share-buttons">Tweet</div><section id="comments"><p>First!</p></section><form>Mail <input></form><ul><li>a<li>b</ul></article>
    <aside>Side</aside><footer>&copy; me</footer></body></html>"""
    assert texts(page) == ["Head & more", "One two three.", "Four five <six> é", "a", "b"]


def test_marks():
    assert texts("<div class='page with-sidebar no_ads'><article class='post sidebar-left'>A</article><div class=side-bar>B</div></div>") == ["A"]
    assert texts("<div class='adobe notable'>A</div><div class='top-ad'>B</div><div id=Cookie_Box>C</div>") == ["A"]


def test_without_article():
    assert texts("<body><header>H</header><div id=main-nav>N</div><div>Text<p>More</div><p hidden>x<p>End") == ["Text", "More", "End"]
    assert texts("<main><p>In</p></main><p>Out</p>") == ["In"]
    assert texts("<p>1 < 2 and <b title='a>b'>bold</b>") == ["1 < 2 and bold"]
    assert texts("") == [] and texts("<script>x") == [] and texts("plain") == ["plain"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<p>" + "x " * 100000) == [("x " * 100000).strip()]
    assert texts("<div>" * 3000 + "deep") == ["deep"]


def test_templates(spark):
    rows = [(k, f"https://a.example/{k}", f"<article><h1>T{k}</h1><p>Same words</p><div>Read <b>more</b> here</div><p>Own {k}</p></article>") for k in range(20)]
    rows += [(100 + k, "http://b.example/", "<body><div>Read <b>more</b> here</div><p>B</p>") for k in range(3)]
    rows += [(200 + k, "http://c.example/", f"<body><div><ul><li>Home<li>About</ul></div><div><p>C {k}</div>") for k in range(8)]
    rows += [(300, None, None), (301, None, ""), (302, "x", "<nav>n</nav>"), (300, None, None)]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "page_id long, url string, html string, text string")
    found = h.extract_text(docs).collect()
    assert len(found) == len(rows)
    got = {r.page_id: r.text for r in found}
    assert all(got[k] == f"T{k}\n\nSame words\n\nOwn {k}" for k in range(20))
    assert all(got[100 + k] == "Read more here\n\nB" for k in range(3))
    assert all(got[200 + k] == f"C {k}" for k in range(8))
    assert got[300] == got[301] == got[302] == ""
    assert h.extract_text(docs.limit(0)).collect() == []


def test_sections_of_a_large_host(spark):
    page = lambda k, body: (k, "http://a.example/", f"<body><div><div>Section <b>{k % 3}</b></div>{'<div>Campaign</div>' if k % 10 < 3 else ''}</div><div>{body}</div>")
    rows = [page(k, f"<h2>T {k}</h2><p>Own {k}</p>") for k in range(60)]
    rows += [page(100 + k, "<h2>Copied</h2><p>The same text</p>") for k in range(12)]
    got = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"T {k}\n\nOwn {k}" for k in range(60))
    assert all(got[100 + k] == "Copied\n\nThe same text" for k in range(12))


def test_marks_need_recurrence(spark):
    bodies = [
        f"""<article><header class="entry-header"><h1>T {k}</h1></header><section id="discussion"><p>Discussion {k}</p></section><div class="share">Tweet</div></article>
        <div>Outside {k}</div><p>All rights reserved</p><div class="newsletter"><p>Subscribe</p></div>"""
        for k in range(6)
    ]
    bodies += [f'<div class="widget Blog"><h2>Post {k}</h2><p>Text {k}</p></div><div class="ad">Buy</div>' for k in range(2)]
    bodies += ["<div><p>The long main text</p></div><article><p>A teaser</p></article>"]
    docs = spark.createDataFrame([(k, "http://a.example/", f"<body>{b}") for k, b in enumerate(bodies)], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in h.extract_text(docs).collect()}
    assert all(got[k] == [f"T {k}", f"Discussion {k}", f"Outside {k}"] for k in range(6))
    assert all(got[6 + k] == [f"Post {k}", f"Text {k}"] for k in range(2))
    assert got[8] == ["The long main text", "A teaser"]


def test_changing_ads_beside_an_article(spark):
    rows = [(k, "http://a.example/", f"<body><div class='ad'>Buy {k}</div><article><h1>T {k}</h1><section id='discussion'><p>D {k}</p></section></article>") for k in range(5)]
    got = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"T {k}\n\nD {k}" for k in range(5)}


def test_outside_of_the_main_element():
    kept = lambda source: [b[0] for b in json.loads(h.Page(source).packed())[0]]
    assert kept("<main><article><p>In</p></article></main><p>Out</p>") == ["In"]
    assert kept("<main><div class=ad>In</div></main><p>Out</p><article>Too</article>") == ["In", "Too"]
    assert kept("<main><nav>Menu</nav></main><p>Out</p>") == ["Menu", "Out"]
    assert kept("<article><p>In</p></article><p>Out</p>") == ["In", "Out"]


def test_time_is_linear_in_nesting():
    for piece in ("<div>x", "<b>x", "<li>x", "<span><p>x", "<section class=ad>y", "<nav><ul><li>z"):
        h.Page(piece * 1000).others()
        times = []
        for n in (4000, 32000):
            began = time.process_time()
            page = h.Page(piece * n)
            page.others(), page.packed()
            times.append(time.process_time() - began)
        assert times[1] < 8 * 4 * max(times[0], 0.02), (piece, times)


def plain_removal(pages):
    """Texts of pages by counts alone: for each host and subtree, how many different running texts stand around it."""
    around, trees = defaultdict(set), []
    for k, host, source in pages:
        root = ET.fromstring(source)
        trees.append((k, host, root))
        every = [e.text for e in root.iter("p")]
        for e in root.iter():
            if e.tag in ("div", "nav", "ul", "footer", "section", "aside"):
                inner = [x.text for x in e.iter("p")]
                around[host, ET.tostring(e)].add(tuple(sorted(set(every) - set(inner))))
                if e.tag in ("nav", "footer", "aside"):
                    around[host, e.tag].add(tuple(sorted(set(every) - set(inner))))
    out = {}
    for k, host, root in trees:
        texts = []

        def walk(e):
            if max(len(around.get((host, x), ())) for x in (ET.tostring(e), e.tag)) >= h.LEAST_PAGES:
                return
            if e.text:
                texts.append(e.text)
            for x in e:
                walk(x)

        walk(root)
        out[k] = "\n\n".join(texts)
    return out


def test_counts_alone_remove_what_a_plain_count_removes(spark):
    r = random.Random(3)
    widget = lambda depth: "".join(f"<{t}>{widget(depth - 1) if depth and r.random() < 0.7 else f'w{r.randrange(30)}'}</{t}>" for t in r.choices(["div", "nav", "ul", "footer", "section", "aside"], k=r.choice([1, 1, 2])))
    shared = [widget(2) for _ in range(14)]
    pages = []
    for k in range(300):
        host = "big" if k % 3 else f"h{k % 12}"
        own = f"<div><p>Own {k if k % 7 else 0}</p></div>"
        pages.append((k, host, f"<body>{''.join(r.sample(shared, 4))}{own}{r.choice(shared)}</body>"))
    docs = spark.createDataFrame([(k, f"http://{host}.example/{k}", x) for k, host, x in pages], "page_id long, url string, html string")
    found = h.extract_text(docs, by_lists=False).collect()
    assert {r.page_id: r.text for r in found} == plain_removal(pages)
    assert sorted(found) == sorted(h.extract_text(docs, by_lists=False, most_sent=0).collect())
    assert sum(r.n_template for r in found) > 500 and not any(r.n_listed for r in found)


def test_menus_and_footers_go_by_counts_and_lists_are_for_what_is_left(spark):
    frame = lambda k, host: f"<body><header>{host}</header><nav><ul><li>Home<li>About</ul></nav><article><h1>T {k}</h1><p>Own {k}</p></article><aside>More</aside><footer>&copy; {host}</footer>"
    rows = [(k, f"http://big.example/{k}", frame(k, "big")) for k in range(8)] + [(100 + k, "http://small.example/", frame(k, "small")) for k in range(3)]
    rows = [(k, u, x.replace("<article>", "<div>").replace("</article>", "</div>")) for k, u, x in rows]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    alone = {r.page_id: r for r in h.extract_text(docs, by_lists=False).collect()}
    assert all(alone[k].text == f"T {k}\n\nOwn {k}" and alone[k].n_template == 5 for k in range(8))
    assert alone[100].text == "small\n\nHome\n\nAbout\n\nT 0\n\nOwn 0\n\nMore\n\n© small"
    both = {r.page_id: r for r in h.extract_text(docs).collect()}
    assert all(both[k].n_listed == 0 for k in range(8)) and all(both[100 + k].text == f"T {k}\n\nOwn {k}" and both[100 + k].n_listed == 5 for k in range(3))


def test_query(spark, tmp_path):
    rows = [(k, f"http://a.example/{k}", f"<body><nav>Menu</nav><article><h1>é {k}</h1><p>a&amp;b \n c&#x1F389;</p></article><script>x</script>", "t", 1) for k in range(6)]
    rows += [(7, None, None, "t", 1), (7, "u", "", "t", 1), (None, "http://[", "<p>plain", "t", 1), (None, "http://[", "<p>plain", "t", 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r)[:4] for r in h.op6_html(spark, str(tmp_path)).collect()), key=str)
    want = [(k, f"http://a.example/{k}", f"é {k}\n\na&b c🎉", 11) for k in range(6)] + [(7, None, "", 0), (7, "u", "", 0)] + [(None, "http://[", "plain", 5)] * 2
    assert got == sorted(want, key=str)


def test_counts_do_most_of_the_work_on_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    both = h.extract_text(pages).agg(F.sum("n_template"), F.sum("n_listed")).first()
    assert both[0] > 100 * both[1], both

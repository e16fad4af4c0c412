import random

import pytest

from ledgerflow.llm import html_text, urls
from ledgerflow.llm.registry import ORACLE_SQL, QUERIES
from tests.llm.words import prose
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_url_filter", "op8_mixing"])
def test_sql(spark, name):
    compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF)


def test_rules(spark, clashing):
    rows = [("http://Example.NET/en/a?x#y", "allow", "example.net/en/"), ("http://a.example.net/de/a", "block", "net/"), ("http://x.example.com/de/", "block", "example.com/de/"), ("http://example.com/DE/", "allow", None), ("http://badexample.com/de/x", "allow", None), ("http://net", "allow", None), ("http://net/", "block", "net/"), ("http://a.org/fr/x", "allow", "org/fr/"), ("no url", "allow", None), (None, "allow", None), ("", "allow", None), ("http://", "allow", None), ("http://e.net?q=/en/", "allow", None), ("x://y://example.net/en/", "allow", None), ("http://" + "a." * 5000 + "net/x", "block", "net/")]
    df = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(rows)], "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["rule"]) for r in urls.judge(clashing(df)).collect()}
    assert got == {i: (v, r) for i, (_, v, r) in enumerate(rows)}
    host = {r["page_id"]: (r["host"], r["path"]) for r in urls.judge(df).collect()}
    assert host[0] == ("example.net", "/en/a") and host[8] == host[9] == host[10] == ("", "") and host[12] == ("e.net", "") and host[13] == ("y:", "//example.net/en/")
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.judge(df.union(df)).count() == 2 * len(rows)


def test_cascade_is_exact_over_its_universe(spark):
    rnd = random.Random(4)
    universe = [f"k{i}" for i in range(20_000)]
    listed = set(rnd.sample(universe, 3000)) | {"absent"}
    df = spark.createDataFrame([(k,) for k in universe] + [(None,), ("k1",)], "key string").repartition(4)
    c = urls.fit_cascades(df, {"a": listed, "b": set()})
    assert len(c["a"].levels) > 2
    assert c["a"].has(universe).tolist() == [k in listed for k in universe] and not c["b"].has(universe).any()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav>Home</nav>
<div class="cookie-notice"><p>We use cookies</div><div id="x"><article><header><h1>Title &amp; more</h1></header><p>One<br>two <b>three</b>.<p>Open <a href="x">link</a> 1 &lt; 2&nbsp;&#233;
<div class="ad">buy</div><blockquote>quote</blockquote><form>Name<input></form><ul><li>a<li>b</ul><section id="comments"><article class="comment">first!</article></section></article></div>
<aside>side</aside><footer>foot</footer><script>if (a<b) "</article>"</script></body></html>"""


def test_article(spark, clashing):
    rows = [(1, "http://h/1", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain & text"), (5, "u", "<div class=ad>x<article><p>kept"), (1, "http://h/1", PAGE), (6, "u", "<article><p>a</p></article><p>between</p><article>b</article>"), (7, "u", "<article><p>" + "long " * 200_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_text.extracted(clashing(df)).collect()}
    assert got[1]["text"] == "Title & more\n\nOne two three.\n\nOpen link 1 < 2 é\n\nquote\n\na\n\nb"
    assert [got[i]["text"] for i in (2, 3, 4, 5, 6)] == ["", "", "plain & text", "kept", "a\n\nb"] and got[7]["n_chars"] == 999_999
    assert html_text.extracted(df).count() == len(rows) and html_text.extracted(df.limit(0)).count() == 0


def test_host_suffix_array_removes_boilerplate(spark, monkeypatch):
    menu, end = "<div>Home</div><div>About us</div><div>Contact and imprint</div><div>Latest news today</div>", "<div>All rights reserved by the owners of this fine site since 1999</div>"
    rows = [(i, f"http://h{i % 2}.org/{i}", f"<html><body>{menu}<p>{(own := prose(i, 40))}</p><p>{own[:30].strip()}</p>{end}</body></html>") for i in range(60)]
    rows.append((99, "http://alone.org/", f"<body>{menu}<p>{prose(99, 40)}</p>{end}</body>"))
    rows += [(200 + i, "http://copies.org/", f"<body>{menu}<p>{prose(7, 40)} {i}</p></body>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    for i in range(60):
        assert got[i] == f"{prose(i, 40)}\n\n{prose(i, 40)[:30].strip()}"
    assert "All rights" in got[99] and "Home" in got[99]  # one page of its host: nothing is repeated
    assert got[200] == f"{prose(7, 40)} 0"  # copies don't erase each other
    monkeypatch.setattr(html_text, "SHARD", 400)  # in many shards: the same
    assert {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()} == got


def test_copied_articles_stay_on_every_page(spark):
    menu, end = "<div>Home</div><div>About us</div><div>Contact and imprint</div><div>Latest news today</div>", "<div>All rights reserved by the owners of this fine site since 1999</div>"

    def copy(seed, i):
        blocks = [f"Title {seed} of it", f"By author{i}", prose(seed, 40), "A heading", prose(seed + 1, 60), "Short.", prose(seed + 2, 30), "The end."]
        tags = ["h1", "div", "p", "h2", "p", "p", "p", "p"]
        return "".join(f"<{t}>{b}</{t}>" for t, b in zip(tags, blocks, strict=True)), "\n\n".join(blocks)

    want, rows = {}, []

    def add(host, body, text, end=end):
        want[len(rows)] = text
        rows.append((len(rows), f"http://{host}/{len(rows)}", f"<body>{menu}{body}{end}</body>"))

    for i in range(20):
        add("some.org", f"<p>{prose(1000 + i, 40)}</p>", prose(1000 + i, 40))
        add("most.org", *copy(5000, i))
        add("all.org", *copy(6000, i), end="")  # every page a copy
    for i in range(2):
        add("some.org", *copy(7000, i))
    for i in range(8):
        add("most.org", f"<p>{prose(2000 + i, 40)}</p>", prose(2000 + i, 40))
    got = {r["page_id"]: r["text"] for r in html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_boilerplate_within_articles_goes(spark):
    """A block that nearly all different articles of a host have goes; one that many have stays; copies don't count twice."""
    line, often = "Subscribe to our letter and never miss a story", "A line that many articles share"
    rows, want = [], {}

    def add(host, blocks, kept):
        want[len(rows)] = "\n\n".join(kept)
        rows.append((len(rows), f"http://{host}/{len(rows)}", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"))

    for i in range(20):
        own = prose(100 + i, 40)
        add("a.org", [own, often, line] if i % 3 else [own, line], [own, often] if i % 3 else [own])
        add("copies.org", [prose(1, 40), line], [prose(1, 40), line])  # one article
        add("near.org", [prose(2, 60), f"By author {i}"], [prose(2, 60), f"By author {i}"])  # more than half of each
    add("few.org", [prose(3, 40), line], [prose(3, 40), line])
    got = {r["page_id"]: r["text"] for r in html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_words_of_classes_alone_empty_no_page(spark):
    text = prose(5, 40)
    cases = [
        (f'<body><div class="product-widget"><p>{text}</p><p>Short.</p></div></body>', f"{text}\n\nShort."),
        (f'<body><p>{text}</p><div class="product-widget"><p>{prose(6, 30)}</p></div></body>', text),
        (f'<body><div class="widget"><p>{text}</p></div><div id="comments"><p>{prose(6, 30)}</p></div><nav>Home</nav></body>', text),
        (f"<article><p>{text}\0x</p></article>", f"{text}\0x"),
    ]
    df = spark.createDataFrame([(i, f"http://h{i}/", h) for i, (h, _) in enumerate(cases)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()} == {i: t for i, (_, t) in enumerate(cases)}


def test_odd_markup_is_scanned_in_one_pass():
    import time

    began = time.time()
    for page in ("<b>x" * 50_000, "<div>x" * 50_000, "<ul>" + "<li>x" * 50_000, "<" * 100_000, "</b>" * 50_000, "<a b='" * 20_000, "<!--" * 20_000, "<article>" * 20_000 + "z"):
        html_text.parsed(page)
    assert time.time() - began < 30

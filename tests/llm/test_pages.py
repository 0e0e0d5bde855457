"""Main texts: pages made from parts, the test pages by their template, entropies by hand."""

import html
import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from lectern.llm import pages
from llm_fixtures import rows

PAGES = "page_id long, url string, html string"


def texts(spark, made, **extra):
    df = spark.createDataFrame(made, PAGES)
    df = df.select("*", *[F.lit(value).alias(name) for name, value in extra.items()])
    found = rows(pages.extracted(df))
    assert all(r[3] == len(r[2]) for r in found)
    return [r[2] for r in found]


def blocks(source):
    page = pages.parse(source)
    return [text for place, text in page.blocks if place < 0 or not page.elements[place].removed]


@pytest.mark.parametrize(
    "source, expected",
    [
        ("", []),
        ("plain &lt;b&gt; &amp text &#233; &nbsp; &quo", ["plain <b> & text é &quo"]),
        ("<p>a<p>b <b>c<br>d</b>e</p> f", ["a", "b c de", "f"]),
        ("<p><b>bold<br><p>next</p></b>", ["bold", "next"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ("<script>var t = '</p><p>x';</script>a<style>p{}</style><!-- <p>no -->b", ["ab"]),
        ("<script>never closed <p>x", []),
        ("a <!-- never closed <p>x", ["a"]),
        ("1 < 2 and <3> <p title='>'>x</p><p title=\">\">y", ["1 < 2 and <3>", "x", "y"]),
        ("<title>t</title><nav>n<p>n</nav><main>m</main><footer>f", ["m"]),
        ("<header>page</header><article><header><h1>own</h1></header>text</article>", ["own", "text"]),
        ("<article>a<div class='ad'>x</div><div class='cookie-notice'>x</div><aside>x</aside>b</article>", ["a", "b"]),
        ("<section id=comments><p>x</p></section><div class='shadow'>kept</div><form>f<button>b</button></form>", ["kept"]),
        ("<p>x <button>no <b>no</b></button> y", ["x y"]),
        ("<div role=navigation>n</div><div role=main>m</div>", ["m"]),
        ("</p></div>a</html><p", ["a"]),
    ],
)
def test_parse(source, expected):
    assert blocks(source) == expected


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + "x" + "</div>" * 30_000
    assert blocks(deep) == ["x"]
    assert blocks("<p>word" * 50_000)[-1] == "word"
    assert len(blocks("<a \"" * 50_000 + ">x")) <= 1


def test_text_of_the_template(spark):
    df = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    expected = {}
    for r in df.collect():
        article = r["html"].partition("<article>")[2].partition("</article>")[0]
        parts = [re.sub("<[^>]*>", " ", p) for p in re.split("</?p>|</?h1>", article)]
        found = [" ".join(html.unescape(p).split()) for p in parts]
        expected[r["page_id"]] = "\n\n".join(p for p in found if p)
    assert {r["page_id"]: r["text"] for r in pages.extracted(df).collect()} == expected


def test_odd_rows(spark):
    made = [(1, None, None), (2, "no host", ""), (2, "no host", ""), (None, "http://h/", "<p>a"), (3, "http://h/", "<nav>x")]
    assert sorted(texts(spark, made, host="x", text="y", HTML="z")) == ["", "", "", "", "a"]
    assert texts(spark, []) == []


def test_copies_of_an_article_keep_their_text(spark):
    page = "<body><div class=top>Site of all sites.</div><article><p>Same words.</p></article></body>"
    assert texts(spark, [(i, "http://h/", page) for i in range(60)]) == ["Same words."] * 60


def site(host, n, notice, start=0):
    """Pages without a telling name: one part repeats, the other does not."""
    return [
        (start + i, f"http://{host}/{i}", f"<body><div class=x{i}>{notice(i)}</div><div class=y>Text {chr(97 + i % 26) * (i + 2)} of its own.</div></body>")
        for i in range(n)
    ]


def test_repeated_branch_without_a_name_is_removed(spark):
    made = site("a.example", 40, lambda i: f"Copyright 20{i} a.example. All rights reserved.")
    assert all(re.fullmatch(r"Text [a-z]+ of its own\.", t) for t in texts(spark, made))


def test_small_hosts_learn_from_all_hosts(spark):
    """Three pages a host, each with one of nine notices: a host alone repeats nothing."""
    made = sum((site(f"h{h}.example", 3, lambda i, h=h: f"Notice {chr(97 + (3 * h + i) % 9)} of the house.", 10 * h) for h in range(40)), [])
    made = [(i, u, s.replace("Text ", f"Text {'q' * i} ")) for i, u, s in made]
    found = texts(spark, made)
    assert all(t.startswith("Text q") or t.startswith("Text  ") or t.startswith("Text") for t in found)
    assert not any("Notice" in t for t in found)


def test_a_host_with_varied_branches_keeps_them(spark):
    made = site("b.example", 40, lambda i: f"Lead {'z' * (i + 1)} here.")
    assert all(t.startswith("Lead z") and "\n\nText" in t for t in texts(spark, made))


def test_importance_by_hand(spark, monkeypatch):
    made = [("h", "<div><p>a. b.</p></div>"), ("h", "<div><p>a. c.</p></div>"), ("h", "<div><p>a. a. d.</p><p>e.</p></div>"), ("g", "<div><p>a.</p></div>")]
    for held in (1, 300_000):
        monkeypatch.setattr(pages, "HELD", held)
        tree = pages.style_tree(spark.createDataFrame(made, "host string, html string").repartition(2)).collect()
        own = {r["host"]: r for r in tree}
        # On h: five features on three pages, one of them on all; one style of p.
        content = 1 - 1 / 5
        assert own["h"]["pages"] == 3 and own["h"]["own"] == pytest.approx(0.9 * content)
        assert own["g"]["own"] == 1.0
        of_all = 0.9 * (1 - math.log(4) / (5 * math.log(4))) + 0.1 * (1 * 1 / 4)
        assert own["h"]["of_all"] == pytest.approx(of_all)
        drawn = (3 * own["h"]["own"] + 20 * of_all) / 23
        assert own["h"]["importance"] == pytest.approx(min(drawn, of_all))
        assert own["g"]["importance"] == pytest.approx(min((1 + 20 * of_all) / 21, of_all))

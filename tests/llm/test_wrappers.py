import html
import random
import re

import pytest

from barloom.llm.dom import label_of, match, parse, slots_of
from barloom.llm.queries import op11_wrappers
from barloom.llm.wrappers import align, extract, host_of, template_of

SHAPE = "page_id long, url string, html string"


def texts(page):
    return [t for t, _ in parse(page)[0:2][1]]


def run(spark, pages, **columns):
    rows = [(k, *p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as host", "2 as kept", "3 as text", "4 as blocks").repartition(3)
    got = extract(df).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    return {r.page_id: r.text for r in got}


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain &amp; <b>bold</b>er", ["plain & bolder"]), ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
    ("<p>a\n\t b&nbsp; c<br>d</p>", ["a b c d"]), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<script>if (a<b) '</p>'</script>x<style>p{}</style><title>t</title><!-- <p>n</p> -->y", ["xy"]), ("a < b <3 &lt;i&gt;", ["a < b <3 <i>"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ('<p title="a>b">c</p><a href=">">d', ["c", "d"]), ('<p title="open>x</p>y', ["x", "y"]),
    ("<p>a</article></div>b</p>c", ["ab", "c"]), ("a<!-- never closed <p>b", ["a"]), ("<script>never closed", []), ("x<", ["x<"]), ("x</", ["x"]), ("<p", []),
    ("<?xml?><!DOCTYPE html><p>&eacute;&#233;&#xe9;&bogus;</p>", ["ééé&bogus;"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
])
def test_parse(page, want):
    assert texts(page) == want


def test_labels_hosts_and_deep_pages():
    assert label_of("div", ' class="side-bar x9 mainNav" id=Top role="navigation" hidden') == "div.bar.main.nav.side@navigation#top!"
    assert [host_of(u) for u in ("https://u:p@WWW.a.org:80/x", "http://b.c", "nonsense", None)] == ["www.a.org", "b.c", "", ""]
    root, blocks = parse("<div>" * 5000 + "x" + "</div>" * 5000 + "".join(f"<section class=c{'abcdefgh'[k % 8]}><i>{k}</section>" for k in range(3000)))
    tree, at = slots_of(root, len(blocks))
    assert len(blocks) == 3001 and len(tree[1]) <= 64


def test_matching_keeps_order():
    tree = lambda *kids: ["r", [["x", []] if k == "x" else [k, []] for k in kids]]
    assert match(tree("a", "b", "c"), tree("a", "c"))[0] == 3
    assert match(tree("a", "b"), tree("b", "a"))[0] == 2
    assert match(["r", []], ["s", []]) == (0, [])
    whole = template_of('["r",[["a",[]],["c",[]]]]', [])
    align(whole, template_of('["r",[["a",[]],["b",[]],["c",[["d",[]]]]]]', []))
    assert [k[0] for k in whole[1]] == ["a", "b", "c"] and whole[1][2][1][0][0] == "d"


def test_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", re.sub("<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    got = op11_wrappers(spark, folder)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in got.collect()} == want


def test_marked_layouts(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(99)) for _ in range(n))
    pages, want = [], []
    for k in range(24):
        paras = [words(30) for _ in range(1 + k % 4)]
        body = "".join(f"<p>{p}</p>" for p in paras)
        title = words(3)
        side = f"<div class='cookie-notice'>We use cookies {words(2)}</div><aside>{words(8)}</aside>"
        comments = f"<section id='comments'><article><p>{words(9)}</p></article></section>"
        form = "<form>name <input><button>go</button></form>"
        one = f"<body class='has-sidebar'><header><h1>Site</h1></header><div class=menu>{words(4)}</div>{side}<article><header><h1>{title}</h1></header>{body}<div class='share-links'>{words(2)}</div>{form}</article>{comments}<footer>f</footer>"
        two = f"<form class=page><div role=navigation>{words(3)}</div><main><h1>{title}</h1>{body}</main><div class='ads'>{words(5)}</div></form>"
        pages.append((f"http://{'one' if k % 2 else 'two'}.org/{k}", one if k % 2 else two))
        want.append("\n".join([title, *paras]))
    got = run(spark, pages)
    assert [got[k] for k in range(len(pages))] == want


def test_unmarked_layouts_need_the_host(spark):
    """Only what stays the same on the host's pages tells the menu, the hint and the imprint from the text."""
    rng = random.Random(2)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(99)) for _ in range(n))
    pages, want = [], []
    for k in range(30):
        paras = [words(40) for _ in range(2 + k % 3)]
        body = "".join(f"<p>{p}</p>" for p in paras)
        extra = "<table><tr><td>stay tuned</table>" if k % 4 == 0 else ""
        pages.append((f"http://plain.org/{k}", f"<div><span>Home</span> <span>About</span></div>{extra}<div><div>{body}</div></div><div>Imprint of this site, all rights kept</div>"))
        want.append("\n".join(paras))
    got = run(spark, pages)
    assert [got[k] for k in range(len(pages))] == want


def test_many_shapes_of_one_host_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr("barloom.llm.wrappers.FAN", 3)
    rng = random.Random(4)
    pages = []
    for k in range(60):
        tags = [rng.choice(["p", "ul", "pre", "h2"]) for _ in range(rng.randrange(1, 6))]
        pages.append(("http://many.org", "<div>Menu here</div><div>" + "".join(f"<{t}>{'<li>' * (t == 'ul')}text {k} {n} {'word ' * 20}</{t}>" for n, t in enumerate(tags)) + "</div><div><i>imprint</i></div>"))
    got = run(spark, pages)
    assert all("Menu" not in t and "imprint" not in t and t.startswith(f"text {k} 0") for k, t in got.items())


def test_odd_rows(spark):
    copy = ("http://copy.org", "<div><p>same text</p></div>")
    pages = [(None, None), ("http://a.org", ""), ("http://a.org", "   "), (None, "<p>alone</p>"), copy, copy, copy, ("x", "<article>" + "long " * 200_000 + "</article>"), ("http://b.org", "<nav>only a menu</nav>")]
    got = run(spark, pages)
    assert [got[k] for k in (0, 1, 2, 3, 4, 5, 6, 8)] == ["", "", "", "alone", "same text", "same text", "same text", ""]
    assert got[7] == ("long " * 200_000).strip()
    assert extract(spark.createDataFrame([], SHAPE)).collect() == []

"""Main text of pages: templates by brute force, odd markup, and pages of the tables."""

import html
import random
import re
from collections import Counter, defaultdict

from odd import CLASHING
from pyspark.sql import functions as F

from dayledger.llm import html_extract as H
from dayledger.llm import queries as Q
from dayledger.llm.common import table


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_parts_that_are_not_the_article():
    text = H.main_text(
        page(
            "<header class=top><h1>Site</h1></header><nav><a href=/>Home</a></nav>"
            '<div id="cookie-notice">We use cookies</div><div class="ad">Buy</div><aside>Side</aside>'
            "<article class='post'><header><h1>Title &amp;\n more</h1></header><p>One <b>two</b>&nbsp;three<br>four"
            "<p>Five<script>var t='</p>';</script><form><p>Name</p></form><div class='share-buttons'>Share</div>"
            "<!-- <p>no</p> --><ul><li>a<li>b</ul><table><tr><td>x<td>y<tr><td>z</table>"
            '<p style="display: none">hidden</p><pre> code  here </pre><footer>foot</footer></article>'
            '<section class="comments"><article class="comment"><p>First!</p></article></section><footer>(c)</footer>'
        )
    )
    assert text == "Title & more\nOne two three four\nFive\na\nb\nx\ny\nz\ncode here"


def test_odd_pages():
    assert H.main_text("") == ""
    assert H.main_text("no markup at all") == "no markup at all"
    assert H.main_text("a < b and <b>c</b> &lt; d &am") == "a < b and c < d &am"
    assert H.main_text("<article>cut off <b>here</b") == "cut off here"
    assert H.main_text("<article><p title='a>b'>x</div></p>y<!-- never ends") == "x\ny"
    assert H.main_text("<article><script>never ends <p>x</p>") == ""
    assert H.main_text(page("<div><main><p>text</p></main></div><p>rest</p>")) == "text"
    menu = "".join(f"<a href=/{i}>item {i}</a>" for i in range(9))
    assert H.main_text(page(f"<div>{menu}</div><p>plain <a href=/>text</a> of the page</p>")) == "plain text of the page"
    assert len(H.main_text(page("<article>" + "<div>" * 3000 + "deep " + "<p>word</p>" * 3000))) > 15_000


def host_pages(n, seed=1, host="a.example"):
    """Pages of one host with a constant notice inside the article and an optional part."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{draw.choice(['alpha', 'beta', 'gamma'])} {i} {k}" for k in range(draw.randrange(1, 4))]
        common = ["a passage that some pages share", "and its second line"] if i % 3 == 0 else []
        body = "".join(f"<p>{w}</p>" for w in [*words, *common])
        rows.append((i, f"http://{host}/{i}", page(
            f"<ul><li>Home</li><li>About</li></ul><article><p>Read this first</p><p>Then that</p>{body}</article>"
            + ("<div><h2>More</h2><i>x</i></div>" if i % 2 else "")
        ), words + common))
    return rows


def test_vectors_and_classes_equal_brute_force(spark):
    rows = host_pages(30) + host_pages(3, 2, "b.example")
    docs = spark.createDataFrame([(f"h{i % 2}" if "a." in u else "small", t, i) for i, u, t, _ in rows], "host string, text string, page long")
    found = H.vectors(docs.repartition(4))
    counts = defaultdict(Counter)
    for r in docs.collect():
        for key in [H.PAGE, *(H.token_hash(t) for t in H.tokens(r["text"]) if t.kind != "=" or not t.text.isspace())]:
            counts[r["host"], key][r["page"]] += key != H.PAGE or 1
    got = {(r["host"], r["token"]): r for r in found.collect()}
    assert got.keys() == counts.keys()
    assert all(got[k]["pages"] == len(c) and got[k]["total"] == sum(c.values()) for k, c in counts.items())
    by_hand, by_hash = defaultdict(set), defaultdict(set)
    for (host, key), c in counts.items():
        by_hand[host, frozenset(c.items())].add(key)
        by_hash[host, got[host, key]["high"], got[host, key]["low"]].add(key)
    assert sorted(map(sorted, by_hand.values())) == sorted(map(sorted, by_hash.values()))
    classes = {r["host"]: r["classes"] for r in H.templates(found).collect()}
    assert classes.keys() == {"h0", "h1"}
    for host, own in classes.items():
        wanted = {frozenset(v) for (h, c), v in by_hand.items() if h == host and len(c) >= 5 and len(v - {H.PAGE}) >= 2}
        assert {frozenset(c["tokens"]) for c in own} == {v - {H.PAGE} for v in wanted}


def test_classes_out_of_order_or_crossing_are_not_valid():
    template = H.Template(30, [{"pages": 30, "tokens": [1, 2]}, {"pages": 30, "tokens": [3, 4]}])
    place = template.place.get
    assert template.valid([place(t) for t in (1, 3, 9, 4, 2)]) == {0, 1}
    assert template.valid([place(t) for t in (1, 2, 1, 2)]) == {0}
    assert template.valid([place(t) for t in (2, 1, 3, 4)]) == {1}
    assert template.valid([place(t) for t in (1, 3, 2, 4)]) == {0}
    assert template.valid([place(t) for t in (1, 3, 4)]) == {1}


def test_constant_text_goes_and_shared_passages_stay(spark, monkeypatch):
    rows = host_pages(40) + [(100 + i, "http://a.example/0", r[2], r[3]) for i, r in enumerate(host_pages(2))]
    few = host_pages(4, 3, "few.example")
    docs = spark.createDataFrame([r[:3] for r in rows + few], "page_id long, url string, html string").repartition(3)
    for sent in (H.SENT_TOKENS, 0):
        monkeypatch.setattr(H, "SENT_TOKENS", sent)
        found = {(r["rest"]["url"], r["rest"]["page_id"]): r["text"] for r in H.extract(docs).collect()}
        for i, url, _, words in rows:
            assert found[url, i] == "\n".join(words)
        for i, url, _, words in few:
            assert found[url, i] == "\n".join(["Read this first", "Then that", *words])


def test_nulls_repeats_empty_table_and_clashing_names(spark):
    rows = [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "http://h/", None), (2, "nonsense", ""), (3, "http://h", "y")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = docs.select("*", *(F.lit("own").alias(c) for c in [*CLASHING, "host", "text", "page", "classes", "rows", "of", "salt"]))
    got = sorted(((r["rest"]["page_id"], r["text"]) for r in H.extract(clash).collect()), key=str)
    assert got == sorted([(1, "x"), (1, "x"), (None, ""), (2, ""), (3, "y")], key=str)
    assert H.extract(docs.where(F.lit(False))).count() == 0


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["page_id"]: r for r in Q.op11_html_extraction(spark, folder).collect()}
    pages = table(spark, folder, "pages").collect()
    assert len(found) == len(pages)
    for p in pages:
        inside = re.search("<article>(.*?)</article>", p["html"], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        text = "\n".join(b for b in blocks if b)
        assert (found[p["page_id"]]["url"], found[p["page_id"]]["text"]) == (p["url"], text)
        assert found[p["page_id"]]["n_chars"] == len(text)

"""Main text of pages: made sites whose articles are known, and classes against plain occurrence vectors."""

import collections
import random

import pytest
from llm.fixtures import words

from riskloom.llm import html_text, store

SCHEMA = "page_id bigint, url string, html string, host string, text string, token bigint, n_chars int, class string"


def table(spark, data):
    return spark.createDataFrame([(*r, "h", "t", 1, 2, "c") for r in data], SCHEMA).repartition(3)


def texts(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        assert r["n_chars"] == len(r["text"])
        out[r["page_id"]].append((r["url"], r["text"]))
    return {k: sorted(v, key=str) for k, v in out.items()}


def expected(data, article):
    out = collections.defaultdict(list)
    for page_id, url, _ in data:
        out[page_id].append((url, article[page_id]))
    return {k: sorted(v, key=str) for k, v in out.items()}


def _site(kind, page, rng):
    """(html, main text) of a page of one of several layouts."""
    title = f"Title {kind} {page} " + words(rng.randrange(10**6), 3)
    paragraphs = [words(rng.randrange(10**6), rng.randint(20, 60)) for _ in range(rng.randint(1, 6))]
    body = "".join(f"<p>{p}</p>\n" for p in paragraphs)
    links = "".join(f'<li><a href="/{k}">{words(rng.randrange(10**6), 2)}</a></li>' for k in range(rng.randint(2, 6)))
    whole = "\n".join([title, *paragraphs])
    if kind == "semantic":
        page = (
            f"<!DOCTYPE html><html><head><title>{title}</title><script>if (a < b) document.write('<p>no</p>');</script><style>p > a {{}}</style></head><body>"
            f"<header><h2>Site name</h2></header><nav><ul>{links}</ul></nav><main><article class='post-{page}'><header><h1>{title}</h1></header>{body}"
            f"<form><label>Mail</label><input name=q><button>Send</button></form></article><section id=comments><h3>Comments</h3><article><p>{words(1, 40)} by reader {page}</p></article></section>"
            f"</main><aside>{words(rng.randrange(10**6), 80)}</aside><footer>&copy; 2024</footer></body></html>"
        )
    elif kind == "divs":
        page = (
            f"<html><body><div class=topbar>Our site has a very long claim that every page repeats, word for word, whatever it is about, and on and on</div>"
            f"<div id=menu1>{links}</div><div class=page><div class=content><h1>{title}</h1><div class=text>{body}</div>"
            f"<div class=hint>Read more on our pages</div><div class='ad-slot'>{words(rng.randrange(10**6), 30)}</div></div>"
            f"<ul>{links}</ul></div><div class='cookie-notice'>We use cookies {page}</div></body></html>"
        )
    elif kind == "broken":
        # Open paragraphs, stray end tags, no end.
        body = "".join(f"<p><b>{p}</b><br>" for p in paragraphs)
        page = f"<body><div class=nav>{links}</div></span><article><h1>{title}</h1>{body}</div></article><div class=footer>{title}"
    else:
        rows = "".join(f"<tr><td>{p}" for p in paragraphs)
        page = f"<html><body><table class=menu><tr><td>{links}</table><table class=story><tr><th><h1>{title}</h1>{rows}</table><p class=copyright-footer>All rights</body></html>"
    return page, whole


def test_sites(spark):
    rng = random.Random(12)
    data, article = [], {}
    for k, (kind, pages) in enumerate([("semantic", 40), ("divs", 30), ("broken", 12), ("tables", 8), ("semantic", 2), ("broken", 1)]):
        for i in range(pages):
            page_id = 1000 * k + i
            page, article[page_id] = _site(kind, i, rng)
            data.append((page_id, f"https://user@Host{k}.example.org:8080/a/{i}?x=1", page))
    data += [data[3], data[3], data[45]]
    got, wanted = texts(html_text.main_texts(table(spark, data))), expected(data, article)
    assert got == wanted


def test_odd_rows(spark):
    long = "".join(f"<p>{words(k, 50)}</p>" for k in range(4000))
    same = "<body><nav>menu</nav><article><h1>Same</h1><p>One text on all pages.</p></article></body>"
    data = [
        (1, "http://a.org/1", None), (2, "http://a.org/2", ""), (3, None, "plain text & more &amp; &#233;&nbsp;&lt;b&gt; &copy 5"), (None, None, "<p>a</p>b<br>c <p> d\n\te"),
        (4, "http://a.org/3", "<p>unclosed <b>bold"), (5, "http://a.org/4", "<p>cut <a href='x"), (6, "x", "<!-- only a comment"), (7, "x", "<script>var a = '<p>x</p>'"),
        (8, "http://long.org/", f"<article>{long}</article>"), (9, "http://a.org/5", "a <b>b</b>c < d <3 <?php x ?> <![CDATA[y]]> </> e"),
        (10, "http://a.org/6", "<a \"" * 1000), (11, "http://a.org/7", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    article = {
        1: "", 2: "", 3: "plain text & more & é <b> © 5", None: "a\nb c\nd e", 4: "unclosed bold", 5: "cut", 6: "", 7: "",
        8: "\n".join(words(k, 50) for k in range(4000)), 9: "a bc < d <3 e", 10: "", 11: "deep",
    }
    for k in range(20, 30):
        data.append((k, f"http://same.org/{k}", same))
        article[k] = "Same\nOne text on all pages."
    got, wanted = texts(html_text.main_texts(table(spark, data))), expected(data, article)
    assert got == wanted
    assert html_text.main_texts(table(spark, [])).count() == 0


def _vectors(pages):
    """Classes of a host by plain vectors: sets of tokens that occur as often as each other on every page."""
    parser = html_text.Parser()
    counts = [collections.Counter(html_text._token(i) for i in parser.parse(p)) for p in pages]
    classes = collections.defaultdict(set)
    for token in set().union(*counts):
        vector = tuple(c[token] for c in counts)
        if sum(n > 0 for n in vector) >= html_text.SUPPORT:
            classes[vector].add(token)
    return {frozenset(c) for c in classes.values() if len(c) > 1}


def test_classes(spark):
    """Signatures give the classes of the plain vectors; the valid ones nest and come in order."""
    rng = random.Random(7)
    pages = [_site("semantic", i, rng)[0] for i in range(9)]
    # Two tags in different orders on different pages: one class, not valid.
    pages = [p.replace("</main>", ("<i></i><u></u>" if k % 2 else "<u></u><i></i>") + "</main>") for k, p in enumerate(pages)]
    rows = html_text._rows(table(spark, [(k, "http://h.org/", p) for k, p in enumerate(pages)]))
    valid, held, _ = html_text.templates(rows)
    got = {frozenset(r["members"]): r for r in valid.collect()}
    plain = _vectors(pages)
    assert set(got) <= plain and len(got) >= 2
    parser = html_text.Parser()
    items = [parser.parse(p) for p in pages]
    turned = {t for t in items[0] if isinstance(t, int)} & {html_text._token(i) for i in parser.parse("<html><body><main><i></i><u></u></main></body></html>")}
    for members, row in got.items():
        for page in items:
            order = [html_text._token(i) for i in page if html_text._token(i) in members]
            assert order == list(row["members"]) * (len(order) // len(members))
    # The class with every page's tokens holds those that turn: it is one vector, but no order.
    ones = next(c for c in plain if turned <= c)
    assert ones not in got
    assert held.count() > 0


@pytest.mark.parametrize("order", ["abcabc", "abc", "acb", "abab"])
def test_arrangement(order):
    classes = html_text.Classes()
    classes.add(1, [97, 98, 99], False)
    classes.add(2, [120, 121], False)
    found = html_text.arrangement([ord(c) for c in order], classes)
    assert found[1] == (((97, 98, 99), 0, 0) if order in ("abc", "abcabc") else ((97, 99, 98), 0, 0) if order == "acb" else None)
    nested = html_text.arrangement([ord(c) for c in "axybc"], classes)
    assert nested[2] == ((120, 121), 1, 1) and nested[1] == ((97, 98, 99), 0, 0)
    assert html_text.arrangement([ord(c) for c in "axybxyc"], classes)[2] is None
    crossed = html_text.arrangement([ord(c) for c in "axbyc"], classes)
    assert crossed[2] is None and crossed[1] is not None


def test_packed_side_tables(spark):
    df = spark.range(5000).selectExpr(f"id * 7919 % 97 - 40 AS {store.BLOCK}", "id AS value")
    path = store.write_packed(df, "packed")
    for block in (-40, 0, 56):
        assert sorted(store.read_packed(path, block, ["value"]).column("value").to_pylist()) == [r["value"] for r in df.filter(f"{store.BLOCK} = {block}").sort("value").collect()]
    assert store.read_packed(path, 10**6, ["value"]) is None

import random

import pytest
from pyspark.sql import functions as F

from plateau.llm import page_diff as X
from plateau.llm.common import prepare

SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_shared_lines_against_table():
    rng = random.Random(0)
    for _ in range(800):
        a = [rng.choice("abcde") for _ in range(rng.randrange(15))]
        b = [rng.choice("abcdf") for _ in range(rng.randrange(15))]
        s = [a[i] for i in sorted(X.shared_lines(a, b))]
        it = iter(b)
        assert all(x in it for x in s) and len(s) == lcs(a, b)


def test_blocks():
    page = ("<!doctype html><html><head><title>T</title><style>p{}</style></head><body class='page'><header>top</header>"
            "<nav><ul><li>menu</ul></nav><main><h1>Head &amp; line</h1><p>one\n  two <b>three</b><p>4 &lt; 5<br>next"
            "<aside>side</aside><div class='cookie-notice'>eat</div><form>f<input></form><script>var a='</p>';</script>"
            "<section id=comments><p>me too</section><footer>f</footer></main><div>after</div></body></html>")
    assert X.blocks(page) == (["Head & line", "one two three", "4 < 5", "next"], True)
    assert X.blocks("plain <i>te</i>xt") == (["plain text"], False)
    assert X.blocks("<article></article><p>only body") == (["only body"], False)
    assert X.blocks("") == ([], False) and X.blocks("<!-- never closed <p>x") == ([], False)


def brute(rows):
    """Partners over the sorted list of all pages, without buckets and rows of copies: the nearest page with other lines on
    either side, the longer common path first, the other if nothing would remain."""
    pages = sorted(({"key": X.page_key(i, u), "page_id": i, "url": u, **dict(zip(("lines", "article"), X.blocks(h or "")))}
                    for i, u, h in rows), key=lambda p: (p["key"], X.line_hash(p["lines"])))
    out = []
    for n, p in enumerate(pages):
        before = next((q for q in reversed(pages[:n]) if q["lines"] != p["lines"]), None)
        after = next((q for q in pages[n + 1:] if q["lines"] != p["lines"]), None)
        path = lambda q: -1 if q is None else X.common_path(p["key"], q["key"])
        order = [before, after] if path(before) >= path(after) else [after, before]
        text = p["lines"]
        for q in [] if p["article"] else order:
            if path(q) >= 0:
                gone = X.shared_lines(p["lines"], q["lines"])
                rest = [x for i, x in enumerate(p["lines"]) if i not in gone]
                if rest:
                    text = rest
                    break
        out.append((p["page_id"], p["url"], "\n".join(text), len("\n".join(text))))
    return out


def copied(rng, n):
    """Sites whose pages repeat under several urls, at host starts and in long rows."""
    rows, i = [], 0
    while i < n:
        host = rng.choice(["a.com", "b.org"])
        body = "".join(f"<p>own {rng.randrange(10 ** 6)}" for _ in range(rng.randrange(0, 3)))
        page = f"<div>menu {host}</div>{body}<div>foot</div>"
        folder = f"{rng.choice('xyz')}{rng.randrange(40):02d}"
        for c in range(rng.choice([1, 1, 2, 3, 9])):
            rows.append((i, f"http://{host}/{folder}/{c}", page if rng.random() < 0.95 else page.replace("own", "new")))
            i += 1
    return rows


def site(rng, n):
    rows = []
    for i in range(n):
        host = rng.choice(["a.com", "a.com", "www.b.org"])
        body = "".join(f"<p>own {rng.randrange(10 ** 6)}" for _ in range(rng.randrange(1, 6)))
        rows.append((i, f"http://{host}/{rng.choice('xyz')}/{rng.randrange(50)}?q={i}", f"<div>Site {host}</div>{body}<div>All rights</div>"))
    return rows


def test_template_lines_go(spark):
    rows = site(random.Random(2), 40)
    got = {r["page_id"]: r["text"] for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("Site" not in t and "All rights" not in t and "own" in t for t in got.values())


@pytest.mark.parametrize("make,n,bucket", [(site, 300, 20), (copied, 200, 3), (copied, 200, 40), (copied, 60, 1)])
def test_buckets_and_copies_change_nothing(spark, monkeypatch, make, n, bucket):
    rows = make(random.Random(n + bucket), n)
    rows += [rows[5], (rows[7][0], rows[7][1], "<p>same url and id")]
    monkeypatch.setattr(X, "PAGES_PER_BUCKET", bucket)
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_short_pages_under_long_templates_and_copies_at_the_start(spark):
    template = "".join(f"<div>site line {i} of ten</div>" for i in range(10))
    rows = [(1, "http://t.com/a/1", template + "<p>one"), (2, "http://t.com/a/2", template + "<p>two"),
            (3, "http://s.com/a/1", "<div>menu</div><p>x<div>foot</div>"), (4, "http://s.com/a/1b", "<div>menu</div><p>x<div>foot</div>"),
            (5, "http://s.com/a/2", "<div>menu</div><p>y<div>foot</div>")]
    got = {r["page_id"]: r["text"] for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "one", 2: "two", 3: "x", 4: "x", 5: "y"}


def test_copies_and_articles_keep_their_lines(spark):
    rows = [(1, "http://h.com/a/1", "<p>x one<p>same"), (2, "http://h.com/a/2", "<p>x one<p>same"),
            (3, "http://g.com/a/1", "<article><p>shared<p>mine</article>"), (4, "http://g.com/a/2", "<article><p>shared<p>other</article>")]
    got = {r["page_id"]: r["text"] for r in X.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "x one\nsame", 2: "x one\nsame", 3: "shared\nmine", 4: "shared\nother"}


def test_awkward_pages(spark):
    rows = [(None, None, None), (None, None, "<p>a"), (1, "", ""), (1, "http://[bad", "<p>b"), (2, "http://x.y/z", "<p>c"), (2, "http://x.y/z", "<p>c"),
            (3, "http://x.y/long", "<p>" + "word " * 50_000 + "<div " * 2000), (4, "http://x.y/é", "<p>\U0001F600 d&eacute;")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(0).alias(c) for c in ("bucket", "key", "own", "lines", "text", "article")])
    got = X.extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sum(r["text"] == "c" for r in got) == 2 and any(r["text"] == "\U0001F600 dé" for r in got)
    assert X.extract(spark.createDataFrame([], SCHEMA)).collect() == []

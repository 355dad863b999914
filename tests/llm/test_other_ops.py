import os
import random
from urllib.parse import urljoin, urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import chat, rules, toxicity, urls, vectors
from spanloom.llm.registry import queries
from spanloom.llm.common import components

PAGES = "page_id long, url string, html string"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def union_find(edges):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        top[max(p, q)] = min(p, q)
    return {x: find(x) for x in top}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    df = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == union_find([e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0


def test_url_rules(spark):
    rows = [
        (1, "https://A.B.Example.NET/en/x?q#f", None), (2, "http://example.net/fr", None), (3, "http://net", None),
        (4, "http://net/", None), (5, None, None), (6, "no scheme", None), (7, "http://x.example.com/de/1", None),
        (8, "ftp://org/fr/://x", None), (9, "http://notnet/", None), (None, "http://x.net/", None),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(1)), RULES).collect()}
    assert got == {
        1: ("a.b.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "/fr", "net/", "block"),
        3: ("net", "", None, "allow"), 4: ("net", "/", "net/", "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("x.example.com", "/de/1", "example.com/de/", "block"), 8: ("org", "/fr/://x", "org/fr/", "allow"),
        9: ("notnet", "/", None, "allow"), None: ("x.net", "/", "net/", "block"),
    }
    assert urls.judge(spark.createDataFrame([], PAGES), RULES).count() == 0


def test_url_aliases(spark):
    link = '<html><LINK href="{}" rel="canonical"></html>'
    rows = [
        (1, "http://a.com/1", link.format("http://bad.net/x")), (2, "http://a.com/2#f", '<meta http-equiv=refresh content="0; url=/1">'),
        (3, "http://a.com/3", link.format("http://c.com/9")), (4, "http://d.org/fr/1", link.format("http://bad.net/x")),
        (5, "http://e.com/", link.format("//bad.net/y")), (6, "http://f.com/a/b", link.format("c")), (7, "http://f.com/a/c", ""),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.verdict for r in urls.judge(pages, RULES).collect()}
    # 1, 2 and 4 share a group with a blocked url and an allowed one: allow goes first
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "block", 6: "allow", 7: "allow"}
    redirects = spark.createDataFrame([("http://f.com/a/c", "http://g.net/")], "a string, b string")
    got = {r.page_id: r.verdict for r in urls.judge(pages.where("page_id <> 4"), RULES, redirects).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 5: "block", 6: "block", 7: "block"}


@pytest.mark.parametrize(("html", "blocked"), [
    ('<!-- <link rel="canonical" href="http://a.net/x"> -->', False), ('<!-- <link rel=canonical href="http://a.net/x">', False),
    ("""<script>x = '<meta http-equiv="refresh" content="0;url=http://a.net/">'</script>""", False),
    ('<style><link rel=canonical href=http://a.net/></style><link rel=canonical href=http://b.com/>', False),
    ('<link rel="canonical" href="http&#x3A;//a&#46;net/x">', True), ('<link rel="canonical" href="http&colon;//a.net/&amp;x">', True),
    ('<LINK data-x="a>b" rel=canonical href=http://a.net/>', True), ("<link title='rel=canonical' href='http://a.net/'>", False),
    ('<link rel="alternate CANONICAL" href="http://a.net/">', True), ('<link rel=canonicals href=http://a.net/>', False),
    ('<link rel=icon href=http://b.com/i><link\nhref = "http://a.net/q?a=1;b=2"\nrel = "canonical"/>', True),
    ('<script>"<!--"</script><link rel=canonical href=http://a.net/>', True), ('<META CONTENT="5; URL=\'http://a.net/\'" HTTP-EQUIV=Refresh>', True),
    ('<meta name="refresh" content="0;url=http://a.net/">', False), ('<meta http-equiv=refresh content=0;url=//a.net/>', True), ("<link rel=canonical>", False),
    ("<link " * 3000 + ">", False), ("<!--" + "-" * 200_000, False),
])
def test_links_of_pages(spark, html, blocked):
    rows = [(1, "http://me.com/p", html), (2, "foo", html), (3, "foo", html)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, PAGES), RULES).collect()}
    assert got == {1: "block" if blocked else "allow", 2: "allow", 3: "allow"}


def test_aliases_equal_their_sql(spark):
    """Group verdicts by a recursive query over edges that are given as such."""
    import duckdb

    rng = random.Random(5)
    hosts = ["a.com", "b.com", "bad.net", "d.org", "example.net", "x.example.com"]
    url = lambda: f"http://{rng.choice(hosts)}/{rng.choice(['fr', 'en', 'de', 'x'])}/{rng.randrange(40)}"
    rows, edges = [], []
    for i in range(300):
        here, there = url(), url()
        rows.append((i, here, f'<link rel="canonical" href="{there}">' if i % 3 else "<p>"))
        edges += [(here, there)] * bool(i % 3)
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, PAGES), RULES).collect()}

    def said(u):
        site = urlsplit(u)
        fits = [(len(h + p), v) for v, h, p in RULES if (site.hostname == h or site.hostname.endswith("." + h)) and site.path.startswith(p)]
        return max(fits)[1] if fits else None

    con = duckdb.connect()
    con.sql("CREATE TABLE p (page_id INT, url VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", [r[:2] for r in rows])
    con.sql("CREATE TABLE e (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO e VALUES (?, ?)", edges)
    con.sql("CREATE TABLE v (url VARCHAR, said VARCHAR)")
    con.executemany("INSERT INTO v VALUES (?, ?)", [(u, said(u)) for u in {*(r[1] for r in rows), *(x for e in edges for x in e)}])
    want = dict(con.sql("""
WITH RECURSIVE both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(url, other) AS (
  SELECT url, url FROM v UNION SELECT url, b FROM reach JOIN both_ways ON a = other
), g AS (SELECT r.url, bool_or(said = 'allow') AS allowed, bool_or(said = 'block') AS blocked FROM reach r JOIN v ON v.url = other GROUP BY 1)
SELECT page_id, coalesce(said, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') FROM p JOIN v USING (url) JOIN g USING (url)""").fetchall())
    assert got == want and len(set(want.values())) == 2


BASE = "http://a.Com/b/c;d?q#f"


@pytest.mark.parametrize("target", [
    "#top", "?p=2", "g", "./g", "g/", "/g", "//G.org", "../g", "../../g", "../../../g", "g/./h/../i", ".", "..",
    "./", "../", "g;x=1/../y", "http://h.net/z?a#b", "mailto:x@y.z", "g?y/./x", "",
])
def test_references_resolve_as_rfc_3986_says(spark, target):
    for base in (BASE, "http://x.com/x/y?p=1", "http://x.com"):
        got = spark.range(1).select(urls.absolute(F.lit(target), F.lit(base))).first()[0]
        assert got == urljoin(base, target).partition("#")[0], (base, target)


def test_dots_of_references_with_a_site(spark):
    # urllib keeps these
    for target, expected in (("//g.org/x/../y", "http://g.org/y"), ("http://h.net/../z/./w?a#b", "http://h.net/z/w?a")):
        assert spark.range(1).select(urls.absolute(F.lit(target), F.lit(BASE))).first()[0] == expected


def test_url_keys(spark):
    rows = [("HTTP://A.Com/X?Q#f", "http://a.com/X?Q"), ("http://a.com", "http://a.com/"), ("http://a.com?q", "http://a.com/?q"), ("/x", "/x")]
    df = spark.createDataFrame(rows, "u string, k string")
    assert all(r[0] == r.k for r in df.select(urls.key_of(F.col("u")), "k").collect())


def test_url_query_on_a_table_with_aliases(spark, tmp_path):
    rng = random.Random(3)
    hosts = ["a.com", "B.net", "example.net", "x.example.com", "c.org", *(f"H{k}.edu" for k in range(60))]
    paths = ["/", "/en/1", "/de/2", "/fr/3", "/x/y/z", "/p?a=1&b=2", ""]
    rows = []
    for i in range(400):
        url = f"http://{rng.choice(hosts)}{rng.choice(paths)}"
        target = rng.choice([None, "../q", "/fr/9", f"http://{rng.choice(hosts)}{rng.choice(paths)}", "//c.org/fr/", "?z=1", "#top"])
        html = None if target is None else f'<link rel="canonical" href="{target.replace("&", "&amp;")}">'
        rows.append((i, url, html))
    rows += [(400, None, "<link rel=canonical href='http://b.net/x'>"), (401, "no url", ""), (402, "http://a.com/" + "x" * 5000, None)] + rows[:3]
    spark.createDataFrame(rows, PAGES).withColumn("group_verdict", F.lit(1)).write.parquet(os.path.join(str(tmp_path), "pages.parquet"))

    def rule(url):
        at = urlsplit(url)
        fits = [(v, h + p) for v, h, p in RULES if (at.netloc.lower() == h or at.netloc.lower().endswith("." + h)) and at.path.startswith(p)]
        return max(fits, key=lambda f: len(f[1]), default=(None, None))

    def key(url):
        at = urlsplit(url)
        return at._replace(scheme=at.scheme.lower(), netloc=at.netloc.lower(), path=at.path or "/", fragment="").geturl()

    edges = [(key(u), key(urljoin(u, h.split('"')[3].replace("&amp;", "&")))) for _, u, h in rows if u and h and "://" in u]
    top = union_find([e for e in edges if e[0] != e[1]])
    said = {}
    for node, root in top.items():
        said.setdefault(root, set()).add(rule(node)[0])
    expected = []
    for i, u, _ in rows:
        verdict, text = rule(u) if u and "://" in u else (None, None)
        if verdict is None and u and "://" in u:
            group = said.get(top.get(key(u)), set())
            verdict = "allow" if "allow" in group else "block" if "block" in group else "allow"
        expected.append((i, verdict or "allow", text))
    got = [(r.page_id, r.verdict, r.rule) for r in queries()["op2_url_filters"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert any(v == "block" and t is None for _, v, t in expected)  # some are blocked by their aliases alone


def test_chat_round_trip_and_attachments(spark):
    hard = ["<|im_end|>\n", "<\\|", "<\\\\|x|>", "<", "|>", "", None, "<|nl|>", "a\nb", "<|image|>"]
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(hard)] + [(2, None, None, "x"), (2, 1, "a\n<|b", "y"), (None, 0, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_part(F.col("text"))).withColumn("formatted", F.lit(1))
    made = chat.format_conversations(df)
    got = {
        r.conv_id: r
        for r in made.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    assert [(t.role, t.text) for t in got[1].turns] == [("user" if i % 2 else "assistant", t or "") for i, t in enumerate(hard)]
    assert [t for t in got[1].loss] == [t for i, t in enumerate(hard) if i % 2 == 0 and t]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "x"), ("a\n<|b", "y")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "z")]
    assert chat.format_conversations(df.limit(0)).count() == 0

    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    parts = [part("text", "see <|image|>"), part("image", ref="i.png", w=57, h=28), part("audio", ref="a", s=2.0), part("document", ref="d", p=3), part("odd", ref="o"), part("image", ref="?")]
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df).withColumn("loss", chat.loss_texts(F.col("formatted"), F.col("loss_spans"))).first()
    assert r.formatted == "<|im_start|>assistant\nsee <\\|image\\|><|image|><|audio|><|document|><|attachment|><|image|><|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "i.png", 3), ("audio", "a", 50), ("document", "d", 768), ("attachment", "o", 1), ("image", "?", 1)]
    assert r.expanded_tokens == 823 and r.loss == ["see <|image|>"]


def test_chat_text_in_any_parts(spark):
    rng = random.Random(2)
    pieces = ["<", "|", "\\", "<|", "|>", "im_end", "im_start", "\n", "<|im_end|>\n", "x", "", "image"]
    part = lambda t: ("text", t, None, None, None, None, None)
    rows, expected = [], {}
    for i in range(300):
        for k in range(rng.randint(1, 4)):
            texts = [rng.choice(pieces) for _ in range(rng.randint(0, 9))]
            role = rng.choice(["user", "assistant"])
            rows.append((i, k, role, [part(t) for t in texts]))
            expected.setdefault(i, []).append((role, texts))
    rows.append((900, 0, "assistant", [part("y" * 200_000)]))
    rows += [(901, 0, "user", [part("again")])] * 2
    expected |= {900: [("assistant", ["y" * 200_000])], 901: [("user", ["again"])] * 2}
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    made = chat.format_conversations(df)
    made = made.select("conv_id", "n_turns", chat.parse(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in made.collect()}
    assert len(got) == len(expected)
    for i, turns in expected.items():
        assert [(t.role, t.text) for t in got[i].turns] == [(role, "".join(texts)) for role, texts in turns]
        assert got[i].n_turns == len(turns)
        assert "".join(got[i].loss) == "".join("".join(texts) for role, texts in turns if role == "assistant")


def brute_links(rows, threshold):
    links = {}
    for i, (a, va, la) in enumerate(rows):
        for j, (b, vb, lb) in enumerate(rows):
            if i == j or la is None or la != lb or not va or not vb or len(va) != len(vb):
                continue
            x, y = np.array(va, dtype=float), np.array(vb, dtype=float)
            if None in va or None in vb or not np.isfinite(x).all() or not np.isfinite(y).all() or not x.any() or not y.any():
                continue
            if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links.setdefault(a, set()).add(b)
    return links


def test_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16))
    rows = []
    for i in range(240):
        v = (centres[i % 12] + 0.18 * rng.standard_normal(16)).astype(np.float32).tolist()
        rows.append((i, v, i % 3))
    rows += [(300 + i, rows[0][1], 0) for i in range(5)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] * 16, 0), (403, [None] * 16, 0), (404, rows[0][1], None), (405, [], 0), (406, rows[0][1][:8], 0), (407, [float("inf")] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("weight", F.lit(1))
    got = {r.vec_id: r for r in vectors.near_duplicates(df, 0.93).collect()}
    links = brute_links(rows, 0.93)
    roots = union_find([(a, b) for a, s in links.items() for b in s])
    assert len(got) == len(rows)
    total = sum(map(len, links.values()))
    assert total > 500 and sum(r.n_links for r in got.values()) >= 0.999 * total
    for i, r in got.items():
        assert r.n_links <= len(links.get(i, ()))
        assert r.component_id >= roots.get(i, i) and r.kept == (r.vec_id == r.component_id)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(400, 408))
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_crowd_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(8) + 0.02 * rng.standard_normal(8)).tolist(), 1) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vectors.near_duplicates(df, 0.93).collect()
    assert all(r.n_links == 59 and r.component_id == 0 for r in got)
    o = 0.0
    east, north, up = [1.0, o, o, o], [o, 1.0, o, o], [o, o, 1e200, o]
    rows = [(7, east, 1), (7, north, 1), (8, north, 1), (9, up, 1), (9, up, 1), (3, [2.0, o, o, 1e-3], 1), (4, north, 2), (5, [o, o, 1e-200, o], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df, 0.93).collect())
    # 7 holds two vectors, which joins 3 and 8; scales don't matter
    assert got == [(3, 1, 3), (4, 0, 4), (5, 2, 5), (7, 1, 3), (7, 1, 3), (8, 1, 3), (9, 2, 5), (9, 2, 5)]


@pytest.mark.parametrize("block", [7, 4096])
def test_vectors_in_dense_buckets_give_what_pairs_give(spark, monkeypatch, block):
    """Clusters in blocks: every link counts once, though its vectors share several dense buckets, and copies by weight."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((4, 12))
    rows = [(i, (centres[i % 4] + 0.25 * rng.standard_normal(12)).tolist(), i % 8 // 4) for i in range(400)]
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(20)]
    # a chain of steps that link neighbours only: one component however it is cut
    turn = [(2000 + i, [float(np.cos(0.2 * i)), float(np.sin(0.2 * i))] + [0.0] * 10, 2) for i in range(8)]
    df = spark.createDataFrame(rows + turn, "vec_id long, embedding array<double>, label int")
    read = lambda: sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df, 0.93).collect())
    pairs = read()
    monkeypatch.setattr(vectors, "DENSE", 12)
    monkeypatch.setattr(vectors, "BLOCK", block)
    links = brute_links(rows + turn, 0.93)
    total = sum(map(len, links.values()))
    dense = read()
    assert sum(n for _, n, _ in dense) >= sum(n for _, n, _ in pairs) >= 0.99 * total and total > 5000
    assert all(n <= len(links.get(i, ())) for i, n, _ in dense)
    roots = union_find([(a, b) for a, s in links.items() for b in s])
    assert sum(c == roots.get(i, i) for i, _, c in dense) >= 0.99 * len(dense)


def test_forest_connects_what_a_matrix_does():
    rng = np.random.default_rng(9)
    for share in (0.0, 0.005, 0.02, 0.1, 1.0):
        for rows, columns in ((60, 90), (1, 5), (5, 1)):
            linked = rng.random((rows, columns)) < share
            a, b = vectors.forest(linked)
            assert linked[a, b].all() and len(a) < rows + columns
            whole = union_find([(i, rows + j) for i, j in zip(*np.nonzero(linked))])
            assert union_find([(i, rows + j) for i, j in zip(a, b)]) == whole
    linked = rng.random((80, 80)) < 0.02
    linked |= linked.T
    assert union_find(list(zip(*vectors.forest(linked)))) == union_find(list(zip(*np.nonzero(linked))))


def test_cosines_at_the_threshold():
    rng = np.random.default_rng(10)
    x, y = rng.standard_normal((40, 9)), rng.standard_normal((30, 9))
    norm = lambda v: np.sqrt((v * v).sum(axis=1))
    one = lambda i, j: sum((p * q for p, q in zip(x[i], y[j])), 0.0) / (norm(x)[i] * norm(y)[j])
    for i, j in ((0, 0), (3, 29), (39, 7)):
        for threshold in (one(i, j), np.nextafter(one(i, j), 2.0)):
            got = vectors._cosines(x, y, norm(x), norm(y), threshold)
            assert got.tolist() == [[bool(one(a, b) >= threshold) for b in range(30)] for a in range(40)]


def test_columns_and_rows_that_nobody_expects(spark):
    from .conftest import CLASHES

    extra = [c for c in (*CLASHES, "x", "y", "b", "dims", "key", "own", "t", "turns", "parts_", "url_", "formatted", "verdict", "rule", "n_links", "kept") if c]
    more = lambda df: df.select("*", *(F.lit("z").alias(c) for c in extra if c not in df.columns))
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    plain = sorted(map(str, vectors.near_duplicates(df).collect()))
    assert sorted(map(str, vectors.near_duplicates(more(df)).collect())) == plain and len(plain) == 5
    got = [r for r in vectors.near_duplicates(more(df)).collect() if r.vec_id is None]
    assert len(got) == 2 and all(r.n_links == 0 and r.component_id is None for r in got)
    pages = spark.createDataFrame([(1, "http://a.net/", "<p>"), (1, "http://a.net/", "<p>"), (None, None, None), (2, "x" * 100_000, "<" * 100_000)], PAGES)
    plain = sorted(map(str, urls.judge(pages, RULES).collect()))
    assert sorted(map(str, urls.judge(more(pages), RULES).collect())) == plain and len(plain) == 4
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 0, "user", "hi"), (None, None, None, None), (2, 1, "assistant", "w " * 50_000)], "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("parts", chat.text_part(F.col("text")))
    plain = sorted(map(str, chat.format_conversations(turns).collect()))
    assert sorted(map(str, chat.format_conversations(more(turns)).collect())) == plain and len(plain) == 3


def test_vectors_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(vectors, "vector_hash", lambda embedding: F.lit(1).cast("long"))
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df, 0.93).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1)]


def test_vector_hashes_select():
    assert vectors.layout(6000, 0.93)[0] >= 8 and vectors.layout(10**9, 0.93)[0] > vectors.layout(10**6, 0.93)[0]
    rng = np.random.default_rng(1)
    unit = lambda v: v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    hasher = vectors.Hasher(64, *vectors.layout(6000, 0.93))
    x, away = unit(rng.standard_normal((2000, 64))), rng.standard_normal((2000, 64))
    away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
    near = 0.93 * x + np.sqrt(1 - 0.93**2) * away  # cosine 0.93 exactly
    keys = hasher.keys(x)
    assert (keys == hasher.keys(near)).any(axis=1).mean() > 0.99
    assert (keys == hasher.keys(unit(rng.standard_normal((2000, 64))))).any(axis=1).mean() < 0.1
    differ = [bin(a ^ b).count("1") for a, b in zip(hasher.signs(x).view(np.uint64).tolist(), hasher.signs(near).view(np.uint64).tolist(), strict=True)]
    assert max(differ) <= vectors.most_signs(0.93) < 32


def test_vector_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").where("label < 4").collect()]
    whole = {r.vec_id: r for r in queries()["op8_embedding_near_dedup"](spark, sf).collect()}
    links = brute_links(rows, 0.93)
    total = sum(map(len, links.values()))
    assert sum(whole[i].n_links for i, _, _ in rows) >= 0.99 * total
    assert all(whole[i].n_links <= len(links.get(i, ())) for i, _, _ in rows)


def test_lasso_rules_learn_and_compile(spark):
    rng = np.random.default_rng(2)
    x = rng.random((1500, len(rules.STATISTICS)))
    y = ((x[:, 3] > 0.4) & (x[:, 9] <= 0.7)).astype(float)
    made = rules.train(x, y)
    assert 0 < len(made.rules) and ((made.predict(x) >= 0.5) == (y == 1)).mean() > 0.97
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], rules._STRUCT)
    scores = [r[0] for r in rows.select(made.score(F.struct(*rules.STATISTICS))).collect()]
    assert np.allclose(scores, made.predict(x[:200]))
    assert rules.train(np.zeros((0, len(rules.STATISTICS))), np.zeros(0)).rules == []


def test_toxicity_counts_every_document(spark, make_docs):
    texts = ["usual" for _ in range(1500)]
    for i in (10, *range(600, 611)):  # once before the 500th, eleven times later
        texts[i] = "usual rareword"
    often, n = toxicity.frequent(make_docs(texts))
    assert n == 1500 and often["=rareword"] == 12 and often["=usual"] == 1500
    docs = make_docs([f"w{i:b} usual" + " rareword" * (i % 100 == 7) for i in range(5000)] + ["near copies of longer words", "of longer copies near words"])
    counts, n = toxicity.count_in_all(docs, ["=longer", "=none", "=rareword", "=usual"])
    assert counts == {"=rareword": 50, "=usual": 5000, "=longer": 1} and n == 5001


def test_toxicity_model_does_not_depend_on_the_layout(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    first = toxicity.fit(docs, labels)
    second = toxicity.fit(docs.orderBy(F.desc("doc_id")).repartition(7), labels.repartition(3))
    assert first.weights and first == second


def pu_examples(seed, n=800, size=12):
    """Toxic rows have one of the first three features; a fifth of U is toxic; the fourth is in half of all."""
    rng = np.random.default_rng(seed)

    def rows(toxic):
        out = []
        for bad in toxic:
            on = {3} if rng.random() < 0.5 else set()
            on |= {int(rng.integers(3))} if bad else set()
            on |= {int(rng.integers(4, size)) for _ in range(2)}
            out.append(np.array(sorted(on), dtype="<u4").tobytes())
        return out

    return rows(np.ones(n)), rows(rng.random(4 * n) < 0.2)


def test_nnpu_gradients_and_the_non_negative_step():
    p, u = pu_examples(1)
    (x_p, s_p), (x_u, s_u) = toxicity.matrix(p, 12), toxicity.matrix(u, 12)
    assert abs(s_p.sum() - 1) < 1e-5 and len(x_p) == len(set(p)) and (x_p[:, -1] == 1).all()
    rng = np.random.default_rng(2)
    w = rng.standard_normal(13)
    x_p, x_u = x_p.astype(float), x_u.astype(float)
    toxic, clean, on_toxic, on_clean = toxicity.risks(w, x_p, s_p, x_u, s_u, 0.2)
    for k in range(13):
        step = np.eye(13)[k] * 1e-5
        up, down = toxicity.risks(w + step, x_p, s_p, x_u, s_u, 0.2), toxicity.risks(w - step, x_p, s_p, x_u, s_u, 0.2)
        assert abs((up[0] - down[0]) / 2e-5 - on_toxic[k]) < 1e-4 and abs((up[1] - down[1]) / 2e-5 - on_clean[k]) < 1e-4
    # with far too large a prior the clean risk would go far below zero; the steps keep it near zero
    w = toxicity.nnpu(x_p.astype(np.float32), s_p, x_u.astype(np.float32), s_u, 0.6)
    assert toxicity.risks(w, x_p, s_p, x_u, s_u, 0.6)[1] > -0.05


def test_nnpu_beats_the_features_alone():
    (p, u), (toxic, mixed) = pu_examples(3), pu_examples(4)
    (x_p, s_p), (x_u, s_u) = toxicity.matrix(p, 12), toxicity.matrix(u, 12)
    w = toxicity.nnpu(x_p, s_p, x_u, s_u, 0.2)
    assert min(w[:3]) > 1 and max(abs(w[3:12])) < min(w[:3]) / 2
    score = lambda rows: np.array([w[-1] + w[np.frombuffer(r, dtype="<u4")].sum() for r in rows])
    truth = np.array([min(np.frombuffer(r, dtype="<u4"), default=9) < 3 for r in mixed])
    right = lambda said: (said == truth).mean()
    # any of the features that a gate lets in, the fourth included, against the learned weights
    gate = np.array([min(np.frombuffer(r, dtype="<u4"), default=9) < 4 for r in mixed])
    assert right(score(mixed) > 0) > 0.97 > right(gate) and (score(toxic) > 0).mean() > 0.97


def test_toxicity_sees_all_of_a_word():
    assert {"=nice", "=idiot", "^idio"} <= set(toxicity.features_of("nice/idiot,"))
    assert toxicity.features_of("(Idiot)") == ["=idiot", "^idio", "^idiot"]
    assert "~idiot" in toxicity.features_of("abc" * 100 + "idiot" + "xyz" * 100)
    assert "~\u7b28\u86cb" in toxicity.features_of("\u4f60\u662f\u4e2a\u7b28\u86cb\u5427")
    assert "~\u7b28\u86cb" in toxicity.features_of("\u5929" * 500 + "\uff0c" + "\u5730" * 500 + "\u7b28\u86cb" + "\u4eba" * 500)
    model = toxicity.Model({"=idiot": 9.0, "~\u7b28\u86cb": 9.0}, -4.0)
    assert list(model.scores(["nice/idiot", "\u5730" * 500 + "\u7b28\u86cb", "nice"]) > 0.5) == [True, True, False]


def test_learned_ops_on_odd_tables(spark, make_docs):
    from .conftest import CLASHES

    docs = make_docs([None, "", "x " * 5000, "ok", (None, "y")], [c for c in CLASHES if c not in ("score",)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model, ensemble = toxicity.fit(docs, labels), rules.fit(docs, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert all(0 <= r.score <= 1 for r in rules.score(docs, ensemble).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="already"):
        toxicity.score(docs, model, "rank")


def test_learned_ops_fit_on_odd_rows(spark, make_docs):
    from .conftest import CLASHES

    rng = random.Random(4)
    toxic, clean = "you vile grumbleton", "a calm and kindly sentence about the weather"
    texts = [(i % 40, (toxic if i % 3 == 0 else clean) + f" number {rng.randrange(9)}") for i in range(240)]
    odd = [(0, None), (1, ""), (1, ""), (2, "x " * 20_000), (3, "y" * 200_000), (None, toxic), (None, None), (5, "\u5730" * 3000)]
    docs = make_docs([*texts, *odd], [c for c in CLASHES if c not in ("score",)])
    labels = spark.createDataFrame([(i % 40, int(i % 3 != 0), int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (0, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model, ensemble = toxicity.fit(docs, labels), rules.fit(docs, labels)
    for made in (toxicity.score(docs, model), rules.score(docs, ensemble)):
        rows = made.select("doc_id", "text", "score").collect()
        assert len(rows) == len(texts) + len(odd) and all(0 <= r.score <= 1 for r in rows)
        assert set(made.columns) == {*docs.columns, "score"}
        by_text = {}
        for r in rows:  # equal texts are scored alike, and null as empty
            assert by_text.setdefault(r.text or "", r.score) == r.score


def test_scores_equal_a_plain_reading(spark, sf_dir):
    """Every row of a table scored word by word, without workers, caches or compiled rules."""
    from spanloom.llm import q04_quality, q05_toxicity

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = q05_toxicity.fit_outside_fold(docs, labels)
    ensemble = q04_quality.fit_outside_fold(docs, labels)
    for name, plain in (
        ("op5_toxicity", lambda t: 1 / (1 + np.exp(-model.bias - sum(model.weights[f] for f in {f for w in (t or "").split() for f in toxicity.features_of(w)} if f in model.weights)))),
        ("op4_quality_rules", lambda t: ensemble.predict(np.array([rules.statistics(t)]))[0]),
    ):
        got = {r.doc_id: r.score for r in queries()[name](spark, sf_dir).collect()}
        assert got.keys() == texts.keys()
        assert max(abs(got[i] - plain(t)) for i, t in texts.items()) < 1e-6


def test_toxic_recall_and_order(spark):
    sf = "/root/testdata/sf0.1"
    held = queries()["op5_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() >= 0.75 and clean.predicted.mean() <= 0.01
    ranks = held.score.rank()
    auc = (ranks[held.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert auc >= 0.9


@pytest.mark.parametrize(("name", "label", "least"), [("op4_quality_rules", "quality", 0.97), ("op5_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    made = queries()[name](spark, sf)
    held = made.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert held.select(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least

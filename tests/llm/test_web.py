"""Operators 5, 7, 8: rules and aliases, revisits, main text."""

import pytest
from pyspark.sql import functions as F

from sessionloom.llm import html_text, url_filter, warc_revisits

RULES = [("block", "bad.com/"), ("allow", "bad.com/good/"), ("block", "net/"), ("block", "x.org/a")]


@pytest.mark.parametrize("literal", [True, False])
def test_rules_and_aliases(spark, literal, monkeypatch):
    if not literal:
        monkeypatch.setattr(url_filter, "MAP_RULES", 0)
    page = lambda link: f'<html><head><link href="{link}" rel=canonical></head></html>'
    pages = [
        (1, "http://WWW.bad.com/q?x=1", ""), (2, "https://bad.com/good/1#t", ""), (3, "http://mirror.io/p", page("http://bad.com/q")),
        (4, "http://mirror.io/p.html", ""), (5, "http://copy.io/", page("http://bad.com/good/2")), (6, "http://both.io/z", page("http://bad.com/good/3")),
        (7, "http://both.io/y", page("/z")), (8, "http://x.org/abc", None), (9, "http://xx.org/abc", ""), (10, None, ""), (11, "nothing", ""), (12, "http://a.net", ""),
        (15, "http://mirror.io:80/p#top", ""), (16, "https://MIRROR.io/p?x=1", ""), (17, "http://bad.com.io/q?x=2", ""), (18, "http://ent.io/1", page("http&#58;//bad.com/?a=1&amp;b=2")), (19, "http://dots.io/a/b/c", page("../../x/./y")), (20, "http://dots.io/x/y", page("http://bad.com/")), (21, "http://dots.io/x/y?q", ""),
        (13, "http://r.io/1", '<META content="0; URL=http://bad.com/w" http-equiv="Refresh">'), (14, "http://t.io/1", ""), (1, "http://WWW.bad.com/q?x=1", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    redirects = spark.createDataFrame([("http://t.io/1", "http://u.io/1"), ("http://u.io/1", "http://evil.net/"), ("http://both.io/z", "http://bad.com/zz"), (None, "x")], "source string, target string")
    got = {}
    for r in url_filter.judge(df, RULES, redirects).collect():
        got.setdefault(r["page_id"], []).append((r["host"], r["path"], r["rule"], r["verdict"]))
    assert got[1] == [("www.bad.com", "/q", "bad.com/", "block")] * 2
    assert got[2] == [("bad.com", "/good/1", "bad.com/good/", "allow")]
    assert got[3][0][2:] == (None, "block") and got[15][0][2:] == (None, "block")  # by the canonical link, and by the same URL spelt otherwise
    assert got[4][0][3] == got[16][0][3] == got[17][0][3] == got[21][0][3] == "allow"  # another path or query without a link
    assert got[18][0][3] == got[19][0][3] == got[20][0][3] == "block"
    assert got[5][0][3] == "allow" and got[6][0][3] == "allow" and got[7][0][3] == "allow"  # an explicit allow comes first
    assert got[8][0][2:] == ("x.org/a", "block") and got[9][0][2:] == (None, "allow")
    assert got[10] == got[11] == [("", "", None, "allow")] and got[12] == [("a.net", "", None, "allow")]
    assert got[13][0][3] == "block" and got[14][0][3] == "block"
    assert url_filter.judge(df.limit(0), RULES).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_redirects_are_union_find(spark, seed):
    """Components by union-find; rules decide alone, then any allow of the component, then any block."""
    import random

    rng = random.Random(seed)
    hosts = ["a.io", "b.io", "bad.com", "x.bad.com", "c.net", "x.org"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['good', 'p', 'a'])}/{k}" for k in range(120)]
    links = [(rng.choice(urls), rng.choice(urls)) for _ in range(70)] + [(urls[0], None), (None, urls[1]), (urls[2], urls[2])]
    parent = {u: u for u in urls}

    def root(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for a, b in links:
        if a and b:
            parent[root(a)] = root(b)

    def rule(u):
        host, path = u.split("/")[2], "/" + u.split("/", 3)[3]
        fits = [(len(r), v) for v, r in RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return max(fits)[1] if fits else None

    want = {}
    for k, u in enumerate(urls):
        met = {rule(x) for x in urls if root(x) == root(u)}
        want[k] = rule(u) or ("allow" if "allow" in met else "block" if "block" in met else "allow")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(pages, RULES, spark.createDataFrame(links, "source string, target string")).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == want and len(set(want.values())) == 2


def test_revisit_ties_and_validators(spark):
    """Equal times by record_id, repeated records, and each validator deciding; the stronger one counts where both sides have it."""
    null = None
    rows = [
        (2, "response", "http://a.b/x", 10, "e1", "m1", "d1", {}, "l2"), (1, "response", "http://a.b/x", 10, "e0", "m0", "d0", {}, "l1"),
        (3, "revisit", "http://a.b/x", 10, "e1", null, null, {}, null), (0, "revisit", "http://a.b/x", 10, "e1", null, null, {}, null),
        (4, "revisit", "http://a.b/x", 11, null, "m1", null, {}, null), (4, "revisit", "http://a.b/x", 11, null, "m1", null, {}, null),
        (5, "revisit", "http://a.b/x", 12, null, "m9", "d1", {}, null), (6, "revisit", "http://a.b/x", 13, null, null, "d1", {}, null),
        (7, "revisit", "http://a.b/x", 14, "e1", "m9", "d9", {}, null), (8, "revisit", "http://a.b/x", None, "e1", null, null, {}, null),
    ]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, etag string, last_modified string, digest string, headers map<string,string>, locator string")
    got = sorted((r["record_id"], r["response_id"], r["outcome"]) for r in warc_revisits.resolve(df).collect() if r["record_id"] != 8)
    assert got == [(0, None, "no response"), (3, 2, "resolved"), (4, 2, "resolved"), (4, 2, "resolved"), (5, 2, "changed"), (6, 2, "resolved"), (7, 2, "resolved")]


def test_revisits(spark):
    null = None
    rows = [
        (1, "response", "http://A.b:80/x", 10, "e1", null, "d1", {"Content-Length": "5", "Date": "1", "X": "y"}, "l1"),
        (2, "revisit", "https://a.b/x#t", 20, "W/e1", null, null, {"content-length": "0", "DATE": "2"}, null),
        (3, "response", "http://a.b/x", 30, "e2", null, null, {}, "l3"),
        (4, "revisit", "http://a.b/x", 30, "e2", null, null, null, null),
        (5, "revisit", "http://a.b/x", 40, "e1", null, null, {}, null),
        (6, "revisit", "http://a.b/y", 40, "e1", null, null, {}, null),
        (7, "revisit", null, 40, "e1", null, null, {}, null),
        (8, "revisit", "http://a.b/x", 50, null, null, null, {}, null),
        (9, "revisit", "http://a.b/x", 5, "e1", null, null, {}, null),
        (10, "request", "http://a.b/x", 5, "e1", null, null, {}, null),
    ]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, etag string, last_modified string, digest string, headers map<string,string>, locator string").withColumn("range", F.lit(1))
    got = {r["record_id"]: r for r in warc_revisits.resolve(df).collect()}
    assert {k: (r["response_id"], r["outcome"]) for k, r in got.items()} == {2: (1, "resolved"), 4: (3, "resolved"), 5: (3, "changed"), 6: (None, "no response"), 7: (None, "no response"), 8: (3, "no validator"), 9: (None, "no response")}
    assert got[2]["headers"] == {"content-length": "5", "date": "2", "x": "y"} and got[2]["locator"] == "l1" and got[5]["locator"] is None
    assert warc_revisits.resolve(df.limit(0)).count() == 0


def test_queries_name_resources(spark):
    """A validator of one query says nothing of another, nor does that of another path."""
    rows = [(1, "response", "http://a.b/p?id=1", 10, "v1", "L1"), (2, "response", "http://a.b/p?id=2", 20, "v1", "L2"), (3, "revisit", "https://a.b:443/p?id=1#x", 30, "v1", None), (4, "revisit", "http://a.b/p", 30, "v1", None), (5, "response", "http://a.b/a.html", 5, "v1", "L5"), (6, "revisit", "http://a.b/a", 30, "v1", None), (7, "response", "http://a.b", 5, "v7", "L7"), (8, "revisit", "http://a.b/", 30, "v7", None)]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, etag string, locator string").withColumns({c: F.lit(None) for c in ("last_modified", "digest", "headers")})
    assert {r["record_id"]: (r["outcome"], r["locator"]) for r in warc_revisits.resolve(df).collect()} == {3: ("resolved", "L1"), 4: ("no response", None), 6: ("no response", None), 8: ("resolved", "L7")}


@pytest.mark.parametrize("target,want", [("../x", "http://h/a/x"), ("/../x/./", "http://h/x/"), ("?q=1", "http://h/a/b/c?q=1"), ("#f", "http://h/a/b/c#f"), ("//o/p", "http://o/p"), ("mailto:a@b", None), ("", None), ("go?u=http://x", "http://h/a/b/go?u=http://x"), ("HTTPS://o", "HTTPS://o"), ("..", "http://h/a/"), ("&#x26;&amp;lt;&#233;", "http://h/a/b/&&lt;é"), ("a&#0;&#xD800;&zz;", "http://h/a/b/a&#0;&#xD800;&zz;")])
def test_link_targets(spark, target, want):
    got = spark.createDataFrame([(target, "http://h/a/b/c?z")], "t string, b string").select(url_filter.absolute(url_filter.decoded(F.col("t")), F.col("b"))).first()[0]
    assert got == want


def test_shared_folder_is_left_empty(spark, tmp_path, monkeypatch):
    """Nothing but the result is left."""
    monkeypatch.setattr("sessionloom.llm.common.shared_dir", lambda _: str(tmp_path))
    pages = spark.createDataFrame([(1, "http://a.b/x", '<link rel=canonical href="/y">')], "page_id long, url string, html string")
    url_filter.judge(pages).collect()
    assert [p.name.split("-")[0:2] for p in tmp_path.iterdir()] == [["url", "verdicts"]]
    warc_revisits.resolve(warc_revisits.page_records(pages)).collect()
    assert sorted(p.name.split("-")[1] for p in tmp_path.iterdir()) == ["revisits", "verdicts"]


def test_hot_url_over_many_ranges(spark):
    rows = [(k, "response" if k % 7 == 0 else "revisit", "http://hot/x", k, f"e{k - k % 7}") for k in range(700)]
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, etag string").withColumns({c: F.lit(None) for c in ("last_modified", "digest", "headers", "locator")})
    got = warc_revisits.resolve(df).collect()
    assert len(got) == 600 and all(r["response_id"] == r["record_id"] - r["record_id"] % 7 and r["outcome"] == "resolved" for r in got)


def test_blocks():
    html = '<title>t</title><div class="comments"><p>x</p></div>a <b>bo</b>ld<p>q &lt; r&nbsp;s<ul><li>1<li>2</ul>t<article><header><h1>T &am</h1></header>z<br>zz<aside>no<p>no</p></aside>y <span class="ad">bad</span> w</article><script>var a="<p>";</script>tail < 3<!-- c -->'
    kinds = {0: "content", 1: "open", 2: "drop"}
    got = [(kinds[k], t) for k, t in html_text.blocks(html)]
    assert got == [("drop", "x"), ("open", "a bold"), ("open", "q < r s"), ("open", "1"), ("open", "2"), ("open", "t"), ("content", "T &am"), ("content", "z zz"), ("drop", "no"), ("drop", "no"), ("content", "y w"), ("open", "tail < 3")]
    assert html_text.blocks(None) == [] and html_text.blocks("") == []


@pytest.mark.parametrize("html", ["<b>" * 150_000 + "</i>" * 150_000, '<a "' * 250_000, "<a x='>" * 150_001, "<b><div></div>" * 70_000, "<div class=ad>" * 70_000 + "<article>x", "<p><b><li>" * 100_000, "<a" * 500_000 + ">", "<!" * 500_000, "<!--" * 250_000, "<article><div class=ad>" * 40_000, "<a =" + " " * 1_000_000 + ">", "<script>" * 120_000, "</script" * 120_000])
def test_broken_pages_take_linear_time(html):
    import time

    began = time.time()
    html_text.blocks(html)
    assert time.time() - began < 8  # quadratic work would take minutes


def test_broken_tags():
    """A quote counts behind = if it is closed; else the tag ends at its first >."""
    assert html_text.blocks('<p title="a > b">x<p class=\'y>z') == [(1, "x"), (1, "z")]
    assert html_text.blocks('<a ">b</a> c') == [(1, "b c")]
    assert html_text.blocks("a < b <c") == [(1, "a < b <c")] and html_text.blocks("x<!-- y") == [(1, "x")] and html_text.blocks("x<p>y <!-- z > <p>") == [(1, "x"), (1, "y")]
    assert html_text.blocks("<SCRIPT>a<p></Script >b<script>c") == [(1, "b")]
    assert html_text.blocks("x</i></div><b>y</p>z") == [(1, "x"), (1, "y"), (1, "z")]


def test_host_suffixes_remove_repeats(spark):
    menu = "<div>home about contact products services help legal imprint</div>"
    page = lambda k, body: f"<html><body>{menu}<div>{body}</div>{menu.replace('home', 'end')}</body></html>"
    word = lambda k: " ".join(f"w{k}x{i}" for i in range(12))
    pages = [(k, "http://h.com/%d" % k, page(k, word(k))) for k in range(6)] + [(9, "http://other.com/", page(9, word(9))), (10, None, None), (11, "http://h.com/a", "<article><p>one</p> <p>two  three</p></article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("key", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert all(got[k] == word(k) for k in range(6))
    assert "home about" in got[9] and word(9) in got[9]  # nothing repeats on that host
    assert got[10] == "" and got[11] == "one\ntwo three"
    assert html_text.main_text(df.limit(0)).count() == 0


def test_only_covered_runs_are_cut(spark):
    """A brute-force count of all windows decides; unique runs of a mostly repeated block stay, repeated runs of a mostly unique one go."""
    shared = [" ".join(f"s{j}t{i}" for i in range(40)) for j in range(2)]
    own = lambda k, n: " ".join(f"p{k}u{i}" for i in range(n))
    pages = {k: [f"{own(k, 5)} {shared[0]} z{k}", f"{own(k + 100, 90)} {shared[1]}"] for k in range(8)}
    df = spark.createDataFrame([(k, f"http://h.com/{k}", "".join(f"<div>{b}</div>" for b in bs)) for k, bs in pages.items()], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    streams = {k: " ".join(bs).split() for k, bs in pages.items()}
    for k, bs in pages.items():
        covered = [False] * len(streams[k])
        for length, least, share in html_text.RULES:
            window = lambda s, i, n=length: tuple(s[i : i + n])
            on = [{window(s, i) for i in range(len(s) - length + 1)} for s in streams.values()]
            for i in range(len(streams[k]) - length + 1):
                if sum(window(streams[k], i) in x for x in on) >= max(least, share * len(pages)):
                    covered[i : i + length] = [True] * length
        assert got[k].split() == [t for t, c in zip(streams[k], covered, strict=True) if not c]
        assert got[k] == f"{own(k, 5)}\nz{k}\n{own(k + 100, 90)}"


def brute_suffix_array(pages):
    """host -> stream -> covered places, by sorting all suffixes of a host's distinct pages and comparing neighbours."""
    out = {}
    for host in {h for h, _ in pages}:
        streams = sorted({s for h, s in pages if h == host})
        array = sorted((s[i:], k, i) for k, s in enumerate(streams) for i in range(len(s)))
        covered = {s: [False] * len(s) for s in streams}
        for length, least, share in html_text.RULES:
            begin = 0
            for at in range(1, len(array) + 1):
                if at < len(array):
                    x, y = array[at - 1][0], array[at][0]
                    shared = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
                    if shared >= length:
                        continue
                members = [m for m in array[begin:at] if len(m[0]) >= length]
                if len({k for _, k, _ in members}) >= max(least, share * len(streams)):
                    for _, k, i in members:
                        covered[streams[k]][i : i + length] = [True] * length
                begin = at
        out[host] = covered
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_those_of_a_suffix_array(spark, seed):
    """Random streams with menus, shared passages, repeats inside a page, page copies and long tokens, on two hosts; ids repeat or are null."""
    import random

    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice(["", "x", "é" * 80])
    passages = [tuple(word() for _ in range(n)) for n in (7, 9, 33, 45)]
    pages = []
    for _ in range(70):
        s = ()
        for _ in range(rng.randrange(6)):
            s += rng.choice(passages) if rng.random() < 0.6 else tuple(word() for _ in range(rng.randrange(1, 12)))
        pages.append((rng.choice(["big.com"] * 5 + ["small.com"]), s))
    pages += rng.sample(pages, 10)
    rows = [(rng.choice([None, 1, k]), f"http://{h}/{k}", f"<p>{' '.join(s)}</p>", k) for k, (h, s) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, starts long")
    covered = brute_suffix_array([(h, s) for h, s in pages if s])
    want = []
    for (page, url, _, _), (h, s) in zip(rows, pages, strict=True):
        gone = covered.get(h, {}).get(s, [])
        lines, run = [], []
        for t, c in [*zip(s, gone, strict=True), ("", True)]:
            if not c:
                run.append(t)
            elif run:
                lines.append(" ".join(run))
                run = []
        want.append((str(page), url, "\n".join(lines)))
    assert any(any(x) and not all(x) for d in covered.values() for x in d.values())
    got = [(str(r["page_id"]), r["url"], r["text"]) for r in html_text.main_text(df).collect()]
    assert sorted(got) == sorted(want)
    found = html_text.decisions(df).first()
    assert found["by_repeats"] == sum(sum(covered[h][s]) for h, s in pages if s) and found["by_names"] == 0
    assert found["tokens"] == sum(len(s) for _, s in pages) == found["by_repeats"] + found["kept"]


def test_repeats_decide_before_names(spark):
    """A menu inside nav that the host repeats counts as cut by the array; a unique one as dropped by its name."""
    menu = " ".join(f"m{i}" for i in range(8))
    rows = [(k, f"http://h.com/{k}", f"<nav>{menu}</nav><article>a{k} {menu}</article><footer>own{k}</footer>") for k in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [(r["page_id"], r["text"]) for r in html_text.main_text(df).orderBy("page_id").collect()] == [(k, f"a{k} {menu}") for k in range(6)]
    assert html_text.decisions(df).first().asDict() == {"tokens": 54, "by_repeats": 48, "by_names": 6, "kept": 0}


def test_common_prefixes():
    import pyarrow as pa

    tokens = ["a b ", "a b c ", "a b c ", "ab c ", "b ", "b "]
    shared, size = html_text.common_prefixes(pa.array(["h"] * 5 + ["i"]), pa.array(tokens))
    assert shared.tolist() == [0, 2, 3, 0, 0, 0] and size.tolist() == [2, 3, 3, 2, 1, 1]


def test_copies_and_phrases_of_a_large_host_stay(spark):
    """Pages without article: exact copies, a print version, a quote and common phrases keep their text; what half of the host shows goes."""
    import random

    rng = random.Random(3)
    phrases = [" ".join(f"f{j}w{i}" for i in range(7)) for j in range(20)]
    text = lambda k, n=30: " ".join(f"p{k}u{i}" for i in range(n))
    menu, quote = " ".join(f"m{i}" for i in range(10)), " ".join(f"q{i}" for i in range(40))
    body = {k: " ".join(f"{x} p{k}v{j}" for j, x in enumerate(rng.sample(phrases, 4))) for k in range(300)}
    for k in range(5):
        body[k] += " " + quote
    pages = [(k, f"http://big.com/{k}", f"<div>{menu}</div><p>{b}</p>") for k, b in body.items()]
    pages += [(1000 + k, f"http://copies.com/a?ref={k}", f"<p>{text(1)}</p><p>{text(2)}</p>") for k in range(6)]
    pages += [(2000 + k, f"http://print.com/{k}", f"<div>version {k}</div><p>{text(3, 60)}</p>") for k in range(2)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k] == b for k, b in body.items())
    assert all(got[1000 + k] == f"{text(1)}\n{text(2)}" for k in range(6))
    assert all(got[2000 + k] == f"version {k}\n{text(3, 60)}" for k in range(2))


def test_marks_keep_main_text():
    kept = lambda html: [t for k, t in html_text.blocks(html) if k == html_text.CONTENT]
    for around in ('div class="layout has-sidebar"', 'div class="page no-sidebar"', 'div class="widget"', 'section id="banner"', 'div class="ad"><div class="popup"'):
        assert kept(f"<{around}><article><p>a</p></article></div><p>b</p>") == ["a"]
    for inside in ('section id="related-work"', 'h2 id="share-buybacks"', 'h2 id="related"', 'div id="privacy-notice"', 'p id="navigation-systems"'):
        assert kept(f"<main><{inside}>a</{inside.split()[0]}></main>") == ["a"]
    for out in ("nav", "aside", "footer", 'div role="dialog"', 'div class="comments"'):
        assert kept(f"<{out}><article>a</article></{out.split()[0]}>") == []
    # text of a wrapper counts like the text around it; a marked element beside the article stays out
    html = '<div class="widget">w<div class="ad">x</div><article>a<div class="share">y</div></article></div><div class="ad">z</div>'
    assert html_text.blocks(html) == [(1, "w"), (2, "x"), (0, "a"), (2, "y"), (2, "z")]


def test_html_text_writes_little_beside_its_input(spark, monkeypatch):
    """Articles are neither written nor shuffled, passages of few pages make no suffixes, and shuffle files go."""
    import random
    from pathlib import Path

    from sessionloom.llm import common

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    menu, quotes = " ".join(word() for _ in range(12)), [" ".join(word() for _ in range(20)) for _ in range(20)]
    article = {k: " ".join(word() for _ in range(1000)) for k in range(300)}
    # each quote is on 15 pages, fewer than half of them
    pages = [(k, f"http://h.com/{k}", f"<div>{menu}</div><article>{a}</article><p>p{k} {quotes[k % 20]}</p>") for k, a in article.items()]
    written, html = {}, sum(len(p[2]) for p in pages)
    real = common.cut

    def cut(df, tag):
        out = real(df, tag)
        written[tag] = sum(Path(f.removeprefix("file:")).stat().st_size for f in out.inputFiles()), out.count()
        return out

    monkeypatch.setattr(common, "cut", cut)
    monkeypatch.setattr(html_text, "cut", cut)
    shuffles = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    before = shuffles()
    out = html_text.main_text(df)
    assert sum(Path(f).stat().st_size for f in shuffles() - before if Path(f).exists()) < 10_000
    assert sum(n for n, _ in written.values()) < html / 10
    assert written["html-array"][1] <= 7 * len(pages)  # seven places in each menu, none in a quote
    assert {r["page_id"]: r["text"] for r in out.collect()} == {k: f"{a}\np{k} {quotes[k % 20]}" for k, a in article.items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_repeats_in_small_packs(spark, seed, monkeypatch):
    """Rows of equal suffixes are handed on after each page, and only one host's share is known."""
    monkeypatch.setattr(html_text, "SUFFIXES_AT_ONCE", 1)
    monkeypatch.setattr(html_text, "LARGE_HOSTS", 1)
    test_repeats_are_those_of_a_suffix_array(spark, seed)


def test_possible_starts():
    import numpy as np

    rng = np.random.default_rng(1)
    for of in (0, 9, 1000, 10_000_000):
        for n in (0, 1, 5, 26, 27, 28, 200):
            counts = rng.choice([3, 4, 5, 19, 20, 500, 65535], n, p=[0.01, 0.05, 0.04, 0.02, 0.08, 0.4, 0.4])
            want = {i for length, least, share in html_text.RULES for i in range(n - length + 6) if all(c >= min(65535, max(least, share * of)) for c in counts[i : i + length - 5])}
            assert html_text.possible_starts(counts, of).tolist() == sorted(want)

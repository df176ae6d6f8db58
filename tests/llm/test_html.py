from dimfold.llm import html_extraction as H

SCHEMA = "page_id long, url string, html string"


def text(source):
    return H.Page(source).main_text()


def test_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy</div>
    <div class="cookie-notice">We use</div><article><h1>A &amp; B</h1><p><b>One<br>two &lt;3.<br><p>Three&nbsp;
    four<i>five</i></p><form><p>Mail</p></form><div class="share">Share</div><ul><li>x<li>y</ul><p>if a < b then</p><script>x</script>
    <section id="comments"><p>First!</p></section></article><aside>Side</aside><footer>&copy; us</footer></body></html>"""
    assert text(page) == "A & B\n\nOne two <3.\n\nThree fourfive\n\nx\n\ny\n\nif a < b then"


def test_regions_without_an_article():
    assert text("<body><nav>n</nav><main><p>m</p></main><p>out</p></body>") == "m"
    assert text("<body><div class=menu>n</div><div id='content'><p>long text of this page</p></div><p>o</p></body>") == "long text of this page"
    assert text("<p>one<p>two <a href=x>l</a></p><p><a href=x>only a link</a></p>") == "one\n\ntwo l"
    assert text("plain") == "plain" and text("") == "" and text("<") == "<" and text("<p>a<p") == "a<p"
    assert text("a <b c='d> e") == "a e"


def test_odd_markup():
    assert text("<article>a<div hidden>h</div><div style='display: none'>s</div><p aria-hidden=true>t</p>b</article>") == "a\n\nb"
    assert text("<article><table><tr><td>1<td>2<tr><td>3</table></article>") == "1 2\n\n3"
    assert text("<article><p>x</article></div></p>tail") == "x"
    assert text('<body class="page has-sidebar nav-top"><div class="sidebar"><article>kept</article></div></body>') == "kept"
    assert text("<article>a<textarea><p>t</p></textarea><!-- open <p>b</p>") == "a"
    assert text("<ARTICLE><P>Up &#233;&#xe9;&eacute;</P></ARTICLE>") == "Up ééé"
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert text(deep) == "x"


def test_headings_and_sections_of_an_article_keep_their_text():
    page = """<article><h1 id="search">A</h1><h2 id="discussion">Discussion</h2><p>one</p><h2 id="related-work">Related work</h2>
    <section id="discussion"><p>two</p></section><div id="social-networks"><p>three</p></div><div class="note alert-box">four</div>
    <div class="share">gone</div><section id="comments">gone</section><div class="ad">gone</div></article>"""
    assert text(page) == "A\n\nDiscussion\n\none\n\nRelated work\n\ntwo\n\nthree\n\nfour"
    assert text('<body><div class="ad-free post"><p>all of it</p></div></body>') == "all of it"
    assert text('<body><div class="post no-sidebar"><p>all</p></div><div class="site-footer">f</div><div class="cookie-notice">c</div></body>') == "all"
    assert text('<body><div class="menu-left">m</div><p>body text</p></body>') == "body text"


def test_controls_end_with_the_block_after_them():
    assert text("<article><p>a</p><button>Like<p>b</p><p>c</p></article>") == "a\n\nb\n\nc"
    assert text("<article><p>a <button>x</button> b</p><select><option>1<option>2</select><p>c</p></article>") == "a b\n\nc"
    assert text("<article><p>a</p><select><option>1<div>b</div></article>") == "a\n\nb"


def test_boxes_of_sections_go(spark):
    """Four sections of 40 pages with an unmarked box each, then the same without sections in the URL."""
    for url in ("http://news.example/{0}/{1}", "http://news.example/{0}-{1}"):
        rows = [(40 * s + i, url.format("abcd"[s], i), f"<body><div>Editor of section {s}: call 555-{s}</div><div><p>own words {s} {i}</p></div></body>")
                for s in range(4) for i in range(40)]
        got = H.extract(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted(r.text for r in got) == sorted(f"own words {s} {i}" for s in range(4) for i in range(40))
    mixed = [(i, f"http://m.example/{'ab'[i % 2]}/{i}", f"<body><div>Only in {'ab'[i % 2]}</div><div><p>w {i}</p></div></body>") for i in range(12)]
    mixed += [(100 + i, f"http://m.example/x{i}", f"<body><p>page {i}</p></body>") for i in range(60)]  # 6 of 72 pages, but all of a section
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(mixed, SCHEMA)).collect()}
    assert all(got[i] == f"w {i}" for i in range(12)) and got[100] == "page 0"


def test_templates_by_an_independent_count(spark):
    """Flat pages whose boxes are told apart by a regular expression, not by the operator's parser."""
    import random
    import re
    from collections import defaultdict

    rng = random.Random(12)
    boxes = [f"<div>box {k}</div>" for k in range(12)]
    rows = []
    for i in range(300):
        site = rng.choice(["p.example", "q.example"])
        part = rng.choice(["", "a/", "b/"])
        some = [b for k, b in enumerate(boxes) if rng.random() < (0.02 + 0.04 * k if part else 0.5 if k == 3 else 0.01)]
        rows.append((i, f"http://{site}/{part}{i}", "<body>" + "".join([*some, f"<div>own {i}</div>"]) + "</body>"))
    seen, whole = defaultdict(set), defaultdict(set)
    scopes = {}
    for i, url, source in rows:
        site, *path = url.removeprefix("http://").split("/")
        scopes[i] = [site] + ([f"{site}/{path[0]}"] if len(path) > 1 else [])
        for scope in scopes[i]:
            whole[scope].add(i)
            for b in re.findall("<div>.*?</div>", source):
                seen[scope, b].add(i)
    gone = {x for x, on in seen.items() if len(on) >= 5 and len(on) >= 0.3 * len(whole[x[0]]) or len(on) >= 20 and len(on) >= 0.05 * len(whole[x[0]])}
    assert 5 < len(gone) < len(seen)
    want = {i: "\n\n".join(b[5:-6] for b in re.findall("<div>.*?</div>", source) if not any((s, b) in gone for s in scopes[i])) for i, _, source in rows}
    assert {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()} == want


def pages():
    """30 pages of one host with a template that no name gives away, 10 copies of one page, and a small host."""
    rows = []
    for i in range(30):
        rows.append((i, f"https://u@H.example:80/{i}", f"<body><div><span>Welcome to our site</span></div><div><p>own words of page {i}</p>"
                     f"<p>Some line</p></div><div>Call us: 555-1234</div></body>"))
    rows += [(100 + i, f"http://h.example/c{i}", "<body><div>Call us: 555-1234</div><div><p>copied</p><p>page of words</p></div></body>") for i in range(10)]
    rows += [(200 + i, f"http://small.example/{i}", f"<body><div>Hello all</div><p>s{i}</p></body>") for i in range(3)]
    prose = "<article><h1>t{0}</h1><p>Standing licence line.</p><p>p{0}</p><div>Read more on our site</div></article>"
    rows += [(300 + i, f"http://art.example/{i}", prose.format(i) if i % 4 else f"<article><p>q{i}</p></article>") for i in range(20)]
    return rows


def brute(rows, min_pages=5, min_share=0.3, many_pages=20, small_share=0.05, prose_share=0.9):
    import re
    from collections import defaultdict

    seen, whole = defaultdict(set), defaultdict(set)

    def scopes(u):
        host = (re.match(r"[a-z]+://(?:[^/@]*@)?([^/:?#]*)", u or "") or ["", ""])[1].lower()
        part = re.match(r"[a-z]+://[^/]*/([^/?#]+)/[^/?#]", u or "")
        return [host, f"{host}/{part[1]}"] if part else [host]

    for _, url, source in rows:
        page = H.Page(source or "")
        for scope in scopes(url):
            whole[scope].add(page.main_text())
            for _, key, prose in page.subtrees():
                seen[scope, key, prose].add(page.main_text())
    gone = defaultdict(list)
    for (scope, key, prose), found in seen.items():
        share = prose_share if prose else small_share if len(found) >= many_pages else min_share
        if len(found) >= min_pages and len(found) >= share * len(whole[scope]):
            gone[scope].append(key)
    return [(i, u, H.Page(s or "").main_text([sorted(gone[x]) for x in scopes(u)])) for i, u, s in rows]


def test_site_templates(spark):
    rows = pages() + [(400, None, None), (401, "no host", ""), (401, "no host", "")]
    df = spark.createDataFrame([r + ("x", "y") for r in rows], SCHEMA + ", host string, Text string")
    for broadcast_hashes in (0, 1000):
        got = sorted(((r.page_id, r.url, r.text) for r in H.extract(df, broadcast_hashes).collect()), key=repr)
        assert got == sorted(brute(rows), key=repr)
    by_id = {i: t for i, _, t in got}
    assert by_id[3] == "own words of page 3" and by_id[100] == "copied\n\npage of words" and by_id[200] == "Hello all\n\ns0"
    assert by_id[301] == "t1\n\nStanding licence line.\n\np1" and by_id[400] == ""
    assert all(r.n_chars == len(r.text) for r in H.extract(df).collect())
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table_against_its_articles(spark):
    """The given pages hold their text in h1 and p of one article."""
    import html
    import re

    from dimfold.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = QUERIES["op4_html_extraction"](spark, d).collect()
    assert len(rows) == len(sources)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", sources[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", article)]
        assert r.text == "\n\n".join(x for x in parts if x)

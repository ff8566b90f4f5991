"""Embeddings and pages against plain code."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from navspan.llm import pages, vectors
from navspan.llm.components import components
from navspan.llm.queries import QUERIES


def brute_links(rows, cosine):
    good = [(i, label, np.array(v, np.float64)) for i, (_, v, label) in enumerate(rows) if label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    links, root = np.zeros(len(rows), int), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a, x) in enumerate(good):
        for j, b, y in good[:k]:
            if a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (vec_id, *_) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), vec_id), vec_id)
    return sorted((rows[i][0], int(links[i]), least[top(i)], rows[i][0] == least[top(i)]) for i in range(len(rows)))


def vector_rows():
    """Tight groups, chains, copies, scaled copies, and everything that links with nothing."""
    draw = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, 2):
        centres = draw.normal(size=(12, 8))
        for k in range(150):
            v = centres[k % 12] + draw.normal(size=8) * draw.choice([0.02, 0.25, 0.5])
            rows.append((n := n + 1, [float(np.float32(x)) for x in v], label))
    rows += [(n + 1 + i, rows[3][1], rows[3][2]) for i in range(40)]
    rows += [(600 + i, [2 * x for x in rows[5][1]], rows[5][2]) for i in range(3)]
    rows += [(700, None, 1), (701, [0.0] * 8, 1), (702, [1.0, None] + [0.0] * 6, 1), (703, [float("nan")] * 8, 1), (704, [float("inf")] * 8, 1), (705, rows[0][1], None), (706, [], 1), (707, [1.0, 2.0], 1), (708, [2.0, 4.0], 1), (3, rows[3][1], 9)]
    return rows


@pytest.mark.parametrize("cell, block", [(10**6, 1024), (40, 16), (10, 5)])
def test_near_duplicates(spark, cell, block):
    """The links do not hang on cells or blocks."""
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("x")).repartition(4)
    found = vectors.near_duplicates(spark, table, cell=cell, block=block).select("vec_id", "n_links", "component_id", "kept")
    assert sorted(map(tuple, found.collect())) == brute_links(rows, vectors.COSINE)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(spark, empty).count() == 0


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(300)]
    root = {x: x for pair in links for x in pair}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    found = {r["node"]: r["root"] for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found.get(x, x) == top(x) for x in root) and set(found) <= set(root)


def text_of(html, others=()):
    blocks = pages.Reader().read(html)
    streams = [blocks, *[pages.Reader().read(o) for o in others]]
    seen = {}
    shares = pages.covered([[pages.token_numbers(b.text, seen) for b in page] for page in streams])
    return pages.main_text(blocks, shares[0])


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("<nav>Menu</nav><article><h1>T &amp; U</h1><p>a\n b<br>c&nbsp;d<p>e</article><footer>f</footer>", "T & U\na b c d\ne"),
    ("<ARTICLE><P>One</P><DIV CLASS='ad'>buy</DIV><aside>x</aside><form><p>y</p></form><p>Two</p></ARTICLE>after", "One\nTwo"),
    ("<article><p>a</p><section id=comments><article><p>mine!</p></article></section><p>b", "a\nb"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x &lt;b&gt; y</p><script>var a='<p>no</p>'</script></article>", "T\nx <b> y"),
    ("<main><p>a<b>b</b>c</p><div class='cookie-notice'>ok?</div></main><p>z</p>", "abc"),
    ("<div id=content><ul><li>1<li>2</ul><div class=sidebar><p>s</div></div>", "1\n2"),
    ("<body><div hidden>h</div><p style='display: none'>n</p><p>kept</p><!-- <p>c</p> --><style>p{}</style></body>", "kept"),
    ("<article><p>cut off here &am", "cut off here &am"),
    ("<article><p>cut <b>off</", "cut off"),
    ("<article><p class=notice>n<p>m</article>", "m"),
    ("<article><p>3 < 4 & 5 &#8364; &eacute;</p></article>", "3 < 4 & 5 € é"),
])
def test_markup(html, want):
    assert text_of(html) == want


def test_repeats_decide_where_markup_does_not():
    notice = "<p>this site keeps small files on your computer to know you again</p>"
    site = [f"<body>{notice}<p>own words of page number {i} and more {i * 7} of them</p>{notice}</body>" for i in range(6)]
    assert text_of(site[0], site[1:]) == "own words of page number 0 and more 0 of them"
    assert "small files" in text_of(site[0], site[1:2])
    inside = [f"<article>{notice}<p>page {i}</p></article>" for i in range(6)]
    assert "small files" in text_of(inside[0], inside[1:])
    assert "small files" in text_of(site[0], [site[0]] * 9)


def test_suffix_array():
    tokens = np.array([3, 1, 2, 1, 2, 1], np.uint64)
    order, rank = pages.suffix_array(tokens, 8)
    suffixes = [tuple(tokens[i:]) for i in order]
    assert suffixes == sorted(suffixes) and len(set(rank.tolist())) == 6


def test_pages(spark):
    draw = random.Random(2)
    word = lambda: "".join(draw.choices("abcdef", k=5))
    rows, want = [], {}
    for i in range(700):
        body = [" ".join(word() for _ in range(12)) for _ in range(3)]
        html = "<nav><a>home</a></nav><article>" + "".join(f"<p>{b}</p>" for b in body) + f"</article><footer>{word()}</footer>"
        rows.append((i, f"https://{'hot' if i % 3 == 0 else f'h{i % 40}'}.example/{i}", html))
        want[i] = "\n".join(body)
    rows += [(900, None, None), (901, "nonsense", ""), (902, "http://x.example/", "<article>" + "long text " * 200000 + "</article>"), rows[0], (3, rows[3][1], rows[3][2])]
    want |= {900: "", 901: "", 902: ("long text " * 200000).strip()}
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x")).repartition(6)
    found = pages.extract(spark, table, run=16).collect()
    assert len(found) == len(rows)
    assert all(r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"]) for r in found)
    assert pages.extract(spark, table.where("page_id < 0")).count() == 0


def test_repeats_are_counted_over_the_whole_host(spark):
    """A passage on 3 of 400 pages of a host goes, one on 2 stays, whatever the pages a task holds; so does one on many hosts."""
    draw = random.Random(6)
    say = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    thrice, twice, hosts, there = say(12), say(12), say(12), say(12)
    rows, want = [], {}
    for i in range(400):
        own = say(20)
        extra = thrice if i in (5, 140, 390) else twice if i in (6, 200) else hosts if i == 7 else there if i in (9, 250) else ""
        rows.append((i, f"https://big.example/{i}", f"<body><p>{extra}</p><p>{own}</p></body>"))
        want[i] = own if extra in ("", thrice, there) else f"{extra}\n{own}"
    for i in range(3):
        own = say(20)
        rows.append((500 + i, f"https://small{i}.example/", f"<p>{hosts}</p><p>{own}</p>"))
        want[500 + i] = f"{hosts}\n{own}"
    # An article counts as a page that the passage is on, and keeps it; an equal page counts once.
    rows += [(600, "https://big.example/a", f"<article><p>{there}</p></article>"), (601, "https://big.example/b", rows[6][2])]
    want |= {600: there, 601: want[6]}
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for run in (16, 1000):
        assert {r["page_id"]: r["text"] for r in pages.extract(spark, table, run=run).collect()} == want


def test_site_without_articles(spark):
    """More pages a host than a task holds: notices and menus go, as they repeat, and each page's own words stay."""
    draw = random.Random(8)
    say = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    menus, notice, own = [say(15), say(15)], say(25), [[say(15), say(30)] for _ in range(2 * (pages.RUN + 50))]
    rows = []
    for i, (a, b) in enumerate(own):
        extra = f"<p>{notice}</p>" if i % 100 < 2 else ""
        rows.append((i, f"http://host{i % 2}.example/{i}", f"<div>{menus[i % 2]}</div><h1>{a}</h1>{extra}<p>{b}</p>"))
    found = pages.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: f"{a}\n{b}" for i, (a, b) in enumerate(own)}


@pytest.mark.parametrize("name, key, table", [("op5_embedding_near_dedup", "vec_id", "embeddings"), ("op8_html_extraction", "page_id", "pages")])
def test_queries_run_on_whole_tables(spark, sf_dir, name, key, table):
    df = QUERIES[name](spark, sf_dir)
    assert df.select(key).distinct().count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).distinct().count() == df.count()


def read_text(page):
    blocks = pages.Reader().read(page)
    return pages.main_text(blocks, [0.0] * len(blocks))


@pytest.mark.parametrize("page, text", [
    ('<article class="post comments-open"><p>The second story.</p></article>', "The second story."),
    ('<article class="hentry comments-open has-sidebar">a</article>', "a"),
    ('<div class="no-sidebar layout"><article>a</article></div>', "a"),
    ('<article class="job-search">The whole story</article><p>other words</p>', "The whole story"),
    ('<article><p>a</p><section class="market-share">b</section></article>', "a\nb"),
    ('<article><p>a</p><div class="share-buttons">b</div><div class="newsletter-signup">c</div></article>', "a"),
    ('<article><script src=/js/>var a=1</script><style/>p{}</style><p>t</p></article>', "t"),
    ('<article>a<svg/>b</article>', "ab"),
    ('<main><div class="cards"><article><p>card</p></article></div><p>body of the main story</p></main>', "card\nbody of the main story"),
    ('<main><p>by line</p><article><p>the long story of this page</p></article></main>', "the long story of this page"),
    ('<div class="comments"><article class="comment">c</article></div><article>m</article>', "m"),
    ('<article>m<div class="comments"><article>c</article></div></article>', "m"),
    ('<aside><article>z</article></aside><article>k</article>', "k"),
    ("", ""),
])
def test_what_marks_an_article(page, text):
    assert read_text(page) == text


def test_broken_markup_takes_time_in_proportion():
    import time

    def seconds(n):
        start = time.process_time()
        read_text("<div>" * n + "</section>" * n + "<aside><p>" + "<div>" * n + "</p>" * n + "</aside>")
        return time.process_time() - start

    assert seconds(40_000) < 40 * max(seconds(4_000), 0.01)


def brute_shares(streams, length, on_pages):
    """Share of each block's tokens within runs that stand on so many distinct pages, by comparing all of them."""
    whole = [[int(t) for b in page for t in b] for page in streams]
    seen = {}
    for page in whole:
        for i in range(len(page) - length + 1):
            seen.setdefault(tuple(page[i : i + length]), set()).add(tuple(page))
    out = []
    for page, blocks in zip(whole, streams, strict=True):
        hit = [False] * len(page)
        for i in range(len(page) - length + 1):
            if len(seen[tuple(page[i : i + length])]) >= on_pages:
                hit[i : i + length] = [True] * length
        at, shares = 0, []
        for b in blocks:
            shares.append(sum(hit[at : at + len(b)]) / max(1, len(b)))
            at += len(b)
        out.append(shares)
    return out


def test_repeats_and_cover_against_all_runs():
    draw = np.random.default_rng(3)
    notice = [draw.integers(0, 50, 20) for _ in range(4)]
    streams = []
    for i in range(40):
        page = [draw.integers(0, 50, int(draw.integers(0, 40))) for _ in range(int(draw.integers(1, 5)))]
        page += [notice[k] for k in range(4) if draw.random() < 0.2 * (k + 1)]
        streams.append(page if i % 9 else streams[0] if streams else page)
    streams = [[b.astype(np.int64) for b in page] for page in streams]
    for length, on_pages in ((8, 3), (4, 2), (1, 3)):
        got, want = pages.covered(streams, length, on_pages), brute_shares(streams, length, on_pages)
        assert all(x == pytest.approx(y) for x, y in zip(got, want, strict=True))


def test_repeats_decide_beside_articles(spark):
    """On pages with an article, what repeats in the main part around it goes, and what is unique there stays."""
    draw = random.Random(9)
    say = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    teaser, rows, want = say(30), [], {}
    for i in range(40):
        story, lead, twice = say(12), say(20), say(10)
        around = f"<p>{teaser}</p>" if i < 3 else f"<p>{lead}</p>"
        rows.append((i, f"http://a.example/{i}", f"<main>{around}<article><p>{story}</p><p>{twice}</p></article></main>"))
        want[i] = f"{story}\n{twice}" if i < 3 or len(lead) <= len(story) + len(twice) else f"{lead}\n{story}\n{twice}"
    for i in range(2):
        rows.append((100 + i, f"http://b{i}.example/", f"<main><p>{teaser}</p><article><p>a story</p></article></main>"))
        want[100 + i] = f"{teaser}\na story"
    found = pages.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), run=8).collect()
    assert {r["page_id"]: r["text"] for r in found} == want


def test_open_places():
    blocks = [pages.Block("a", 2, False), pages.Block("b", 0, False), pages.Block("c", 0, True)]
    streams = [np.arange(20), np.arange(2), np.arange(20)]
    assert pages.open_places(blocks, streams).tolist() == list(range(13, 22))
    assert len(pages.open_places(blocks[:1], streams[:1])) == 0

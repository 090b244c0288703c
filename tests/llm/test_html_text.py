import random

import corpus
import numpy as np
from strata.llm import html_text as h

PAGES = "page_id bigint, url string, html string"


def text(page):
    return "\n".join(t for m, t in h.blocks(page) if m)


def test_blocks_of_an_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head><body class=home>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav><!-- ad <p>no</p> --><div class="ad top">buy</div>
    <aside>side</aside><article><header><h1>Head &amp; line&nbsp;1</h1></header><p><b>bold &lt;p&gt; text<br><p>one
    two\t three</p><p>a<i>b</i>c &copy &#233;&#x1F600;<div class="cookie-notice">accept</div><p hidden>not shown</p>
    <p style="display: none">nor this</p><form><input value=">"><p>name</p></form><section id=comments><p>first!</p></section>
    <ul><li>x<li>y</ul><table><tr><td>1<td>2</table><blockquote>q < 3 &amp;amp; x<<y</blockquote><footer>by me</footer></article>
    <div class="sidebar-right">s</div><p>in<span class="ad">x</span>line</p><p>after</p><footer>&copy; site</footer></body></html>"""
    assert text(page) == "Head & line 1\nbold <p> text\none two three\nabc © é😀\nx\ny\n1\n2\nq < 3 &amp; x<"
    assert [t for m, t in h.blocks(page) if not m] == ["inline", "after"]


def test_pages_cut_off_anywhere():
    page = '<html><body><nav>menu</nav><article class="post comments-open"><h1>Title</h1><p>some text &amp; more</p></article></body></html>'
    for n in range(len(page) + 1):
        assert text(page[:n]) in ("", "Title", *["Title\n" + "some text &amp; more"[:k].replace("&amp;", "&").strip() for k in range(20)], "Title\nsome text & more",
                                  *["Title"[:k] for k in range(5)], "Title\nsome text &am", "Title\nsome text &", "Title\nsome text &a")
    assert text(page) == "Title\nsome text & more"
    assert h.blocks(None) == [] and h.blocks("") == [] and h.blocks("<p") == [] and h.blocks("<") == []
    assert h.blocks('<p title="a > b" class=\'x\'>t') == [(False, "t")] and h.blocks('<p title="a>t') == [(False, "t")]


def brute_repeated(pages):
    """Words in runs of MIN_RUN that MIN_PAGES pages of different words share."""
    where = {}
    for i, p in enumerate(pages):
        for k in range(len(p) - h.MIN_RUN + 1):
            where.setdefault(tuple(p[k : k + h.MIN_RUN]), set()).add(tuple(p))
    out = []
    for p in pages:
        mark = np.zeros(len(p), bool)
        for k in range(len(p) - h.MIN_RUN + 1):
            if len(where[tuple(p[k : k + h.MIN_RUN])]) >= h.MIN_PAGES:
                mark[k : k + h.MIN_RUN] = True
        out.append(mark)
    return out


def test_repeated_runs_equal_brute_force():
    rng = random.Random(2)
    shared = [corpus.prose(rng, rng.choice([7, 8, 12, 30])).split() for _ in range(6)]
    pages = []
    for _ in range(60):
        page = []
        for _ in range(rng.randint(0, 6)):
            page += rng.choice(shared) if rng.random() < 0.5 else corpus.prose(rng, rng.randint(0, 12)).split()
        pages.append(page)
    pages += [pages[-1], pages[-1], ["a"] * 40, ["a"] * 41, ["a"] * 9, []]
    got = h.repeated(pages)
    assert all((a == b).all() for a, b in zip(got, brute_repeated(pages)))
    assert [len(x) for x in h.repeated([[], []])] == [0, 0]


def site(rng, n, host="h.example"):
    menu = " ".join(f"<li>{corpus.prose(rng, 2)}</li>" for _ in range(8))
    legal = corpus.prose(rng, 25)
    rows, want = [], {}
    for i in range(n):
        body = [corpus.prose(rng, 30) for _ in range(3)]
        want[i] = "\n".join(body)
        rows.append((i, f"https://{host}/{i}", f"<html><body><ul>{menu}</ul>" + "".join(f"<p>{b}</p>" for b in body) + f"<p>{legal}</p></body></html>"))
    return rows, want


def test_unmarked_pages_lose_repeated_blocks(spark, monkeypatch):
    rows, want = site(random.Random(3), 40)
    got = {r["page_id"]: r["text"] for r in h.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == want
    monkeypatch.setattr(h, "SHARD_CHARS", 5_000)  # many shards of one host
    got = {r["page_id"]: r["text"] for r in h.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == want


def test_marked_pages_keep_repeated_text(spark):
    shared = "<p>" + corpus.prose(random.Random(4), 30) + "</p>"
    rows = [(i, "http://x/", f"<nav>menu {i}</nav><article><h1>t{i}</h1>{shared}</article>") for i in range(10)]
    df = spark.createDataFrame(rows, PAGES)
    got = h.main_texts(df).collect()
    assert len(got) == 10 and all(r["text"] == f"t{r['page_id']}\n" + shared[3:-4] and r["marked"] for r in got)
    assert all(r["covered"] == [0.0, 1.0] for r in h.with_repeats(h.keyed(df)).collect())


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None, None), (None, "http://x/", "<p>a</p>"), (2, "not a url", ""), (3, "http://x/", "<article>" + "w " * 200_000 + "</article>")]
    rows += [(4, "//y/z", "<article>twice</article>")] * 2
    spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES + ", texts string, uid int").write.parquet(f"{tmp_path}/pages.parquet")
    got = h.op5_html_text(spark, str(tmp_path)).collect()
    assert sorted((str(r["page_id"]), len(r["text"]), r["n_chars"]) for r in got) == sorted(
        [("1", 0, 0), ("2", 0, 0), ("None", 1, 1), ("3", 399_999, 399_999), ("4", 5, 5), ("4", 5, 5)]
    )
    assert h.main_texts(spark.createDataFrame([], PAGES)).collect() == []


def test_runs_are_counted_over_all_shards_of_a_host(spark, monkeypatch):
    rng = random.Random(6)
    legal = corpus.prose(rng, 25)
    bodies = [corpus.prose(rng, 30) for _ in range(60)]
    rows = [(i, "https://h.example/x", f"<body><p>{b}</p>" + (f"<p>{legal}</p>" if i % 20 == 0 else "") + "</body>") for i, b in enumerate(bodies)]
    monkeypatch.setattr(h, "SHARD_CHARS", 300)  # the three pages lie in different shards
    got = {r["page_id"]: r["text"] for r in h.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == dict(enumerate(bodies))


def test_unmarked_pages_lose_exactly_the_repeated_words(spark):
    rng = random.Random(7)
    passage, footer = corpus.prose(rng, 40), corpus.prose(rng, 10)
    # A closing sentence of its own after a shared passage; a title and a date of its own around shared words.
    ends, around = [f"end{i} own{i} words{i}" for i in range(5)], [(f"title{i} more{i} x{i} y{i} z{i}", f"date{i}") for i in range(5)]
    rows = [(i, "http://x/", f"<body><p>{passage} {ends[i]}</p><p>{a} {footer} {b}</p><p>{footer}</p></body>") for i, (a, b) in enumerate(around)]
    rows += [(5, "http://x/", "<body><p>alone</p></body>"), (6, "http://y/", f"<body><p>{passage}</p></body>")]
    got = {r["page_id"]: r["text"] for r in h.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    want = {i: f"{ends[i]}\n{a} {b}" for i, (a, b) in enumerate(around)}
    # The date stands between two repeated runs, but in no repeated run itself.
    assert got == want | {5: "alone", 6: passage}


def test_boilerplate_beside_articles_goes_from_articles_too(spark, monkeypatch):
    rng = random.Random(8)
    line, lead, quote = corpus.prose(rng, 12), corpus.prose(rng, 20), corpus.prose(rng, 15)
    bodies = [corpus.prose(rng, 30) for _ in range(12)]
    page = lambda i, inner, beside: (i, "http://x/", f"<body><article><p>{bodies[i]}</p>{inner}</article><div>{beside}</div></body>")
    # The line stands beside four articles and in three; the lead of one article is announced beside four others; a quotation is in articles only.
    rows = [page(i, f"<p>{quote}</p>", f"<p>{line}</p>") for i in range(4)]
    rows += [page(i, f"<p>{line} own{i}</p>", "") for i in range(4, 7)]
    rows += [page(7, f"<p>{lead}</p>", "")] + [page(i, "", f"<p>{lead}</p>") for i in range(8, 12)]
    rows += [(20, "http://y/", f"<article><p>{line}</p></article>")]
    want = {i: f"{bodies[i]}\n{quote}" for i in range(4)} | {i: f"{bodies[i]}\nown{i}" for i in range(4, 7)}
    want |= {7: f"{bodies[7]}\n{lead}"} | {i: bodies[i] for i in range(8, 12)} | {20: line}
    for size in (h.SHARD_CHARS, 300):
        monkeypatch.setattr(h, "SHARD_CHARS", size)
        assert {r["page_id"]: r["text"] for r in h.main_texts(spark.createDataFrame(rows, PAGES)).collect()} == want


def test_hostile_markup_takes_time_in_proportion():
    import time

    start = time.process_time()
    assert h.blocks("<article>a <" + "x" * 1_000_000) == [(True, "a")]
    assert h.blocks("<" + "x" * 1_000_000) == []
    deep = "<article>" + "<b>" * 20_000 + "in" + "</i>" * 20_000 + "<p>out</p>" * 2_000
    found = h.blocks(deep)
    assert [t for _, t in found] == ["in"] + ["out"] * 2_000 and all(m for m, _ in found)
    assert time.process_time() - start < 5

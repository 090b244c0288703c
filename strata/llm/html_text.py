"""Main text of web pages: markup says what an article is, a host's suffix array what its boilerplate is.

A page is read into blocks of text; what stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
reader comments by its tags, roles, classes and ids is left out, and blocks within <article> or <main> are marked as such. The
words of a host's pages are then concatenated and their suffixes sorted; runs of MIN_RUN words or more that stand in
MIN_PAGES distinct pages or more are repeated. Where a page marks its article, that is the main text but for the words in boilerplate:
runs that the host puts beside the marked articles of MIN_PAGES distinct pages or more, and into those of MIN_ARTICLES or more. Other
repeated runs stay in it, since quotations and copies belong to an article, and a text that is only its own belongs to it however many pages
announce it. On pages that mark none, the words in repeated runs go. Of each block the other words stay.

At scale: pages are parsed where they are read. A host's pages are dealt into shards of bounded size by a hash of their words, so
that a host may hold any share of all pages, and each shard has its own suffix array. It gives the distinct pages of each run of
MIN_RUN words; these are summed over all shards of the host, so the size of the shards decides nothing. Only runs that stand outside
marked articles are summed (a bit set of fixed size holds them); they are found again in the pages by a join.

Cases: null and empty html, and pages without text, have the text ''; a null url is a host of its own; pages of equal blocks count as
one page when repeats are sought; repeated rows are pages of their own in the result; markup may be cut off anywhere: an
unfinished tag at the end is no text, unfinished elements end with the page; an empty table gives an empty result.
"""

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strata.llm.shared import store, table
from strata.llm.shingles import bit_set, in_set, small_batches, spans

MIN_RUN = 8  # a power of two
MIN_PAGES = 3
MIN_ARTICLES = 2
SHARD_CHARS = 1_000_000

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select|canvas|object|audio|video)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)"
    r"|<[!?/][^>]*>"
    r"|<(?:[a-z!?/][^>]*)?\Z",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|(?<=\s)(hidden)(?=[\s/>])""", re.S)
WITHIN = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
DROPPED = frozenset("nav footer aside form button dialog head menu search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus reply replies respond sidebar widget menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related recommended recommendations pagination "
    "pager skip toolbar login".split()
)
#: Opening one of these ends an open element of the second kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl menu table".split())


def attributes(rest: str) -> dict:
    out = {}
    for m in ATTRIBUTE.finditer(rest):
        if m[5]:
            out["hidden"] = ""
        else:
            out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def unwanted(name: str, rest: str, in_main: bool) -> bool:
    """Whether an element is left out by its tag, role, class, id or style."""
    if name in DROPPED or name == "header" and not in_main:
        return True
    if len(rest) < 4 or name in ("html", "body"):
        return False
    given = attributes(rest)
    if "hidden" in given or re.search(r"display\s*:\s*none", given.get("style", ""), re.I):
        return True
    if given.get("role", "").lower() in ROLES:
        return True
    for part in f"{given.get('class', '')} {given.get('id', '')}".lower().split():
        words = re.split(r"[^a-z0-9]+", part)
        # Of an article only a class of its own counts: names like comments-open tell something else.
        ends = {part} if name in MAIN else {words[0], words[-1]} if words[0] not in ("with", "has", "no", "without") else set()
        found = ends & NAMES
        if found - ({"header"} if in_main or name in MAIN else set()):
            return True
    return False


def blocks(page: str | None) -> list[tuple[bool, str]]:
    """The blocks of text of a page in order, each with whether it is in the marked article."""
    out: list = []
    stack: list = []  # name, left out, in main
    open_: dict = {}  # how many of each name stand in it
    text: list = []
    state = (False, False)

    def finish():
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                out.append((state[1], joined))

    def keep(piece):
        if piece and not state[0]:
            text.append(html.unescape(piece) if "&" in piece else piece)

    def pop(at):
        nonlocal state
        ends = False
        for x in stack[at:]:
            open_[x[0]] -= 1
            ends = ends or x[0] in BLOCKS
        if ends:
            finish()
        del stack[at:]
        state = stack[-1][1:] if stack else (False, False)

    page, at = page or "", 0
    for m in MARKUP.finditer(page):
        keep(page[at : m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1) if open_.get(name) else ():
                if stack[i][0] == name:
                    pop(i)
                    break
                if stack[i][0] in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "article", "main", "body", "html"):
                    break
            if name in BLOCKS:
                finish()
            continue
        if name in BLOCKS:
            finish()
            ended = open_.get("p") or name in CLOSES and any(map(open_.get, CLOSES[name]))
            for i in range(len(stack) - 1, -1, -1) if ended else ():  # a block ends an open paragraph, an item the one before
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(name, ()):
                    pop(i)
                    break
                if stack[i][0] in LISTS or stack[i][0] in BLOCKS and name not in CLOSES:
                    break
        if name in WITHIN:
            if name == "br":
                keep(" ")
            continue
        dropped, main = state
        dropped = dropped or unwanted(name, m["rest"], main)
        stack.append((name, dropped, main or name in MAIN))
        open_[name] = open_.get(name, 0) + 1
        state = (dropped, main or name in MAIN)
        if len(m["rest"]) > 1 and m["rest"][-2] == "/" and name not in BLOCKS:
            pop(len(stack) - 1)
    keep(page[at:])
    finish()
    return out


def suffixes(pages: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the pages and an end mark after each page: the rank of its suffix, and the first page of the same words as its page.

    The suffixes of the concatenated pages are sorted by their first MIN_RUN words, by doubling: ranks of one word,
    then of two, four, eight. Equal ranks are neighbours in the suffix array with that much in common.
    """
    lengths = np.array([len(p) for p in pages])
    ids, _ = pd.factorize(np.array([w for p in pages for w in (*p, None)], dtype=object))
    page = np.repeat(np.arange(len(pages)), lengths + 1)
    rank = ids.astype(np.int64)
    ends = rank < 0  # one end mark of its own for each page: no run crosses pages
    rank[ends] = rank.max() + 1 + np.arange(ends.sum())
    width = 1
    while width < MIN_RUN:
        after = np.concatenate((rank[width:], np.full(width, -1)))[: len(rank)]
        rank = np.unique(rank * (after.max() + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        width *= 2
    same: dict = {}
    first = np.array([same.setdefault(tuple(p), i) for i, p in enumerate(pages)])
    return rank, first[page]


def distinct_pages(rank: np.ndarray, page: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each rank, in how many distinct pages it stands at the places `at`; pages with the same words are one."""
    width = int(page.max(initial=0)) + 1
    return np.bincount(np.unique(rank[at] * width + page[at]) // width, minlength=rank.max() + 1)


def marked_words(begins: np.ndarray, length: int) -> np.ndarray:
    """Which of `length` words stand in a run of MIN_RUN words that begins at one of the places."""
    marks = np.zeros(length + MIN_RUN + 1, np.int64)
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + MIN_RUN, -1)
    return np.cumsum(marks)[:length] > 0


def repeated(pages: list[list[str]]) -> list[np.ndarray]:
    """For each page (its words in order) which words stand in a run that MIN_PAGES distinct pages share."""
    lengths = np.array([len(p) for p in pages])
    if not lengths.sum():
        return [np.zeros(n, bool) for n in lengths]
    rank, page = suffixes(pages)
    covered = marked_words(np.flatnonzero(distinct_pages(rank, page, np.arange(len(rank)))[rank] >= MIN_PAGES), len(rank))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    return [covered[starts[i] : starts[i] + n] for i, n in enumerate(lengths)]


NO_RUNS = pd.DataFrame({c: np.empty(0, np.int64) for c in ("key", "n", "beside", "within")})


def run_counts(pages: list[list[str]], blocks_of: list[list[int]], bits: np.ndarray | None) -> pd.DataFrame:
    """key (the hash) of each distinct run of MIN_RUN words, and how many distinct pages have it: anywhere (n), beside a marked article
    (beside), and in one (within); of the runs in the bit set, if one is given.

    `blocks_of` has the number of words of each block of a page, below 0 for a block of a marked article.
    """
    left = np.array([i for p in pages for i in range(len(p), -1, -1)])
    full = np.flatnonzero(left >= MIN_RUN)
    if not len(full):
        return NO_RUNS
    rank, page = suffixes(pages)
    runs = full[np.unique(rank[full], return_index=True)[1]]
    flat = [w for p in pages for w in (*p, None)]
    keys = np.array([xxh64_intdigest(" ".join(flat[i : i + MIN_RUN]), MIN_RUN) for i in runs.tolist()], np.uint64)
    if bits is not None:
        keep = in_set(keys, bits)
        runs, keys = runs[keep], keys[keep]
    if not len(runs):
        return NO_RUNS
    wanted = np.zeros(rank.max() + 1, bool)
    wanted[rank[runs]] = True
    at = full[wanted[rank[full]]]  # all places of the runs
    # The words up to each place that stand in an article; a run is within one if all its words are, beside one if none is.
    article = [np.append(np.repeat(np.array(b, int) < 0, np.abs(np.array(b, int))), False) for b in blocks_of]
    marks = np.concatenate([np.full(len(a), a.any()) for a in article])
    upto = np.concatenate(([0], np.cumsum(np.concatenate(article))))
    own = upto[at + MIN_RUN] - upto[at]
    places = {"n": at, "beside": at[(own == 0) & marks[at]], "within": at[own == MIN_RUN]}
    return pd.DataFrame({"key": keys.view(np.int64)} | {c: distinct_pages(rank, page, x)[rank[runs]] for c, x in places.items()})


def run_keys(words: list[str]) -> np.ndarray:
    """The hash of the run of MIN_RUN words that begins at each place."""
    if len(words) < MIN_RUN:
        return np.empty(0, np.uint64)
    joined, starts, ends = spans([w.encode() for w in words], MIN_RUN)
    return np.array([xxh64_intdigest(joined[a:b], MIN_RUN) for a, b in zip(starts, ends)], np.uint64)


PARSED = "page_id bigint, url string, host string, main array<boolean>, texts array<string>"


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, host and html."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def parsed(rows: DataFrame) -> DataFrame:
    """The blocks of every page; further columns of `rows` must be numbers and follow."""
    small_batches(rows.sparkSession)
    more = [c for c in rows.columns if c not in ("page_id", "url", "host", "html")]

    def parse(frames):
        for frame in frames:
            found = [blocks(h) for h in frame["html"]]
            out = pd.DataFrame({
                "page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "host": frame["host"],
                "main": [[m for m, _ in b] for b in found], "texts": [[t for _, t in b] for b in found],
            })
            for c in more:
                out[c] = frame[c]
            yield out

    return rows.mapInPandas(parse, PARSED + "".join(f", {c} bigint" for c in more))


def page_words(texts) -> list[str]:
    return [w for t in texts for w in t.split()]


def runs_of(pages: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """uid, host, key and place of every run of the pages, of those in the bit set if one is given."""

    def of(frames):
        for frame in frames:
            for uid, host, texts in zip(frame["uid"], frame["host"], frame["texts"]):
                keys = run_keys(page_words(texts))
                at = np.arange(len(keys)) if bits is None else np.flatnonzero(in_set(keys, bits))
                if len(at):
                    yield pd.DataFrame({"uid": uid, "host": host, "key": keys[at].view(np.int64), "place": at})

    return pages.select("uid", "host", "texts").mapInPandas(of, "uid bigint, host string, key bigint, place bigint")


def shared_runs(rows: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """host and key of the runs that stand in MIN_PAGES distinct pages of the host or more, and whether they are boilerplate in marked articles.

    Large hosts are dealt into shards. Their table has a row for each of them only, so the pages themselves move once. Pages of
    the same words are in the same shard, so distinct pages can be summed; a task passes such a page on once.
    """
    counted = rows.groupBy("host").agg(F.ceil(F.sum(F.length("html")) / SHARD_CHARS).cast("bigint").alias("shards"))
    large = store(counted.where("shards > 1"), "page-hosts")
    dealt = rows.join(large, "host", "left").withColumn("shards", F.coalesce("shards", F.lit(1).cast("bigint")))
    streams = parsed(dealt.select("page_id", "url", "host", "html", "shards"))
    joined = F.array_join("texts", " ")
    sizes = F.transform("texts", lambda x, i: F.size(F.split(x, " ")) * F.when(F.get("main", i), -1).otherwise(1))
    streams = streams.select("host", F.pmod(F.xxhash64(joined), "shards").alias("shard"), joined.alias("text"), sizes.alias("blocks"))

    def once(frames):
        seen = set()
        for frame in frames:
            new = []
            for page in zip(frame["host"], map(xxh64_intdigest, frame["text"]), map(bytes, frame["blocks"])):
                new.append(page not in seen)
                seen.add(page)
            yield frame[new]

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        return run_counts([t.split() for t in frame["text"]], frame["blocks"].tolist(), bits).assign(host=frame["host"].iloc[0])

    streams = streams.mapInPandas(once, "host string, shard bigint, text string, blocks array<int>").repartition("host", "shard")
    counts = streams.groupBy("host", "shard").applyInPandas(count, "host string, key bigint, n bigint, beside bigint, within bigint")
    sums = counts.groupBy("host", "key").agg(*[F.sum(c).alias(c) for c in ("n", "beside", "within")])
    boilerplate = (F.col("beside") >= MIN_PAGES) & (F.col("within") >= MIN_ARTICLES)
    return store(sums.where(F.col("n") >= MIN_PAGES).select("host", "key", boilerplate.alias("boilerplate")), "page-shared")


def marked_runs(pages: DataFrame, shared: DataFrame) -> DataFrame:
    """The columns of `pages` (uid, host, texts, ...) `covered`, for each block the share of its words in shared runs, and `kept`, its other words."""
    found = runs_of(pages, bit_set(F.col("key"), shared)).join(shared.select("host", "key"), ["host", "key"])
    found = found.groupBy("uid").agg(F.collect_list("place").alias("places"))

    @F.pandas_udf("struct<covered: array<double>, kept: array<string>>")
    def cover(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        shares, kept = [], []
        for page, begins in zip(texts, places):
            split = [t.split() for t in page]
            lengths = [len(words) for words in split]
            mark = marked_words(np.array([] if begins is None else begins, np.int64), sum(lengths))
            ends = np.cumsum(lengths, dtype=np.int64).tolist()
            marks = [mark[e - n : e] for e, n in zip(ends, lengths)]
            shares.append([float(m.mean()) for m in marks])
            kept.append([" ".join(w for w, gone in zip(words, m.tolist()) if not gone) for words, m in zip(split, marks)])
        return pd.DataFrame({"covered": shares, "kept": kept})

    return pages.join(found, "uid", "left").withColumn("cut", cover("texts", "places")).select(*pages.columns, "cut.covered", "cut.kept")


def with_repeats(rows: DataFrame) -> DataFrame:
    """page_id, url, host, main, texts, `covered` and `kept` of every page."""
    pages = store(parsed(rows).withColumn("uid", F.monotonically_increasing_id()), "page-blocks")
    return marked_runs(pages, shared_runs(rows)).drop("uid")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and marked (whether the page marks an article).

    Pages that mark theirs are read again for it rather than stored beside the runs.
    """
    rows = keyed(pages)
    marked = F.exists("main", lambda m: m)
    # The blocks outside marked articles: all of a page that marks none.
    beside = F.filter("texts", lambda t, i: ~F.get("main", i))
    outside = parsed(rows).select("page_id", "url", "host", beside.alias("texts"), marked.alias("marked")).where(~F.col("marked") | (F.size("texts") > 0))
    outside = store(outside.withColumn("uid", F.monotonically_increasing_id()), "page-outside")
    shared = shared_runs(rows, bit_set(F.col("key"), runs_of(outside)))

    def unique(some: DataFrame, runs: DataFrame, is_marked: bool) -> DataFrame:
        kept = F.array_join(F.filter("kept", lambda t: t != ""), "\n")
        return marked_runs(some, runs).select("page_id", "url", kept.alias("text"), F.lit(is_marked).alias("marked"))

    others = unique(outside.where(~F.col("marked")).drop("marked"), shared, False)
    articles = parsed(rows).where(marked).select("page_id", "url", "host", F.filter("texts", lambda t, i: F.get("main", i)).alias("texts"))
    whole = F.array_join("texts", "\n")
    boilerplate = shared.where("boilerplate")
    bits = bit_set(F.col("key"), boilerplate)
    if not bits.any():
        return articles.select("page_id", "url", whole.alias("text"), F.lit(True).alias("marked")).unionAll(others)

    @F.pandas_udf("boolean")
    def has_run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(in_set(run_keys(page_words(t)), bits).any()) for t in texts], dtype=bool)

    # Only the articles that may have boilerplate are stored and joined.
    clean = articles.where(~has_run("texts")).select("page_id", "url", whole.alias("text"), F.lit(True).alias("marked"))
    hit = store(articles.where(has_run("texts")).withColumn("uid", F.monotonically_increasing_id()), "page-articles")
    return clean.unionAll(unique(hit, boilerplate, True)).unionAll(others)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_texts(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


#: The main text for the markup of the given pages, which all mark their article: <h1>, <p>, <b> and <br> within it.
ORACLE_SQL = r"""
WITH bodies AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS body FROM pages
), pieces AS (
    SELECT page_id, url, [regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g')
        for x in regexp_split_to_array(body, '</?(?:p|h1)>')] AS raw
    FROM bodies
), decoded AS (
    SELECT page_id, url, [trim(regexp_replace(regexp_replace(
        replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''),
        '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) for x in raw] AS texts
    FROM pieces
), joined AS (
    SELECT page_id, url, coalesce(array_to_string([x for x in texts if x <> ''], chr(10)), '') AS text FROM decoded
)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""

"""Rows that caps, cut ids and per-row decisions would lose."""

import hashlib
import html
import re
import textwrap
import time
import tracemalloc

import pytest

import corpus_pipeline
from tests.llm.brute import item_hits, shingle_set
from tickloom.llm import decontaminate, html_text, licences, tokens, urls, warc
from tickloom.llm.common import table
from tickloom.session import workspace

rng_words = [f"word{i * 7919 % 1009}x{i}" for i in range(4000)]


def test_archives_keep_long_headers_and_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "HEADER_BYTES", 2000)
    pages = [(1, "http://a/" + "u" * 2_000_000, "<p>one</p>"), (2, "http://b/", "<p>two</p>" * 50_000), (3, None, None)]
    df = spark.createDataFrame([(*p, 5, "x") for p in pages], "page_id bigint, url string, html string, payload_bytes int, digest string")
    folder = workspace(spark, "long")
    warc.write_archives(df, folder)
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.page_records(warc.read_archives(spark, folder)).collect()}
    assert got == {i: (len(h or ""), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in pages}
    short = warc.read_archives(spark, folder, limit=100_000).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in short}["record"] == 1
    empty = workspace(spark, "none")
    warc.write_archives(df.filter("false"), empty)
    assert warc.read_archives(spark, empty).collect() == []


def test_every_id_has_a_path(spark):
    notice = next(iter(licences.TEMPLATES.values()))[0]
    ids = [0, 7, 999_999_999, 1_234_567_890, 1_234_567_891, 123_456_789_000, 9_223_372_036_854_775_807, -12, None]
    docs = spark.createDataFrame([(i, notice if i == 1_234_567_890 else "plain words", "s", "en") for i in ids],
                                 "doc_id bigint, text string, source string, lang string")
    files = licences.document_files(docs)
    paths = {r.doc_id: r.path for r in files.collect()}
    assert len(set(paths.values())) == len(ids) and paths[7] == "s/en/000/000/007.txt"
    assert paths[1_234_567_891] == "s/en/001/234/567/891.txt" and paths[None] is None
    found = {r.doc_id: (r.licence is not None, r.levels_up) for r in licences.scan(files).collect()}
    assert found[1_234_567_890] == (True, 0) and found[1_234_567_891] == (True, 1) and found[7] == (False, None)


@pytest.mark.parametrize("width", [40, 72, 80, 5000])
def test_wrapped_licence_texts(spark, width):
    """Licence texts wrapped at any width, alone, in long files and amid long lines; what lies below them inherits."""
    mit, bsd, apache = (max(licences.TEMPLATES[k], key=len) for k in ("MIT", "BSD-3-Clause", "Apache-2.0"))
    prose = " ".join(rng_words[:3000])
    spoken = {
        "m/LICENSE": ("MIT", "The MIT License\n\nCopyright 2020 A. Writer\n\n" + textwrap.fill(mit, width) + "\n\n" + prose),
        "b/COPYING": ("BSD-3-Clause", prose + "\n" + textwrap.fill(prose[:300] + " " + bsd + " " + prose[:300], width)),
        "a/x.py": ("Apache-2.0", "\n".join("# " + line for line in textwrap.wrap("Copyright 2020 A. Writer " + apache, width)) + "\n" + prose),
        "s/y.py": ("GPL-3.0", prose[:700] + " This work is licensed under the GNU General Public License, version 3. " + prose[:700]),
        "n/z.py": (None, textwrap.fill(prose, width)),
    }
    rows = [(p, t) for p, (_, t) in spoken.items()] + [("m/deep/er/file", "code"), ("n/file", None)]
    rows += [("m/LICENSE", "other text of the same path"), ("b/COPYING", spoken["b/COPYING"][1])]
    found = {r.path: (r.licence, r.levels_up) for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found == {p: (k, 0 if k else None) for p, (k, _) in spoken.items()} | {"m/deep/er/file": ("MIT", 3), "n/file": (None, None)}


def test_items_over_several_rows_of_a_document(spark):
    item = " ".join(rng_words[:14])
    parts = [(7, " ".join(rng_words[k:k + 7])) for k in (0, 3, 7)] + [(8, " ".join(rng_words[0:7]))]
    parts += [(None, " ".join(rng_words[0:9])), (None, " ".join(rng_words[5:14])), (9, item), (10, " ".join(rng_words[100:2000]))]
    docs = spark.createDataFrame(parts, "doc_id bigint, text string")
    got = {(r.doc_id, r.n_common) for r in decontaminate.contained(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string")).collect()}
    whole = shingle_set(item)
    want = set()
    for key in {i for i, _ in parts}:
        common = len(whole & set().union(*(shingle_set(t) for i, t in parts if i == key)))
        if 100 * common >= 80 * len(whole):
            want.add((key, common))
    assert got == want and {i for i, _ in got} == {7, None, 9}
    assert item_hits([(9, item)], [(1, item)])


def test_short_items_inside_documents(spark):
    items = [(1, "What is love"), (2, "love"), (3, "is  love in"), (4, "y what is love z"), (5, "love what"), (6, "a b c d"), (7, "one"), (8, None)]
    texts = ["x y what is LOVE z", "what is love", "what is", "loved one", "", None, "a b c d e a b c d", "is love\nin", "d c b a " * 500 + "b c d"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.n_item, r.n_common) for r in decontaminate.contained(docs, table).collect()]
    assert len(got) == len(set(got)) and set(got) == item_hits([*enumerate(texts)], items)
    assert {(0, 1), (1, 1), (0, 4), (7, 3), (6, 6), (3, 7)} <= {g[:2] for g in got} and not {g for g in got if g[1] == 5}


def test_paths_without_a_host_are_judged(spark):
    pages = spark.createDataFrame([(1, "file:///casino/free-slots"), (2, None), (3, "no address"), (4, "http://")], "page_id bigint, url string")
    rows = {r.page_id: r for r in urls.judge(pages, urls.fit(urls.labelled_urls(spark))).collect()}
    assert (rows[1].host, rows[1].path) == ("", "/casino/free-slots") and rows[1].score > 0.5 and rows[1].verdict == "block"
    assert {(rows[i].host, rows[i].path, rows[i].verdict, rows[i].score) for i in (2, 3, 4)} == {("", "", "allow", 0.0)}


def test_pipeline_stages_keep_rows_apart(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    long = " ".join(rng_words[:400])
    rows = [(1, long), (1, " ".join(rng_words[400:800])), (2, " ".join(rng_words[800:1200])), (2, " ".join(rng_words[800:1200])),
            (None, item), (None, " ".join(rng_words[1200:1600])), (None, " ".join(rng_words[1200:1600])), (3, long + " end"), (4, item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    unique = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    left = sorted((r.doc_id or 0, r.text) for r in unique.collect())
    assert left == sorted((i or 0, t) for i, t in set(rows) - {(3, long + " end")})
    clean = corpus_pipeline.benchmark_decontamination(spark, docs, sf_dir)
    assert sorted((r.doc_id or 0, r.text) for r in clean.collect()) == sorted((i or 0, t) for i, t in rows if t != item)


LONG = "Some long text, with commas, and more words to score well."


@pytest.mark.parametrize("inside, wanted", [
    ("<p>The area is <math><msup><mi>r</mi><mn>2</mn></msup><annotation>r^2</annotation></math> times pi.</p>", "The area is r2 times pi."),
    ("<p>One <script>a<b</script>two <svg><g><path d=1 /></g><text>x</text></svg>three <button>b</button>four.</p>", "One two three four."),
    ("<h2>Sources</h2><ul><li><a href=https://a.org/x>One</a><li><a href=//b.org>Two</a><li><a href='http://c.org'>Three</a></ul>",
     "Sources\nOne\nTwo\nThree"),
    ("<ul><li><a href=/a>One</a><li><a href=http://www.site.org/b>Two</a><li><a href='#c'>Three</a></ul>", ""),
    (f"<div class=discussion><p>{LONG}</p></div><p class=related>Related work is found in these papers.</p>",
     f"{LONG}\nRelated work is found in these papers."),
    (f"<div class=discussion><div class=comment><p>{LONG}</p></div><p>{LONG}</p></div>", ""),
    (f"</article><article><h2>Second</h2><p>{LONG}</p>", f"Second\n{LONG}"),
    (f"</article><article><h2><a href=/x>Teaser</a></h2><p>{LONG}</p>", ""),
])
def test_article_text_is_kept(inside, wanted):
    page = f"<nav><a href=/>Home</a></nav><article><p>{LONG}</p>{inside}</article><footer>Us, here.</footer>"
    assert html_text.main_text(page, "http://site.org/p") == f"{LONG}\n{wanted}".strip()


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "</x>" * 100_000, "<b>" * 100_000 + "<p></b>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000,
    "<ul>" * 60_000 + "<li>" * 100_000, "<header>" * 90_000,
])
def test_stray_tags_take_linear_time(page):
    start = time.process_time()
    assert html_text.main_text(page) == ""
    assert time.process_time() - start < 20  # some 2 s; a search of the open elements per tag takes half an hour


def test_main_text_of_the_table_by_a_plain_reading(spark, sf_dir):
    """The pages of the table have one article each, of headlines, paragraphs and lists, with adverts inside it."""
    for page in html_text.extract(table(spark, sf_dir, "pages")).join(
            table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article[^>]*>(.*?)</article>", page.html, re.S).group(1)
        article = re.sub(r"<(div class=\"ad\"|script|style|form).*?</(div|script|style|form)>", "\n", article, flags=re.S)
        blocks = re.split(r"</?(?:h\d|p|li|ul|ol|div|blockquote|pre)\b[^>]*>", re.sub(r"\s+", " ", article))
        plain = [re.sub(r"<[^>]+>", "", re.sub(r"<br[^>]*>", " ", b)) for b in blocks]
        lines = [" ".join(html.unescape(x).split()) for x in plain]
        assert page.text == "\n".join(x for x in lines if x), page.page_id


def plain_tokens(word, scores, byte, longest):
    """Fewest tokens of the best segmentation, by the plain recurrence over all ends."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * byte, best[end - 1][1] - size)]
        options += [
            (best[start][0] + scores[word[start:end]], best[start][1] - 1)
            for start in range(max(0, end - longest), end) if word[start:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_long_pretokens_are_counted_in_little_memory():
    scores = tokens.unigram_scores()
    shallow, usual = tokens.TokenTrie(scores, depth=5), tokens.TokenTrie(scores)
    for n in (1, 4, 5, 6, 17, 300, 2000):
        word = "▁" + ("".join(rng_words) + "漢字が続く")[-n:] * 3
        assert shallow.count(word) == usual.count(word) == plain_tokens(word, scores, usual.byte, usual.longest)
    assert len(usual.children) <= 7 * tokens.TRIE_DEPTH + 1
    counts = tokens.WordCounts(usual)
    long = "漢字abc".encode() * 20_000
    tracemalloc.start()
    whole = counts[long]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert whole > 40_000 and peak < 2_000_000 and not counts


def test_token_totals_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores = tokens.unigram_scores()
    trie = tokens.TokenTrie(scores)
    known: dict[str, int] = {}
    wanted = {}
    for doc, text in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for word in words:
            if word not in known:
                known[word] = plain_tokens("▁" + word, scores, trie.byte, trie.longest)
        wanted[doc] = (len(words), sum(known[w] for w in words))
    assert {r.doc_id: (r.n_pretokens, r.n_tokens) for r in tokens.token_counts(docs).collect()} == wanted

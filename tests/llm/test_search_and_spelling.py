"""Top-k search, hard negatives and spelling variants against brute force, on awkward tables and on prunable ones."""

import math
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest

from tickloom.llm import negatives, queries, spelling, topk, vectors
from tests.test_oracle import rows_of

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, rank int, score double"
WORDS = "doc_id bigint, text string, word string, n int"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_topk_search", "op13_hard_negatives"])
def test_matches_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    result = queries.REGISTRY[name](spark, sf_dir)
    found = con.execute(queries.SQL[name])
    assert rows_of(result.columns, result.collect()) == rows_of([d[0] for d in found.description], found.fetchall())


def scaled(vector, scale, width):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector] + [0] * (width - len(vector))


def inner(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def first(rows, k):
    """The ``k`` best of (score, vec_id)."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]


def brute_top(table, k):
    width = max(len(r[1]) for r in table if r[1] is not None)
    rows = [(r[0], v) for r in table if (v := scaled(r[1], topk.SCALE, width)) is not None]
    found = Counter()
    for at, (query, v) in enumerate(rows):
        if query is not None and query % 100 == 0:
            best = first([(inner(v, w), i) for other, (i, w) in enumerate(rows) if other != at], k)
            found.update((query, rank, i, score) for rank, (score, i) in enumerate(best, 1))
    return found


def brute_negatives(table):
    width = max(len(r[1]) for r in table if r[1] is not None)
    rows = [(r[0], v, r[2]) for r in table if r[2] is not None and (v := scaled(r[1], negatives.SCALE, width)) is not None]
    found = Counter()
    for at, (anchor, v, label) in enumerate(rows):
        if anchor is None or anchor % 50:
            continue
        scores = [(inner(v, w), i, other) for k, (i, w, other) in enumerate(rows) if k != at]
        for positive, of, _ in first([s for s in scores if s[2] == label], 5):
            fits = [s for s in scores if s[2] != label and 50 * positive <= 100 * s[0] <= 95 * positive]
            found.update((anchor, of, rank, i, positive, score) for rank, (score, i, _) in enumerate(first(fits, 3), 1))
    return found


def awkward(seed, n=700, width=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    table = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=width) * rng.choice([0.05, 0.5])
        table.append((int(i if i % 11 else i * 50), (v * rng.choice([0.1, 1, 3])).round(2).tolist(), int(rng.integers(0, 4))))
    copy = table[60][1]
    table += [(5000 + i, copy, int(i % 2)) for i in range(n // 2)]  # a third of all rows are copies
    table += [(100, copy, 1), (100, copy, 1), (None, copy, 1), (None, copy, 2), (200, [0.0] * width, 0), (300, [], 1), (400, [1.5], 2)]
    table += [(500, None, 1), (600, [None, 1.0], 1), (700, [float("nan"), 1.0], 1), (800, [float("inf"), 1.0], 1), (900, copy, None)]
    return table


@pytest.fixture(scope="module", params=[1, 2])
def embeddings(spark, request):
    table = awkward(request.param)
    return table, spark.createDataFrame([(*r, "x", 1, 2.0) for r in table], VECTORS).repartition(5)


def top(df, k=topk.K):
    return Counter(map(tuple, topk.top_k(df, df["vec_id"] % 100 == 0, k).collect()))


def mined(df):
    return Counter(map(tuple, negatives.mine(df, df["vec_id"] % 50 == 0, df["label"]).collect()))


def test_top_k_on_awkward_rows(embeddings):
    table, df = embeddings
    assert top(df) == brute_top(table, topk.K)
    assert top(df, 1) == brute_top(table, 1)


def test_negatives_on_awkward_rows(embeddings):
    table, df = embeddings
    assert mined(df) == brute_negatives(table)


def test_many_chunks_and_blocks_give_the_same(embeddings, monkeypatch):
    table, df = embeddings
    monkeypatch.setattr(vectors, "CHUNK_VALUES", 12 * 9)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 50)
    monkeypatch.setattr(negatives, "LEADER_ANCHORS", 20)
    small = [r for r in table if r[0] is None or r[0] % 50 == 0 or r[0] % 7 == 0]
    kept = df.filter("vec_id is null or vec_id % 50 = 0 or vec_id % 7 = 0")
    assert top(kept) == brute_top(small, topk.K)
    assert mined(kept) == brute_negatives(small)


@pytest.mark.parametrize("table", [[], [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (0, [1.0], 1)], [(1, [1.0], 1), (2, [3.0], 2)], [(0, None, 1)]])
def test_vectors_of_small_tables(spark, table):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in table], VECTORS)
    want = [r for r in table if r[1] is not None]
    assert top(df) == (brute_top(want, topk.K) if want else Counter())
    assert mined(df) == (brute_negatives(want) if want else Counter())


def test_wide_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    table = [(i * 50, (rng.normal(size=4) * 100_000).tolist(), i % 2) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in table], VECTORS)
    assert max(abs(r[3]) for r in top(df)) > 2**53
    assert top(df) == brute_top(table, topk.K)


def block_of(found, labels=None):
    block = vectors.Rows.__new__(vectors.Rows)
    block.vector, block.row, block.vec_id = found, np.arange(len(found)), np.arange(len(found))
    block.no_id, block.label = np.zeros(len(found), bool), labels
    return block


def test_search_leaves_most_products_out():
    """Mass in few dimensions, as embeddings have it: most dimensions of most rows are never added."""
    rng = np.random.default_rng(4)
    rows = np.floor(1000 * rng.normal(size=(4000, 64)) * 0.85 ** np.arange(64))
    found = vectors.Best(100, 10)
    work = sum(topk.search(found, rows[:100], np.arange(100), block_of(rows), np.arange(64)) for _ in range(1))
    again = vectors.Best(100, 10, found.least)
    work = topk.search(again, rows[:100], np.arange(100), block_of(rows), np.arange(64))
    assert (again.row == found.row).all() and (again.score == found.score).all()
    assert work < 0.4 * 100 * 4000 * 64


def test_walks_end_early():
    """Anchors around a few directions: a member stops long before the end of the shared list."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32))
    centres /= np.sqrt((centres ** 2).sum(axis=1))[:, None]
    of = rng.integers(0, 20, 6000)
    rows = np.floor(1000 * (centres[of] + 0.02 * rng.normal(size=(6000, 32))))
    labels = np.zeros(6000, np.int64)
    anchors = np.flatnonzero(of == 3)[:64]
    cluster = negatives.Cluster(0, np.arange(len(anchors)), rows[anchors])
    lists = negatives.Positives.__new__(negatives.Positives)
    lists.ids, lists.found = anchors, vectors.Best(len(anchors), 5)
    scored = lists.scan(cluster, rows[anchors], block_of(rows, labels))
    assert scored < 0.25 * len(anchors) * 6000
    scores = rows[anchors] @ rows.T
    scores[np.arange(len(anchors)), anchors] = -np.inf
    assert (lists.found.score.reshape(-1, 5) == -np.sort(-scores, axis=1)[:, :5]).all()


@pytest.mark.parametrize("score", [0, 1, 7, 99, 100, 101, 12345, 10**15 + 7, -1, -150])
def test_windows(score):
    low, high = negatives.windows(np.array([score]))
    assert low[0] == -(-50 * score // 100) and high[0] == 95 * score // 100


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    if len(short) == len(long):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(counts):
    close = {w: [o for o in counts if near(w, o)] for w in counts}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(close[w]), counts.get(form[w])) for w, n in counts.items()}


@pytest.mark.parametrize("seed", range(4))
def test_variants_of_dense_vocabularies(spark, seed):
    """Short words of few letters: anagrams, repeated letters, chains of forms and ties."""
    rng = np.random.default_rng(seed)
    letters = list(["ab", "abcé", "aàçÿñbc", "aeiouxyzst"][seed])
    words = {"".join(rng.choice(letters, rng.integers(6, 9))) for _ in range(400)}
    for w in list(words)[:60]:
        k = int(rng.integers(0, len(w)))
        words |= {w[:k] + w[k + 1:], w[:k] + letters[0] + w[k:], w + "ÿ", "×" + w}
    counts = {w: int(5 * 5 ** rng.integers(0, 5)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert set(map(tuple, spelling.variants(df).collect())) == brute_variants(counts)


def test_signatures_meet_in_every_alphabet(spark):
    """Any partition of the alphabet finds the same pairs."""
    words = ["letters", "lettets", "etters", "lletters", "letterz", "zzletters", "üetters"]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    want = {tuple(sorted(p)) for p in combinations(words, 2) if near(*p)}
    for parts in (list(spelling.LETTERS[k::6] for k in range(6)), [spelling.LETTERS, "", "", "", "", ""]):
        assert {tuple(sorted((r.word, r.other))) for r in spelling.near_words(df, parts).collect()} == want


def brute_slips(rows):
    found = Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for doc, text in rows:
        run = ""
        for c in (text or "").translate(upper) + "\n":
            if c in spelling.LETTERS:
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                word = run[:h % len(run)] + run[h % len(run) + 1:] if h % spelling.SLIP == 0 else run
                if len(word) >= 6:
                    found[word] += 1
            run = ""
    return found


def test_slipped_words(spark, sf_dir):
    rows = [(i, f"Window{chr(97 + i % 26)} WINDOWÉ win×dows a1bcdefg \U0001f600letters") for i in range(3000)]
    rows += [(None, "window letters"), (1, None), (2, ""), (3, "x" * 300_000), (4, "Ünder ünder under" * 3)] * 2
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], WORDS).repartition(3)
    want = brute_slips(rows)
    assert len(want) > 27 and {r.word: r["count"] for r in spelling.slipped(df).groupBy("word").count().collect()} == want
    counts = {w: n for w, n in want.items() if n >= 5}
    assert set(map(tuple, spelling.document_variants(df).collect())) == brute_variants(counts)
    assert spelling.document_variants(df.filter("false")).collect() == []
    assert spelling.document_variants(df.filter("doc_id = 1 and text is null")).collect() == []

"""Hard negatives where bounds spare little: matrix products in tiles, lists that are sorted only where rows come, few tasks."""

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import negatives, vectors


def rows_of(vector, labels, ids=None):
    table = pa.table({
        "row": np.arange(len(vector)), "vec_id": pa.array(np.arange(len(vector)) if ids is None else ids, pa.int64()),
        "vector": pa.array(list(vector)), "label": labels})
    return table, vectors.Rows(table, vector.shape[1], 1.0)


def test_an_addition_sorts_only_its_lists(monkeypatch):
    _, rows = rows_of(np.ones((8, 2)), np.zeros(8, np.int64))
    found = vectors.Best(10_000, 5)
    found.add(np.repeat(np.arange(10_000), 5), np.arange(50_000), rows, np.tile(np.arange(5), 10_000))
    sort, sizes = np.lexsort, []
    monkeypatch.setattr(vectors.np, "lexsort", lambda keys: sizes.append(len(keys[0])) or sort(keys))
    found.add(np.array([3, 9999]), np.array([10**6, -1]), rows, np.array([6, 7]))
    assert sum(sizes) <= 12
    assert len(found.of) == 50_000 and found.score[15:20].tolist() == [10**6, 19, 18, 17, 16] and found.least[3] == 16


def test_best_of_ties_in_any_order():
    rng = np.random.default_rng(0)
    ids = [None if k % 5 == 0 else int(rng.integers(0, 6)) for k in range(60)]
    _, rows = rows_of(np.ones((60, 1)), np.zeros(60, np.int64), ids)
    of, score, at = rng.integers(0, 4, 300), rng.integers(0, 3, 300), rng.integers(0, 60, 300)
    found = vectors.Best(5, 7)
    for k in range(0, 300, 11):
        found.add(of[k:k + 11], score[k:k + 11], rows, at[k:k + 11])
    order = sorted(range(300), key=lambda k: (of[k], -score[k], rows.no_id[at[k]], rows.vec_id[at[k]], at[k]))
    want = [k for n in range(4) for k in [k for k in order if of[k] == n][:7]]
    assert found.of.tolist() == of[want].tolist() and found.score.tolist() == score[want].tolist()
    assert found.row.tolist() == at[want].tolist() and found.no_id.tolist() == rows.no_id[at[want]].tolist()


@pytest.mark.parametrize("scale", [100, 10**6, 10**8])
@pytest.mark.parametrize("spared", [1, 10**9])
@pytest.mark.parametrize("kind", [negatives.Positives, negatives.Negatives])
def test_tiles_and_walks_find_the_same(monkeypatch, scale, spared, kind):
    """32-bit floats, 64-bit floats and whole numbers; labels of many rows, of few and of none."""
    monkeypatch.setattr(negatives, "SPARED", spared)
    monkeypatch.setattr(negatives, "TILE", 7)
    monkeypatch.setattr(negatives, "HITS", 50)
    monkeypatch.setattr(negatives, "LABEL_ANCHORS", 6)
    rng = np.random.default_rng(scale)
    vector = np.floor(scale * (rng.normal(size=(5, 6))[rng.integers(0, 5, 900)] + 0.2 * rng.normal(size=(900, 6))))
    vector[:40], vector[40] = vector[0], 0
    labels = rng.choice([1, 1, 1, 2, 2, 3, 70, 71, -5], 900)
    table, _ = rows_of(vector, labels)
    chunk = table.filter(pa.array(np.arange(900) % 9 == 0))
    anchors = vectors.Rows(chunk, 6, 1.0)
    exact = anchors.vector.astype(np.int64) @ vector.astype(np.int64).T
    high = np.sort(rng.choice(exact.ravel(), (len(anchors.row), 5)), axis=1)[:, ::-1]
    low = np.minimum(high, high // 2)
    chunk = chunk.append_column("least", pa.array(np.full(len(anchors.row), -np.inf)))
    for name, x in (("low", low), ("high", high), ("third", low.astype(float))):
        chunk = chunk.append_column(name, pa.array(list(x)))
    lists = kind(chunk)
    groups = negatives.clusters(anchors.vector, anchors.label, np.zeros(len(anchors.row)), spared)
    for at in range(0, 900, 250):
        negatives.search(lists, anchors, np.argsort(anchors.label, kind="stable"), groups, vectors.Rows(table.slice(at, 250), 6, 1.0))
    held = list(zip(lists.found.of.tolist(), lists.found.score.tolist(), lists.found.row.tolist(), strict=True))
    want = []
    for one in range(len(anchors.row)):
        same = labels == anchors.label[one]
        if kind is negatives.Positives:
            fits = [same & (np.arange(900) != anchors.row[one])]
        else:
            fits = [~same & (exact[one] >= low[one, k]) & (exact[one] <= high[one, k]) for k in range(5)]
        for k, each in enumerate(fits):
            best = sorted(np.flatnonzero(each), key=lambda r: (-exact[one, r], r))[:lists.found.k]
            want += [(one * len(fits) + k, int(exact[one, r]), int(r)) for r in best]
    assert held == want


def test_few_rare_labels_share_a_tile():
    lists, labels = negatives.Negatives, np.sort(np.r_[np.arange(1000), np.full(100, 400)])
    groups = list(lists.meetings(labels, labels))
    assert [(g.start, g.stop) for g, _ in groups] == [(0, 400), (400, 501), (501, 1100)]
    assert [p for _, p in groups] == [[(0, 1100)], [(0, 400), (501, 1100)], [(0, 1100)]]


def test_a_pass_has_few_tasks(spark):
    """Each task returns its best rows of every list, so their number must not grow with the table."""
    rows = spark.range(500).selectExpr("id as row", "id as vec_id", "array(float(id), 1f) as vector", "id % 2 as label").repartition(100)
    chunk = pa.table({"row": [0, 1], "vec_id": [0, 1], "vector": [[0.0, 1.0], [1.0, 1.0]], "label": [0, 1], "leader": [0, 0],
                      "least": [-np.inf, -np.inf]})
    found = negatives._scan(rows, chunk, negatives.Positives, 2, 1.0)
    assert found.rdd.getNumPartitions() == max(negatives.TASKS, 2 * spark.sparkContext.defaultParallelism)
    best = sorted((r.anchor_row, r.score, r.row) for r in found.collect())
    assert [r for r in best if r[0] == 1][-5:] == [(1, k + 1, k) for k in (491, 493, 495, 497, 499)]


def test_the_sample_meets_few_anchors_at_a_time():
    batch = pa.record_batch({"row": np.arange(10_000)})
    assert max(b.num_rows for b in negatives.tiles([batch])) <= negatives.TILE
    assert sum(b.num_rows for b in negatives.tiles([batch])) == 10_000


def test_kth():
    scores, fits = np.array([[5.0, 1, 3], [2, 2, 9]]), np.array([[True, True, False], [True, True, True]])
    assert negatives.kth(scores, fits, 2).tolist() == [1, 2] and negatives.kth(scores, fits, 3).tolist() == [-np.inf, 2]
    assert negatives.kth(scores, fits, 4).tolist() == [-np.inf, -np.inf]
    assert negatives.kth(np.zeros((2, 0)), np.zeros((2, 0), bool), 1).tolist() == [-np.inf, -np.inf]


def test_copies_are_taken_in_parts(monkeypatch):
    monkeypatch.setattr(negatives, "HITS", 100)
    parts = list(negatives.reaching(np.ones((20, 30), np.float32), np.r_[np.zeros(19), np.inf]))
    assert [len(one) for one, _ in parts] == [100] * 5 + [70]
    assert sorted(zip(*map(np.concatenate, zip(*parts, strict=True)), strict=True)) == [(i, j) for i in range(19) for j in range(30)]

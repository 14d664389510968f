"""Top-k search and embedding near-dedup against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import embedding_dedup, exact_topk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, vec string, entry int, block int"
BAD = [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan"), 0.0, 1.0]), (903, [float("inf"), 0.0, 1.0]), (904, []),
       (905, [1.0]), (None, [1.0, 1.0, 1.0])]


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "i", "v", 1, 2) for i, v, l in rows], SCHEMA)


def brute_topk(rows, queries, k):
    fine = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in fine:
        if q in queries:
            best = sorted(((-float(v @ w), i) for i, w in fine if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"bits": 2, "strip": 40, "block": 3, "wave": 4}])
def test_topk_equals_brute_force(spark, options):
    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(-40, 40, 3).astype(float).tolist(), 0) for k in range(250)]
    rows += [(300 + k, [39.0, 39.0, 39.0], 0) for k in range(30)] + [(i, v, 0) for i, v in BAD]
    frame = table(spark, rows)
    queries = {k for k in range(0, 400, 10)}
    got = sorted(tuple(r) for r in exact_topk.exact_topk(frame, frame.where("vec_id % 10 = 0"), 5, **options).collect())
    assert got == brute_topk(rows, queries, 5)


@pytest.mark.parametrize("options", [{}, {"bits": 2, "strip": 20, "block": 3, "wave": 2}])
def test_topk_of_repeated_rows_and_shared_vectors(spark, options):
    rng = np.random.default_rng(4)
    fine = [(k, rng.integers(-30, 30, 3).astype(float).tolist(), 0) for k in range(60)]
    rows = [*fine, *fine[:20], *fine[:20:2] * 6]  # queries given twice and eight times
    rows += [(10, [38.0, 38.0, 38.0], 0)] * 7 + [(100 + k, [38.0, 38.0, 38.0], 0) for k in range(4)]
    rows += [(20, [39.0, -39.0, 39.0], 0)] * 2 + [(k, fine[30][1], 0) for k in (31, 31, 40, 200, 201)]
    frame = table(spark, rows)
    asked = {i: min(v for j, v, _ in rows if j == i) for i in range(0, 60, 10)}
    got = sorted(tuple(r) for r in exact_topk.exact_topk(frame, frame.where("vec_id < 60 and vec_id % 10 = 0"), 5, **options).collect())
    want = []
    for q, v in asked.items():
        best = sorted((-float(np.dot(v, w)), i) for i, w, _ in rows if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_topk_bound_is_not_given_by_the_querys_own_repeated_row(spark):
    rows = [(1, [3.0, 0.0], 0)] * 2 + [(k, [4.0 - k / 2, 1.0], 0) for k in range(2, 8)]
    frame = table(spark, rows)
    got = [tuple(r) for r in exact_topk.exact_topk(frame, frame.where("vec_id = 1"), 5).orderBy("rank").collect()]
    assert got == [(1, k - 1, k, 3.0 * (4.0 - k / 2)) for k in range(2, 7)]


def test_topk_keeps_other_rows_of_a_vector_the_query_repeats(spark):
    rows = [(1, [5.0, 5.0], 0)] * 7 + [(k, [5.0, 5.0], 0) for k in (2, 3, 3)] + [(k, [1.0, k / 10], 0) for k in range(4, 9)]
    frame = table(spark, rows)
    got = [tuple(r) for r in exact_topk.exact_topk(frame, frame.where("vec_id = 1"), 5).orderBy("rank").collect()]
    assert got == [(1, 1, 2, 50.0), (1, 2, 3, 50.0), (1, 3, 3, 50.0), (1, 4, 8, 9.0), (1, 5, 7, 8.5)]


def test_topk_of_few_rows_and_none(spark):
    two = table(spark, [(1, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 3.0], 0)])
    assert sorted(tuple(r) for r in exact_topk.exact_topk(two, two).collect()) == [(1, 1, 2, 14.0), (2, 1, 1, 14.0)]
    none = table(spark, [])
    assert exact_topk.exact_topk(none, none).count() == 0
    assert exact_topk.exact_topk(two, none).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    m, q = rng.normal(size=(200, 8)), rng.normal(size=(20, 8))
    cells = exact_topk.Cells(m.min(0), m.max(0), 3)
    low, high = exact_topk.bounds(q, *cells.box(cells.of(m)))
    exact = q @ m.T
    assert (low <= exact).all() and (exact <= high).all()


def brute_links(rows, threshold):
    fine = [l is not None and v and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n
    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(n):
        for b in range(a):
            if fine[a] and fine[b] and rows[a][2] == rows[b][2] and \
                    embedding_dedup.exact_cosine(np.array(rows[a][1]), np.array(rows[b][1])) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted((str(i), links[k], str(low.get(find(k))), i == low.get(find(k)) if i is not None else low.get(find(k)) is None)
                  for k, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize("options", [{}, {"block": 16, "dims": 2, "sample": 50}])
def test_embedding_dedup_equals_brute_force(spark, options, monkeypatch):
    if options:
        monkeypatch.setattr(embedding_dedup, "LEAF", 4)
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=3).tolist(), int(rng.integers(0, 3))) for k in range(150)]
    rows += [(200 + k, [1.0, 2.0, 3.0], 1) for k in range(20)] + [(230, [2.0, 4.0, 6.0], 1), (231, [1.0, 2.0, 3.0], 2)]
    rows += [(240, [0.0, 0.0, 0.0], 1), (241, [1.0, 2.0, 3.0], None), (242, [1e-200, 2e-200, 3e-200], 1), (200, [-5.0, 1.0, 0.0], 0)]
    rows += [(i, v, 1) for i, v in BAD]
    got = sorted((str(r.id), r.n_links, str(r.component_id), r.kept) for r in embedding_dedup.embedding_dedup(table(spark, rows), **options).collect())
    assert got == brute_links(rows, 0.93)


def test_embedding_dedup_of_an_empty_table(spark):
    assert embedding_dedup.embedding_dedup(table(spark, [])).count() == 0


def test_lengths_are_groups_of_their_own(spark):
    """Other lengths, however common, change nothing: neither partners nor scores."""
    rng = np.random.default_rng(5)
    three = [(k, rng.integers(-9, 9, 3).astype(float).tolist(), k % 2) for k in range(30)]
    two = [(100 + k, [1.0, 2.0], 1) for k in range(2)] + [(110, [5.0, -1.0], 1)]
    for more in ([], [(200 + k, [float(k), 1.0], 0) for k in range(60)]):
        frame = table(spark, three + two + more)
        got = {(r.query, r.id): r.score for r in exact_topk.exact_topk(frame, frame.where("vec_id in (0, 100)"), 3).collect()}
        of = lambda q, rows: sorted((-float(np.dot(dict((i, v) for i, v, _ in rows)[q], v)), i) for i, v, _ in rows if i != q)[:3]
        assert got == {**{(0, i): -s for s, i in of(0, three)}, **{(100, i): -s for s, i in of(100, two + more)}}
        links = {r.id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(frame).collect()}
        assert links[100] == links[101] == (1, 100) and links[110] == (0, 110)

"""Hard negatives, whitening and top-k search against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.llm import multi_index, pivot_search, vectors, whitening
from colonnade.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL

NAN, INF = float("nan"), float("inf")
#: vec_id, vector, label: nulls in any column, bad components, short, long and empty vectors, ties, repeated rows and ids.
EDGE = ([(i, [((i * 7 + k * 3) % 11 - 5) / 8, (i % 5) / 4, ((i * i + k) % 7 - 3) / 16], i % 3) for i in range(120) for k in [i % 4]]
        + [(i, [0.5, 0.25, -0.125], 1) for i in range(200, 260)]
        + [(300, None, 1), (350, [0.5, None, 1.0], 1), (400, [NAN, 0.1, 0.2], 1), (450, [INF, 0.1, 0.2], 2), (500, [0.5], 0), (550, [], 1), (None, [0.5, 0.5, 0.5], 1),
           (600, [0.5, 0.5, 0.5], None), (650, [-0.5, -0.5, -0.5], 2), (700, [0.0, 0.0, 0.0], 0), (0, [0.0, 0.0, 0.0], 0), (100, [0.25, 0.5, 0.125], 1),
           (100, [0.25, 0.5, 0.125], 1), (750, [-0.001, 0.0039, 1e-9], 0)])


def table(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    clash = ["x", "n", "cell", "rank", "score", "d", "j", "slice", "part", "anchor_id", "query_id", "seen", "bound", "least", "square"]
    return df.withColumns({c: F.lit("clash") for c in clash}) if extra else df


def taking_part(rows, labelled=False):
    """{vec_id: (x, label)} by the rules of ``vectors``, lists padded to one length."""
    fine = [(i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v) and not (labelled and lab is None) and i is not None]
    d = max((len(v) for _, v, _ in fine), default=0)
    out = {}
    for i, v, lab in sorted(fine, key=lambda r: (r[0], r[1] + [0] * (d - len(r[1])), r[2] if r[2] is not None else -1)):
        out.setdefault(i, (v + [0] * (d - len(v)), lab))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, every, k=5):
    have = taking_part(rows)
    out = []
    for q in sorted(have):
        if q % every == 0:
            best = sorted(((-dot(have[q][0], have[c][0]), c) for c in have if c != q))[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return out


def brute_negatives(rows, every, k=5):
    have = taking_part(rows, labelled=True)
    out = []
    for a in sorted(have):
        if a % every == 0:
            order = sorted(((-dot(have[a][0], have[c][0]), c) for c in have if c != a))
            for s, p in [(s, c) for s, c in order if have[c][1] == have[a][1]][:k]:
                fits = [(t, c) for t, c in order if have[c][1] != have[a][1] and 80 * -s <= 100 * -t <= 100 * -s][:k]
                out += [(a, p, r + 1, c, -s, -t) for r, (t, c) in enumerate(fits)]
    return sorted(out)


def collected(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


TOP = ("query_id", "rank", "vec_id", "score")
NEGATIVE = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("kwargs", [{}, {"block": 16, "group": 2, "n_pivots": 5}, {"most": 3, "n_pivots": 2}])
def test_top_k_edge(spark, kwargs):
    got = pivot_search.top_k(table(spark, EDGE), F.col("vec_id") % 50 == 0, **kwargs)
    assert collected(got, *TOP) == sorted(brute_top(EDGE, 50))


def test_top_k_small_and_empty(spark):
    assert pivot_search.top_k(table(spark, EDGE).limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = [(0, [1.0, 2.0], 1), (50, [2.0, 1.0], 1), (7, [0.0, 0.5], 0)]
    assert collected(pivot_search.top_k(table(spark, few), F.col("vec_id") % 50 == 0), *TOP) == sorted(brute_top(few, 50))
    assert pivot_search.top_k(table(spark, few[2:]), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("kwargs", [{}, {"codewords": 3, "block": 16, "group": 2}, {"codewords": 2, "most": 4}])
def test_negatives_edge(spark, kwargs):
    got = multi_index.mine(table(spark, EDGE), F.col("vec_id") % 50 == 0, F.col("label"), **kwargs)
    assert collected(got, *NEGATIVE) == brute_negatives(EDGE, 50)


def test_negatives_empty_and_one_label(spark):
    assert multi_index.mine(table(spark, EDGE).limit(0), F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
    alone = [(i, [float(i)], 1) for i in range(0, 300, 25)]
    assert multi_index.mine(table(spark, alone), F.col("vec_id") % 50 == 0, F.col("label")).count() == 0


def test_rounds_stop_early(spark):
    """Well separated groups: the bounds certify every window before all cells are visited, with the same result."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 8)) * 4
    rows = [(i, (centres[i % 12] + rng.standard_normal(8) * 0.02).tolist(), i // 12 % 3) for i in range(1800)]
    got = multi_index.mine(table(spark, rows, extra=False), F.col("vec_id") % 100 == 0, F.col("label"))
    assert collected(got, *NEGATIVE) == brute_negatives(rows, 100)
    rows_in = vectors.integer_rows(table(spark, rows, extra=False)).withColumn("label", F.col("label").cast("long"))
    grid, index = multi_index.build(rows_in, 16, 4096)
    begin = grid.filter("vec_id % 100 = 0").selectExpr("vec_id anchor_id", "label", "x", "array(bigint(1) << 62) highs", "array(-(bigint(1) << 62)) lows", "0 seen")
    plan = multi_index.visited(begin, index, multi_index.SHARES[0])
    assert all(r["bound"] is not None and len(r["cells"]) < len(index.rows) for r in plan.collect())


def test_heap_order():
    rng = np.random.default_rng(1)
    index = multi_index.Index(rng.standard_normal((6, 3)) * 50, rng.standard_normal((5, 2)) * 50)
    index.rows = {c: 1 + c % 3 for c in range(30) if c % 4}
    index.radii = (rng.random(6) * 9, rng.random(5) * 9)
    q = rng.integers(-99, 99, 5)
    seen = list(index.visits(q))
    assert sorted(c for _, _, c in seen) == sorted(index.rows) and all(a[0] >= b[0] for a, b in zip(seen, seen[1:]))
    for high, low, cell in seen:
        for _ in range(20):
            parts = []
            for part, book, radius, code in zip((3, 2), index.books, index.radii, divmod(cell, 5)):
                step = rng.standard_normal(part)
                parts.append(book[code] + step / np.linalg.norm(step) * radius[code] * rng.random())
            assert low <= np.concatenate(parts) @ q <= high


def brute_whiten(rows, k=4):
    fine = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max(len(v) for _, v in fine)
    x = np.array([v + [0] * (d - len(v)) for _, v in fine])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    return [i for i, _ in fine], n, ((n * x - total) ** 2).sum(1), (x - total / n) @ axes / np.sqrt(e), e / (centred ** 2).sum() * n


def check_whitened(df, rows):
    ids, n, deviation, want, explained = brute_whiten(rows)
    k = want.shape[1]
    got = defaultdict(list)
    for r in df.collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-9
        got[r["vec_id"]].append((r["component"], r["deviation"], r["whitened"]))
    assert sorted(got, key=str) == sorted(set(ids), key=str)
    signs = None
    for i, dev, w in zip(ids, deviation, want):
        mine = [x for x in got[i] if x[1] == dev]
        have = {c: v for c, _, v in mine}
        values = np.array([have[c] for c in range(1, k + 1)])
        if signs is None and (np.abs(w) > 1e-3).all():
            signs = np.sign(w * values)
        if signs is not None and len(mine) == k:
            assert np.abs(values * signs - w).max() < 1e-8


def test_whitening_edge(spark):
    check_whitened(whitening.whiten(table(spark, EDGE)), EDGE)


def test_whitening_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    check_whitened(QUERIES["op12_lanczos_whitening"](spark, SF_SMALL), [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()])


def test_whitening_degenerate(spark):
    assert whitening.whiten(table(spark, EDGE).limit(0)).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)])).count() == 0
    line = [(i, [i / 4, i / 2, 0.0], 0) for i in range(9)]  # one component only
    rows = whitening.whiten(table(spark, line)).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 9 and all(abs(r["explained"] - 1) < 1e-12 for r in rows)


def test_whitening_equal_eigenvalues(spark):
    """The corners of a cube: all variances are equal, so the Krylov space ends after one step and starts anew."""
    cube = [(i, [float(i >> k & 1) for k in range(5)], 0) for i in range(32)]
    rows = whitening.whiten(table(spark, cube)).collect()
    assert len(rows) == 32 * 4 and all(abs(r["explained"] - 0.2) < 1e-12 and r["identity_error"] < 1e-12 for r in rows)


def test_whitening_large_numbers(spark):
    """Sums beyond doubles and deviations beyond a long stay exact, or become null."""
    rows = [(i, [float(1 << 40) * (i % 3), float(i)], 0) for i in range(7)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(table(spark, rows)).collect()}
    x = [[math.floor(256 * c) for c in v] for _, v, _ in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((7 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [got[i] for i in range(7)] == [v if v < 1 << 63 else None for v in want]


@pytest.mark.parametrize("name", ["op11_multi_index", "op13_pivot_search"])
def test_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert collected(got, *columns) == sorted(want.fetchall())

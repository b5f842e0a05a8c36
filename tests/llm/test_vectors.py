"""Centroid clustering and hard-negative mining against plain re-statements in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from civitas.llm import centroids as C, hard_negatives as H

VECTORS = "vec_id long, embedding array<double>, label int"


def usable(x):
    return x is not None and all(e is not None and math.isfinite(e) for e in x)


def clusters(rows, k, rounds, width, scale=1024):
    """(vec_id, cluster, distance, cluster inertia, inertia, centroid hash) of every kept row."""
    points = [(i, [math.floor(scale * e) for e in x]) for i, x, *_ in rows if usable(x) and len(x) == width]
    name = lambda p: (p[0] is None, hashlib.sha256(f"3:{p[0]}".encode()).hexdigest(), p[0] or 0, p[1])
    middle = [x for _, x in sorted(points, key=name)[:k]]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    assign = lambda: [min((square(x, c), j) for j, c in enumerate(middle)) for _, x in points]
    for _ in range(rounds):
        at = assign()
        for j in range(len(middle)):
            own = [x for (_, x), (_, a) in zip(points, at, strict=True) if a == j]
            if own:
                middle[j] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    at = assign()
    inertia = [sum(d for d, a in at if a == j) for j in range(len(middle))]
    long = lambda v: v if v < 1 << 63 else None
    return sorted(((i, a, long(d), long(inertia[a]), long(sum(inertia)), hashlib.sha256(",".join(map(str, middle[a])).encode()).hexdigest()) for (i, _), (d, a) in zip(points, at, strict=True)), key=repr)


def clustered(spark, rows, **more):
    return sorted((tuple(r)[:6] for r in C.cluster(spark, spark.createDataFrame(rows, VECTORS), **more).collect()), key=repr)


ODD = [(500, None, 1), (501, [], 1), (502, [1.0] * 5, 1), (503, [None, *[1.0] * 5], 1), (504, [math.nan] * 6, 1), (505, [math.inf] * 6, 1), (None, [0.5] * 6, 2), (7, [0.1] * 6, None)]


@pytest.mark.parametrize("kind", ["spread", "grouped", "large"])
def test_clusters_against_brute_force(spark, kind):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 0) for i in range(120)]
    if kind == "grouped":
        rows = [(i, [10 * ((i % 9) >> j % 3 & 1) + rng.gauss(0, 0.1) for j in range(6)], 0) for i in range(120)]
    if kind == "large":
        rows += [(200, [1e30] * 6, 0), (201, [-1e30, 1e300, 3.0, -1.5e9, 0.0, 7.0], 0), (202, [3e9] * 6, 0), (203, [-4e9] * 6, 0)]
    rows += ODD + [rows[0], rows[0], *((300 + i, [1.0, 2.0, 3.0, -1.0, -2.0, -3.0], 0) for i in range(60))]
    assert clustered(spark, rows, width=6, segments=3) == clusters(rows, 8, 10, 6)


def test_few_vectors_ties_and_none(spark):
    assert clustered(spark, [], width=2) == clustered(spark, [(1, None, 0), (2, [1.0], 0)], width=2) == []
    rows = [(i, [float(i % 2), 0.0], 0) for i in range(5)] + [(9, [0.5, 0.0], 0)]
    for segments in (1, 2):
        assert clustered(spark, rows, width=2, segments=segments) == clusters(rows, 8, 10, 2)


def test_screening_spares_exact_distances(spark):
    rng = random.Random(1)
    rows = [(i, [4.0 * (j // 8 == i % 8) + rng.gauss(0, 0.05) for j in range(64)], 0) for i in range(400)]
    got = C.cluster(spark, spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == clusters(rows, 8, 10, 64)
    assert sum(r.checked for r in got) < 2 * len(rows)


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 300, (500, 16)))
    middle = [[int(v) for v in r] for r in np.floor(rng.normal(0, 300, (9, 16)))]
    pick, best, exact, checked = C.nearest(x, (x * x).sum(1), C.segment_norms(x, 4), middle, 4)
    truth = [min((sum((int(a) - b) ** 2 for a, b in zip(r, c, strict=True)), j) for j, c in enumerate(middle)) for r in x]
    assert [(int(d), int(j)) for d, j in zip(best, pick, strict=True)] == truth and not exact and (checked >= 1).all()


def mined(rows, every):
    """(anchor, positive, rank, negative, scores) by the contract; rows are told apart by their place."""
    points = []
    for at, (i, x, label) in enumerate(rows):
        if usable(x) and label is not None:
            points.append((at, i, [math.floor(256 * e) for e in x], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for at, i, x, label in points:
        if i is None or i % every:
            continue
        score = lambda p: max(-H.MOST, min(H.MOST, sum(s * t for s, t in zip(x, p[2], strict=False))))
        ranked = sorted((p for p in points if p[0] != at), key=lambda p: (-score(p), p[1] is None, p[1] or 0, p[0]))
        for p in [p for p in ranked if p[3] == label][:5]:
            fits = [n for n in ranked if n[3] != label and 30 * score(p) <= 100 * score(n) <= 90 * score(p)]
            out += [(i, p[1], rank, n[1], score(p), score(n)) for rank, n in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


def negatives(spark, rows, every):
    return sorted(map(tuple, H.mine(spark, spark.createDataFrame(rows, VECTORS), every=every).collect()), key=repr)


@pytest.mark.parametrize("kind", ["spread", "blocks", "hot", "large", "widths"])
def test_negatives_against_brute_force(spark, kind, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(6)], rng.randrange(4)) for i in range(300)]
    if kind == "blocks":  # many small blocks and tiles; the plan carries the sizes in its closures
        monkeypatch.setattr(H, "TILE", 2)
        monkeypatch.setattr(H, "PIVOTS", 2)
        rows = [(i, [rng.gauss(3 * (i % 5 == j), 0.2) for j in range(6)], rng.randrange(3)) for i in range(400)]
    if kind == "hot":
        rows += [(1000 + i, [0.5, -0.25, 0.5, 0.125, 0.0, 0.25], i % 2) for i in range(300)]
    if kind == "large":
        rows += [(4001, [1e30] * 6, 1), (5000, [1e7, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (4003, [2e6] * 6, 2), (4004, [-1e300, 1e300, 1.0, 1.0, 1.0, 1.0], 1), (4005, [5e6] * 6, 1)]
    if kind == "widths":
        rows = [(i, x[: rng.randint(0, 6)], k) for i, x, k in rows]
    rows += [r for r in ODD if r[0] != 502 or kind == "widths"] + [rows[0], rows[10], (None, rows[20][1], 1), (-20, rows[30][1], 2), (-7, rows[40][1], -3)]
    assert negatives(spark, rows, 10) == mined(rows, 10)


def test_negatives_of_few_rows(spark):
    assert negatives(spark, [], 10) == negatives(spark, [(10, None, 1), (20, [1.0], None)], 10) == []
    assert negatives(spark, [(1, [1.0], 1), (2, [1.0], 2)], 10) == []
    rows = [(0, [1.0, 0.0], 1), (10, [1.0, 0.0], 2), (1, [0.5, 0.0], 2), (2, [0.5, 0.0], 1), (3, [0.0, 0.0], 3), (4, [-1.0, 0.0], 1)]
    assert negatives(spark, rows, 10) == mined(rows, 10)


def test_brackets_hold_scores_and_leave_rows_out():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(0, 20, (300, 8)) + 400 * np.eye(8)[rng.integers(0, 8, 300)])
    largest, pivots = float((x * x).sum(1).max()), H.farthest_first(x[:100], 8)
    one = lambda rows, query: H._Block({"n": len(rows), "block": 0, "uids": H._own(rows), "ids": H._own(rows), "named": bytes([1] * len(rows)), "labels": H._own(rows), "vectors": H._own(x[rows]), "distances": H._own(H.pivot_distances(x[rows], pivots, largest, query))}, "")
    q, v = one(np.arange(20), True), one(np.arange(20, 300), False)
    true = x[:20] @ x[20:].T
    low, high = H.brackets(q, v, np.arange(280), largest)
    assert (low <= true).all() and (true <= high).all() and (high < 0.5 * true.max(axis=1)[:, None]).mean() > 0.2
    low, high = H.block_bracket(q, v, largest)
    assert (low[:, None] <= true).all() and (true <= high[:, None]).all()
    assert (H.scores(q, v, np.arange(280)) == true).all()

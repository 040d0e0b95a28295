"""Hard negatives against all pairs, with many pages, copies, ties and edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.llm import hardnegatives

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, is_anchor, positives=5, negatives=5, share=(80, 100)):
    """rows: (id, label, whole vector)."""
    out = []
    for a, label, x in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(int(p) * int(q) for p, q in zip(x, y)), i, other) for i, other, y in rows if i != a)
        for score, i in [(-s, i) for s, i, other in scored if other == label][:positives]:
            fits = [(-s, j) for s, j, other in scored
                    if other != label and share[0] * score <= -100 * s <= share[1] * score][:negatives]
            out += [(a, i, k + 1, j, score, s) for k, (s, j) in enumerate(fits)]
    return sorted(out)


def made(spark, rows, **more):
    points = spark.createDataFrame([(i, label, [float(v) for v in x]) for i, label, x in rows],
                                   "id long, label long, vector array<double>")
    return sorted(tuple(r[n] for n in NAMES) for r in hardnegatives.mine(points, F.col("id") % 10 == 0, **more).collect())


def vectors(seed, count, width=8, spread=100):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, spread, (6, width))
    points = centres[draw.integers(0, 6, count)] + draw.normal(0, spread / 8, (count, width))
    points[: count // 10] = np.round(points[0])              # a group of copies, and ties with it
    return [(k, int(draw.integers(0, 4)), np.floor(p)) for k, p in enumerate(points)]


@pytest.mark.parametrize("page", [8192, 40])
def test_as_all_pairs(spark, monkeypatch, page):
    monkeypatch.setattr(hardnegatives, "PAGE", page)
    monkeypatch.setattr(hardnegatives, "BLOCK", 16)
    rows = vectors(3, 400)
    want = plain(rows, lambda i: i % 10 == 0)
    assert made(spark, rows) == want and len(want) > 100


def test_other_counts_and_shares(spark):
    rows = vectors(4, 150, spread=20)
    assert made(spark, rows, positives=2, negatives=3, share=(50, 90)) == plain(
        rows, lambda i: i % 10 == 0, 2, 3, (50, 90))


def test_bounds_hold_in_every_node():
    rows = vectors(8, 3000)
    points = np.array([x for *_, x in rows])
    most = float((points ** 2).sum(1).max())
    tree = hardnegatives.CoverTree(points, most)
    assert sorted(tree.order.tolist()) == list(range(3000))
    below = {}
    for k in reversed(range(len(tree.radius))):
        below[k] = (set(range(tree.first[k], tree.last[k])) if tree.first[k] >= 0
                    else set().union(*[below[c] for c in tree.children[k]]))
        assert all(tree.radius[c] <= tree.radius[k] + 1e-9 for c in tree.children[k])
    assert below[0] == set(range(3000)) and len(tree.radius) > 20
    query = points[17]
    length = np.linalg.norm(query)
    for k, places in below.items():
        scores = points[tree.order[sorted(places)]] @ query
        assert scores.max() <= tree.centre[k] @ query + length * tree.radius[k] + 1e-6
        assert scores.min() >= tree.centre[k] @ query - length * tree.radius[k] - 1e-6


def test_edge_rows(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.5]), (2, 2, [1.0, 1.4]), (3, 2, [0.9]), (4, 2, [1.0, None]),
            (5, 2, [float("nan"), 1.0]), (6, 2, [float("inf"), 1.0]), (7, None, [1.0, 2.0]), (8, 2, None),
            (None, 2, [1.0, 1.4]), (9, 2, []), (10, 3, [0.0, 0.0]), (11, 3, [0.0, 0.0]), (2, 5, [1.0, 1.4]),
            (1, 1, [1.0, 1.5])]
    table = spark.createDataFrame([(*r, "x", 0) for r in rows],
                                  "vec_id long, label int, embedding array<float>, cell string, slot int")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    points = hardnegatives.usable(table, "vec_id", F.col("label"), F.col("embedding"), whole)
    kept = {r["id"]: (r["label"], r["vector"]) for r in points.collect()}
    assert sorted(kept) == [0, 1, 2, 3, 9, 10, 11] and kept[2][0] == 2
    full = [(i, label, list(v) + [0.0] * (2 - len(v))) for i, (label, v) in sorted(kept.items())]
    assert all(v == math.floor(v) for *_, x in full for v in x)
    got = sorted(tuple(r[n] for n in NAMES) for r in hardnegatives.mine(points, F.col("id") % 10 == 0).collect())
    assert got == plain(full, lambda i: i % 10 == 0)
    assert any(r[0] == 10 and r[4] == 0 for r in got)
    assert hardnegatives.mine(points.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hardnegatives.mine(points, F.col("id") < 0).count() == 0

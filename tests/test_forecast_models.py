"""The trend, recurrent and k-means models against their definitions."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillgrain.operators import forecast as fc, kmeans, recurrent, trend
from tillgrain.operators.kmeans import Centres
from tillgrain.schema import Settings
from tillgrain.session import materialize, scratch_path


def test_a_planted_change_is_found():
    days = np.arange(400.0)
    line = 100 + 0.2 * days + np.where(days > 160, 1.5 * (days - 160), 0)
    noise = np.random.default_rng(1).normal(0, 3, 400)
    model = trend.Trend(days, line + noise)
    changes = model.beta[model.changes]
    at = model.knots[np.abs(changes).argmax()] * model.span
    assert abs(at - 160) < 25 and changes[np.abs(changes).argmax()] > 0
    assert (changes == 0).sum() >= len(changes) // 2                 # few changes, not many small ones
    ahead = model.predict(np.arange(400.0, 430))
    assert np.abs(ahead / (100 + 0.2 * np.arange(400, 430) + 1.5 * (np.arange(400, 430) - 160)) - 1).max() < 0.05


def test_the_fit_is_the_minimum():
    """The gradient is 0, or within the penalty where a change is 0."""
    days = np.arange(300.0)
    y = 50 + 10 * np.sin(days / 7 * 2 * np.pi) + np.random.default_rng(2).normal(0, 2, 300) + np.maximum(days - 100, 0)
    model = trend.Trend(days, y)
    x, scaled = trend.design(days, model.start, model.span, model.knots), y / model.size
    slope = x.T @ (scaled - x @ model.beta) - model.ridge * model.beta
    for j, penalty in enumerate(model.lasso):
        if penalty == 0:
            assert abs(slope[j]) < 1e-5
        elif model.beta[j] == 0:
            assert abs(slope[j]) <= penalty + 1e-6
        else:
            assert slope[j] == pytest.approx(penalty * np.sign(model.beta[j]), abs=1e-5)


def test_intervals_widen_and_repeat():
    draw = np.random.default_rng(3)
    days = np.arange(500.0)
    model = trend.Trend(days, 100 + np.cumsum(draw.normal(0, 2, 500)))
    ahead = np.arange(500.0, 560)
    low, high = model.interval(ahead, 7)
    again = model.interval(ahead, 7)
    assert np.array_equal(low, again[0]) and np.array_equal(high, again[1])
    middle = model.predict(ahead)
    assert (low <= middle).all() and (middle <= high).all()
    assert (high - low)[-10:].mean() > 1.2 * (high - low)[:10].mean()


@pytest.mark.parametrize("n", [1, 2, 5])
def test_short_and_constant_series(n):
    model = trend.Trend(np.arange(float(n)), np.full(n, 4.0))
    low, high = model.interval(np.arange(n, n + 3.0), 1)
    assert np.isfinite([*model.predict(np.arange(n, n + 3.0)), *low, *high]).all()


def test_gradients_are_those_of_the_error():
    draw = np.random.default_rng(4)
    hidden, length = 3, 5
    flat = draw.normal(0, 0.7, sum(int(np.prod(s)) for s in recurrent.shapes(hidden).values()))
    x, y = draw.random((7, length)), draw.normal(0, 1, 7)

    def error(w):
        return 0.5 * ((recurrent.forward(recurrent.unpacked(w, hidden), x, hidden)[0] - y) ** 2).sum()
    made, loss = recurrent.gradients(recurrent.unpacked(flat, hidden), x, y, hidden)
    assert loss == pytest.approx(2 * error(flat))
    found = np.concatenate([made[n].ravel() for n in recurrent.shapes(hidden)])
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-5
        assert found[k] == pytest.approx((error(flat + step) - error(flat - step)) / 2e-5, abs=1e-5)


def waves(spark, days=260):
    """Sines with drift whose tops are cut off: no linear map of the last days gives the next."""
    start = datetime.date(2023, 1, 1)
    rows = [(name, start + datetime.timedelta(days=d),
             float(min(60, 50 + 30 * np.sin((d + shift) / 9) + 0.05 * d))) for name, shift in (("a", 0), ("b", 4)) for d in range(days)]
    return materialize(spark.createDataFrame(rows, "series string, ds date, y double"))


def test_the_network_beats_the_linear_map(spark):
    series = waves(spark)
    frame = materialize(fc.sequence_frame(series))
    days = fc.chronological_split(series).filter("part = 'test'").select("series", "ds")
    train = frame.join(days, ["series", "ds"], "left_anti")
    settings = Settings(sequence_epochs=40)
    model = fc.sequence_model(train, settings)
    again = fc.sequence_model(train, settings)
    assert np.array_equal(model.flat, again.flat) and len(model.losses) == 41
    skip, level = fc.linear_map(train)
    linear = recurrent.fit_recurrent(train.select("lags", F.col("scaled").alias("target")), skip, level, 16, 0, 0.0, 1)
    truth = series.join(days, ["series", "ds"])

    def error(m):
        return fc.sequence_forecast(frame, days, m).join(truth, ["series", "ds"]).agg(
            F.avg((F.col("yhat") - F.col("y")) ** 2)).first()[0]
    assert min(model.losses) < 0.7 * model.losses[0] and error(model) < error(linear)
    path = scratch_path(spark, "sequence")
    model.save(spark, path)
    assert error(recurrent.RecurrentModel.load(spark, path)) == error(model)


def test_a_network_without_rows(spark):
    frame = fc.sequence_frame(waves(spark, 5))
    model = fc.sequence_model(frame)
    assert not model.losses and fc.sequence_forecast(frame, frame.select("series", "ds"), model).count() == 0


def blobs(spark, n=600):
    draw = np.random.default_rng(6)
    centres = np.array([[0, 0], [10, 0], [0, 10], [10, 10]])
    points = centres[draw.integers(0, 4, n)] + draw.normal(0, 0.5, (n, 2))
    points[: n // 3] = points[0]                                    # a third are copies
    return points, materialize(spark.createDataFrame([(f"k{i}", float(a), float(b)) for i, (a, b) in enumerate(points)],
                                                     "id string, x double, y double"))


def test_all_starts_at_once(spark):
    points, df = blobs(spark)
    model = kmeans.fit_starts(df, ["x", "y"], 4, 10, 42, "id")
    assert len(model.costs) == 10 and model.cost == min(model.costs)
    away = ((points[:, None] - model.points[None]) ** 2).sum(2)
    assert model.cost == pytest.approx(away.min(1).sum(), rel=1e-6)
    assigned = {r["id"]: r["cluster"] for r in model.assign(df).collect()}
    assert [assigned[f"k{i}"] for i in range(len(points))] == away.argmin(1).tolist()
    for c in range(4):                                              # each centre is the mean of its points
        assert model.points[c] == pytest.approx(points[away.argmin(1) == c].mean(0), abs=1e-6)
    alone = kmeans.fit_starts(df, ["x", "y"], 4, 1, 42, "id")
    assert alone.cost == model.costs[0]                             # a start does not depend on the others
    dealt = kmeans.fit_starts(df.repartition(7), ["x", "y"], 4, 10, 42, "id")
    assert np.array_equal(dealt.points, model.points)
    path = scratch_path(spark, "kmeans")
    model.save(spark, path)
    loaded = Centres.load(spark, path)
    assert np.array_equal(loaded.points, model.points) and loaded.assign(df).exceptAll(model.assign(df)).isEmpty()


def test_fewer_points_than_centres(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0)], "id string, x double, y double")
    model = kmeans.fit_starts(df, ["x", "y"], 3, 2, 1, "id")
    assert model.cost == 0 and {r["cluster"] for r in model.assign(df).collect()} == {0}
    with pytest.raises(ValueError, match="no points"):
        kmeans.fit_starts(df.limit(0), ["x", "y"], 3, 2, 1, "id")


def test_a_kmeans_step_adds_up_every_start(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(500, 3))
    active = {s: draw.normal(size=(4, 3)) for s in (0, 2, 7)}
    active[7][3] = 50.0                                               # far from all points: has none
    df = spark.createDataFrame(x.tolist(), "x double, y double, z double").repartition(3)
    got = {(r.start, r.cluster): [int(v) for v in r[3:]]
           for r in kmeans._step(df, ["x", "y", "z"], active).itertuples()}
    want = {}
    for s, centres in active.items():
        best, away = kmeans._nearest(x, centres)
        for c in np.unique(best):
            mine = best == c
            want[s, int(c)] = [int(mine.sum()), int(np.rint(away[mine] / kmeans.UNIT).sum()),
                               *np.rint(x[mine] / kmeans.UNIT).astype(np.int64).sum(0).tolist()]
    assert got == want and (7, 3) not in got

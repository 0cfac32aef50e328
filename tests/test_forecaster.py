"""Forecasters against brute force: ridge by normal equations, boosted trees, recursion, permuted features."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import hourly
from gridcast.operators import ml
from gridcast.operators.series import chronological_split, position_index
from gridcast.plans import forecast_flow as flow
from gridcast.plans.future import future_features
from gridcast.plans.serve_features import serve_features

FEATURES = ["hour_sin", "is_weekend", "temperature", "demand_lag_24h", "demand_lag_168h"]


def history(spark, n=400, series=("a", "b")):
    """Daily shape, a temperature effect and noise."""
    rng, out = random.Random(3), None
    for k, s in enumerate(series):
        values = [40000 + 3000 * k + 4000 * math.sin(2 * math.pi * (i % 24) / 24) - 120 * (i % 31) + rng.gauss(0, 300) for i in range(n)]
        one = hourly(spark, values, series=s, name="target_demand").withColumnRenamed("ts", "timestamp")
        out = one if out is None else out.unionByName(one)
    hour = F.unix_timestamp(F.col("timestamp").cast("timestamp")) / 3600
    return out.withColumn("temperature", F.pmod(hour, F.lit(31)).cast("double")).withColumn("is_public_holiday", F.lit(False)).withColumn(
        "daylight_savings_winter", F.lit(True)).withColumn("daylight_savings_summer", F.lit(False))


@pytest.fixture(scope="module")
def frame(spark):
    from gridcast.session import materialize
    return materialize(chronological_split(serve_features(history(spark), keep_pos=True)), "t-forecaster")


def arrays(frame, features=FEATURES, where="true"):
    rows = frame.where(where).orderBy("series_id", "pos").select("target_demand", *features).collect()
    a = np.array([[float(v) for v in r] for r in rows])
    return a[:, 1:], a[:, 0]


def ridge(x, y, reg=1e-3):
    sd = x.std(0)
    z = np.where(sd > 0, (x - x.mean(0)) / np.where(sd > 0, sd, 1), 0)
    b = np.linalg.solve(z.T @ z / len(y) + reg / y.std() * np.eye(x.shape[1]), z.T @ (y - y.mean()) / len(y) / y.std()) * y.std()
    b = np.where(sd > 0, b / np.where(sd > 0, sd, 1), 0)
    return b, y.mean() - b @ x.mean(0)


def test_linear_equals_normal_equations(frame):
    model = ml.fit_forecaster(frame.where("split = 'train'"), FEATURES)
    b, c = ridge(*arrays(frame, where="split = 'train'"))
    intercept, coef = ml.linear_terms(model, FEATURES)
    assert np.allclose([coef[f] for f in FEATURES], b, rtol=1e-6, atol=1e-6) and abs(intercept - c) < 1e-4 * abs(c)
    x, y = arrays(frame, where="split = 'test' and series_id = 'b'")
    got = {(r.split, r.series_id): r for r in ml.backtest({"linear": model}, frame, FEATURES).collect()}["test", "b"]
    assert abs(got.linear_mae - np.abs(x @ b + c - y).mean()) < 1e-4 and abs(got.naive_mae - np.abs(x[:, 3] - y).mean()) < 1e-6
    assert got.rows == len(y) == 40


def _tree(x, r, depth):
    """Best variance split on each level: (feature, threshold, left, right), or the mean."""
    best = None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                gain = r.var() - (r[left].var() * left.sum() + r[~left].var() * (~left).sum()) / len(r)
                if best is None or gain > best[0] + 1e-12:
                    best = gain, f, cut
    if best is None or best[0] <= 0:
        return r.mean()
    left = x[:, best[1]] <= best[2]
    return best[1], best[2], _tree(x[left], r[left], depth - 1), _tree(x[~left], r[~left], depth - 1)


def _eval(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_boosted_equals_plain_boosting(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(50, 2))
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0.3, 4, -1) + rng.normal(0, 0.1, 50)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, target_demand double").coalesce(1)
    model = ml.fit_boosted(df, ["a", "b"], trees=5, depth=2, max_bins=64)
    said, rate = np.zeros(50), 1.0
    for _ in range(5):  # the first tree counts whole, later ones fit the gradient 2 (y - f) with the step
        tree = _tree(x, y - said if rate == 1.0 else 2 * (y - said), 2)
        said = said + rate * np.array([_eval(tree, row) for row in x])
        rate = 0.1
    got = [r.p for r in ml.predict(model, df, ["a", "b"], "p").collect()]
    assert np.allclose(got, said, atol=1e-9)


def test_boosted_beats_naive_and_is_chosen_on_validation(frame):
    train, val = frame.where("split = 'train'"), frame.where("split = 'val'")
    name, best = flow.fit_best(train, val)
    boosted = ml.fit_boosted(train, flow.FORECAST_FEATURES)
    linear = ml.fit_forecaster(train, flow.FORECAST_FEATURES)
    rows = ml.backtest({"boosted": boosted, "linear": linear}, frame, flow.FORECAST_FEATURES).collect()
    assert all(r.boosted_mae < 0.8 * r.naive_mae for r in rows if r.split == "test")  # a fifth better than the day before
    errors = {n: sum(r[f"{n}_mae"] * r.rows for r in rows if r.split == "val") for n in ("boosted", "linear")}
    assert name == min(errors, key=errors.get) and ml.is_linear(best) == (name == "linear")


@pytest.mark.parametrize("hours", [1, 24, 25, 168])
def test_recursive_forecast_equals_a_loop(spark, frame, hours):
    hist = history(spark)
    train = frame.where("split = 'train'")
    linear = ml.fit_forecaster(train, FEATURES)
    future = future_features(position_index(hist, "series_id", "timestamp"), hours)
    rows = {}
    for r in future.select("series_id", "horizon", *FEATURES).collect():
        rows.setdefault(r.series_id, {})[r.horizon] = [float(r[f]) for f in FEATURES]
    intercept, coef = ml.linear_terms(linear, FEATURES)
    want = {}
    for s, by in rows.items():
        for h in range(1, hours + 1):
            x = list(by[h])
            if h > 24:
                x[3] = want[s, h - 24]
            want[s, h] = intercept + sum(coef[f] * v for f, v in zip(FEATURES, x))
    got = flow.forecast(spark, hist, linear, FEATURES, hours=hours, apply_bias_correction=False).collect()
    end = max(r.timestamp for r in hist.collect())
    at = {(r.series_id, round((r.timestamp - end).total_seconds() / 3600)): r.predicted_demand for r in got}
    assert at.keys() == want.keys() and all(abs(at[k] - want[k]) < 1e-5 for k in want)
    if hours in (25, 168):  # any other model runs day by day; a linear one made to must agree
        boosted = ml.fit_boosted(train, FEATURES, trees=3, depth=3)
        said = {(r.series_id, r.horizon): r.predicted_demand for r in flow.predict_recursive(boosted, future, FEATURES, hours).collect()}
        flat = {(r.series_id, r.horizon): r.p for r in ml.predict(boosted, future, FEATURES, "p").collect()}
        assert said.keys() == want.keys() and all(said[k] == flat[k] for k in said if k[1] <= 24)
        fed = spark.createDataFrame([(s, h, *(x[:3]), (said[s, h - 24] if h > 24 else x[3]), x[4]) for s, by in rows.items() for h, x in by.items()],
                                    "series_id string, horizon int, " + ", ".join(f"{f} double" for f in FEATURES))
        one_step = {(r.series_id, r.horizon): r.p for r in ml.predict(boosted, fed, FEATURES, "p").collect()}
        assert all(abs(one_step[k] - said[k]) < 1e-9 for k in said)


def test_permutation_importance_equals_brute_force(spark, frame):
    model = ml.fit_forecaster(frame.where("split = 'train'"), FEATURES)
    held = frame.where("split <> 'train'")
    keys = F.md5(F.concat_ws(":", F.lit("5"), "series_id", F.col("pos").cast("string")))
    rows = held.select("series_id", "pos", keys.alias("k"), "target_demand", *FEATURES).collect()
    intercept, coef = ml.linear_terms(model, FEATURES)
    groups = {}
    for r in rows:
        groups.setdefault((r.series_id, r.pos // 16), []).append(r)

    def mae(feature):
        errors = []
        for g in groups.values():
            own, other = sorted(g, key=lambda r: r.pos), sorted(g, key=lambda r: r.k)
            for a, b in zip(own, other):
                x = {f: float((b if f == feature else a)[f]) for f in FEATURES}
                errors.append(abs(intercept + sum(coef[f] * x[f] for f in FEATURES) - a.target_demand))
        return np.mean(errors)

    want = {f: mae(f) - mae(None) for f in FEATURES}
    got = ml.permutation_importance(model, held, FEATURES, block_rows=16, seed=5).collect()
    assert {r.feature for r in got} == set(FEATURES) and all(abs(r.importance - want[r.feature]) < 1e-6 for r in got)
    assert [r.feature for r in sorted(got, key=lambda r: r.rank)] == sorted(FEATURES, key=lambda f: (-want[f], f))


def test_importance_ranks_hold_over_seeds_and_models(frame):
    train, held = frame.where("split = 'train'"), frame.where("split <> 'train'")
    linear, boosted = ml.fit_forecaster(train, FEATURES), ml.fit_boosted(train, FEATURES, trees=8)
    firsts = set()
    for model in (linear, boosted):
        for seed in (0, 1):
            firsts.add(ml.permutation_importance(model, held, FEATURES, seed=seed).where("rank = 1").first().feature)
    assert len(firsts) == 1
    assert ml.permutation_importance(linear, held.limit(0), FEATURES).where("importance is not null").count() == 0

import math

import numpy as np
import pytest
import series_reference as numeric
from pyspark.sql import functions as F

from tallyloom.functions import tails
from tallyloom.operators import evaluate, folded, gram, profile


def frame(spark, **series):
    """Rows (s, m, y, ...) of the given lists of values or of tuples of values."""
    rows = [(name, i, *(float(v) if v is not None else None for v in np.atleast_1d(x))) for name, values in series.items() for i, x in enumerate(values)]
    return spark.createDataFrame(rows, "s string, m int, y double" + ", x double" * (len(rows[0]) == 4))


def plain_unit_root(y):
    """(statistic, lags): orders compared on common rows, the best one fitted to all rows it can have."""
    y = (y - y.mean()) / y.std()
    n, d = len(y), np.diff(y)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

    def fit(k, skip):
        x = np.column_stack([np.ones(n - 1 - skip), y[skip:-1], *(d[skip - j : len(d) - j] for j in range(1, k + 1))])
        beta, rss, se = numeric.ols(x, d[skip:])
        return len(x) * math.log(rss / len(x)) + 2 * x.shape[1], beta[1] / se[1]

    lags = min(range(most + 1), key=lambda k: fit(k, most)[0])
    return fit(lags, lags)[1], lags


def test_tails(spark):
    rows = [(f, a, b) for f in (1e-3, 0.3, 1.0, 4.0, 25.0) for a in (1.0, 2.0, 7.0, 13.0) for b in (1.0, 8.0, 55.0, 240.0)]
    got = spark.createDataFrame(rows, "f double, a double, b double").select("*", tails.f_tail(F.col("f"), F.col("a"), F.col("b")), tails.t_tail(F.col("f"), F.col("b")), tails.chi2_tail(F.col("f"), F.col("a")), tails.normal_cdf(F.col("f") - 2)).collect()
    for f, a, b, *found in got:
        want = [numeric.f_tail(f, a, b), numeric.t_tail(f, b), numeric.chi2_tail(f, a), 0.5 * (1 + math.erf((f - 2) / math.sqrt(2)))]
        assert np.allclose(found, want, rtol=1e-8, atol=1e-11), (f, a, b)
    # published 5 and 1 percent points of the unit-root statistic and of the test of trend stationarity
    got = spark.createDataFrame([(-2.8615, 0.146), (-3.4304, 0.5), (None, None), (5.0, 0.01)], "t double, k double").select(tails.unit_root_p(F.col("t")), tails.trend_stationary_p(F.col("k"))).collect()
    assert abs(got[0][0] - 0.05) < 2e-3 and abs(got[1][0] - 0.01) < 1e-3 and tuple(got[2]) == (None, None) and got[3][0] == 1.0
    assert [r[1] for r in got] == [pytest.approx(0.05), 0.01, None, pytest.approx(0.1)]
    assert spark.range(1).select(tails.f_tail(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0)), tails.chi2_tail(F.lit(2.0), F.lit(0.0)), tails.t_tail(F.lit(1.0), F.lit(0.0))).first() == (None, None, None)


def test_unit_root_against_least_squares(spark):
    rng = np.random.default_rng(4)
    noise = rng.normal(size=120)
    series = {"walk": np.cumsum(noise) + 500, "noise": noise, "season": 1e8 * (3 + np.sin(np.arange(96) * np.pi / 6)) + 1e6 * rng.normal(size=96), "short": noise[:19], "long": np.cumsum(np.convolve(rng.normal(size=300), [1, 0.6, 0.3])[:260])}
    rows = frame(spark, **series, constant=np.ones(40), **{"line": np.arange(50.0)})
    got = {r.s: r for r in gram.unit_root(rows.union(spark.createDataFrame([("noise", 500, None), ("empty", 1, None)], rows.schema)), ["s"], "m", "y").collect()}
    for name in ("walk", "noise", "season", "long"):
        stat, lags = plain_unit_root(series[name])
        assert got[name].lags == lags and math.isclose(got[name].stat, stat, rel_tol=1e-6), name
    assert got["noise"].p < 0.01 < got["walk"].p and got["noise"].n == 120
    assert [(got[s].stat, got[s].p) for s in ("short", "constant")] == [(None, 1.0)] * 2 and "empty" not in got
    assert got["line"].stat is None or got["line"].p >= 0
    assert gram.unit_root(rows.limit(0), ["s"], "m", "y").count() == 0


def test_relations_against_least_squares(spark):
    rng = np.random.default_rng(3)
    dx = rng.normal(size=150)
    dy = np.concatenate([np.zeros(6), dx[:-6]]) + 0.2 * rng.normal(size=150)
    pairs = {"a": list(zip(np.cumsum(dy), np.cumsum(dx))), "few": list(zip(dy[:34], np.cumsum(dx)[:34])), "short": [(1.0, 2.0)] * 29, "flat": [(float(i % 3), 1.0) for i in range(40)]}
    got = {(r.s, r.direction, r.lag): r for r in gram.relations(frame(spark, **pairs), ["s"], "m", "y", "x").collect()}
    for name in ("a", "few"):
        y, x = (np.array(v) for v in zip(*pairs[name], strict=True))
        first = got[name, "forward", 1]
        n = min(len(y) - first.y_order, len(x) - first.x_order)
        y, x = np.diff(y, first.y_order)[-n:], np.diff(x, first.x_order)[-n:]
        for way, e, c in (("forward", y, x), ("reverse", x, y)):
            tests = {k: numeric.granger(e, c, k) for k in range(1, 7)}
            for k, (f, p, rows) in tests.items():
                r = got[name, way, k]
                assert r.n == rows and math.isclose(r.f, f, rel_tol=1e-6) and math.isclose(r.p, p, rel_tol=1e-6, abs_tol=1e-12)
                assert r.best_lag == min(tests, key=lambda j: tests[j][1])
    assert (got["a", "forward", 1].y_order, got["a", "forward", 1].x_order) == (1, 1) and got["a", "forward", 6].p < 1e-9
    assert got["a", "forward", 1].verdict == "CONFIRMED (p < 0.01)"
    assert (got["short", "forward", 0].verdict, got["short", "reverse", 0].p, got["short", "forward", 0].n) == ("INSUFFICIENT DATA", 1.0, 29)
    assert all(r.f is None and r.best_lag is None for (s, *_), r in got.items() if s == "flat")


def test_residuals_of_a_line(spark):
    rng = np.random.default_rng(6)
    series = {"noise": rng.normal(size=90) + np.arange(90), "walk": np.cumsum(rng.normal(size=150)), "short": np.arange(8.0) ** 2, "line": 2.0 * np.arange(30)}
    rows = frame(spark, **series)
    shape = {r.s: r for r in gram.trend_stationarity(rows, ["s"], "m", "y").collect()}
    box = {(r.s, r.lags): r for r in gram.residual_autocorrelation(rows, ["s"], "m", "y").collect()}
    for name in ("noise", "walk"):
        y = series[name]
        n, x = len(y), np.column_stack([np.ones(len(y)), np.arange(len(y))])
        e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        g = [e[k:] @ e[: n - k] for k in range(n)]
        few = int(n ** (2 / 9))
        ratio = sum(k * g[k] / (n / 2) for k in range(1, few + 1)) / (g[0] / n + sum(g[k] / (n / 2) for k in range(1, few + 1)))
        lags = min(int(1.1447 * (ratio * ratio) ** (1 / 3) * n ** (1 / 3)), n - 1)
        variance = (g[0] + 2 * sum((1 - k / (lags + 1)) * g[k] for k in range(1, lags + 1))) / n
        assert shape[name].lags == lags and math.isclose(shape[name].stat, (np.cumsum(e) ** 2).sum() / n**2 / variance, rel_tol=1e-8)
        for k in (6, 12):
            q, p = numeric.ljung_box(e, k)
            assert math.isclose(box[name, k].q, q, rel_tol=1e-8) and math.isclose(box[name, k].p, p, rel_tol=1e-6, abs_tol=1e-12)
    assert shape["noise"].p == 0.1 and shape["walk"].p < 0.05 and "short" not in shape
    assert box["short", 12].q is None and box["short", 12].p is None


def test_inflation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) @ np.array([[1, 0.8, 0.3], [0, 1, 0.5], [0, 0, 1]])
    rows = spark.createDataFrame([("a", *map(float, r)) for r in x] + [("b", float(i), 2.0 * i, 1.0) for i in range(30)] + [("a", None, 1.0, 1.0)], "s string, p double, q double, r double")
    got = {(r.s, r.regressor): r.vif for r in gram.inflation(rows, ["s"], ["p", "q", "r"]).collect()}
    assert np.allclose([got["a", c] for c in "pqr"], np.diag(np.linalg.inv(np.corrcoef(x.T))), rtol=1e-9)
    assert [got["b", c] for c in "pqr"] == [None] * 3


def test_models_against_plain_recursions(spark):
    rng = np.random.default_rng(8)
    t = np.arange(100)
    series = {"season": 50 + t + 9 * np.sin(t * np.pi / 6) + rng.normal(size=100), "walk": 40 + np.cumsum(rng.normal(size=70)), "year": 5 + rng.random(20), "tiny": [1.0, 2.0], "hole": [1.0] * 20 + [None] + [2.0] * 30}
    arrays = folded.series_arrays(frame(spark, **series), ["s"], "m", "y", logged=False)
    for model, plain in ((folded.holt_winters, numeric.holt_winters), (folded.arima111, numeric.arima111)):
        got = {}
        for r in model(arrays, ["s"]).collect():
            got.setdefault(r.s, {})[r.step] = r.yhat
        for name, y in series.items():
            want = plain(np.array(y, float), 6)
            found = [got[name][k] for k in range(1, 7)]
            assert found == [None] * 6 if want is None else np.allclose(found, want, rtol=1e-7), (model.__name__, name)


def test_structural_folds(spark):
    rng = np.random.default_rng(9)
    t = np.arange(80.0)
    y = 10 + 0.1 * t + np.maximum(t - 36, 0) * 0.2 + np.cos(t * np.pi / 6) + 0.1 * rng.normal(size=80)
    fits = folded.structural(frame(spark, a=y, b=y[:23], c=np.full(30, 7.0)), ["s"], "m", "y", [36], 6, logged=False)
    got = {(r.s, r.cut): r.coefficients for r in fits.collect()}
    assert sorted(c for s, c in got if s == "a") == [36, 42, 48, 54, 60, 66, 72, 78] and not any(s in "bc" for s, _ in got)
    x = np.column_stack([np.ones(80), t / 12, *(np.maximum(t - b, 0) / 12 for b in folded.BENDS), *(f(2 * np.pi * w * t / 12) for w in (1, 2, 3) for f in (np.sin, np.cos))])
    for cut in (36, 60, 78):
        want = np.linalg.solve(x[:cut].T @ x[:cut] + np.diag(folded.PENALTY), x[:cut].T @ y[:cut])
        assert np.allclose(got["a", cut], want, rtol=1e-5, atol=1e-6)
        ahead = {r.step: r.yhat for r in folded.structural_forecast(fits.filter(F.col("cut") == cut), ["s"], 2).collect()}
        assert np.allclose([ahead[1], ahead[2]], [x[cut] @ want, x[cut + 1] @ want if cut < 79 else ahead[2]], rtol=1e-5)
    whole = folded.structural(frame(spark, a=y, c=np.full(30, 7.0)), ["s"], "m", "y", logged=False).collect()
    assert {(r.s, r.cut) for r in whole} == {("a", 80), ("c", 30)}


def test_cross_validation_and_nulls(spark):
    rng = np.random.default_rng(1)
    rows = frame(spark, a=100 + np.cumsum(rng.normal(size=60)), b=list(rng.random(20) + 1), hole=[5.0] * 30 + [None] + [6.0] * 30)
    got = folded.cross_validated(rows, ["s"], "m", "y").collect()
    assert {(r.s, r.fold) for r in got} == {("a", k) for k in range(4)} and {r.model for r in got} == {"ets", "arima", "structural"}
    ahead = folded.forecasts(rows, ["s"], "m", "y").collect()
    assert len(ahead) == 3 * 3 * 6 and all(r.yhat is None for r in ahead if r.s == "hole" and r.model != "structural" or r.s == "b" and r.model in ("ets", "structural"))
    assert all(r.yhat > 0 for r in ahead if r.s == "a")
    assert folded.forecasts(rows.limit(0), ["s"], "m", "y").count() == 0


def test_lagged_ranks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=40)
    rows = frame(spark, a=list(zip(np.append([0.0, 0.0], x[:-2]), x)), b=list(zip(x[:9], x[:9])), c=[(1.0, float(i)) for i in range(12)])
    got = {(r.s, r.lag): r for r in profile.lagged_spearman(rows, ["s"], "m", "y", ["x"], [0, 2]).collect()}
    assert got["a", 2].rho > 0.99 and got["a", 2].p < 1e-20 and got["a", 2].n == 38 and ("b", 0) not in got and got["c", 0].rho is None and got["c", 0].p is None
    n, rho = got["a", 0].n, got["a", 0].rho
    assert math.isclose(got["a", 0].p, numeric.t_tail(rho * math.sqrt((n - 2) / (1 - rho * rho)), n - 2), rel_tol=1e-7)
    summary = profile.spearman_summary(profile.lagged_spearman(rows, ["s"], "m", "y", ["x"], [0, 2]), ["lag"]).collect()
    assert {r.lag: (r.n_series, r.n_significant) for r in summary}[2] == (1, 1)


def test_labels_stars_and_shares(spark):
    rows = [(51.0, 0.0009), (50.0, 0.001), (10.0, 0.01), (-10.0, 0.05), (-50.0, None), (None, math.nan)]
    got = spark.createDataFrame(rows, "pct double, p double").select(evaluate.trend_label(F.col("pct")), evaluate.stars(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("strong growth", "***"), ("growth", "**"), ("flat", "*"), ("declining", ""), ("strong decline", ""), (None, "")]
    rows = [("a", 100.0, 104.0), ("a", 100.0, 105.0), ("a", 100.0, 115.0), ("a", 100.0, 130.0), ("a", 0.0, 1.0)]
    assert [tuple(r) for r in evaluate.within_shares(spark.createDataFrame(rows, "s string, y double, yhat double"), ["s"]).collect()] == [("a", 4, 0.25, 0.5, 0.75, 1, 1, 2)]

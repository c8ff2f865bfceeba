import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import parse
from tallyloom.operators import cleaning, evaluate, features, profile
from tallyloom.sources import readers


def test_units_and_signs(spark):
    rows = spark.createDataFrame([(2.5,), (-0.04,), (None,), (0.0,), (-3.26,)], "v double")
    got = rows.select(parse.converted(F.col("v"), "crore", "million").alias("m"), parse.signed_percent(F.col("v")).alias("s")).collect()
    assert [r.s for r in got] == ["+2.5%", "0.0%", None, "0.0%", "-3.3%"]
    assert math.isclose(got[0].m, 25.0) and got[2].m is None
    with pytest.raises(KeyError):
        parse.converted(F.col("v"), "crore", "dozen")


def test_structure_issues(spark):
    rows = [("a", "2020-01-01", 1.0, None, 1.0), ("a", "2020-02-01", None, 2.0, 0.5), ("a", "2020-05-01", 3.0, 2.0, None), ("b", "2020-01-01", 1.0, 1.0, 0.0), ("b", "2020-02-01", 1.0, 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "k string, month string, y double, x double, d double").withColumn("month", F.col("month").cast("date"))
    got = sorted((tuple(r) for r in cleaning.structure_issues(frame, ["k"], "month", "y", ["x"], ["d"]).collect()), key=str)
    want = [("a", "y", "null", 1, None, None), ("a", "x", "null", 1, None, None), ("a", "d", "not 0 or 1", 2, 0.5, 0.5), ("a", "month", "gap", 1, 90.0, 90.0), ("b", None, "none", 0, None, None)]
    assert got == sorted(want, key=str)
    assert cleaning.structure_issues(frame.limit(0), ["k"], "month", "y", ["x"], ["d"]).count() == 0


def test_strongest_lags(spark):
    rows = [("a", 0, -0.2), ("a", 1, 0.9), ("a", 3, -0.9), ("a", 6, -0.9), ("b", 0, 0.1), ("b", 1, None), ("c", 0, None)]
    lagged = spark.createDataFrame(rows, "k string, lag int, r double")
    got = {r.k: tuple(r)[1:] for r in profile.strongest_lags(lagged, ["k"]).collect()}
    assert got == {"a": (3, -0.9, 1, 0.9), "b": (None, None, 0, 0.1), "c": (None, None, None, None)}


def test_decay_and_future_events(spark):
    falling, steep, rising = [60.0 - 5 * i for i in range(6)], [600.0 - 118 * i for i in range(6)], [1.0 + i for i in range(6)]
    rows = [(k, f"2020-{i + 1:02d}-01", v) for k, values in (("falling", falling), ("steep", steep), ("rising", rising)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "k string, m string, v double").withColumn("m", F.col("m").cast("date"))
    ahead = features.future_events(features.future_rows(frame, ["k"], "m", "v", "decay", 3), [("p", "pulse", ["2020-01-01"]), ("s", "step", ["2020-01-01"]), ("c", "change_point", ["2020-01-01"])])
    got = {k: [r.v for r in ahead.filter(F.col("k") == k).orderBy("m").collect()] for k in ("falling", "steep", "rising")}
    assert [round(x, 6) for x in got["falling"]] == [round(35 * (1 - 5 / 35) ** h, 6) for h in (1, 2, 3)]
    assert [round(x, 6) for x in got["steep"]] == [5.0, 2.5, 1.25] and [round(x, 6) for x in got["rising"]] == [7.0, 8.0, 9.0]
    assert ahead.columns == ["k", "m", "v", "event_p", "event_s"] and {(r.event_p, r.event_s) for r in ahead.collect()} == {(0.0, 1.0)}


def test_forecast_delta_and_window(spark):
    rows = spark.createDataFrame([("a", 100.5, 100.0), ("a", 99.5, 100.0), ("b", 110.0, 100.0), ("b", 5.0, 0.0), ("c", 1.0, None)], "k string, w double, o double")
    got = {r.k: (r.n, r.decision) for r in evaluate.forecast_delta(rows, ["k"], "w", "o").collect()}
    assert got == {"a": (2, "DROP"), "b": (1, "ESCALATE"), "c": (0, None)}
    scored = spark.createDataFrame([("a", "2020-01-01", 100.0, 90.0, 10.0), ("a", "2020-02-01", 100.0, 70.0, 10.0), ("b", "2020-03-01", 10.0, 10.0, 1.0)], "k string, m string, y double, f double, h double").withColumn("m", F.col("m").cast("date"))
    got = {r.k: (r.n, round(r.mape, 6), r.coverage, r.n_window, r.mape_window, r.stressed) for r in evaluate.holdout_scores(scored, ["k"], "m", "y", "f", "h", ("2020-02-01", "2020-02-29")).collect()}
    assert got == {"a": (2, 0.2, 0.5, 1, 0.3, True), "b": (1, 0.0, 1.0, 0, None, None)}


def test_stacked_formats(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.option("header", "true").csv(f"{tmp_path}/c")
    spark.createDataFrame([(2, 0.5)], "a int, z double").write.json(f"{tmp_path}/j")
    globs = {"c": f"{tmp_path}/c/*.csv", "j": f"{tmp_path}/j/*.json", "gone": f"{tmp_path}/gone/*.csv"}
    rows = readers.stacked(spark, globs, formats={"c": "csv", "j": "json", "gone": "csv"}, schemas={"c": "a int, b string", "gone": "a int"})
    assert sorted((r.source, r.a, r.b, r.z) for r in rows.collect()) == [("c", 1, "x", None), ("j", 2, None, 0.5)]
    with pytest.raises(ValueError):
        readers.stacked(spark, {"gone": f"{tmp_path}/gone/*.csv"}, formats={"gone": "csv"}, schemas={"gone": "a int"})

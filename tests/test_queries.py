import math
import random
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
import series_reference as numeric
from oracle import compare
from pyspark.sql import functions as F

from tallyloom import registry
from tallyloom.functions import parse
from tallyloom.operators import align, cleaning, evaluate, serving, sketches
from tallyloom.sources import readers
from tallyloom.streaming import ingest, status


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    assert compare(spark, registry.queries()[name], registry.oracle_sql()[name], sf) is None


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_has_rows(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_parsing(spark):
    numbers = ["21,703.44", "29,52,542.05", "-", "NA", "N/A", "", " 7 ", "abc", None]
    assert column(spark, numbers, parse.number) == [21703.44, 2952542.05, None, None, None, None, 7.0, None, None]
    months = ["Apr-2004", "April-2016", "as on March 31, May 2025", "Sept-19", "Dec 99", "none", None]
    assert [str(x) for x in column(spark, months, parse.month_from_text)] == ["2004-04-01", "2016-04-01", "2025-05-01", "2019-09-01", "1999-12-01", "None", "None"]
    paths = ["x/stat_2024-Aug.xlsx", "https://a/ATMAPRIL2026.xls", "https://a/ATM122025.xls", "none"]
    assert [str(x) for x in column(spark, paths, parse.month_from_path)] == ["2024-08-01", "2026-04-01", "2025-12-01", "None"]


def test_fills(spark):
    rows = [("a", 1, None), ("a", 2, 2.0), ("a", 3, None), ("a", 4, None), ("a", 5, 8.0), ("a", 6, None), ("b", 1, None), ("b", 2, None)]
    frame = spark.createDataFrame(rows, "s string, t int, v double")
    want = {"zero": [0, 2, 0, 0, 8, 0, 0, 0], "ffill": [2, 2, 2, 2, 8, 8, None, None], "bfill": [2, 2, 8, 8, 8, 8, None, None], "linear": [2, 2, 4, 6, 8, 8, None, None]}
    for how, values in want.items():
        assert [r.v for r in align.filled(frame, ["s"], "t", "v", how).orderBy("s", "t").collect()] == values, how


def test_upsert_and_priority(spark):
    old = spark.createDataFrame([("a", None, 1.0), ("b", 2, 2.0)], "k string, m int, v double")
    new = spark.createDataFrame([("a", None, 5.0, 1), ("a", None, 6.0, 2), ("c", 1, 7.0, 1)], "k string, m int, v double, t int")
    got = serving.upserted(old, new, ["k", "m"], "t")
    assert sorted(map(tuple, got.collect()), key=str) == [("a", None, 6.0), ("b", 2, 2.0), ("c", 1, 7.0)]
    assert sorted(map(tuple, serving.upserted(got, new, ["k", "m"], "t").collect()), key=str) == [("a", None, 6.0), ("b", 2, 2.0), ("c", 1, 7.0)]
    rows = spark.createDataFrame([(1, "x", 1.0), (1, "monthly_xls", 2.0), (1, "consolidated", 3.0), (2, "x", 4.0)], "k int, source string, v double")
    assert sorted(map(tuple, cleaning.by_priority(rows, ["k"]).collect())) == [(1, "consolidated", 3.0), (2, "x", 4.0)]


def test_folds_do_not_look_ahead(spark):
    rows = spark.createDataFrame([("s", i, float(i * i)) for i in range(1, 50)] + [("t", i, 1.0) for i in range(1, 42)], "s string, i int, y double")
    cv = evaluate.fold_forecasts(rows, ["s"], "i", "y", 36, 6, 6).collect()
    assert {(r.s, r.fold) for r in cv} == {("s", 0), ("s", 1)}
    x = np.arange(1, 37)
    slope, icept = np.polyfit(x, x * x, 1)
    one = next(r for r in cv if r.fold == 0 and r.step == 3)
    assert math.isclose(one.linear, icept + slope * 39, rel_tol=1e-9) and one.y == 39**2 and one.seasonal == 27**2 and math.isclose(one.drift, 36**2 + 3 * (36**2 - 1) / 35)


def test_splice(spark):
    rows = [(f"2020-{m:02d}-01", float(m + (100 if m >= 7 else 0))) for m in range(1, 13)]
    frame = spark.createDataFrame(rows, "m string, y double").select(F.lit("a").alias("s"), F.col("m").cast("date").alias("m"), "y")
    got = cleaning.spliced(frame, ["s"], "m", "y", "2020-07-01").orderBy("m").collect()
    assert all(math.isclose(r.spliced, i + 101, abs_tol=1e-6) for i, r in enumerate(got))


def test_tails_and_tests():
    assert math.isclose(numeric.t_tail(2.228, 10), 0.05, abs_tol=2e-4)
    assert math.isclose(numeric.f_tail(4.26, 2, 9), 0.05, abs_tol=2e-4)
    assert math.isclose(numeric.chi2_tail(12.592, 6), 0.05, abs_tol=2e-4)
    rng = np.random.default_rng(42)
    noise = rng.normal(size=300)
    ar = np.zeros(300)
    for t in range(1, 300):
        ar[t] = 0.4 * ar[t - 1] + noise[t]
    assert numeric.adf(ar)[2] and not numeric.adf(np.cumsum(noise))[2] and not numeric.adf(ar[:10])[2]
    x = rng.normal(size=300)
    y = np.concatenate([[0, 0], 0.8 * x[:-2]]) + 0.3 * rng.normal(size=300)
    assert numeric.granger(y, x, 2)[1] < 1e-6 < 0.001 < numeric.granger(x, y, 2)[1]
    assert numeric.ljung_box(ar, 6)[1] < 0.01 < numeric.ljung_box(noise, 6)[1]
    assert numeric.kpss(noise) < 0.146 < numeric.kpss(np.cumsum(noise))


def test_models_recover_simulated_series():
    rng = np.random.default_rng(42)
    t = np.arange(120)
    y = 50 + 0.3 * t + 8 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.5, 120)
    for model in (numeric.holt_winters, numeric.structural):
        assert np.abs(model(y[:114], 6) - y[114:]).max() < 4
    walk = np.cumsum(1 + rng.normal(0, 0.2, 120))
    assert abs(numeric.arima111(walk[:114], 6)[-1] - walk[119]) < 2
    assert numeric.holt_winters(y[:20], 6) is None and numeric.arima111(y[:5], 6) is None and numeric.structural(np.full(30, np.nan), 6) is None


def test_streams_equal_batches(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(4, "ts").write.parquet(f"{tmp_path}/in")
    stream = ingest.event_stream(spark, f"{tmp_path}/in", events.schema, 10)
    rolled = ingest.run_once(ingest.daily_rollup(stream, "ts", "event_type", "value"), "rolled", f"{tmp_path}/c1")
    batch = {(r.day, r.event_type): (r.n, r.total) for r in events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")).collect()}
    got = {(r.day, r.event_type): (r.n, r.total) for r in rolled.collect()}
    closed = events.agg(F.max("ts")).first()[0] - timedelta(days=1)
    assert got == {k: v for k, v in batch.items() if datetime.combine(k[0], datetime.min.time()) + timedelta(days=1) <= closed}
    unique = ingest.run_once(ingest.first_of_each(stream, ["event_id"], "ts", "40 days"), "unique", f"{tmp_path}/c2")
    assert unique.count() == events.count()
    out = ingest.upsert_stream(stream.select("user_id", "value", "ts"), f"{tmp_path}/out", ["user_id"], "ts", f"{tmp_path}/c3")
    last = {r.user_id: r.value for r in out.collect()}
    want = {r.user_id: r.v for r in events.groupBy("user_id").agg(F.max_by("value", "ts").alias("v")).collect()}
    assert last == want


def test_upserts_over_batches(spark, sf, tmp_path):
    """One file a micro-batch, more rows than a bucket holds, a restart with a new checkpoint, and a batch that fails halfway."""
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("user_id", "value", "ts")
    events.repartition(4, "value").write.parquet(f"{tmp_path}/in")
    want = {r.user_id: tuple(r.v) for r in events.groupBy("user_id").agg(F.max_by(F.struct("value", "ts"), F.struct("ts", "value")).alias("v")).collect()}
    read = lambda df: {r.user_id: (r.value, r.ts) for r in df.collect()}
    target = f"{tmp_path}/out"
    stream = lambda: ingest.event_stream(spark, f"{tmp_path}/in", events.schema, 1)
    assert read(ingest.upsert_stream(stream(), target, ["user_id"], "ts", f"{tmp_path}/c1", bucket_rows=20)) == want
    table = ingest.Upserted(spark, target, 20)
    assert table.versions() and len(table.versions()) <= 2 and table.manifest().agg(F.max("buckets")).first()[0] * 20 >= len(want)
    # nothing new under the same checkpoint; all again under another
    version = table.versions()[-1]
    assert read(ingest.upsert_stream(stream(), target, ["user_id"], "ts", f"{tmp_path}/c1", bucket_rows=20)) == want and table.versions()[-1] == version
    assert read(ingest.upsert_stream(stream(), target, ["user_id"], "ts", f"{tmp_path}/c2", bucket_rows=20)) == want
    # an older row of one key and a new key
    user = min(want)
    more = spark.createDataFrame([(user, -1.0, datetime(1990, 1, 1)), (10**9, 5.0, datetime(2030, 1, 1)), (None, 6.0, datetime(2030, 1, 1))], events.schema)
    table.merge(more, ["user_id"], "ts")
    assert read(table.rows(events.schema)) == want | {10**9: (5.0, datetime(2030, 1, 1)), None: (6.0, datetime(2030, 1, 1))}
    # files of a version without its manifest don't count
    more.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{target}/data/version={table.versions()[-1] + 1}")
    assert read(table.rows(events.schema))[user] == want[user]
    table.merge(more.limit(0), ["user_id"], "ts")
    table.merge(more, ["user_id"], "ts")
    assert read(table.rows(events.schema))[user] == want[user] and table.rows(events.schema).count() == len(want) + 2
    assert ingest.Upserted(spark, f"{tmp_path}/none").rows(events.schema).count() == 0


def test_months_with_late_rows(spark, tmp_path):
    """Late rows of an open month count, those of a month behind the watermark don't."""
    rows = [[("a", 1.0, datetime(2024, 1, 5)), ("a", 2.0, datetime(2024, 2, 3))], [("a", 4.0, datetime(2024, 1, 20)), ("b", 1.0, datetime(2024, 2, 28))], [("a", 1.0, datetime(2024, 6, 1))], [("a", 9.0, datetime(2024, 1, 1))], [("b", 9.0, datetime(2024, 5, 2))]]
    schema = "k string, v double, at timestamp"
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
        stream = ingest.event_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, 1)
        out = ingest.upsert_stream(ingest.monthly_rollup(stream, "at", "k", "v", "62 days"), f"{tmp_path}/out", ["month", "k"], "n", f"{tmp_path}/c", mode="update")
    got = {(str(r.month)[:7], r.k): (r.n, float(r.total)) for r in out.collect()}
    assert got == {("2024-01", "a"): (2, 5.0), ("2024-02", "a"): (1, 2.0), ("2024-02", "b"): (1, 1.0), ("2024-06", "a"): (1, 1.0), ("2024-05", "b"): (1, 9.0)}


def test_status_over_batches(spark, tmp_path):
    """Sources that go on, stop, and come back; each step is a micro-batch under the same checkpoint."""
    parts = [[("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2)), (None, datetime(2024, 1, 2))], [("a", datetime(2024, 1, 20)), ("a", None)], [("a", datetime(2024, 2, 9)), ("a", datetime(2024, 2, 5))], [("b", datetime(2024, 2, 10))]]
    want = [{"a": (1, "ok"), "b": (1, "ok"), None: (1, "ok")}, {"a": (2, "ok"), "b": (1, "late"), None: (1, "late")}, {"a": (4, "ok"), "b": (1, "late"), None: (1, "late")}, {"a": (4, "ok"), "b": (2, "ok"), None: (1, "late")}]
    schema = "k string, at timestamp"
    for i, (part, expected) in enumerate(zip(parts, want, strict=True)):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
        stream = ingest.event_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, 1)
        out = ingest.upsert_stream(status.status_stream(stream, "k", "at", 10), f"{tmp_path}/out", ["k"], "change", f"{tmp_path}/c", mode="update")
        assert {r.k: (r.n, r.status) for r in out.collect()} == expected, i


def test_tree_of_hashes(spark):
    rows = [("g", f"p{i}", f"text {i}") for i in range(300)] + [("g", "p1", "text 1"), ("g", None, None), (None, "x", "y")]
    frame = spark.createDataFrame(rows, "g string, path string, text string")
    found = lambda df: {r.g: (r.n, r.hash) for r in serving.tree_hash(df, "g", "path", "text").collect()}
    whole = found(frame)
    assert whole["g"][0] == 302 and whole[None][0] == 1 and found(frame.repartition(7)) == whole
    assert found(frame.filter("path <> 'p7' or path is null"))["g"] != whole["g"][1] and found(frame.withColumn("text", F.when(F.col("path") == "p9", "other").otherwise(F.col("text"))))["g"][1] != whole["g"][1]
    assert found(frame.limit(0)) == {}


def test_sketches_merge_over_days(spark):
    rows = spark.range(60000).select((F.col("id") % 2).cast("string").alias("k"), F.expr("date_add(date'2024-01-01', int(id % 30))").alias("day"), (F.col("id") % 10000).alias("u"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    daily = sketches.daily_sketches(rows, ["k"], F.col("day"), "u", "v")
    assert daily.count() == 30 and daily.agg(F.sum("n")).first()[0] == 60000
    for r in sketches.merged(daily, ["k"], [0.25, 0.5]).collect():
        assert r.n == 30000 and abs(r.n_distinct - 5000) < 150 and abs(r.quantiles[0] - 15000) < 1500 and abs(r.quantiles[1] - 30000) < 1500
    assert sketches.merged(daily.limit(0), ["k"], [0.5]).count() == 0


def test_as_of_over_years(spark):
    rng = random.Random(5)
    day = lambda: datetime(2021, 11, 1) + timedelta(days=rng.randrange(900), seconds=rng.randrange(86400))
    events = [(day(), float(i)) for i in range(40)] + [(datetime(2023, 12, 20), 7.0), (datetime(2024, 1, 1), 8.0), (datetime(2024, 1, 1), 3.0)]
    spine = [(i, day()) for i in range(300)] + [(900, datetime(2023, 12, 31)), (901, datetime(2024, 1, 1)), (902, datetime(2020, 1, 1)), (903, datetime(2024, 1, 5))]
    e = spark.createDataFrame(events, "effective timestamp, v double")
    s = spark.createDataFrame(spine, "id long, at timestamp")
    got = {r.id: r.v for r in align.as_of(s, e, "at", "effective", "v").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE e (effective TIMESTAMP, v DOUBLE); CREATE TABLE s (id BIGINT, t TIMESTAMP)")
    con.executemany("INSERT INTO e VALUES (?, ?)", events)
    con.executemany("INSERT INTO s VALUES (?, ?)", spine)
    assert got == dict(con.execute("SELECT id, v FROM s ASOF LEFT JOIN (SELECT effective, max(v) AS v FROM e GROUP BY 1) e ON s.t >= e.effective").fetchall())
    assert got[902] is None


def test_signals_in_answers(spark):
    answers = ['{"signal_type": "a", "confidence": 0.9}', '```json\n[{"signal_type": "b", "bank_name": "X", "confidence": 1}, {"signal_type": "c"}]\n```', "[]", "no JSON", "", None, '[{"signal_type": "d", "bank_name": "", "confidence": 0.5}]']
    frame = spark.createDataFrame(list(enumerate(answers)), "i int, a string").select("i", F.explode(parse.signal_array(F.col("a"), F.lit("own"))).alias("s"))
    assert sorted((r.i, r.s.signal_type, r.s.bank_name) for r in frame.collect()) == [(0, "a", "own"), (1, "b", "X"), (6, "d", "own")]


def test_missing_sources(spark, sf):
    with pytest.raises(ValueError, match="no files"):
        readers.stacked(spark, {"a": f"{sf}/gone*.parquet"})
    assert readers.load_named(spark, sf, ["gone"]) == {}


def test_as_of_within_minutes(spark):
    """Many times in a few minutes of one day, events without a value, empty tables."""
    rng = random.Random(6)
    moment = lambda: datetime(2024, 3, 1, 10) + timedelta(milliseconds=rng.randrange(400_000))
    events = [(moment(), float(i)) for i in range(60)] + [(moment(), None) for _ in range(60)] + [(datetime(2024, 2, 29, 23, 59, 59), -1.0)]
    spine = [(i, moment()) for i in range(500)] + [(900, datetime(2024, 2, 1)), (901, datetime(2024, 3, 1)), (902, datetime(2024, 3, 1, 10, 3)), (903, None)]
    e = spark.createDataFrame(events, "effective timestamp, v double")
    s = spark.createDataFrame(spine, "id long, at timestamp")
    got = {r.id: r.v for r in align.as_of(s, e, "at", "effective", "v").collect()}
    known = sorted((t, v) for t, v in events if v is not None)
    assert got == {i: next((v for u, v in reversed(known) if t and u <= t), None) for i, t in spine}
    assert {r.v for r in align.as_of(s, e.limit(0), "at", "effective", "v").collect()} == {None}
    assert align.as_of(s.limit(0), e, "at", "effective", "v").count() == 0

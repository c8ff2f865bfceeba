"""Registered queries of structure checks, units, lag choices, future frames, event dates, holdout windows and file formats."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import parse
from tallyloom.operators import cleaning, evaluate, features, profile
from tallyloom.plans.queries import _CV, KEY, _cv, query
from tallyloom.sources import fixtures as fx
from tallyloom.sources import readers
from tallyloom.sources.fixtures import PANEL, table

_LAGS = [0, 1, 3, 6]
_EVENTS = [("shock", "pulse", ["1996-04-01", "1996-05-01"]), ("rule", "step", ["1999-01-01"]), ("bend", "change_point", ["1998-01-01"])]


@query("""SELECT 'nations' AS source, n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier UNION ALL SELECT 'regions', r_regionkey, r_name FROM region""")
def a2_stacked_formats(spark, sf):
    """CSV with a header line, JSON lines and Parquet of different columns as one table."""
    path = readers.scratch(spark, "formats")
    table(spark, sf, "nation").select("n_nationkey", "n_name").repartition(3).write.option("header", "true").csv(f"{path}/nations")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").repartition(3).write.json(f"{path}/suppliers")
    globs = {"nations": f"{path}/nations/*.csv", "suppliers": f"{path}/suppliers/*.json", "regions": f"{sf}/region.parque[t]", "gone": f"{path}/gone/*.csv"}
    columns = {"id": F.coalesce("n_nationkey", "s_suppkey", "r_regionkey"), "name": F.coalesce("n_name", "s_name", "r_name")}
    schemas = {"nations": "n_nationkey long, n_name string", "suppliers": "s_suppkey long, s_name string", "gone": "x long"}
    return readers.stacked(spark, globs, columns, {"nations": "csv", "suppliers": "json", "gone": "csv"}, schemas).drop("file")


@query(f"""WITH {PANEL}, m AS (SELECT *, round((outstanding / nullif(lag(outstanding) OVER (PARTITION BY bank_name, card_type ORDER BY month), 0) - 1) * 100, 1) AS pct FROM panel)
SELECT bank_name, card_type, month, round(outstanding / 100000.0, 9) AS lakh, round(outstanding / 1000000.0, 9) AS million, round(outstanding / 10000000.0, 9) AS crore, round(outstanding / 100000.0 * 100000.0 / 1000000.0, 9) AS lakh_as_million,
 CASE WHEN pct = 0 THEN '0.0%' ELSE printf('%+.1f%%', pct) END AS change FROM m""")
def b15_units_and_signs(spark, sf):
    y = F.col("outstanding")
    before = F.lag("outstanding").over(Window.partitionBy(*KEY).orderBy("month"))
    to = lambda unit: F.round(parse.converted(y, "one", unit), 9).alias(unit)
    again = F.round(parse.converted(parse.converted(y, "one", "lakh"), "lakh", "million"), 9)
    return fx.panel(spark, sf).select(*KEY, "month", to("lakh"), to("million"), to("crore"), again.alias("lakh_as_million"), parse.signed_percent((y / F.nullif(before, F.lit(0.0)) - 1) * 100).alias("change"))


@query(f"""WITH {PANEL}, t AS (SELECT bank_name, card_type, month, CASE WHEN n_rows % 17 <> 0 THEN outstanding END AS y, lag(txn_vol, 3) OVER (PARTITION BY bank_name, card_type ORDER BY month) AS x_lag3, CASE WHEN month >= DATE '1999-01-01' THEN 1 ELSE 0 END AS event_rule,
 CASE WHEN n_rows % 5 = 0 THEN (n_rows % 4) / 2 ELSE 1 END::DOUBLE AS event_odd, datediff('day', lag(month) OVER (PARTITION BY bank_name, card_type ORDER BY month), month) AS days FROM panel),
i AS (SELECT bank_name, card_type, 'y' AS "column", 'null' AS issue, count(*) FILTER (WHERE y IS NULL) AS n, NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM t GROUP BY 1, 2
UNION ALL SELECT bank_name, card_type, 'x_lag3', 'null', count(*) FILTER (WHERE x_lag3 IS NULL), NULL, NULL FROM t GROUP BY 1, 2
UNION ALL SELECT bank_name, card_type, 'event_rule', 'not 0 or 1', count(*) FILTER (WHERE event_rule NOT IN (0, 1)), NULL, NULL FROM t GROUP BY 1, 2
UNION ALL SELECT bank_name, card_type, 'event_odd', 'not 0 or 1', count(*) FILTER (WHERE event_odd NOT IN (0, 1)), min(event_odd) FILTER (WHERE event_odd NOT IN (0, 1)), max(event_odd) FILTER (WHERE event_odd NOT IN (0, 1)) FROM t GROUP BY 1, 2
UNION ALL SELECT bank_name, card_type, 'month', 'gap', count(*) FILTER (WHERE days > 35), min(days) FILTER (WHERE days > 35), max(days) FILTER (WHERE days > 35) FROM t GROUP BY 1, 2)
SELECT * FROM i WHERE n > 0 UNION ALL SELECT bank_name, card_type, NULL, 'none', 0, NULL, NULL FROM i GROUP BY 1, 2 HAVING max(n) = 0""")
def c8_structure_issues(spark, sf):
    """Issues of a training frame on the months as they are: null targets and lags, an event column with values of its own, missing months."""
    rows = features.event_columns(fx.panel(spark, sf), "month", _EVENTS[1:])
    odd = F.when(F.col("n_rows") % 5 == 0, (F.col("n_rows") % 4) / 2).otherwise(1.0)
    lag = F.lag("txn_vol", 3).over(Window.partitionBy(*KEY).orderBy("month"))
    rows = rows.select(*KEY, "month", F.when(F.col("n_rows") % 17 != 0, F.col("outstanding")).alias("y"), lag.alias("x_lag3"), "event_rule", odd.alias("event_odd"))
    return cleaning.structure_issues(rows, KEY, "month", "y", ["x_lag3"], ["event_rule", "event_odd"])


@query(f"""WITH {PANEL}, l(lag) AS (VALUES (0), (1), (3), (6)), w AS (SELECT bank_name, card_type, lag, outstanding AS y, CASE lag WHEN 0 THEN txn_vol WHEN 1 THEN lag(txn_vol, 1) OVER s WHEN 3 THEN lag(txn_vol, 3) OVER s ELSE lag(txn_vol, 6) OVER s END AS x FROM panel, l WINDOW s AS (PARTITION BY bank_name, card_type, lag ORDER BY month)),
c AS (SELECT bank_name, card_type, lag, CASE WHEN count(*) >= 10 THEN corr(y, x) END AS r FROM w WHERE x IS NOT NULL GROUP BY 1, 2, 3), s AS (SELECT DISTINCT bank_name, card_type FROM c),
n AS (SELECT * FROM c WHERE round(r, 9) < 0 QUALIFY row_number() OVER (PARTITION BY bank_name, card_type ORDER BY round(r, 9), lag) = 1), a AS (SELECT * FROM c WHERE r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY bank_name, card_type ORDER BY abs(round(r, 9)) DESC, lag) = 1)
SELECT s.bank_name, s.card_type, n.lag AS lag_negative, round(n.r, 6) AS r_negative, a.lag AS lag_strongest, round(a.r, 6) AS r_strongest FROM s LEFT JOIN n ON n.bank_name = s.bank_name AND n.card_type = s.card_type LEFT JOIN a ON a.bank_name = s.bank_name AND a.card_type = s.card_type""")
def e7_strongest_lags(spark, sf):
    """The most negative and the strongest of the correlations at several lags."""
    lagged = profile.lag_correlation(fx.panel(spark, sf), KEY, "month", "outstanding", "txn_vol", _LAGS)
    return profile.strongest_lags(lagged, KEY).withColumns({c: F.round(c, 6) for c in ("r_negative", "r_strongest")})


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k FROM panel), s AS (SELECT bank_name, card_type, max(month) AS last, CASE WHEN count(*) FILTER (WHERE k <= 6) >= 6 THEN regr_slope(txn_vol, -k) FILTER (WHERE k <= 6) ELSE 0 END AS slope, arg_max(txn_vol, month) AS v FROM n GROUP BY 1, 2)
SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, round(CASE WHEN slope < 0 AND v > 0 THEN v * power(greatest(1 + slope / v, 0.5), h) ELSE greatest(0, v + slope * h) END, 6) AS txn_vol, 0.0::DOUBLE AS event_shock, 1.0::DOUBLE AS event_rule FROM s, range(1, 25) t(h)""")
def h5_future_frame(spark, sf):
    """24 months ahead: a regressor that decays where it falls, pulses that are over and steps that stay."""
    ahead = features.future_rows(fx.panel(spark, sf), KEY, "month", "txn_vol", "decay").withColumn("txn_vol", F.round("txn_vol", 6))
    return features.future_events(ahead, _EVENTS)


_SHIFTS = f"""{PANEL}, r AS (SELECT bank_name, card_type, month, outstanding AS y, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS i, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel),
g AS (SELECT r.*, k AS shift, CASE WHEN month >= DATE '1998-06-01' + to_months(CAST(k AS INTEGER)) THEN 1.0 ELSE 0.0 END AS x FROM r, range(-2, 3) t(k)),
s AS (SELECT *, count(*) OVER w AS k, coalesce(CASE WHEN var_pop(x) OVER w > 0 THEN regr_slope(y, x) OVER w END, 0) AS b, coalesce(CASE WHEN var_pop(x) OVER w > 0 THEN regr_intercept(y, x) OVER w END, avg(y) OVER w) AS a FROM g WINDOW w AS (PARTITION BY bank_name, card_type, shift ORDER BY i ROWS UNBOUNDED PRECEDING)),
e AS (SELECT s.bank_name, s.card_type, s.shift, s.i AS p, avg(abs((g.y - (a + b * g.x)) / nullif(g.y, 0))) AS mape FROM s JOIN g ON g.bank_name = s.bank_name AND g.card_type = s.card_type AND g.shift = s.shift AND g.i > s.i AND g.i <= s.i + 6 WHERE s.i + 6 <= s.n AND s.k >= 36 GROUP BY 1, 2, 3, 4)"""


@query(f"""WITH {_SHIFTS}, m AS (SELECT bank_name, card_type, shift, avg(mape) * 100 AS pct, count(*) AS n FROM e GROUP BY 1, 2, 3)
SELECT bank_name, card_type, CAST(shift AS INTEGER) AS shift, n, round(pct, 6) AS mape_pct, round(pct - max(CASE WHEN shift = 0 THEN pct END) OVER (PARTITION BY bank_name, card_type), 6) AS delta FROM m""")
def i13_event_dates(spark, sf):
    """Errors with a step event moved by up to two months either way, against the event's own date."""
    at = F.lit("1998-06-01").cast("date")
    variants = {str(k): (F.col("month") >= F.add_months(at, k)).cast("double") for k in range(-2, 3)}
    errors = evaluate.regression_errors(fx.panel(spark, sf), KEY, "outstanding", variants, "month")
    mean = errors.groupBy(*KEY, F.col("variant").cast("int").alias("shift")).agg(F.count(F.lit(1)).alias("n"), (F.avg("mape") * 100).alias("pct"))
    own = F.max(F.when(F.col("shift") == 0, F.col("pct"))).over(Window.partitionBy(*KEY))
    return mean.select(*KEY, "shift", "n", F.round("pct", 6).alias("mape_pct"), F.round(F.col("pct") - own, 6).alias("delta"))


@query(f"""WITH {_CV}, l AS (SELECT bank_name, card_type, max(fold) AS fold FROM cv GROUP BY 1, 2), d AS (SELECT bank_name, card_type, abs((linear - seasonal) / nullif(seasonal, 0)) * 100 AS pct FROM cv JOIN l USING (bank_name, card_type, fold))
SELECT bank_name, card_type, count(pct) AS n, round(avg(pct), 6) AS mean_abs_pct, round(max(pct), 6) AS max_abs_pct, CASE WHEN round(avg(pct), 9) < 1 THEN 'DROP' WHEN avg(pct) IS NOT NULL THEN 'ESCALATE' END AS decision FROM d GROUP BY 1, 2""")
def i13_forecast_delta(spark, sf):
    """What time as a regressor does to the last fold's forecast, beside the forecast without it."""
    cv = _cv(spark, sf)
    last = cv.groupBy(*KEY).agg(F.max("fold").alias("fold"))
    out = evaluate.forecast_delta(cv.join(last, [*KEY, "fold"]), KEY, "linear", "seasonal")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_abs_pct", "max_abs_pct")})


@query(f"""WITH {PANEL}, t AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel WHERE month <= DATE '2000-12-01'),
f AS (SELECT bank_name, card_type, max(month) AS last, regr_slope(outstanding, -k) AS a, regr_intercept(outstanding, -k) AS c FROM t WHERE n >= 24 AND k <= 16 GROUP BY 1, 2), g AS (SELECT bank_name, card_type, round(1.645 * stddev_pop(outstanding), 4) AS half FROM t GROUP BY 1, 2),
p AS (SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, round(greatest(0, c + a * (h - 1)), 4) AS yhat FROM f, range(1, 7) s(h)),
j AS (SELECT *, month BETWEEN DATE '2001-02-01' AND DATE '2001-04-01' AS here, abs((outstanding - yhat) / nullif(outstanding, 0)) AS e FROM p JOIN panel USING (bank_name, card_type, month) JOIN g USING (bank_name, card_type))
SELECT bank_name, card_type, count(*) AS n, round(avg(e), 6) AS mape, round(avg(CASE WHEN abs(outstanding - yhat) <= half THEN 1.0 ELSE 0.0 END), 6) AS coverage, count(*) FILTER (WHERE here) AS n_window, round(avg(e) FILTER (WHERE here), 6) AS mape_window, round((avg(e) FILTER (WHERE here) - avg(e)) * 100, 9) > 5 AS stressed FROM j GROUP BY 1, 2""")
def i18_coverage_and_window(spark, sf):
    """Months after a cutoff: error, coverage of 90 % intervals, and a given window of them against the whole."""
    rows = fx.panel(spark, sf)
    train = rows.filter("month <= date'2000-12-01'")
    half = train.groupBy(*KEY).agg(F.round(1.645 * F.stddev_pop("outstanding"), 4).alias("half"))
    ahead = evaluate.trend_forecast(train, KEY, "month", "outstanding", least=24).withColumn("forecast", F.round("forecast", 4))
    out = evaluate.holdout_scores(ahead.join(rows, [*KEY, "month"]).join(half, KEY), KEY, "month", "outstanding", "forecast", "half", ("2001-02-01", "2001-04-01"))
    return out.withColumns({c: F.round(c, 6) for c in ("mape", "coverage", "mape_window")})

"""Registered queries of folds, selection, intervals and verdicts over closed-form forecasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import evaluate, features
from tallyloom.plans.queries import _CV, _TREND, KEY, _cv, _members, query
from tallyloom.sources import fixtures as fx
from tallyloom.sources.fixtures import PANEL

_ERRORS = f"""{PANEL}, r AS (SELECT bank_name, card_type, outstanding AS y, txn_vol AS x, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS i, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel),
g AS (SELECT a.bank_name, a.card_type, a.i, a.n, a.y, 'lag' || l.k AS variant, b.x FROM r a CROSS JOIN (VALUES (1), (2), (3)) l(k) JOIN r b ON b.bank_name = a.bank_name AND b.card_type = a.card_type AND b.i = a.i - l.k UNION ALL SELECT bank_name, card_type, i, n, y, 'none', 0 FROM r UNION ALL SELECT bank_name, card_type, i, n, y, 'time', i FROM r),
s AS (SELECT *, count(*) OVER w AS k, CASE WHEN variant = 'none' THEN 0 ELSE regr_slope(y, x) OVER w END AS b, CASE WHEN variant = 'none' THEN avg(y) OVER w ELSE regr_intercept(y, x) OVER w END AS a FROM g WINDOW w AS (PARTITION BY bank_name, card_type, variant ORDER BY i ROWS UNBOUNDED PRECEDING)),
e AS (SELECT s.bank_name, s.card_type, s.variant, s.i AS p, s.n, avg(abs((g.y - (a + b * g.x)) / nullif(g.y, 0))) AS mape FROM s JOIN g ON g.bank_name = s.bank_name AND g.card_type = s.card_type AND g.variant = s.variant AND g.i > s.i AND g.i <= s.i + 6 WHERE s.i + 6 <= s.n AND s.k >= 36 GROUP BY 1, 2, 3, 4, 5)"""


def _errors(spark, sf):
    """Errors of lines on the volume of one, two and three rows before, on time, and of the mean."""
    w = Window.partitionBy(*KEY).orderBy("month")
    variants = {f"lag{k}": F.lag("txn_vol", k).over(w) for k in (1, 2, 3)} | {"none": F.lit(0.0), "time": F.row_number().over(w).cast("double")}
    return evaluate.regression_errors(fx.panel(spark, sf), KEY, "outstanding", variants, "month")


@query(f"""WITH {_ERRORS}, l AS (SELECT * FROM e WHERE starts_with(variant, 'lag')), c AS (SELECT DISTINCT bank_name, card_type, p AS cut FROM l WHERE p >= 48 AND (p - 48) % 6 = 0),
i AS (SELECT c.bank_name, c.card_type, cut, variant, avg(mape) AS m FROM c JOIN l ON l.bank_name = c.bank_name AND l.card_type = c.card_type AND l.p IN (cut - 6, cut - 12, cut - 18) GROUP BY 1, 2, 3, 4),
b AS (SELECT bank_name, card_type, cut, arg_min(variant, (round(m, 9), variant)) AS chosen FROM i GROUP BY 1, 2, 3)
SELECT b.bank_name, b.card_type, cut, chosen, round(mape, 6) AS outer_mape FROM b LEFT JOIN l ON l.bank_name = b.bank_name AND l.card_type = b.card_type AND l.p = cut AND l.variant = chosen""")
def i12_nested_lags(spark, sf):
    """The lag that does best on the inner folds before each cut, scored after it."""
    lags = _errors(spark, sf).filter(F.col("variant").startswith("lag"))
    return evaluate.nested_choice(lags, KEY).withColumn("outer_mape", F.round("outer_mape", 6))


@query(f"""WITH {_ERRORS}, m AS (SELECT bank_name, card_type, variant, avg(mape) * 100 AS m FROM e GROUP BY 1, 2, 3), d AS (SELECT a.bank_name, a.card_type, a.variant, a.m AS w, b.m AS o, round(b.m - a.m, 6) AS delta FROM m a JOIN m b ON a.bank_name = b.bank_name AND a.card_type = b.card_type AND b.variant = 'none' WHERE a.variant <> 'none')
SELECT bank_name, card_type, variant, round(w, 5) AS with_pct, round(o, 5) AS without_pct, round(delta, 5) AS delta, CASE WHEN delta > 0.1 THEN 'KEEP' WHEN delta < -0.1 THEN 'REMOVE' ELSE 'MARGINAL' END AS verdict FROM d""")
def i13_ablation(spark, sf):
    out = evaluate.ablation(_errors(spark, sf), KEY, "none")
    return out.withColumns({c: F.round(c, 5) for c in ("with_pct", "without_pct", "delta")})


@query(f"WITH {PANEL}, n AS (SELECT bank_name, card_type, count(*) AS n FROM panel GROUP BY 1, 2), c AS (SELECT bank_name, card_type, unnest(range(48, n - 5, 6)) AS cut FROM n) SELECT bank_name, card_type, CAST((cut - 48) / 6 AS INTEGER) AS fold, CAST(cut AS INTEGER) AS cut FROM c")
def i1_folds(spark, sf):
    return evaluate.folds(fx.panel(spark, sf), KEY, "month", 48)


@query(f"""WITH {_CV}, s AS (SELECT bank_name, card_type, stddev_pop(y - linear) AS g FROM cv GROUP BY 1, 2) SELECT bank_name, card_type, CAST(h AS INTEGER) AS step, round(1.645 * g * sqrt(h), 4) AS half_width FROM s, range(1, 25) t(h)""")
def i9_normal_interval(spark, sf):
    """Half the width of a 90 % interval, growing with the root of the step."""
    sigma = _cv(spark, sf).groupBy(*KEY).agg(F.stddev_pop(F.col("y") - F.col("linear")).alias("g"))
    steps = sigma.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(24))))
    return steps.select(*KEY, "step", F.round(1.645 * F.col("g") * F.sqrt("step"), 4).alias("half_width"))


@query(f"""WITH {_CV}, s AS (SELECT bank_name, card_type, stddev_pop(y - linear) AS g FROM cv GROUP BY 1, 2), b AS (SELECT CASE WHEN step <= 3 THEN 'near' ELSE 'far' END AS bucket, abs(y - linear) <= round(1.645 * g, 6) AS inside FROM cv JOIN s USING (bank_name, card_type))
SELECT bucket, count(*) AS n, round(100.0 * count(*) FILTER (WHERE inside) / count(*), 4) AS coverage, CASE WHEN 100.0 * count(*) FILTER (WHERE inside) / count(*) BETWEEN 85 AND 95 THEN 'calibrated' WHEN 100.0 * count(*) FILTER (WHERE inside) / count(*) > 95 THEN 'too wide' ELSE 'too narrow' END AS verdict FROM b GROUP BY 1""")
def i11_calibration(spark, sf):
    """Coverage of 90 % intervals by horizon, and whether it is what they promise."""
    cv = _cv(spark, sf)
    sigma = cv.groupBy(*KEY).agg(F.stddev_pop(F.col("y") - F.col("linear")).alias("g"))
    inside = F.abs(F.col("y") - F.col("linear")) <= F.round(1.645 * F.col("g"), 6)
    share = 100.0 * F.count_if("inside") / F.count(F.lit(1))
    rows = cv.join(sigma, KEY).select(F.when(F.col("step") <= 3, "near").otherwise("far").alias("bucket"), inside.alias("inside"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.round(share, 4).alias("coverage"), F.when(share.between(85, 95), "calibrated").when(share > 95, "too wide").otherwise("too narrow").alias("verdict"))


@query(f"""WITH {_CV}, c AS (SELECT bank_name, card_type, avg(abs((y - linear) / nullif(y, 0))) AS cv FROM cv GROUP BY 1, 2), l AS (SELECT bank_name, card_type, max(fold) AS fold FROM cv GROUP BY 1, 2),
o AS (SELECT bank_name, card_type, avg(abs((y - linear) / nullif(y, 0))) AS oos FROM cv JOIN l USING (bank_name, card_type, fold) GROUP BY 1, 2)
SELECT bank_name, card_type, round(oos, 6) AS oos, round(cv, 6) AS cv, CASE WHEN round(oos / cv, 9) <= 1 THEN 'better' WHEN round(oos / cv, 9) <= 1.5 THEN 'in line' ELSE 'worse' END AS verdict, (oos - cv) * 100 > 5 AS stressed FROM o JOIN c USING (bank_name, card_type)""")
def i18_verdict(spark, sf):
    """The last fold as a holdout against the mean of all folds; stressed where it is over five points worse."""
    cv = _cv(spark, sf)
    error = evaluate.mape(F.col("y"), F.col("linear"))
    last = cv.groupBy(*KEY).agg(F.max("fold").alias("fold"))
    oos = cv.join(last, [*KEY, "fold"]).groupBy(*KEY).agg(error.alias("oos"))
    both = oos.join(cv.groupBy(*KEY).agg(error.alias("cv")), KEY)
    ratio = F.round(F.col("oos") / F.col("cv"), 9)
    return both.select(*KEY, F.round("oos", 6).alias("oos"), F.round("cv", 6).alias("cv"), F.when(ratio <= 1, "better").when(ratio <= 1.5, "in line").otherwise("worse").alias("verdict"), ((F.col("oos") - F.col("cv")) * 100 > 5).alias("stressed"))


@query(f"""WITH {_CV}, w AS (SELECT bank_name, card_type, i / 20.0 AS weight, round(avg(abs((y - (i / 20.0 * linear + (1 - i / 20.0) * seasonal)) / nullif(y, 0))), 8) AS mape FROM cv, range(0, 21) t(i) GROUP BY 1, 2, 3)
SELECT bank_name, card_type, CAST(row_number() OVER (PARTITION BY bank_name, card_type ORDER BY mape, weight) AS INTEGER) AS place, CAST(weight AS DOUBLE) AS weight, round(mape, 6) AS mape FROM w QUALIFY row_number() OVER (PARTITION BY bank_name, card_type ORDER BY mape, weight) <= 5""")
def i19_top_weights(spark, sf):
    """The five best weights of each series."""
    return evaluate.weight_ranks(_cv(spark, sf), KEY, "linear", "seasonal", 5).withColumn("mape", F.round("mape", 6))


@query(f"""WITH {_CV}, s AS (SELECT bank_name, card_type, step, model, avg(abs((y - yhat) / nullif(y, 0))) AS e FROM m GROUP BY 1, 2, 3, 4) SELECT bank_name, card_type, step, arg_min(model, (round(e, 9), model)) AS best, round(min(e), 6) AS mape FROM s GROUP BY 1, 2, 3""")
def i19_best_by_step(spark, sf):
    by = _members(spark, sf).groupBy(*KEY, "step", "model").agg(evaluate.mape(F.col("y"), F.col("yhat")).alias("e"))
    return by.groupBy(*KEY, "step").agg(F.min(F.struct(F.round("e", 9), "model"))["model"].alias("best"), F.round(F.min("e"), 6).alias("mape"))


@query(f"""WITH {PANEL}, r AS (SELECT bank_name, card_type, regr_slope(outstanding, txn_vol) AS b, regr_intercept(outstanding, txn_vol) AS a, arg_max(txn_vol, month) AS x FROM panel GROUP BY 1, 2), s(scenario, growth) AS (VALUES ('base', 0.0), ('up', 0.02), ('down', -0.02))
SELECT bank_name, card_type, scenario, CAST(h AS INTEGER) AS step, round((a + b * x * power(1 + growth, h)) / nullif(a + b * x, 0) * 100 - 100, 4) AS impact_pct FROM r, s, (VALUES (6), (12), (24)) t(h)""")
def i20_scenario_steps(spark, sf):
    """A regressor that grows by its scenario, and what that does to the forecast after 6, 12 and 24 months."""
    fit = fx.panel(spark, sf).groupBy(*KEY).agg(F.regr_slope("outstanding", "txn_vol").alias("b"), F.regr_intercept("outstanding", "txn_vol").alias("a"), F.max_by("txn_vol", "month").alias("x"))
    scenarios = F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(g).alias("growth")) for n, g in (("base", 0.0), ("up", 0.02), ("down", -0.02))))
    out = fit.withColumn("s", F.explode(scenarios)).withColumn("step", F.explode(F.array(F.lit(6), F.lit(12), F.lit(24))))
    line = lambda x: F.col("a") + F.col("b") * x
    return out.select(*KEY, "s.scenario", "step", F.round(line(F.col("x") * F.pow(1 + F.col("s.growth"), "step")) / F.nullif(line(F.col("x")), F.lit(0.0)) * 100 - 100, 4).alias("impact_pct"))


@query(f"""WITH {PANEL}, {_TREND}, h AS (SELECT bank_name, card_type, month, outstanding AS y, CASE WHEN k <= 16 AND n >= 48 THEN c - a * k END AS fitted FROM n LEFT JOIN f USING (bank_name, card_type))
SELECT bank_name, card_type, month, y, round(fitted, 4) AS fitted, NULL::DOUBLE AS forecast, 'actual' AS kind FROM h UNION ALL SELECT bank_name, card_type, month, NULL, NULL, round(forecast * 1.01, 4), 'forecast' FROM fc""")
def i22_fitted_frame(spark, sf):
    """History with fitted values where the line was fitted; the forecast rows come from the ensemble (here the line plus 1 %)."""
    rows = fx.panel(spark, sf)
    ahead = evaluate.trend_forecast(rows, KEY, "month", "outstanding")
    ensemble = ahead.select(*KEY, "month", (F.col("forecast") * 1.01).alias("ensemble"))
    out = evaluate.full_frame(rows, ahead, ensemble, KEY, "month", "outstanding")
    return out.withColumns({c: F.round(c, 4) for c in ("fitted", "forecast")})


@query(f"WITH {PANEL}, {_TREND}, s AS (SELECT bank_name, card_type, stddev_pop(outstanding) AS g FROM panel GROUP BY 1, 2) SELECT card_type, month, count(*) AS n_banks, round(sum(forecast), 0) AS forecast, round(sum(forecast - 1.645 * g), 0) AS forecast_lower, round(sum(forecast + 1.645 * g), 0) AS forecast_upper FROM fc JOIN s USING (bank_name, card_type) GROUP BY 1, 2")
def e2_bottom_up(spark, sf):
    """Points and bounds of all components summed by month."""
    rows = fx.panel(spark, sf)
    sigma = rows.groupBy(*KEY).agg(F.stddev_pop("outstanding").alias("g"))
    ahead = evaluate.trend_forecast(rows, KEY, "month", "outstanding").join(sigma, KEY)
    wide = 1.645 * F.col("g")
    return ahead.groupBy("card_type", "month").agg(F.count(F.lit(1)).alias("n_banks"), F.round(F.sum("forecast"), 0).alias("forecast"), F.round(F.sum(F.col("forecast") - wide), 0).alias("forecast_lower"), F.round(F.sum(F.col("forecast") + wide), 0).alias("forecast_upper"))


@query(f"""WITH {PANEL} SELECT bank_name, card_type, count(*) AS n, round(CASE WHEN count(*) >= 10 THEN regr_r2(outstanding, txn_vol) END, 6) AS r2, CASE WHEN count(*) < 10 THEN NULL WHEN regr_r2(outstanding, txn_vol) >= 0.7 THEN 'linear' WHEN regr_r2(outstanding, txn_vol) >= 0.4 THEN 'moderate' ELSE 'weak' END AS label FROM panel GROUP BY 1, 2""")
def e9_linearity(spark, sf):
    r2, n = F.regr_r2("outstanding", "txn_vol"), F.count(F.lit(1))
    return fx.panel(spark, sf).groupBy(*KEY).agg(n.alias("n"), F.round(F.when(n >= 10, r2), 6).alias("r2"), F.when(n < 10, None).when(r2 >= 0.7, "linear").when(r2 >= 0.4, "moderate").otherwise("weak").alias("label"))


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k FROM panel), s AS (SELECT bank_name, card_type, max(month) AS last, arg_max(txn_vol, month) AS flat, avg(txn_vol) FILTER (WHERE k <= 12) AS mean FROM n GROUP BY 1, 2)
SELECT rule, bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, round(CASE rule WHEN 'flat' THEN flat ELSE mean END, 6) AS txn_vol FROM s, range(1, 7) t(h), (VALUES ('flat'), ('mean')) r(rule)""")
def h5_flat_and_mean(spark, sf):
    rows = fx.panel(spark, sf)
    one = lambda rule: features.future_rows(rows, KEY, "month", "txn_vol", rule, 6).select(F.lit(rule).alias("rule"), *KEY, "month", F.round("txn_vol", 6).alias("txn_vol"))
    return one("flat").unionByName(one("mean"))

"""Further registered queries: sources, set operations, comparisons, gates and scenarios."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import align, evaluate, features
from tallyloom.plans.queries import _CV, _DENSE, KEY, _cv, _members, query
from tallyloom.sources import fixtures as fx
from tallyloom.sources.fixtures import MACRO, PANEL, SIGNALS, SOURCES, TOTALS, table


@query("""SELECT 'cc' AS card_type, o_orderkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS forecast_month, o_totalprice AS yhat, 'orders' AS model_type FROM orders
UNION ALL SELECT 'dc', c_custkey, NULL, c_acctbal, 'customers' FROM customer""")
def a8_one_schema(spark, sf):
    """Tables with different names for the same columns under one schema, with lineage."""
    orders = table(spark, sf, "orders").select(F.lit("cc").alias("card_type"), F.col("o_orderkey").alias("id"), F.trunc("o_orderdate", "MM").alias("forecast_month"), F.col("o_totalprice").alias("yhat"), F.lit("orders").alias("model_type"))
    customers = table(spark, sf, "customer").select(F.lit("dc").alias("card_type"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("yhat"), F.lit("customers").alias("model_type"))
    return orders.unionByName(customers, allowMissingColumns=True)


@query("""WITH r AS (SELECT date_trunc('year', min(o_orderdate) - INTERVAL 3 MONTH) AS a, max(o_orderdate) - INTERVAL 3 MONTH AS b FROM orders)
SELECT CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS label FROM (SELECT unnest(generate_series(year(a), year(b))) AS y FROM r)""")
def b6_fiscal_years(spark, sf):
    ends = table(spark, sf, "orders").agg(F.year(F.add_months(F.min("o_orderdate"), -3)).alias("a"), F.year(F.add_months(F.max("o_orderdate"), -3)).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("y")).select(F.concat(F.col("y").cast("string"), F.lit("-"), F.lpad(((F.col("y") + 1) % 100).cast("string"), 2, "0")).alias("label"))


@query("""SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'One' WHEN 'One' THEN 'First' WHEN 'NATION_2' THEN 'Two' ELSE n_name END AS canonical FROM nation""")
def b8_alias_layer(spark, sf):
    """Exact names only: one pass, so an alias of an alias stays."""
    aliases = spark.createDataFrame([("NATION_1", "One"), ("One", "First"), ("NATION_2", "Two")], "n_name string, alias string")
    return table(spark, sf, "nation").join(F.broadcast(aliases), "n_name", "left").select("n_nationkey", F.coalesce("alias", "n_name").alias("canonical"))


@query("""WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), n AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT CASE WHEN o_custkey IN (SELECT o_custkey FROM b) THEN 'updated' ELSE 'new' END AS kind, count(*) AS n FROM n GROUP BY 1""")
def c3_new_and_updated(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderdate < timestamp'1999-01-01'").select("o_custkey").distinct().withColumn("old", F.lit(True))
    new = o.filter("o_orderdate >= timestamp'1999-01-01'").select("o_custkey").distinct()
    return new.join(old, "o_custkey", "left").groupBy(F.when(F.col("old").isNotNull(), "updated").otherwise("new").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SOURCES}, x AS (SELECT bank, bool_or(date < DATE '1998-01-01') AND bool_or(date >= DATE '1998-01-01') AS spans, min(CASE WHEN source = 'monthly_xlsx' THEN date END) AS stitch FROM sources GROUP BY 1) SELECT bank, spans, stitch FROM x""")
def c10_spans_break(spark, sf):
    before = F.col("date") < F.lit("1998-01-01").cast("date")
    return fx.sources(spark, sf).groupBy("bank").agg((F.bool_or(before) & F.bool_or(~before)).alias("spans"), F.min(F.when(F.col("source") == "monthly_xlsx", F.col("date"))).alias("stitch"))


@query(f"""WITH {PANEL}, {MACRO} SELECT month FROM (SELECT month FROM panel WHERE card_type = 'cc' UNION SELECT month FROM macro) WHERE month BETWEEN DATE '1996-01-01' AND DATE '1997-12-01'""")
def c12_union_of_months(spark, sf):
    months = fx.panel(spark, sf).filter("card_type = 'cc'").select("month").union(fx.macro(spark, sf).select("month"))
    return months.filter("month between date'1996-01-01' and date'1997-12-01'").distinct()


@query(f"""WITH {PANEL} SELECT month FROM (SELECT month FROM panel WHERE bank_name = 'NATION_1' INTERSECT SELECT month FROM panel WHERE bank_name = 'NATION_3') ORDER BY month DESC LIMIT 12""")
def c14_common_months(spark, sf):
    rows = fx.panel(spark, sf)
    return rows.filter("bank_name = 'NATION_1'").select("month").intersect(rows.filter("bank_name = 'NATION_3'").select("month")).orderBy(F.desc("month")).limit(12)


@query(f"""WITH {PANEL} SELECT bank_name, card_type, max(month) AS used_month, arg_max(outstanding, month) AS value FROM panel WHERE month <= DATE '1998-06-01' GROUP BY 1, 2""")
def d3_latest_earlier(spark, sf):
    return fx.panel(spark, sf).filter("month <= date'1998-06-01'").groupBy(*KEY).agg(F.max("month").alias("used_month"), F.max_by("outstanding", "month").alias("value"))


@query(f"""WITH {_CV} SELECT bank_name, card_type, fold, step, round(abs(linear - y) / y * 100, 6) AS ape, y BETWEEN linear * 0.8 AND linear * 1.2 AS inside FROM cv WHERE y > 0""")
def d6_forecast_against_actual(spark, sf):
    inside = F.col("y").between(F.col("linear") * 0.8, F.col("linear") * 1.2)
    return _cv(spark, sf).filter("y > 0").select(*KEY, "fold", "step", F.round(F.abs(F.col("linear") - F.col("y")) / F.col("y") * 100, 6).alias("ape"), inside.alias("inside"))


@query(f"""WITH {PANEL} SELECT a.bank_name, a.card_type, a.month, b.outstanding AS before, round(a.outstanding - b.outstanding, 4) AS change FROM panel a LEFT JOIN panel b ON a.bank_name = b.bank_name AND a.card_type = b.card_type AND b.month = CAST(a.month - INTERVAL 1 MONTH AS DATE)""")
def d9_previous_month(spark, sf):
    """By the calendar: where the month before is missing there is no value."""
    w = Window.partitionBy(*KEY).orderBy("month")
    lag = F.when(F.lag("month").over(w) == F.add_months("month", -1), F.lag("outstanding").over(w))
    return fx.panel(spark, sf).withColumn("before", lag).select(*KEY, "month", "before", F.round(F.col("outstanding") - F.col("before"), 4).alias("change"))


@query(f"""WITH {SOURCES}, a AS (SELECT date, CASE WHEN bank IN ('NATION_1', 'NATION_2') THEN 'Joined' ELSE bank END AS bank, source, v FROM sources) SELECT date, bank, coalesce(round(sum(v), 4), 0) AS v, min(source) AS source FROM a GROUP BY 1, 2""")
def e1_collapsed_aliases(spark, sf):
    bank = F.when(F.col("bank").isin("NATION_1", "NATION_2"), "Joined").otherwise(F.col("bank"))
    return fx.sources(spark, sf).groupBy("date", bank.alias("bank")).agg(F.coalesce(F.round(F.sum("v"), 4), F.lit(0.0)).alias("v"), F.min("source").alias("source"))


@query(f"""WITH {PANEL}, l AS (SELECT * FROM panel WHERE month = (SELECT max(month) FROM panel)) SELECT card_type, round(sum(CASE WHEN bank_name IN ('NATION_1', 'NATION_2', 'NATION_3') THEN outstanding ELSE 0 END) / sum(outstanding), 6) AS covered FROM l GROUP BY 1""")
def e4_coverage(spark, sf):
    rows = fx.panel(spark, sf)
    last = rows.join(F.broadcast(rows.agg(F.max("month").alias("month"))), "month", "left_semi")  # one row
    named = F.sum(F.when(F.col("bank_name").isin("NATION_1", "NATION_2", "NATION_3"), F.col("outstanding")).otherwise(0.0))
    return last.groupBy("card_type").agg(F.round(F.coalesce(F.try_divide(named, F.sum("outstanding")), F.lit(0.0)), 6).alias("covered"))


@query(f"""WITH {PANEL}, q AS (SELECT bank_name, quantile_cont(txn_vol, 0.5) AS cut FROM panel GROUP BY 1) SELECT bank_name, count(*) FILTER (WHERE txn_vol <= cut) AS n_low, round(corr(outstanding, txn_vol) FILTER (WHERE txn_vol <= cut), 6) AS r_low, round(corr(outstanding, txn_vol) FILTER (WHERE txn_vol > cut), 6) AS r_high FROM panel JOIN q USING (bank_name) GROUP BY 1 HAVING count(*) FILTER (WHERE txn_vol <= cut) > 5""")
def e10_threshold_correlation(spark, sf):
    rows = fx.panel(spark, sf)
    cut = rows.groupBy("bank_name").agg(F.percentile("txn_vol", F.lit(0.5)).alias("cut"))
    low = F.col("txn_vol") <= F.col("cut")
    pick = lambda side: F.round(F.corr(F.when(side, F.col("outstanding")), F.when(side, F.col("txn_vol"))), 6)
    return rows.join(cut, "bank_name").groupBy("bank_name").agg(F.count_if(low).alias("n_low"), pick(low).alias("r_low"), pick(~low).alias("r_high")).filter("n_low > 5")


@query(f"""WITH {PANEL}, m AS (SELECT *, outstanding / lag(outstanding) OVER (PARTITION BY bank_name, card_type ORDER BY month) - 1 AS mom FROM panel) SELECT bank_name, card_type, count(*) AS n, arg_max(outstanding, month) AS latest, round(avg(outstanding), 4) AS mean, round((arg_max(outstanding, month) / arg_min(outstanding, month) - 1) * 100, 6) AS change_pct, round(avg(mom), 6) AS mom_mean, round(stddev(mom), 6) AS mom_std FROM m GROUP BY 1, 2""")
def e12_profile(spark, sf):
    w = Window.partitionBy(*KEY).orderBy("month")
    rows = fx.panel(spark, sf).withColumn("mom", F.col("outstanding") / F.lag("outstanding").over(w) - 1)
    first, last = F.min_by("outstanding", "month"), F.max_by("outstanding", "month")
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), last.alias("latest"), F.round(F.avg("outstanding"), 4).alias("mean"), F.round(F.when(first == 0, 0.0).otherwise((last / first - 1) * 100), 6).alias("change_pct"), F.round(F.avg("mom"), 6).alias("mom_mean"), F.round(F.stddev("mom"), 6).alias("mom_std"))


@query(f"""WITH {PANEL}, c AS (SELECT bank_name, card_type, count(*) AS n FROM panel GROUP BY 1, 2) SELECT (SELECT count(DISTINCT bank_name) FROM panel) AS n_banks, (SELECT count(DISTINCT month) FROM panel) AS n_months, (SELECT count(*) FROM c WHERE n >= 48) AS n_ready""")
def e14_distinct_counts(spark, sf):
    rows = fx.panel(spark, sf)
    ready = rows.groupBy(*KEY).count().agg(F.count_if(F.col("count") >= 48).alias("n_ready"))
    return rows.agg(F.countDistinct("bank_name").alias("n_banks"), F.countDistinct("month").alias("n_months")).crossJoin(ready)  # one row each


@query(f"""WITH {PANEL}, {MACRO}, t AS (SELECT month, sum(outstanding) AS y FROM panel GROUP BY 1), v AS (SELECT 'm1' AS name, corr(y, m1) AS r FROM t JOIN macro USING (month) UNION ALL SELECT 'm2', corr(y, m2) FROM t JOIN macro USING (month)) SELECT name, round(r, 6) AS r, row_number() OVER (ORDER BY abs(r) DESC, name) AS place FROM v""")
def e16_top_regressors(spark, sf):
    rows = fx.panel(spark, sf).groupBy("month").agg(F.sum("outstanding").alias("y")).join(fx.macro(spark, sf), "month")
    long = rows.unpivot(["month", "y"], ["m1", "m2"], "name", "x").groupBy("name").agg(F.corr("y", "x").alias("r"), F.stddev("x").alias("s")).filter("s > 0")
    best = long.agg(F.sort_array(F.collect_list(F.struct((-F.abs("r")).alias("k"), "name", "r"))).alias("a"))  # a row for each regressor
    return best.select(F.posexplode("a")).select("col.name", F.round("col.r", 6).alias("r"), (F.col("pos") + 1).cast("long").alias("place"))


@query("""WITH e AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT user_id, ts, value FROM e WHERE abs(value - before) > 0.01""")
def f6_change_points(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").withColumn("before", F.lag("value").over(w)).filter("abs(value - before) > 0.01").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")


@query(f"""WITH {_DENSE}, f AS (SELECT *, coalesce(last_value(y IGNORE NULLS) OVER (PARTITION BY bank_name, card_type ORDER BY month ROWS UNBOUNDED PRECEDING), first_value(y IGNORE NULLS) OVER (PARTITION BY bank_name, card_type ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM d),
l AS (SELECT *, lag(x, 3) OVER (PARTITION BY bank_name, card_type ORDER BY month) AS x_lag3 FROM f)
SELECT bank_name, card_type, month AS ds, y, x_lag3, CASE WHEN month >= DATE '1999-01-01' THEN 1.0 ELSE 0.0 END::DOUBLE AS event_rule FROM l WHERE y > 0 AND month >= DATE '1996-01-01'""")
def h4_training_frame(spark, sf):
    """Fill, then lag on the dense calendar, then event columns, target filter and start; leading lags stay null."""
    rows = align.filled(align.dense(fx.panel(spark, sf), KEY, "month"), KEY, "month", "outstanding", "ffill", "x")
    rows = rows.withColumn("x_lag3", F.lag("x", 3).over(Window.partitionBy(*KEY).orderBy("month")))
    rows = features.event_columns(rows, "month", [("rule", "step", ["1999-01-01"])]).filter("outstanding > 0 and month >= date'1996-01-01'")
    return rows.select(*KEY, F.col("month").alias("ds"), F.col("outstanding").alias("y"), "x_lag3", "event_rule")


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k FROM panel), s AS (SELECT bank_name, card_type, arg_max(outstanding, month) AS last, max(CASE WHEN k = 13 THEN outstanding END) AS old FROM n GROUP BY 1, 2)
SELECT bank_name, card_type, round(greatest(1.3 * last, last + 24 * coalesce((last - old) / 12, 0), 1.1 * last), 6) AS cap FROM s""")
def i14_growth_cap(spark, sf):
    last = align.trailing(fx.panel(spark, sf), KEY, "month", "outstanding").groupBy(*KEY).agg(F.max_by("outstanding", "month").alias("last"), F.max_by("growth12", "month").alias("growth"))
    cap = F.greatest(1.3 * F.col("last"), F.col("last") + 24 * F.coalesce(F.col("growth") / 12, F.lit(0.0)), 1.1 * F.col("last"))
    return last.select(*KEY, F.round(cap, 6).alias("cap"))


@query(f"""WITH {PANEL}, x(bank_name, exit_month) AS (VALUES ('NATION_4', DATE '1997-12-01')) SELECT bank_name, card_type, month, CASE WHEN month > exit_month THEN 0 ELSE outstanding END AS outstanding FROM panel LEFT JOIN x USING (bank_name)""")
def i15_terminated(spark, sf):
    exits = spark.createDataFrame([("NATION_4", "1997-12-01")], "bank_name string, exit_month string")
    gone = F.col("month") > F.col("exit_month").cast("date")
    return fx.panel(spark, sf).join(F.broadcast(exits), "bank_name", "left").select(*KEY, "month", F.when(gone, 0.0).otherwise(F.col("outstanding")).alias("outstanding"))


@query(f"""WITH {PANEL}, t AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel WHERE month <= DATE '2000-12-01'),
f AS (SELECT bank_name, card_type, max(month) AS last, regr_slope(outstanding, -k) AS a, regr_intercept(outstanding, -k) AS c FROM t WHERE n >= 24 AND k <= 16 GROUP BY 1, 2),
p AS (SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, greatest(0, c + a * (h - 1)) AS yhat FROM f, range(1, 7) s(h))
SELECT bank_name, card_type, count(*) AS n, round(avg(abs(outstanding - yhat) / outstanding), 6) AS mape FROM p JOIN panel USING (bank_name, card_type, month) WHERE outstanding > 0 GROUP BY 1, 2""")
def i18_holdout(spark, sf):
    rows = fx.panel(spark, sf)
    out = evaluate.trend_forecast(rows.filter("month <= date'2000-12-01'"), KEY, "month", "outstanding", least=24)
    scored = out.join(rows.filter("outstanding > 0"), [*KEY, "month"])
    return scored.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.round(evaluate.mape(F.col("outstanding"), F.col("forecast")), 6).alias("mape"))


@query(f"""WITH {PANEL}, r AS (SELECT bank_name, card_type, regr_slope(outstanding, txn_vol) AS b, regr_intercept(outstanding, txn_vol) AS a, arg_max(txn_vol, month) AS x FROM panel GROUP BY 1, 2), s(scenario, factor) AS (VALUES ('base', 1.0), ('up', 1.1), ('down', 0.9))
SELECT bank_name, card_type, scenario, round((a + b * x * factor) / nullif(a + b * x, 0) * 100 - 100, 4) AS impact_pct FROM r, s""")
def i20_scenarios(spark, sf):
    fit = fx.panel(spark, sf).groupBy(*KEY).agg(F.regr_slope("outstanding", "txn_vol").alias("b"), F.regr_intercept("outstanding", "txn_vol").alias("a"), F.max_by("txn_vol", "month").alias("x"))
    scenarios = F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(f).alias("factor")) for n, f in (("base", 1.0), ("up", 1.1), ("down", 0.9))))
    base = F.col("a") + F.col("b") * F.col("x")
    out = fit.withColumn("s", F.explode(scenarios))
    return out.select(*KEY, "s.scenario", F.round((F.col("a") + F.col("b") * F.col("x") * F.col("s.factor")) / F.nullif(base, F.lit(0.0)) * 100 - 100, 4).alias("impact_pct"))


@query(f"""WITH {_CV}, f AS (SELECT bank_name, card_type, model, fold, avg(abs((y - yhat) / nullif(y, 0))) AS e FROM m GROUP BY 1, 2, 3, 4), sc AS (SELECT bank_name, card_type, model, avg(least(e, 1)) AS s FROM f GROUP BY 1, 2, 3)
SELECT bank_name, card_type, round(max(CASE WHEN model = 'drift' THEN s END), 6) AS old, round(max(CASE WHEN model = 'linear' THEN s END), 6) AS new, max(CASE WHEN model = 'linear' THEN s END) < max(CASE WHEN model = 'drift' THEN s END) AS promoted FROM sc GROUP BY 1, 2""")
def i21_champion_gate(spark, sf):
    """The challenger replaces the champion only if its error is smaller; without a champion there is no decision."""
    of = lambda name: F.max(F.when(F.col("model") == name, F.col("mape_mean")))
    return evaluate.cv_scores(_members(spark, sf), KEY).groupBy(*KEY).agg(F.round(of("drift"), 6).alias("old"), F.round(of("linear"), 6).alias("new"), (of("linear") < of("drift")).alias("promoted"))


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel), f AS (SELECT bank_name, card_type, max(month) AS last, regr_slope(outstanding, -k) AS a, regr_intercept(outstanding, -k) AS c FROM n WHERE n >= 48 AND k <= 16 GROUP BY 1, 2)
SELECT bank_name, card_type, month, outstanding AS y, 'actual' AS kind FROM panel UNION ALL SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE), round(greatest(0, c + a * (h - 1)), 4), 'forecast' FROM f, range(1, 7) t(h)""")
def i22_full_frame(spark, sf):
    rows = fx.panel(spark, sf)
    ahead = evaluate.trend_forecast(rows, KEY, "month", "outstanding").select(*KEY, "month", F.round("forecast", 4).alias("y"), F.lit("forecast").alias("kind"))
    return rows.select(*KEY, "month", F.col("outstanding").alias("y"), F.lit("actual").alias("kind")).unionByName(ahead)


@query(f"""WITH {PANEL} SELECT card_type, round(corr(outstanding, txn_vol), 6) AS r, round(1 / (1 - power(corr(outstanding, txn_vol), 2)), 4) AS vif, CASE WHEN abs(corr(outstanding, txn_vol)) >= 0.8 THEN 'HIGH' WHEN abs(corr(outstanding, txn_vol)) >= 0.6 THEN 'MODERATE' ELSE 'LOW' END AS band FROM panel GROUP BY 1""")
def j6_collinearity(spark, sf):
    r = F.corr("outstanding", "txn_vol")
    return fx.panel(spark, sf).groupBy("card_type").agg(F.round(r, 6).alias("r"), F.round(1 / (1 - r * r), 4).alias("vif"), F.when(F.abs(r) >= 0.8, "HIGH").when(F.abs(r) >= 0.6, "MODERATE").otherwise("LOW").alias("band"))


@query(f"""WITH {SIGNALS}, m AS (SELECT signal_type, CAST(date_trunc('month', max(discovered_at)) AS DATE) AS last FROM signals GROUP BY 1) SELECT signal_type, last, CAST(datediff('month', last, DATE '2024-06-01') AS INTEGER) AS months_behind FROM m""")
def s4_months_behind(spark, sf):
    last = F.trunc(F.max("discovered_at"), "MM")
    return fx.signals(spark, sf).groupBy("signal_type").agg(last.alias("last")).withColumn("months_behind", F.months_between(F.lit("2024-06-01").cast("date"), "last").cast("int"))


@query(f"""WITH {PANEL}, {TOTALS}, c AS (SELECT card_type, month, count(*) AS n, count(*) FILTER (WHERE outstanding IS NULL) AS n_null FROM panel GROUP BY 1, 2) SELECT card_type, month, n, n_null, total IS NULL AS no_target FROM c LEFT JOIN totals USING (card_type, month)""")
def c8_structure(spark, sf):
    counts = fx.panel(spark, sf).groupBy("card_type", "month").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("outstanding").isNull()).alias("n_null"))
    return counts.join(fx.totals(spark, sf), ["card_type", "month"], "left").select("card_type", "month", "n", "n_null", F.col("total").isNull().alias("no_target"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month FROM orders""")
def b2_fixed_patterns(spark, sf):
    """The first of the patterns that fits; text of another form gives null."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format(d, "MMM-yyyy")).when(k == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("Q3/99")
    found = F.coalesce(*(F.try_to_timestamp(text, F.lit(p)) for p in ("MMM-yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return table(spark, sf, "orders").select("o_orderkey", F.trunc(found, "MM").alias("month"))


@query(f"""WITH {PANEL} SELECT card_type, count(outstanding) > 0 AS has_outstanding, count(txn_vol) > 0 AS has_txn_vol, count(CASE WHEN n_rows < 0 THEN 1 END) > 0 AS has_extra, count(*) AS n FROM panel GROUP BY 1""")
def c6_columns_with_values(spark, sf):
    there = lambda c: (F.count(c) > 0)
    return fx.panel(spark, sf).groupBy("card_type").agg(there("outstanding").alias("has_outstanding"), there("txn_vol").alias("has_txn_vol"), there(F.when(F.col("n_rows") < 0, 1)).alias("has_extra"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {PANEL} SELECT * FROM (SELECT 'head' AS part, month, bank_name, card_type FROM panel ORDER BY month, bank_name, card_type LIMIT 5) UNION ALL SELECT * FROM (SELECT 'tail', month, bank_name, card_type FROM panel ORDER BY month DESC, bank_name DESC, card_type DESC LIMIT 5)""")
def e21_head_and_tail(spark, sf):
    keys = ["month", "bank_name", "card_type"]
    rows = fx.panel(spark, sf).select(*keys)
    head = rows.orderBy(*keys).limit(5).select(F.lit("head").alias("part"), *keys)
    return head.unionByName(rows.orderBy(*(F.desc(k) for k in keys)).limit(5).select(F.lit("tail").alias("part"), *keys))


@query(f"""WITH {PANEL}, m(bank_name, card_type, since) AS (VALUES ('NATION_6', 'cc', DATE '1998-07-01')) SELECT bank_name, card_type, month, CASE WHEN month >= since THEN 1.0 ELSE 0.0 END::DOUBLE AS merger FROM panel LEFT JOIN m USING (bank_name, card_type)""")
def h3_merger_dummy(spark, sf):
    mergers = spark.createDataFrame([("NATION_6", "cc", "1998-07-01")], "bank_name string, card_type string, since string")
    step = F.when(F.col("month") >= F.col("since").cast("date"), 1.0).otherwise(0.0)
    return fx.panel(spark, sf).join(F.broadcast(mergers), KEY, "left").select(*KEY, "month", step.alias("merger"))


@query(f"""WITH {PANEL}, r AS (SELECT bank_name, card_type, month, outstanding AS y, lag(outstanding, 12) OVER w AS before, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k FROM panel WINDOW w AS (PARTITION BY bank_name, card_type ORDER BY month)),
p AS (SELECT bank_name, card_type, month, round(100.0 * (y - before) / nullif(before, 0), 6) AS pct FROM r WHERE k = 1)
SELECT *, CASE WHEN pct > 50 THEN 'strong growth' WHEN pct > 10 THEN 'growth' WHEN pct > -10 THEN 'flat' WHEN pct > -50 THEN 'declining' WHEN pct IS NOT NULL THEN 'strong decline' END AS trend FROM p""")
def b16_trend_labels(spark, sf):
    """The last year's change of each series in percent, and its label (null where there is no year before)."""
    w = Window.partitionBy(*KEY)
    r = fx.panel(spark, sf).withColumns({"_b": F.lag("outstanding", 12).over(w.orderBy("month")), "_k": F.row_number().over(w.orderBy(F.desc("month")))}).filter("_k = 1")
    r = r.select(*KEY, "month", F.round(100.0 * (F.col("outstanding") - F.col("_b")) / F.nullif("_b", F.lit(0)), 6).alias("pct"))
    return r.withColumn("trend", evaluate.trend_label(F.col("pct")))


@query(f"""WITH {_CV}, a AS (SELECT *, round(abs((y - yhat) / nullif(y, 0)), 8) AS ape FROM m)
SELECT bank_name, card_type, model, count(ape) AS n, avg(CASE WHEN ape < 0.05 THEN 1.0 WHEN ape IS NOT NULL THEN 0.0 END) AS within_5, avg(CASE WHEN ape < 0.1 THEN 1.0 WHEN ape IS NOT NULL THEN 0.0 END) AS within_10,
 avg(CASE WHEN ape < 0.2 THEN 1.0 WHEN ape IS NOT NULL THEN 0.0 END) AS within_20, count(*) FILTER (ape < 0.05) AS good, count(*) FILTER (ape >= 0.05 AND ape < 0.15) AS ok, count(*) FILTER (ape >= 0.15) AS bad FROM a GROUP BY 1, 2, 3""")
def e6_within_shares(spark, sf):
    return evaluate.within_shares(_members(spark, sf), [*KEY, "model"])

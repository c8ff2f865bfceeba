"""The registered queries of the library's own operators, each with the same statement as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import parse
from tallyloom.operators import align, cleaning, evaluate, features, grid, profile, serving
from tallyloom.sources import fixtures as fx
from tallyloom.sources.fixtures import MACRO, PANEL, RATES, SIGNALS, SOURCES, TOTALS, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEY = ["bank_name", "card_type"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


# ---- parsing ----

_TEXT = "concat(CASE WHEN o_orderkey % 5 = 0 THEN '-' WHEN o_orderkey % 5 = 1 THEN ' NA ' WHEN o_orderkey % 5 = 2 THEN 'x1' ELSE ' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) // 1000 AS VARCHAR) || ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.5' END)"


@query(f"""WITH t AS (SELECT o_orderkey, {_TEXT} AS txt FROM orders), c AS (SELECT o_orderkey, replace(trim(txt), ',', '') AS clean FROM t)
SELECT o_orderkey, CASE WHEN clean NOT IN ('', '-', 'NA', 'N/A') THEN TRY_CAST(clean AS DOUBLE) END AS parsed FROM c""")
def b1_number_parse(spark, sf):
    whole = F.col("o_totalprice").cast("long")
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "-").when(k == 1, " NA ").when(k == 2, "x1").otherwise(F.concat(F.lit(" "), F.expr("cast(cast(o_totalprice as bigint) div 1000 as string)"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit(".5")))
    return table(spark, sf, "orders").select("o_orderkey", parse.number(text).alias("parsed"))


@query("""WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k = 3 THEN NULL ELSE CAST(date_trunc('month', d) AS DATE) END AS from_text,
       CASE WHEN k = 3 THEN NULL ELSE CAST(date_trunc('month', d) AS DATE) END AS from_path FROM t""")
def b3_month_parse(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(d, "MMM-yyyy")).when(k == 1, F.concat(F.lit("as on "), F.date_format(d, "MMMM d, MMM yyyy"))).when(k == 2, F.date_format(d, "MMM yy")).otherwise("no month")
    path = F.when(k == 0, F.concat(F.lit("/a/stat_"), F.date_format(d, "yyyy-MMM"), F.lit(".xls"))).when(k == 1, F.concat(F.lit("/ATM"), F.upper(F.date_format(d, "MMMMyyyy")), F.lit(".xlsx"))).when(k == 2, F.concat(F.lit("/x/"), F.date_format(d, "yyyyMMMM"))).otherwise("/x/atm.xls")
    return table(spark, sf, "orders").select("o_orderkey", parse.month_from_text(text).alias("from_text"), parse.month_from_path(path).alias("from_path"))


@query("""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
 CAST(year(o_orderdate - INTERVAL 3 MONTH) AS VARCHAR) || '-' || lpad(CAST((year(o_orderdate - INTERVAL 3 MONTH) + 1) % 100 AS VARCHAR), 2, '0') AS fiscal_year FROM orders""")
def b5_month_and_fiscal_year(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "MM").alias("month"), parse.fiscal_year(F.col("o_orderdate")).alias("fiscal_year"))


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' LTD.' WHEN 1 THEN upper(p_name) WHEN 2 THEN '  ' || p_name || '  Limited ' ELSE CAST(p_partkey AS VARCHAR) END AS raw FROM part)
SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(upper(trim(raw)), '\\b(LIMITED|LTD|PVT|PRIVATE|CORPORATION|CORP|CO)\\b\\.?', ' ', 'g'), '\\s+', ' ', 'g'), '^[\\s.,\\-]+|[\\s.,\\-]+$', '', 'g') AS key,
       regexp_matches(raw, '^\\d+\\.?\\d*$') AS is_number FROM n""")
def b7_name_keys(spark, sf):
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.concat("p_name", F.lit(" LTD."))).when(k == 1, F.upper("p_name")).when(k == 2, F.concat(F.lit("  "), "p_name", F.lit("  Limited "))).otherwise(F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select("p_partkey", parse.stripped_name(raw).alias("key"), parse.is_number_name(raw).alias("is_number"))


@query("""SELECT bank, count(*) AS n FROM (SELECT CASE WHEN contains(lower(c_name), '1') THEN 'one' WHEN contains(lower(c_name), '22') THEN 'two' WHEN contains(lower(c_mktsegment), 'auto') THEN 'auto' ELSE 'other' END AS bank FROM customer) GROUP BY 1""")
def b10_ordered_classes(spark, sf):
    name, segment = F.lower("c_name"), F.lower("c_mktsegment")
    kind = F.when(name.contains("1"), "one").when(name.contains("22"), "two").when(segment.contains("auto"), "auto").otherwise("other")
    return table(spark, sf, "customer").groupBy(kind.alias("bank")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages),
l AS (SELECT page_id, url, unnest(h) AS href, unnest(t) AS raw FROM p), c AS (SELECT page_id, url, href, trim(regexp_replace(raw, '<[^>]+>', '', 'g')) AS text FROM l)
SELECT page_id, text, CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || href
       ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[^/]*$', '/') || href END AS link, count(*) AS n FROM c WHERE href <> '' AND text <> '' GROUP BY 1, 2, 3""")
def b11_links(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", "url", F.explode(parse.links(F.col("html"))).alias("l"))
    return rows.groupBy("page_id", F.col("l.text").alias("text"), parse.resolved(F.col("l.href"), F.col("url")).alias("link")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 8000) AS text FROM pages)
SELECT page_id, length(text)::BIGINT AS n_chars, CASE WHEN length(text) > 0 THEN left(sha256(text), 16) END AS hash FROM p""")
def b12_page_text_hash(spark, sf):
    text = parse.plain_text(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.length(text).cast("long").alias("n_chars"), parse.content_hash(text).alias("hash"))


@query("""WITH d AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events),
x AS (SELECT event_id, user_id, k, unnest([1, 2]) AS nth, event_type FROM d WHERE event_id % 4 < 3)
SELECT event_id, CASE WHEN nth = 1 THEN event_type ELSE 'second' END AS signal_type, CASE WHEN nth = 1 THEN 'bank_' || CAST(user_id % 5 AS VARCHAR) ELSE 'own' END AS bank_name, CASE WHEN nth = 1 THEN k / 100.0 ELSE 0.75 END::DOUBLE AS confidence
FROM x WHERE (nth = 1 OR event_id % 4 = 1) AND CASE WHEN nth = 1 THEN k / 100.0 ELSE 0.75 END >= 0.5""")
def b13_signal_arrays(spark, sf):
    """Answers as models give them: a bare object, an array in a code fence, an array, and text that is no JSON."""
    one = F.concat(F.lit('{"signal_type": "'), F.col("event_type"), F.lit('", "confidence": '), (F.get_json_object("props", "$.k").cast("int") / 100.0).cast("string"), F.lit("}"))
    more = F.lit(', {"signal_type": "second", "bank_name": "own", "confidence": 0.75}, {"signal_type": "unsure"}')
    k = F.pmod("event_id", F.lit(4))
    answer = F.when(k == 0, one).when(k == 1, F.concat(F.lit("```json\n["), one, more, F.lit("]\n```"))).when(k == 2, F.concat(F.lit("["), one, F.lit("]"))).otherwise("I found nothing, {sorry")
    rows = table(spark, sf, "events").select("event_id", F.concat(F.lit("bank_"), F.pmod("user_id", F.lit(5)).cast("string")).alias("bank"), answer.alias("answer"))
    found = rows.select("event_id", F.explode(parse.signal_array(F.col("answer"), F.col("bank"))).alias("s"))
    return found.select("event_id", "s.signal_type", "s.bank_name", "s.confidence")


@query(f"""WITH {PANEL} SELECT bank_name, card_type, month, round(ln(1 + outstanding), 6) AS logged, round(exp(ln(1 + outstanding)) - 1, 2) AS back, round(outstanding / 100000.0, 7) AS lakh,
 CASE WHEN n_rows < 5 THEN 'low' WHEN n_rows < 15 THEN 'mid' ELSE 'high' END AS band FROM panel""")
def b14_transforms(spark, sf):
    y = F.col("outstanding")
    band = F.when(F.col("n_rows") < 5, "low").when(F.col("n_rows") < 15, "mid").otherwise("high")
    return fx.panel(spark, sf).select(*KEY, "month", F.round(F.log1p(y), 6).alias("logged"), F.round(F.greatest(F.lit(0.0), F.expm1(F.log1p(y))), 2).alias("back"), F.round(y / 1e5, 7).alias("lakh"), band.alias("band"))


# ---- cleaning ----


@query(f"""WITH {SOURCES} SELECT date, bank, source, v FROM sources
QUALIFY row_number() OVER (PARTITION BY date, bank ORDER BY CASE source WHEN 'consolidated' THEN 0 WHEN 'monthly_xlsx' THEN 1 WHEN 'monthly_xls' THEN 2 ELSE 9 END, source) = 1""")
def c1_source_priority(spark, sf):
    return cleaning.by_priority(fx.sources(spark, sf), ["date", "bank"])


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def c2_keep_last(spark, sf):
    return cleaning.keep_one(table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(f"""WITH {PANEL}, w AS (SELECT *, last_value(outstanding) OVER r AS l, first_value(outstanding) OVER r AS f, count(outstanding) OVER r AS n FROM panel WINDOW r AS (PARTITION BY bank_name, card_type ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT bank_name, card_type, month, round(CASE WHEN n_rows % 7 = 0 AND n >= 2 THEN l + (l - f) / (n - 1) ELSE outstanding END, 4) AS fixed FROM w""")
def c4_known_errors(spark, sf):
    return cleaning.imputed(fx.panel(spark, sf), KEY, "month", "outstanding", F.col("n_rows") % 7 == 0).select(*KEY, "month", F.round("fixed", 4).alias("fixed"))


@query(f"""WITH {PANEL}, w AS (SELECT *, datediff('day', lag(month) OVER (PARTITION BY bank_name, card_type ORDER BY month), month) AS gap FROM panel)
SELECT bank_name, card_type, count(*) AS n_rows, max(gap) AS max_gap, count(*) FILTER (WHERE gap > 35) AS n_gaps, count(*) >= 48 AND coalesce(max(gap), 0) <= 35 AS ok, count(outstanding) < 12 AS low_coverage FROM w GROUP BY 1, 2""")
def c7_quality_report(spark, sf):
    rows = fx.panel(spark, sf)
    report = cleaning.quality_report(rows, KEY, "month", "outstanding", 48, 0.1)
    flags = cleaning.coverage_flag(rows, KEY, "outstanding").select(*KEY, "low_coverage").distinct()
    return report.join(flags, KEY).drop("null_share")


@query(f"""WITH {PANEL}, t AS (SELECT *, (year(month) - 1998) * 12 + month(month) - 1 AS k FROM panel),
s AS (SELECT bank_name, card_type, CASE WHEN count(*) FILTER (WHERE k BETWEEN -4 AND -1) >= 3 AND count(*) FILTER (WHERE k BETWEEN 0 AND 3) >= 3
  THEN regr_intercept(outstanding, k) FILTER (WHERE k BETWEEN 0 AND 3) - regr_intercept(outstanding, k) FILTER (WHERE k BETWEEN -4 AND -1) END AS shift FROM t GROUP BY 1, 2)
SELECT bank_name, card_type, t.month, round(CASE WHEN t.month < DATE '1998-01-01' THEN outstanding + coalesce(shift, 0) ELSE outstanding END, 4) AS spliced FROM t JOIN s USING (bank_name, card_type)""")
def c9_level_splice(spark, sf):
    return cleaning.spliced(fx.panel(spark, sf), KEY, "month", "outstanding", "1998-01-01").select(*KEY, "month", F.round("spliced", 4).alias("spliced"))


@query(f"""WITH {PANEL}, c(bank_name) AS (VALUES ('NATION_6'), ('NATION_2'), ('ATLANTIS')), b AS (SELECT DISTINCT bank_name FROM panel)
SELECT bank_name, CASE WHEN bank_name IN (SELECT bank_name FROM b) THEN 'modelled' ELSE 'missing' END AS kind FROM c UNION ALL SELECT bank_name, 'residual' FROM b WHERE bank_name NOT IN (SELECT bank_name FROM c)""")
def c11_entity_selection(spark, sf):
    there = fx.panel(spark, sf).select("bank_name").distinct()
    wanted = spark.createDataFrame([("NATION_6",), ("NATION_2",), ("ATLANTIS",)], "bank_name string")
    return wanted.join(there, "bank_name", "left_semi").withColumn("kind", F.lit("modelled")).unionByName(wanted.join(there, "bank_name", "left_anti").withColumn("kind", F.lit("missing"))).unionByName(there.join(F.broadcast(wanted), "bank_name", "left_anti").withColumn("kind", F.lit("residual")))


@query(f"""WITH {PANEL} SELECT bank_name, card_type, month, outstanding FROM panel WHERE month >= CASE WHEN bank_name = 'NATION_6' THEN DATE '1997-01-01' ELSE DATE '1996-01-01' END AND outstanding > 0
QUALIFY count(*) OVER (PARTITION BY bank_name, card_type) >= 24""")
def c13_training_rows(spark, sf):
    starts = spark.createDataFrame([("NATION_6", "1997-01-01")], "bank_name string, since string")
    rows = fx.panel(spark, sf).join(F.broadcast(starts), "bank_name", "left").filter("month >= coalesce(to_date(since), date'1996-01-01') and outstanding > 0")
    return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*KEY))).filter("n >= 24").select(*KEY, "month", "outstanding")


# ---- alignment ----


@query(f"""WITH {PANEL}, {TOTALS}, {MACRO} SELECT card_type, t.month, round(total, 3) AS total, round(m1, 4) AS m1, round(m2, 6) AS m2 FROM totals t LEFT JOIN macro USING (month)""")
def d1_master_frame(spark, sf):
    return fx.totals(spark, sf).join(fx.macro(spark, sf), "month", "left").select("card_type", "month", F.round("total", 3).alias("total"), F.round("m1", 4).alias("m1"), F.round("m2", 6).alias("m2"))


@query(f"""WITH {RATES}, o AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS at FROM events WHERE event_type = 'purchase')
SELECT event_id, rate FROM o ASOF LEFT JOIN (SELECT effective_ts, max(rate) AS rate FROM rates GROUP BY 1) r ON o.at >= r.effective_ts""")
def d2_as_of(spark, sf):
    spine = table(spark, sf, "events").filter("event_type = 'purchase'").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    return align.as_of(spine, fx.rate_events(spark, sf), "at", "effective_ts", "rate").select("event_id", "rate")


@query(f"""WITH {PANEL}, e AS (SELECT bank_name, card_type, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month FROM panel GROUP BY 1, 2)
SELECT bank_name, card_type, month, outstanding FROM e LEFT JOIN panel USING (bank_name, card_type, month)""")
def d4_dense_calendar(spark, sf):
    return align.dense(fx.panel(spark, sf), KEY, "month").select(*KEY, "month", "outstanding")


@query(f"""WITH {PANEL}, {TOTALS}, p AS (SELECT card_type, month, sum(outstanding) AS parts FROM panel WHERE bank_name < 'NATION_2' GROUP BY 1, 2)
SELECT card_type, month, round(total - parts, 4) AS residual FROM totals JOIN p USING (card_type, month) WHERE parts > 0 AND total - parts > 0""")
def d5_residual(spark, sf):
    parts = fx.panel(spark, sf).filter("bank_name < 'NATION_2'").groupBy("card_type", "month").agg(F.sum("outstanding").alias("parts"))
    return fx.totals(spark, sf).join(parts, ["card_type", "month"]).filter("parts > 0 and total - parts > 0").select("card_type", "month", F.round(F.col("total") - F.col("parts"), 4).alias("residual"))


@query(f"""WITH {PANEL}, h(lo, hi, name) AS (VALUES (0, 5, 'few'), (5, 15, 'some'), (15, 1000000, 'many')) SELECT name, card_type, count(*) AS n, round(sum(outstanding), 4) AS amount FROM panel JOIN h ON n_rows >= lo AND n_rows < hi GROUP BY 1, 2""")
def d7_range_join(spark, sf):
    bands = spark.createDataFrame([(0, 5, "few"), (5, 15, "some"), (15, 1000000, "many")], "lo int, hi int, name string")
    return fx.panel(spark, sf).join(F.broadcast(bands), F.expr("n_rows >= lo and n_rows < hi")).groupBy("name", "card_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("outstanding"), 4).alias("amount"))


_DENSE = f"{PANEL}, e AS (SELECT bank_name, card_type, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month FROM panel GROUP BY 1, 2), d AS (SELECT bank_name, card_type, month, outstanding AS y FROM e LEFT JOIN panel USING (bank_name, card_type, month))"


@query(f"""WITH {_DENSE} SELECT bank_name, card_type, month, round(lag(y, 3) OVER w, 2) AS lag3, round(y - lag(y) OVER w, 2) AS diff1, round(y - 2 * lag(y) OVER w + lag(y, 2) OVER w, 2) AS diff2, round(y / lag(y) OVER w - 1, 4) AS mom, round(y / lag(y, 12) OVER w - 1, 4) AS yoy
FROM d WINDOW w AS (PARTITION BY bank_name, card_type ORDER BY month)""")
def f1_lags_and_changes(spark, sf):
    rows = align.changes(align.dense(fx.panel(spark, sf), KEY, "month"), KEY, "month", "outstanding")
    return rows.select(*KEY, "month", *(F.round(c, 2).alias(c) for c in ("lag3", "diff1", "diff2")), *(F.round(c, 4).alias(c) for c in ("mom", "yoy")))


@query(f"""WITH {_DENSE}, n AS (SELECT *, row_number() OVER w AS i, CASE WHEN y IS NOT NULL THEN row_number() OVER w END AS k FROM d WINDOW w AS (PARTITION BY bank_name, card_type ORDER BY month)),
f AS (SELECT *, last_value(y IGNORE NULLS) OVER b AS pv, first_value(y IGNORE NULLS) OVER a AS nv, last_value(k IGNORE NULLS) OVER b AS pk, first_value(k IGNORE NULLS) OVER a AS nk FROM n
 WINDOW b AS (PARTITION BY bank_name, card_type ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY bank_name, card_type ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT bank_name, card_type, month, coalesce(y, 0) AS zero, coalesce(pv, nv) AS ffill, coalesce(nv, pv) AS bfill, round(coalesce(y, pv + (nv - pv) * (i - pk) / nullif(nk - pk, 0), pv, nv), 6) AS linear FROM f""")
def f3_fills(spark, sf):
    rows = align.dense(fx.panel(spark, sf), KEY, "month")
    for how in ("zero", "ffill", "bfill", "linear"):
        rows = align.filled(rows, KEY, "month", "outstanding", how, how)
    return rows.select(*KEY, "month", "zero", "ffill", "bfill", F.round("linear", 6).alias("linear"))


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS i FROM panel)
SELECT bank_name, card_type, month, round(avg(outstanding) OVER (PARTITION BY bank_name, card_type ORDER BY month ROWS 11 PRECEDING), 6) AS mean12,
 round(CASE WHEN i >= 6 THEN regr_slope(outstanding, i) OVER (PARTITION BY bank_name, card_type ORDER BY month ROWS 5 PRECEDING) ELSE 0 END, 6) AS slope6, round(outstanding - lag(outstanding, 12) OVER (PARTITION BY bank_name, card_type ORDER BY month), 4) AS growth12 FROM n""")
def f4_trailing(spark, sf):
    return align.trailing(fx.panel(spark, sf), KEY, "month", "outstanding").select(*KEY, "month", *(F.round(c, 6).alias(c) for c in ("mean12", "slope6")), F.round("growth12", 4).alias("growth12"))


@query(f"""WITH {PANEL} SELECT bank_name, card_type, arg_min(outstanding, month) AS first_value, arg_max(outstanding, month) AS last_value, max(outstanding) AS peak, arg_max(month, outstanding) AS peak_month, arg_min(month, outstanding) AS trough_month,
 round((arg_max(outstanding, month) / max(outstanding) - 1) * 100, 4) AS from_peak_pct FROM panel GROUP BY 1, 2""")
def f5_extremes(spark, sf):
    out = profile.extremes(fx.panel(spark, sf), KEY, "month", "outstanding")
    return out.withColumn("from_peak_pct", F.round("from_peak_pct", 4))


@query(f"""WITH {PANEL}, l AS (SELECT * FROM panel WHERE month = (SELECT max(month) FROM panel)), t AS (SELECT card_type, sum(outstanding) AS s FROM l GROUP BY 1)
SELECT card_type, bank_name, row_number() OVER w AS place, round(outstanding / s, 6) AS share, round(sum(outstanding) OVER (PARTITION BY card_type ORDER BY outstanding DESC, bank_name ROWS UNBOUNDED PRECEDING) / s, 6) AS cumulative FROM l JOIN t USING (card_type)
WINDOW w AS (PARTITION BY card_type ORDER BY outstanding DESC, bank_name)""")
def f7_concentration(spark, sf):
    rows = fx.panel(spark, sf)
    last = rows.join(F.broadcast(rows.agg(F.max("month").alias("month"))), "month", "left_semi")  # one row
    return profile.concentration(last, ["card_type"], "bank_name", "outstanding").select("card_type", "bank_name", F.col("place").cast("long"), F.round("share", 6).alias("share"), F.round("cumulative", 6).alias("cumulative"))


# ---- aggregates ----


@query(f"""WITH {PANEL} SELECT card_type, bank_name, count(*) AS n_months, round(sum(outstanding), 4) AS total FROM panel GROUP BY ROLLUP (card_type, bank_name)""")
def e2_rollup(spark, sf):
    return fx.panel(spark, sf).rollup("card_type", "bank_name").agg(F.count(F.lit(1)).alias("n_months"), F.round(F.sum("outstanding"), 4).alias("total"))


@query(f"""WITH {PANEL}, {TOTALS}, p AS (SELECT card_type, month, sum(outstanding) AS parts FROM panel WHERE bank_name <> 'NATION_6' GROUP BY 1, 2)
SELECT card_type, round(avg(abs(parts - total) / total * 100), 4) AS divergence, CASE WHEN avg(abs(parts - total) / total * 100) < 10 THEN 'good' WHEN avg(abs(parts - total) / total * 100) < 20 THEN 'fair' ELSE 'poor' END AS verdict FROM totals JOIN p USING (card_type, month) GROUP BY 1""")
def e3_cross_check(spark, sf):
    parts = fx.panel(spark, sf).filter("bank_name <> 'NATION_6'").groupBy("card_type", "month").agg(F.sum("outstanding").alias("parts"))
    d = F.avg(F.abs(F.col("parts") - F.col("total")) / F.col("total") * 100)
    return fx.totals(spark, sf).join(parts, ["card_type", "month"]).groupBy("card_type").agg(F.round(d, 4).alias("divergence"), F.when(d < 10, "good").when(d < 20, "fair").otherwise("poor").alias("verdict"))


@query(f"""WITH {PANEL} SELECT bank_name, round(median(outstanding), 5) AS median, round(quantile_cont(outstanding, 0.9), 5) AS p90, round(stddev(outstanding), 2) AS std, round(stddev_pop(outstanding), 2) AS std_pop, min(outstanding) AS low, max(outstanding) AS high,
 round(avg(CASE WHEN n_rows < 10 THEN 1 ELSE 0 END), 6) AS share_small FROM panel GROUP BY 1""")
def e5_spread(spark, sf):
    y = F.col("outstanding")
    return fx.panel(spark, sf).groupBy("bank_name").agg(F.round(F.percentile(y, F.lit(0.5)), 5).alias("median"), F.round(F.percentile(y, F.lit(0.9)), 5).alias("p90"), F.round(F.stddev(y), 2).alias("std"), F.round(F.stddev_pop(y), 2).alias("std_pop"), F.min(y).alias("low"), F.max(y).alias("high"), F.round(F.avg((F.col("n_rows") < 10).cast("double")), 6).alias("share_small"))


@query(f"""WITH {PANEL}, l(lag) AS (VALUES (0), (1), (3), (6)), w AS (SELECT bank_name, card_type, lag, outstanding AS y, CASE lag WHEN 0 THEN txn_vol WHEN 1 THEN lag(txn_vol, 1) OVER s WHEN 3 THEN lag(txn_vol, 3) OVER s ELSE lag(txn_vol, 6) OVER s END AS x FROM panel, l WINDOW s AS (PARTITION BY bank_name, card_type, lag ORDER BY month))
SELECT bank_name, card_type, lag, count(*) AS n, round(CASE WHEN count(*) >= 10 THEN corr(y, x) END, 6) AS r FROM w WHERE x IS NOT NULL GROUP BY 1, 2, 3""")
def e7_lag_correlation(spark, sf):
    return rounded(profile.lag_correlation(fx.panel(spark, sf), KEY, "month", "outstanding", "txn_vol", [0, 1, 3, 6]), 6)


@query(f"""WITH {PANEL}, r AS (SELECT bank_name, card_type, rank() OVER (PARTITION BY bank_name, card_type ORDER BY n_rows) + (count(*) OVER (PARTITION BY bank_name, card_type, n_rows) - 1) / 2.0 AS a, rank() OVER (PARTITION BY bank_name, card_type ORDER BY txn_vol) + (count(*) OVER (PARTITION BY bank_name, card_type, txn_vol) - 1) / 2.0 AS b FROM panel)
SELECT bank_name, card_type, count(*) AS n, round(corr(a, b), 6) AS rho FROM r GROUP BY 1, 2""")
def e8_spearman(spark, sf):
    return rounded(profile.spearman(fx.panel(spark, sf), KEY, "n_rows", "txn_vol"), 6)


@query(f"""WITH {PANEL}, m AS (SELECT *, outstanding - avg(outstanding) OVER (PARTITION BY bank_name, card_type) AS e FROM panel), g AS (SELECT *, e - lag(e) OVER (PARTITION BY bank_name, card_type ORDER BY month) AS d FROM m)
SELECT bank_name, card_type, count(*) AS n, round(stddev(e), 1) AS std, round(skewness(e), 4) AS skew, round(kurtosis(e), 4) AS kurt, round(sum(d * d) / sum(e * e), 4) AS dw, round(regr_r2(outstanding, txn_vol), 4) AS r2 FROM g GROUP BY 1, 2""")
def e13_residual_shape(spark, sf):
    rows = fx.panel(spark, sf)
    e = F.col("outstanding") - F.avg("outstanding").over(Window.partitionBy(*KEY))
    shape = profile.residual_shape(rows.withColumn("e", e), KEY, "month", "e")
    fit = rows.groupBy(*KEY).agg(F.round(F.regr_r2("outstanding", "txn_vol"), 4).alias("r2"))
    return shape.join(fit, KEY).select(*KEY, "n", F.round("std", 1).alias("std"), *(F.round(c, 4).alias(c) for c in ("skew", "kurt", "dw")), "r2")


@query(f"""WITH {PANEL} SELECT 'outstanding' AS variable, count(DISTINCT bank_name) AS n_banks, min(month) AS first_month, max(month) AS last_month, round(avg(CASE WHEN outstanding IS NULL THEN 1 ELSE 0 END), 4) AS null_share FROM panel
UNION ALL SELECT 'txn_vol', count(DISTINCT bank_name), min(month), max(month), round(avg(CASE WHEN txn_vol IS NULL THEN 1 ELSE 0 END), 4) FROM panel""")
def e11_availability(spark, sf):
    long = fx.panel(spark, sf).unpivot(["bank_name", "month"], ["outstanding", "txn_vol"], "variable", "value")
    return long.groupBy("variable").agg(F.countDistinct("bank_name").alias("n_banks"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.round(F.avg(F.col("value").isNull().cast("double")), 4).alias("null_share"))


@query(f"""WITH {PANEL}, t AS (SELECT bank_name FROM panel WHERE month = (SELECT max(month) FROM panel) GROUP BY 1 ORDER BY sum(outstanding) DESC, bank_name LIMIT 5) SELECT bank_name, month, round(sum(outstanding), 4) AS total FROM panel WHERE bank_name IN (SELECT bank_name FROM t) GROUP BY 1, 2""")
def e15_top_entities(spark, sf):
    rows = fx.panel(spark, sf)
    last = rows.join(F.broadcast(rows.agg(F.max("month").alias("month"))), "month", "left_semi")  # one row
    top = last.groupBy("bank_name").agg(F.sum("outstanding").alias("s")).orderBy(F.desc("s"), "bank_name").limit(5)
    return rows.join(F.broadcast(top), "bank_name", "left_semi").groupBy("bank_name", "month").agg(F.round(F.sum("outstanding"), 4).alias("total"))  # five rows


@query(f"""WITH {PANEL} SELECT month, max(CASE WHEN bank_name = 'NATION_6' THEN outstanding END) AS "NATION_6", max(CASE WHEN bank_name = 'NATION_2' THEN outstanding END) AS "NATION_2" FROM panel WHERE card_type = 'cc' GROUP BY 1""")
def e17_comparison(spark, sf):
    return serving.comparison(fx.panel(spark, sf).filter("card_type = 'cc'"), "month", "bank_name", "outstanding", ["NATION_6", "NATION_2"])


@query(f"""WITH {SIGNALS} SELECT signal_type, bank_name, count(*) AS n FROM signals GROUP BY 1, 2""")
def e18_frequencies(spark, sf):
    return fx.signals(spark, sf).groupBy("signal_type", "bank_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SIGNALS} SELECT id, signal_type FROM signals WHERE discovered_at >= (SELECT max(discovered_at) FROM signals) - INTERVAL 3 DAY ORDER BY discovered_at DESC, id DESC LIMIT 20""")
def e20_recent_findings(spark, sf):
    rows = fx.signals(spark, sf)
    end = F.broadcast(rows.agg(F.max("discovered_at").alias("end")))  # one row
    return rows.join(end, F.expr("discovered_at >= end - interval 3 days")).orderBy(F.desc("discovered_at"), F.desc("id")).limit(20).select("id", "signal_type")


# ---- features ----


@query(f"""WITH {PANEL} SELECT bank_name, card_type, month, CASE WHEN month IN (DATE '1996-04-01', DATE '1996-05-01') THEN 1.0 ELSE 0.0 END::DOUBLE AS event_shock, CASE WHEN month >= DATE '1999-01-01' THEN 1.0 ELSE 0.0 END::DOUBLE AS event_rule FROM panel""")
def h1_event_columns(spark, sf):
    events = [("shock", "pulse", ["1996-04-01", "1996-05-01"]), ("rule", "step", ["1999-01-01"]), ("bend", "change_point", ["1998-01-01"])]
    return features.event_columns(fx.panel(spark, sf).select(*KEY, "month"), "month", events)


@query(f"""WITH {PANEL}, e AS (SELECT bank_name, card_type, min(month) AS a, max(month) AS b FROM panel GROUP BY 1, 2), p(change_point) AS (VALUES (DATE '1995-01-01'), (DATE '1998-06-01'), (DATE '2001-07-01')) SELECT bank_name, card_type, change_point FROM e, p WHERE change_point > a AND change_point < b""")
def h2_change_points(spark, sf):
    return features.change_points(fx.panel(spark, sf), KEY, "month", ["1995-01-01", "1998-06-01", "2001-07-01"])


@query(f"""WITH {SIGNALS}, r(signal_type, prefix, how, weight) AS (VALUES {', '.join(str(r) for r in fx.SIGNAL_RULES)}),
x AS (SELECT *, CAST(discovered_at AS DATE) AS period, CASE impact_magnitude WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS mg, CASE impact_direction WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END AS dr FROM signals JOIN r USING (signal_type))
SELECT period, CASE WHEN how = 'direction' THEN prefix ELSE prefix || '_' || bank_name END AS "column", CAST(CASE WHEN how = 'flag' THEN CASE WHEN arg_max(dr, (discovered_at, id)) >= 0 THEN 1 ELSE 0 END WHEN how = 'count' THEN sum(weight * mg) ELSE sum(dr * mg) END AS DOUBLE) AS value FROM x GROUP BY period, 2, how""")
def h6_signal_regressors(spark, sf):
    return features.signal_regressors(fx.signals(spark, sf), fx.SIGNAL_RULES, fx.MAGNITUDES, fx.DIRECTIONS)


@query(f"""WITH {PANEL}, n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k FROM panel), s AS (SELECT bank_name, card_type, max(month) AS last, CASE WHEN count(*) FILTER (WHERE k <= 6) >= 6 THEN regr_slope(txn_vol, -k) FILTER (WHERE k <= 6) ELSE 0 END AS slope, arg_max(txn_vol, month) AS v FROM n GROUP BY 1, 2)
SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, round(greatest(0, v + slope * h), 6) AS txn_vol FROM s, range(1, 25) t(h)""")
def h5_future_regressor(spark, sf):
    return rounded(features.future_rows(fx.panel(spark, sf), KEY, "month", "txn_vol", "slope"), 6)


# ---- forecasts ----

_CV = f"""{PANEL}, r AS (SELECT bank_name, card_type, month, outstanding AS y, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS i, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel),
cuts AS (SELECT DISTINCT bank_name, card_type, i AS cut, CAST((i - 36) // 6 AS INTEGER) AS fold FROM r WHERE i >= 36 AND i <= n - 6 AND (i - 36) % 6 = 0),
st AS (SELECT c.bank_name, c.card_type, c.cut, c.fold, regr_slope(y, i) AS slope, regr_intercept(y, i) AS icept, arg_max(y, i) AS last, arg_min(y, i) AS y1 FROM cuts c JOIN r ON r.bank_name = c.bank_name AND r.card_type = c.card_type AND r.i <= c.cut GROUP BY 1, 2, 3, 4),
cv AS (SELECT st.bank_name, st.card_type, fold, CAST(t.i - cut AS INTEGER) AS step, t.y, icept + slope * t.i AS linear, last + (t.i - cut) * (last - y1) / (cut - 1) AS drift, s.y AS seasonal
 FROM st JOIN r t ON t.bank_name = st.bank_name AND t.card_type = st.card_type AND t.i > cut AND t.i <= cut + 6 JOIN r s ON s.bank_name = st.bank_name AND s.card_type = st.card_type AND s.i = t.i - 12),
m AS (SELECT bank_name, card_type, fold, step, y, unnest(['linear', 'drift', 'seasonal']) AS model, unnest([linear, drift, seasonal]) AS yhat FROM cv)"""


def _cv(spark, sf):
    return evaluate.fold_forecasts(fx.panel(spark, sf), KEY, "month", "outstanding")


def _members(spark, sf):
    return evaluate.long_members(_cv(spark, sf), [*KEY, "fold", "step", "y"])


@query(f"WITH {_CV} SELECT bank_name, card_type, fold, step, y, round(linear, 4) AS linear, round(drift, 4) AS drift, seasonal FROM cv")
def i2_fold_forecasts(spark, sf):
    return _cv(spark, sf).withColumns({c: F.round(c, 4) for c in ("linear", "drift")})


@query(f"WITH {_CV} SELECT bank_name, card_type, fold, step, round((2 * linear + drift + seasonal) / 4, 4) AS ensemble FROM cv")
def i6_ensemble(spark, sf):
    out = evaluate.ensemble(_members(spark, sf), [*KEY, "fold", "step"], {"linear": 2.0, "drift": 1.0, "seasonal": 1.0})
    return out.withColumn("ensemble", F.round("ensemble", 4))


_SCORES = "f AS (SELECT bank_name, card_type, model, fold, avg(abs((y - yhat) / nullif(y, 0))) AS e FROM m GROUP BY 1, 2, 3, 4), sc AS (SELECT bank_name, card_type, model, count(*) AS n_folds, avg(least(e, 1)) AS mape_mean, median(least(e, 1)) AS mape_median, min(least(e, 1)) AS mape_min, max(least(e, 1)) AS mape_max, count(*) FILTER (WHERE e > 1) AS n_capped FROM f GROUP BY 1, 2, 3)"


@query(f"WITH {_CV}, {_SCORES} SELECT bank_name, card_type, fold, step, round(sum(yhat / mape_mean) / sum(1 / mape_mean), 4) AS ensemble FROM m JOIN sc USING (bank_name, card_type, model) GROUP BY 1, 2, 3, 4")
def i7_inverse_error_ensemble(spark, sf):
    m = _members(spark, sf)
    out = evaluate.inverse_error_ensemble(m, [*KEY, "fold", "step"], evaluate.cv_scores(m, KEY), KEY)
    return out.withColumn("ensemble", F.round("ensemble", 4))


@query(f"WITH {_CV}, p AS (SELECT bank_name, card_type, model, step, count(*) AS n, quantile_cont(y - yhat, 0.05) AS a, quantile_cont(y - yhat, 0.95) AS b FROM m GROUP BY 1, 2, 3, 4), s AS (SELECT bank_name, card_type, model, stddev_pop(y - yhat) AS g FROM m GROUP BY 1, 2, 3) SELECT bank_name, card_type, model, step, round(CASE WHEN n < 3 THEN -1.645 * g * sqrt(step) ELSE a END, 5) AS lower, round(CASE WHEN n < 3 THEN 1.645 * g * sqrt(step) ELSE b END, 5) AS upper, CASE WHEN n < 3 THEN 'normal' ELSE 'conformal' END AS how FROM p JOIN s USING (bank_name, card_type, model)")
def i8_conformal(spark, sf):
    return rounded(evaluate.conformal(_members(spark, sf), [*KEY, "model"]), 5)


@query(f"WITH {_CV}, {_SCORES} SELECT bank_name, card_type, model, n_folds, round(mape_mean, 6) AS mape_mean, round(mape_median, 6) AS mape_median, round(mape_min, 6) AS mape_min, round(mape_max, 6) AS mape_max, n_capped FROM sc")
def i10_cv_scores(spark, sf):
    return rounded(evaluate.cv_scores(_members(spark, sf), KEY), 6)


@query(f"WITH {_CV} SELECT model, CASE WHEN step <= 3 THEN 'near' ELSE 'far' END AS bucket, round(avg(abs((y - yhat) / nullif(y, 0))), 6) AS mape, count(*) AS n FROM m GROUP BY 1, 2")
def i11_horizon_drift(spark, sf):
    return _members(spark, sf).groupBy("model", F.when(F.col("step") <= 3, "near").otherwise("far").alias("bucket")).agg(F.round(evaluate.mape(F.col("y"), F.col("yhat")), 6).alias("mape"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {PANEL}, s AS (SELECT card_type, bank_name, month, outstanding / sum(outstanding) OVER (PARTITION BY card_type, month) AS share FROM panel), l AS (SELECT *, row_number() OVER (PARTITION BY card_type, bank_name ORDER BY month DESC) AS k FROM s), f AS (SELECT card_type, bank_name, count(*) AS n, regr_slope(share, -k) AS a, regr_intercept(share, -k) AS c, arg_max(share, month) AS last FROM l WHERE k <= 16 GROUP BY 1, 2) SELECT card_type, bank_name, round(last, 6) AS fixed_share, round(CASE WHEN n < 4 THEN last ELSE greatest(0, c + a * 5) END, 6) AS trend_share FROM f")
def i16_share_allocation(spark, sf):
    share = F.col("outstanding") / F.sum("outstanding").over(Window.partitionBy("card_type", "month"))
    w = Window.partitionBy("card_type", "bank_name").orderBy(F.desc("month"))
    rows = fx.panel(spark, sf).withColumn("share", share).withColumn("k", F.row_number().over(w)).filter("k <= 16")
    fit = rows.groupBy("card_type", "bank_name").agg(F.count(F.lit(1)).alias("n"), F.regr_slope("share", -F.col("k")).alias("a"), F.regr_intercept("share", -F.col("k")).alias("c"), F.max_by("share", "month").alias("last"))
    return fit.select("card_type", "bank_name", F.round("last", 6).alias("fixed_share"), F.round(F.when(F.col("n") < 4, F.col("last")).otherwise(F.greatest(F.lit(0.0), F.col("c") + F.col("a") * 5)), 6).alias("trend_share"))


@query(f"WITH {_CV}, {_SCORES} SELECT bank_name, card_type, arg_min(model, (round(mape_mean, 9), model)) AS best, round(min(mape_mean), 6) AS mape, CASE WHEN min(mape_mean) <= 0.07 THEN 'green' WHEN min(mape_mean) <= 0.15 THEN 'amber' ELSE 'red' END AS tier FROM sc GROUP BY 1, 2")
def i17_scorecard(spark, sf):
    m = F.min("mape_mean")
    tier = F.when(m <= 0.07, "green").when(m <= 0.15, "amber").otherwise("red")
    return evaluate.cv_scores(_members(spark, sf), KEY).groupBy(*KEY).agg(F.min_by("model", F.struct(F.round("mape_mean", 9), "model")).alias("best"), F.round(m, 6).alias("mape"), tier.alias("tier"))


@query(f"WITH {_CV}, g AS (SELECT bank_name, card_type, w / 20.0 AS weight, round(avg(abs((y - (w / 20.0 * linear + (1 - w / 20.0) * seasonal)) / nullif(y, 0))), 10) AS e FROM cv, range(0, 21) t(w) GROUP BY 1, 2, 3) SELECT bank_name, card_type, CAST(arg_min(weight, (e, weight)) AS DOUBLE) AS weight, round(min(e), 6) AS mape FROM g GROUP BY 1, 2")
def i19_weight_grid(spark, sf):
    return evaluate.weight_grid(_cv(spark, sf), KEY, "linear", "seasonal").withColumn("mape", F.round("mape", 6))


_TREND = "n AS (SELECT *, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month DESC) AS k, count(*) OVER (PARTITION BY bank_name, card_type) AS n FROM panel), f AS (SELECT bank_name, card_type, max(month) AS last, regr_slope(outstanding, -k) AS a, regr_intercept(outstanding, -k) AS c FROM n WHERE n >= 48 AND k <= 16 GROUP BY 1, 2), fc AS (SELECT bank_name, card_type, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS month, greatest(0, c + a * (h - 1)) AS forecast FROM f, range(1, 7) t(h))"


@query(f"WITH {PANEL}, {_TREND} SELECT card_type, month, count(*) AS n_banks, round(sum(forecast), 0) AS bottom_up FROM fc GROUP BY 1, 2")
def entry_forecast(spark, sf):
    """Each series' trend forecast, summed to totals by card type and month."""
    out = evaluate.trend_forecast(fx.panel(spark, sf), KEY, "month", "outstanding")
    return out.groupBy("card_type", "month").agg(F.count(F.lit(1)).alias("n_banks"), F.round(F.sum("forecast"), 0).alias("bottom_up"))


# ---- serving ----


@query("""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey, o_totalprice FROM orders), b AS (SELECT * FROM o WHERE o_orderkey % 2 = 0), n AS (SELECT * FROM o WHERE o_orderkey % 2 = 1),
x AS (SELECT o_custkey, d, o_totalprice, 0 AS isnew, o_orderkey FROM b UNION ALL SELECT o_custkey, d, o_totalprice, 1, o_orderkey FROM n)
SELECT o_custkey, d, o_totalprice FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey, d ORDER BY isnew DESC, CASE WHEN isnew = 1 THEN o_orderkey END DESC NULLS LAST, o_totalprice DESC) = 1""")
def a7_upsert(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_totalprice", "o_orderkey")
    return serving.upserted(o.filter("o_orderkey % 2 = 0").drop("o_orderkey"), o.filter("o_orderkey % 2 = 1"), ["o_custkey", "d"], "o_orderkey")


@query("""WITH old AS (SELECT sha256(coalesce(text, '')) AS h FROM documents WHERE doc_id % 3 = 0) SELECT doc_id, sha256(coalesce(text, '')) AS hash, sha256(coalesce(text, '')) NOT IN (SELECT h FROM old) AS is_new FROM documents""")
def a9_freshness(spark, sf):
    docs = table(spark, sf, "documents")
    ledger = docs.filter("doc_id % 3 = 0").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"))
    return serving.freshness(docs, ledger, "doc_id", "text")


@query(f"""WITH {PANEL} SELECT bank_name, to_json({{'month': list(strftime(month, '%Y-%m-%d') ORDER BY month), 'n_rows': list(n_rows ORDER BY month)}})::VARCHAR AS payload FROM panel WHERE card_type = 'cc' GROUP BY 1""")
def a10_nested_export(spark, sf):
    return serving.nested_export(fx.panel(spark, sf).filter("card_type = 'cc'"), "bank_name", "month", ["n_rows"])


@query("""WITH r AS (SELECT event_type AS source, CAST(ts AS TIMESTAMP) AS started_at, CASE WHEN CAST(floor(value) AS BIGINT) % 3 = 0 THEN 'failed' ELSE 'ok' END AS status FROM events), g(source) AS (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('mail'))
SELECT g.source, coalesce(arg_max(status, started_at), 'never_run') AS status, max(started_at) AS started_at, count(r.source) AS n_runs FROM g LEFT JOIN r ON r.source = g.source GROUP BY 1""")
def f8_latest_status(spark, sf):
    status = F.when(F.pmod(F.floor("value"), F.lit(3)) == 0, "failed").otherwise("ok")
    runs = table(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("started_at"), status.alias("status"))
    groups = spark.createDataFrame([(x,) for x in ("click", "view", "purchase", "signup", "error", "mail")], "source string")
    return serving.latest(runs, groups, "source", "started_at")


# ---- cell grids ----

_CELLS = f"""{PANEL}, base AS (SELECT card_type AS file, bank_name AS sheet, CAST(row_number() OVER (PARTITION BY card_type, bank_name ORDER BY month) AS INTEGER) AS r, month, outstanding, txn_vol FROM panel),
cells AS (SELECT file, sheet, r + 2 AS row, 0 AS col, CASE WHEN r % 12 = 1 THEN 'Year group' WHEN r % 12 = 0 THEN 'TOTAL' ELSE strftime(month, '%Y-%m') END AS value FROM base
 UNION ALL SELECT file, sheet, r + 2, 1, CAST(CAST(floor(outstanding) AS BIGINT) AS VARCHAR) FROM base UNION ALL SELECT file, sheet, r + 2, 2, CASE WHEN r % 5 = 0 THEN '-' ELSE CAST(CAST(floor(txn_vol) AS BIGINT) AS VARCHAR) END FROM base
 UNION ALL SELECT DISTINCT file, sheet, v.row, v.col, v.value FROM base, (VALUES (0, 0, 'Name'), (0, 1, '8 Cards Outstanding'), (0, 2, ' '), (1, 0, NULL), (1, 1, 'Amount'), (1, 2, 'Volume (Online)'), (2, 0, NULL), (2, 1, 'Rs'), (2, 2, 'Number')) v(row, col, value))"""


def _cells(spark, sf):
    w = Window.partitionBy("file", "sheet").orderBy("month")
    base = fx.panel(spark, sf).select(F.col("card_type").alias("file"), F.col("bank_name").alias("sheet"), "month", "outstanding", "txn_vol").withColumn("r", F.row_number().over(w))
    label = F.when(F.col("r") % 12 == 1, "Year group").when(F.col("r") % 12 == 0, "TOTAL").otherwise(F.date_format("month", "yyyy-MM"))
    whole = lambda c: F.col(c).cast("long").cast("string")
    cell = lambda col, value: F.struct((F.col("r") + 2).alias("row"), F.lit(col).alias("col"), value.alias("value"))
    body = base.select("file", "sheet", F.explode(F.array(cell(0, label), cell(1, whole("outstanding")), cell(2, F.when(F.col("r") % 5 == 0, "-").otherwise(whole("txn_vol"))))).alias("c")).select("file", "sheet", "c.*")
    head = spark.createDataFrame([(0, 0, "Name"), (0, 1, "8 Cards Outstanding"), (0, 2, " "), (1, 0, None), (1, 1, "Amount"), (1, 2, "Volume (Online)"), (2, 0, None), (2, 1, "Rs"), (2, 2, "Number")], "row int, col int, value string")
    return grid.data_sheets(body.unionByName(base.select("file", "sheet").distinct().crossJoin(F.broadcast(head))))  # nine header cells


@query(f"WITH {_CELLS} SELECT file, sheet, row, col, last_value(nullif(trim(value), '') IGNORE NULLS) OVER (PARTITION BY file, sheet, row ORDER BY col ROWS UNBOUNDED PRECEDING) AS value FROM cells WHERE row < 3")
def g1_filled_headers(spark, sf):
    return grid.filled_headers(_cells(spark, sf), 3)


@query(f"WITH {_CELLS} SELECT file, sheet, col, last_value(CASE WHEN regexp_matches(value, '^\\s*\\d+\\s+\\S') THEN value END IGNORE NULLS) OVER (PARTITION BY file, sheet ORDER BY col ROWS UNBOUNDED PRECEDING) AS section FROM cells WHERE row = 0")
def g2_sections(spark, sf):
    return grid.section_of_columns(_cells(spark, sf), 0)


@query(f"WITH {_CELLS} SELECT DISTINCT file, sheet, target, c AS col FROM cells, (VALUES ('amount', 1), ('volume', 2), ('limit', NULL)) t(target, c)")
def g4_resolved_targets(spark, sf):
    sigs = grid.signatures(grid.filled_headers(_cells(spark, sf), 3))
    return grid.resolved_targets(sigs, {"amount": [["outstanding", "amount"]], "volume": [["quantity"], ["volume", "online"]], "limit": [["limit"]]})


@query(f"WITH {_CELLS}, l AS (SELECT file, sheet, row, value, last_value(CASE WHEN upper(trim(value)) = 'YEAR GROUP' THEN value END IGNORE NULLS) OVER (PARTITION BY file, sheet ORDER BY row ROWS UNBOUNDED PRECEDING) AS category FROM cells WHERE col = 0 AND row >= 3) SELECT file, sheet, row, value AS label, category FROM l WHERE upper(trim(value)) <> 'YEAR GROUP' AND NOT starts_with(upper(trim(value)), 'TOTAL')")
def g6_categories(spark, sf):
    return grid.categories(_cells(spark, sf), 0, ["Year group"], 3)


@query(f"WITH {_CELLS} SELECT file, sheet, row, max(CASE WHEN col = 1 THEN TRY_CAST(value AS DOUBLE) END) AS amount, max(CASE WHEN col = 2 THEN TRY_CAST(value AS DOUBLE) END) AS volume FROM cells WHERE row >= 3 AND col > 0 GROUP BY 1, 2, 3")
def g7_extracted_rows(spark, sf):
    cells = _cells(spark, sf)
    columns = grid.resolved_targets(grid.signatures(grid.filled_headers(cells, 3)), {"amount": [["amount"]], "volume": [["volume"]]})
    return grid.extracted(cells, columns, 3, ["amount", "volume"], parse.number(F.col("value")))

"""Registered queries of sources, names, findings, grids and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import parse
from tallyloom.operators import cleaning, features, grid, serving, sketches
from tallyloom.plans.queries import _CELLS, KEY, _cells, query
from tallyloom.sources import fixtures as fx
from tallyloom.sources import readers
from tallyloom.sources.fixtures import MACRO, PANEL, table
from tallyloom.streaming import ingest, status


@query("""SELECT 'orders' AS name, count(*) AS n, count(o_orderdate) AS n_dates FROM orders UNION ALL SELECT 'events', count(*), count(ts) FROM events""")
def a1_named_tables(spark, sf):
    """A table that isn't there is left out."""
    found = readers.load_named(spark, sf, ["orders", "not_there", "events"])
    one = lambda name, date: found[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.count(F.col(date).cast("timestamp")).alias("n_dates"))
    assert sorted(found) == ["events", "orders"]
    return one("orders", "o_orderdate").unionByName(one("events", "ts"))


@query("""SELECT 'customers' AS source, c_custkey AS id, c_acctbal AS amount, NULL::DOUBLE AS price, true AS has_file FROM customer UNION ALL SELECT 'orders', o_orderkey, NULL, o_totalprice, true FROM orders""")
def a2_stacked_sources(spark, sf):
    rows = readers.stacked(spark, {"customers": f"{sf}/customer.parque[t]", "orders": f"{sf}/orders.parque[t]", "gone": f"{sf}/gone*.parquet"})
    return rows.select("source", F.coalesce("c_custkey", "o_orderkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("o_totalprice").alias("price"), (F.length("file") > 0).alias("has_file"))


@query(f"WITH {PANEL}, {MACRO} SELECT month, m1, round(m2, 9) AS m2 FROM macro")
def a3_csv_months(spark, sf):
    """Monthly rows written as CSV with their dates within the month, read back as months."""
    path = readers.scratch(spark, "months") + ".csv"
    fx.macro(spark, sf).select(F.date_add("month", 14).alias("month"), "m1", F.round("m2", 9).alias("m2")).write.option("header", "true").csv(path)
    return readers.monthly_table(spark, path, "month date, m1 double, m2 double", "month")


@query(f"WITH {PANEL} SELECT card_type, month AS date, n_rows AS banks_live, outstanding AS value FROM panel WHERE bank_name = 'NATION_1' AND month(month) <> 3")
def a4_json_records(spark, sf):
    """An array of records in each file; records without a date are left out, counts that came as decimals become whole."""
    rows = fx.panel(spark, sf).filter("bank_name = 'NATION_1'")
    record = F.struct(F.when(F.month("month") != 3, F.col("month")).alias("date"), F.col("n_rows").cast("double").alias("banks_live"), F.col("outstanding").alias("value"))
    path = readers.scratch(spark, "records")
    rows.groupBy("card_type").agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("card_type").text(path)  # a series of months each
    found = readers.monthly_records(spark, path, "date date, banks_live double, value double, card_type string")
    return found.select("card_type", "date", F.col("banks_live").cast("long").alias("banks_live"), "value")


@query(f"WITH {PANEL} SELECT form, bank_name, card_type, month, outstanding FROM panel, (VALUES ('csv'), ('parquet')) f(form)")
def a5_both_forms(spark, sf):
    rows = fx.panel(spark, sf).select(*KEY, "month", "outstanding")
    parquet, csv = readers.write_both(rows, readers.scratch(spark, "panel"))
    schema = "bank_name string, card_type string, month date, outstanding double"
    return readers.monthly_table(spark, parquet, schema, "month").withColumn("form", F.lit("parquet")).unionByName(readers.monthly_table(spark, csv, schema, "month").withColumn("form", F.lit("csv")))


@query(f"WITH {PANEL} SELECT card_type, lower(replace(bank_name, 'NATION_', 'n._')) || '_x' AS bank_name_slug, count(*) AS n, round(sum(outstanding), 2) AS total FROM panel GROUP BY 1, 2".replace("'n._'", "'n_'"))
def a6_entity_outputs(spark, sf):
    rows = fx.panel(spark, sf).withColumn("bank_name", F.concat(F.replace("bank_name", F.lit("NATION_"), F.lit("N./")), F.lit(" X")))
    back = spark.read.parquet(readers.write_entities(rows, readers.scratch(spark, "banks"), "card_type", "bank_name"))
    return back.groupBy("card_type", "bank_name_slug").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("outstanding"), 2).alias("total"))


@query("""SELECT 'orders' AS model_type, o_orderkey AS id, CAST(o_orderdate AS DATE) AS forecast_month, o_totalprice AS yhat, 'CC' AS card_type FROM orders
UNION ALL SELECT 'customers', c_custkey, NULL, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT 'events', event_id, CAST(ts AS DATE), value, NULL FROM events""")
def a8_harmonised(spark, sf):
    """Tables with other names for the same columns, under one schema with the table's name."""
    tables = {n: table(spark, sf, n if n != "customers" else "customer") for n in ("orders", "customers", "events")}
    columns = {"id": ["o_orderkey", "c_custkey", "event_id"], "forecast_month": ["ds", "o_orderdate", "ts"], "yhat": ["forecast", "o_totalprice", "c_acctbal", "value"], "card_type": ["c_mktsegment"]}
    out = serving.harmonised(tables, columns, {"orders": {"card_type": F.upper(F.lit("cc"))}})
    return out.withColumn("forecast_month", F.col("forecast_month").cast("date"))


@query("""WITH h AS (SELECT source, sha256(string_agg(sha256(coalesce(text, '')), '' ORDER BY doc_id)) AS hash FROM documents GROUP BY 1)
SELECT source, hash, CASE WHEN hash < '8' THEN 're-run' ELSE 'new' END AS verdict FROM h""")
def a9_combined_hash(spark, sf):
    """One hash of each source's texts; the ledger knows those that begin with a digit below 8, and other hashes for the rest."""
    docs = table(spark, sf, "documents").select("source", "doc_id", "text")
    now = serving.combined_hash(docs, "source", "doc_id", "text", docs.select("source", F.lit("").alias("hash")).limit(0))
    ledger = now.select("source", F.when(F.col("hash") < "8", F.col("hash")).otherwise("gone").alias("hash"))
    return serving.combined_hash(docs, "source", "doc_id", "text", ledger)


@query("""WITH l AS (SELECT source, CAST(doc_id AS VARCHAR) AS path, sha256(coalesce(text, '')) AS h FROM documents), p AS (SELECT source, substr(sha256(path), 1, 3) AS part, count(*) AS n, sha256(string_agg(h, '' ORDER BY path, h)) AS h FROM l GROUP BY 1, 2)
SELECT source, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(h, '' ORDER BY part)) AS hash FROM p GROUP BY 1""")
def a9_tree_hash(spark, sf):
    """One hash of each source's texts, as a tree over parts of their ids."""
    return serving.tree_hash(table(spark, sf, "documents"), "source", "doc_id", "text")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, TRUE AS count_is_near, TRUE AS quantiles_are_near FROM events GROUP BY 1")
def e14_e5_daily_sketches(spark, sf):
    """Users and quantiles of each event type from sketches kept by day: within 3 % of the exact count, and of the wanted ranks."""
    events, path, shares = table(spark, sf, "events"), readers.scratch(spark, "sketches"), [0.1, 0.5, 0.9]
    sketches.daily_sketches(events, ["event_type"], F.to_date("ts"), "user_id", "value").write.parquet(path)
    found = sketches.merged(spark.read.parquet(path), ["event_type"], shares)
    rank = [F.avg((F.col("value") <= F.get("quantiles", F.lit(i))).cast("double")) - s for i, s in enumerate(shares)]
    exact = events.join(F.broadcast(found.drop("n")), "event_type").groupBy("event_type", "n_distinct").agg(F.countDistinct("user_id").alias("n_users"), *(r.alias(f"_r{i}") for i, r in enumerate(rank)))  # one row an event type
    near = (F.abs("_r0") < 0.03) & (F.abs("_r1") < 0.03) & (F.abs("_r2") < 0.03)
    return exact.join(found.select("event_type", "n"), "event_type").select("event_type", "n", "n_users", (F.abs(F.col("n_distinct") - F.col("n_users")) <= 0.03 * F.col("n_users")).alias("count_is_near"), near.alias("quantiles_are_near"))


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' LTD.' WHEN 1 THEN upper(p_name) WHEN 2 THEN ' ' || p_name || '-o''neil 3RD Co' ELSE p_name END AS raw FROM part),
k AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(upper(trim(raw)), '\\b(LIMITED|LTD|PVT|PRIVATE|CORPORATION|CORP|CO)\\b\\.?', ' ', 'g'), '\\s+', ' ', 'g'), '^[\\s.,\\-]+|[\\s.,\\-]+$', '', 'g') AS key FROM n)
SELECT p_partkey, CASE key WHEN 'SMALL RING' THEN 'The Ring' WHEN 'BLUE BOLT' THEN 'Bolt & Sons' ELSE array_to_string(list_transform(regexp_extract_all(lower(trim(raw)), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || substr(w, 2)), '') END AS canonical FROM k""")
def b7_canonical_names(spark, sf):
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.concat("p_name", F.lit(" LTD."))).when(k == 1, F.upper("p_name")).when(k == 2, F.concat(F.lit(" "), "p_name", F.lit("-o'neil 3RD Co"))).otherwise(F.col("p_name"))
    rows = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return cleaning.canonical_names(rows, "raw", [("SMALL RING", "The Ring"), ("BLUE BOLT", "Bolt & Sons")]).select("p_partkey", "canonical")


@query("""WITH p AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages),
l AS (SELECT page_id, unnest(h) AS href, trim(regexp_replace(unnest(t), '<[^>]+>', '', 'g')) AS text FROM p) SELECT page_id, href, text, count(*) AS n FROM l WHERE href <> '' AND text <> '' AND regexp_matches(text || ' ' || href, '(?i)the|der') GROUP BY 1, 2, 3""")
def b11_links_about(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.explode(parse.about(parse.links(F.col("html")), ["the", "der"])).alias("l"))
    return rows.groupBy("page_id", F.col("l.href").alias("href"), F.col("l.text").alias("text")).agg(F.count(F.lit(1)).alias("n"))


def _sheet_columns(spark, sf):
    """Columns of a sheet for each series, with sections, labels and units; a sheet's name tells how far they are shifted, and where a unit is missing."""
    spec = spark.createDataFrame([(0, None, "Name", None), (1, "8 Cards Outstanding", "Credit Cards", "Number"), (2, "9 Payments by Card", "Credit Cards", "Volume (Lakh)"), (3, "9 Payments by Card", "Credit Cards", "Value (Cr)"), (4, "9 Payments by Card", "Debit Cards", "Volume (Lakh)")], "col int, section string, label string, unit string")
    sheets = fx.panel(spark, sf).select(F.col("card_type").alias("file"), F.col("bank_name").alias("sheet")).distinct()
    shift = _shift()
    unit = F.when((F.col("col") != 4) | (shift < 2), F.col("unit"))
    return sheets.crossJoin(F.broadcast(spec)).withColumns({"unit": unit, "col": F.col("col") + shift})  # five columns


def _shift():
    return F.ascii(F.right("sheet", F.lit(1))) % 3


@query(f"WITH {PANEL} SELECT DISTINCT card_type AS file, bank_name AS sheet, target, CASE WHEN target <> 'debit_volume' OR ascii(right(bank_name, 1)) % 3 < 2 THEN c + ascii(right(bank_name, 1)) % 3 END AS col FROM panel, (VALUES ('cards', 1), ('credit_volume', 2), ('credit_value', 3), ('debit_volume', 4), ('debit_cards', NULL)) t(target, c)")
def g3_columns_by_section(spark, sf):
    specs = {"cards": {"section": ["outstanding"], "column": ["credit"]}, "credit_volume": {"section_not": ["outstanding"], "column": ["credit"], "unit": ["volume"]}, "credit_value": {"section": ["payments"], "column": ["credit"], "unit": ["value"]}, "debit_volume": {"column": ["DEBIT"], "unit": ["volume"]}, "debit_cards": {"section": ["outstanding"], "column": ["debit"]}}
    return grid.resolved_by_section(_sheet_columns(spark, sf), specs)


@query(f"WITH {PANEL} SELECT DISTINCT card_type AS file, bank_name AS sheet, CASE card_type WHEN 'cc' THEN 3 ELSE 2 END + ascii(right(bank_name, 1)) % 3 AS col, CASE card_type WHEN 'cc' THEN 'span' ELSE 'banner' END AS how FROM panel WHERE card_type <> 'cc' OR ascii(right(bank_name, 1)) % 3 < 2")
def g5_group_columns(spark, sf):
    """In one form the word stands inside the group's span, in the other above its name; columns are shifted by sheet, and some spans lack the word."""
    span = [(0, 1, "Debit Cards"), (0, 2, "Credit Cards"), (0, 3, "Credit Cards"), (0, 4, "Other"), (1, 1, "Outstanding"), (1, 2, "Volume"), (1, 3, "No. of outstanding cards"), (1, 4, "Outstanding")]
    banner = [(0, 1, "Number - Outstanding"), (0, 2, "Number - Outstanding"), (1, 1, "Debit Cards"), (1, 2, "Credit Cards"), (1, 3, "Credit Cards at POS"), (2, 2, "Number"), (2, 3, "Volume")]
    cells = spark.createDataFrame([("cc", *x) for x in span] + [("dc", *x) for x in banner], "file string, row int, col int, value string")
    sheets = fx.panel(spark, sf).select(F.col("card_type").alias("file"), F.col("bank_name").alias("sheet")).distinct()
    cells = sheets.join(F.broadcast(cells), "file")  # fifteen header cells
    value = F.when((F.col("file") == "cc") & (_shift() == 2) & (F.col("row") == 1) & (F.col("col") == 3), F.lit("No. of cards")).otherwise(F.col("value"))
    return grid.group_columns(cells.withColumns({"value": value, "col": F.col("col") + _shift()}), "credit cards")


@query(f"WITH {_CELLS} SELECT file, sheet, row, max(CASE WHEN col = 1 THEN TRY_CAST(value AS DOUBLE) END) + coalesce(max(CASE WHEN col = 2 THEN TRY_CAST(value AS DOUBLE) END), 0) AS both FROM cells WHERE row >= 3 AND col > 0 GROUP BY 1, 2, 3")
def g7_summed_targets(spark, sf):
    """The sum of two targets where both are there, else the first."""
    cells = _cells(spark, sf)
    columns = grid.resolved_targets(grid.signatures(grid.filled_headers(cells, 3)), {"amount": [["amount"]], "volume": [["volume"]]})
    rows = grid.extracted(cells, columns, 3, ["amount", "volume"], parse.number(F.col("value")))
    return rows.select("file", "sheet", "row", grid.summed(F.col("amount"), F.col("volume")).alias("both"))


@query("""SELECT DISTINCT source AS file, CASE doc_id % 5 WHEN 0 THEN 'Summary' WHEN 1 THEN 'chart 1' WHEN 2 THEN 'PSI old' WHEN 3 THEN 'New PSI' ELSE 'Other' END AS sheet, CASE doc_id % 5 WHEN 2 THEN 'old' WHEN 3 THEN 'new' END AS format FROM documents WHERE doc_id % 5 > 1""")
def g8_sheet_formats(spark, sf):
    """Summary and chart sheets are left out; the first mark in a sheet's name tells its format."""
    k = F.pmod("doc_id", F.lit(5))
    sheet = F.when(k == 0, "Summary").when(k == 1, "chart 1").when(k == 2, "PSI old").when(k == 3, "New PSI").otherwise("Other")
    cells = table(spark, sf, "documents").select(F.col("source").alias("file"), sheet.alias("sheet"))
    return grid.sheet_formats(grid.data_sheets(cells), [("new", "new psi"), ("old", "psi")])


@query(f"""WITH {PANEL}, {MACRO}, x AS (SELECT bank_name, card_type, month, unnest(['m1', 'flat']) AS name, unnest([m1, 5.0]) AS v FROM panel p LEFT JOIN (SELECT * FROM macro WHERE month(month) > 2) e USING (month)),
y AS (SELECT bank_name, card_type, month, name, CASE WHEN name = 'flat' THEN 5.0 ELSE coalesce(v, 0) END AS value FROM x) SELECT bank_name, card_type, month, name, round(value, 4) AS value FROM y WHERE name = 'm1'""")
def h7_extra_regressors(spark, sf):
    """Months that the extra table lacks get 0; a column that is constant in a series is left out of it."""
    extra = fx.macro(spark, sf).filter("month(month) > 2").select("month", "m1", F.lit(0.0).alias("flat"))
    out = features.with_extra_regressors(fx.panel(spark, sf), extra, KEY, "month", ["m1", "flat"])
    return out.select(*KEY, "month", "name", F.round("value", 4).alias("value"))


@query("""SELECT o_custkey, d AS day, v, kind FROM (
 WITH o AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS d, o_orderkey, o_totalprice AS v FROM orders),
 a AS (SELECT o_custkey, d, arg_min(v, (o_orderkey)) AS v FROM o WHERE o_orderkey % 3 = 0 GROUP BY 1, 2), b AS (SELECT o_custkey, d, arg_min(v, o_orderkey) AS v FROM o WHERE o_orderkey % 3 = 1 GROUP BY 1, 2)
 SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.d, b.d) AS d, coalesce(b.v, a.v) AS v, CASE WHEN b.v IS NULL THEN 'kept' WHEN a.v IS NULL THEN 'new' ELSE 'updated' END AS kind FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.d = b.d)""")
def c3_merged_records(spark, sf):
    """Of a batch's records for one key the first counts."""
    o = table(spark, sf, "orders").select("o_custkey", F.trunc("o_orderdate", "YEAR").alias("day"), "o_orderkey", F.col("o_totalprice").alias("v"))
    old = o.filter("o_orderkey % 3 = 0").groupBy("o_custkey", "day").agg(F.min_by("v", "o_orderkey").alias("v"))
    return cleaning.merged_records(old, o.filter("o_orderkey % 3 = 1"), ["o_custkey", "day"], "o_orderkey")


@query(f"WITH {PANEL}, w AS (SELECT bank_name, card_type, lag(month) OVER (PARTITION BY bank_name, card_type ORDER BY month) AS since, month AS until FROM panel) SELECT *, CAST(datediff('day', since, until) AS INTEGER) AS days FROM w WHERE datediff('day', since, until) > 35")
def c7_gaps(spark, sf):
    return cleaning.gaps(fx.panel(spark, sf), KEY, "month")


@query(f"WITH {PANEL} SELECT card_type, CASE card_type WHEN 'cc' THEN 'outstanding,txn_vol' ELSE 'outstanding' END AS optional, count(*) AS n FROM panel GROUP BY 1")
def c6_split_tables(spark, sf):
    """A table for each type; a column without any value in a type isn't in its table."""
    rows = fx.panel(spark, sf).withColumn("txn_vol", F.when(F.col("card_type") == "cc", F.col("txn_vol")))
    parts = cleaning.split_by_type(rows, "card_type", ["cc", "dc"], ["outstanding", "txn_vol"])
    one = lambda t: t.groupBy("card_type").agg(F.lit(",".join(c for c in t.columns if c in ("outstanding", "txn_vol"))).alias("optional"), F.count(F.lit(1)).alias("n"))
    return one(parts["cc"]).unionByName(one(parts["dc"]))


@query("""WITH m AS (SELECT event_type, CAST(date_trunc('month', max(ts)) AS DATE) AS last, CAST(date_trunc('month', DATE '2024-06-01' - 62) AS DATE) AS expected FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-02' GROUP BY 1)
SELECT event_type, last, expected, CAST(greatest(0, datediff('month', last, expected)) AS INTEGER) AS months_behind FROM m""")
def s4_expected_months(spark, sf):
    """Against the month of 62 days before the first of a given day's month."""
    runs = table(spark, sf, "events").filter("event_type <> 'view' or ts < timestamp'2024-01-02'")
    return serving.months_behind(runs, "event_type", "ts", F.lit("2024-06-17").cast("date"))


def _stream(spark, sf):
    events = table(spark, sf, "events")
    return ingest.event_stream(spark, f"{sf}/events.parque[t]", events.schema, 4)


def _batches(spark, sf):
    """The events as several files, read one a micro-batch, in no order of time."""
    events, path = table(spark, sf, "events"), readers.scratch(spark, "events")
    events.repartition(5, "event_id").write.parquet(path)
    return ingest.event_stream(spark, path, events.schema, 1)


@query("SELECT DISTINCT user_id, event_type FROM events")
def s1_stream_first_of_key(spark, sf):
    """De-duplicated as files come in; equals the batch, as nothing is later than the watermark allows."""
    path = readers.scratch(spark, "first")
    return ingest.to_files(ingest.first_of_each(_stream(spark, sf), ["user_id", "event_type"], "ts", "400 days").select("user_id", "event_type"), path, f"{path}-state")


@query("SELECT event_id, user_id, event_type, value, ts::TIMESTAMP AS ts FROM events")
def s1_stream_redelivered(spark, sf):
    """Every event comes twice, in other micro-batches; each is taken in once, with all its columns."""
    events, path = table(spark, sf, "events"), readers.scratch(spark, "redelivered")
    for seed in (3, 4):
        events.repartition(2, F.xxhash64("event_id", F.lit(seed))).write.mode("append").parquet(path)
    stream = ingest.event_stream(spark, path, events.schema, 1)
    once = ingest.first_of_each(stream, ["event_id"], "ts", "400 days")
    return ingest.to_files(once.select("event_id", "user_id", "event_type", "value", "ts"), f"{path}-out", f"{path}-state")


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2")
def s2_stream_daily_rollup(spark, sf):
    """All days that the watermark has closed."""
    path = readers.scratch(spark, "daily")
    rolled = ingest.to_files(ingest.daily_rollup(_stream(spark, sf), "ts", "event_type", "value"), path, f"{path}-state")
    return rolled.withColumn("total", F.col("total").cast("double"))


@query("""SELECT user_id, max(ts)::TIMESTAMP AS last, count(*) AS n, CASE WHEN max(ts) < (SELECT max(ts) FROM events) - INTERVAL 1 DAY THEN 'late' ELSE 'ok' END AS status FROM events GROUP BY 1""")
def s4_stream_status(spark, sf):
    """The latest event of each user and whether none has come for a day, kept as state over micro-batches in order of time."""
    events, path = table(spark, sf, "events"), readers.scratch(spark, "ordered")
    cuts = events.agg(F.percentile_approx(F.col("ts").cast("timestamp").cast("long"), [0.25, 0.5, 0.75])).first()[0]
    seconds = F.col("ts").cast("timestamp").cast("long")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):  # a file set for each quarter, one after another
        part = events.filter(F.lit(True) if low is None else seconds > low).filter(F.lit(True) if high is None else seconds <= high)
        part.coalesce(1).write.mode("append").parquet(path)
    stream = ingest.event_stream(spark, path, events.schema, 1)
    out = ingest.upsert_stream(status.status_stream(stream, "user_id", "ts", 1), f"{path}-out", ["user_id"], "change", f"{path}-state", mode="update")
    return out.select("user_id", "last", "n", "status")


@query("SELECT user_id, arg_max(value, (ts, value)) AS value, max(ts)::TIMESTAMP AS ts FROM events GROUP BY 1")
def s3_stream_upsert(spark, sf):
    """The latest event of each user, merged over several micro-batches."""
    path = readers.scratch(spark, "latest")
    return ingest.upsert_stream(_batches(spark, sf).select("user_id", "value", "ts"), path, ["user_id"], "ts", f"{path}-state", bucket_rows=1000)


@query("SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def s2_stream_monthly_rollup(spark, sf):
    """Calendar months that grow over several micro-batches; the greatest count of a month is its latest state."""
    path = readers.scratch(spark, "monthly")
    rolled = ingest.monthly_rollup(_batches(spark, sf), "ts", "event_type", "value", "400 days")
    out = ingest.upsert_stream(rolled, path, ["month", "event_type"], "n", f"{path}-state", mode="update")
    return out.select(F.col("month").cast("date").alias("month"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query(f"WITH {PANEL}, b AS (SELECT bank_name, card_type, month, lag(month) OVER (PARTITION BY bank_name, card_type ORDER BY month) AS since FROM panel) SELECT card_type, count(*) AS n, count(*) FILTER (WHERE since IS NULL) AS n_first FROM b GROUP BY 1")
def f9_row_index(spark, sf):
    rows = fx.panel(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy(*KEY).orderBy("month")))
    return rows.groupBy("card_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("i") == 1).alias("n_first"))

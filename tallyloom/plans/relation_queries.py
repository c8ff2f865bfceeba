"""Registered queries of tests on series and between them, from sums of products, with SQL that solves the same equations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import evaluate, gram, profile
from tallyloom.plans.queries import KEY, query
from tallyloom.sources import fixtures as fx
from tallyloom.sources.fixtures import PANEL

# ---- the same in SQL: tail probabilities as sums of positive terms, elimination as a recursive table ----


def sql_beta(a: str, b: str, x: str) -> str:
    def series(a: str, b: str, x: str) -> str:
        return f"list_sum(list_transform(range(0, 600), lambda q: exp(lgamma({a} + {b} + q) - lgamma({b}) - lgamma({a} + 1 + q) + ({a} + q) * ln(greatest({x}, 1e-300)) + ({b}) * ln(greatest(1 - ({x}), 1e-300)))))"

    return f"(CASE WHEN {x} <= 0 THEN 0.0 WHEN {x} >= 1 THEN 1.0 WHEN {x} <= ({a} + 1) / ({a} + {b} + 2) THEN {series(a, b, x)} ELSE 1 - {series(b, a, f'(1 - {x})')} END)"


def sql_f_tail(f: str, d1: str, d2: str) -> str:
    return f"(CASE WHEN {f} <= 0 THEN 1.0 ELSE {sql_beta(f'({d2} / 2.0)', f'({d1} / 2.0)', f'({d2} / ({d2} + {d1} * {f}))')} END)"


def sql_t_tail(t: str, d: str) -> str:
    return sql_beta(f"({d} / 2.0)", "0.5", f"({d} / ({d} + {t} * {t}))")


def sql_chi2_tail(x: str, k: str) -> str:
    return f"(CASE WHEN {x} <= 0 THEN 1.0 ELSE 1 - list_sum(list_transform(range(0, 400), lambda q: exp(({k} / 2.0 + q) * ln(greatest({x} / 2, 1e-300)) - {x} / 2 - lgamma({k} / 2.0 + q + 1)))) END)"


def sql_normal(z: str) -> str:
    erf = f"list_sum(list_transform(range(0, 400), lambda q: exp((2 * q + 1) * ln(greatest(abs({z}) / sqrt(2.0), 1e-300)) - {z} * {z} / 2 - lgamma(q + 1.5))))"
    return f"(0.5 * (1 + sign({z}) * {erf}))"


def sql_elimination(name: str, source: str, keys: str, pivots: int, width: int, penalty: list[float] | None = None, both: bool = False) -> str:
    """CTE with (keys, n, m, rss): rows v (a list) of `source` summed to a matrix, its first columns taken out (both: above the pivots too)."""
    m = "[" + ", ".join("[" + ", ".join(f"sum(v[{min(i, j)}] * v[{max(i, j)}])" + (f" + {penalty[i - 1]}" if penalty and i == j <= len(penalty) else "") for j in range(1, width + 1)) + "]" for i in range(1, width + 1)) + "]"
    return f"""{name}_g AS (SELECT {keys}, count(*) AS n, {m} AS m FROM {source} GROUP BY {keys}),
{name}_e AS (SELECT {keys}, n, 0 AS k, m, [m[{width}][{width}]] AS rss FROM {name}_g
  UNION ALL SELECT {keys}, n, k + 1, m2, list_append(rss, m2[{width}][{width}]) FROM (SELECT *, CASE WHEN m[k + 1][k + 1] > 1e-10 * n
    THEN list_transform(m, lambda r, i: CASE WHEN i {'=' if both else '<='} k + 1 THEN r ELSE list_transform(r, lambda x, j: x - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) ELSE m END AS m2 FROM {name}_e WHERE k < {pivots})),
{name} AS (SELECT * FROM {name}_e WHERE k = {pivots})"""


#: Lags that the SQL has room for: series of up to 400 months.
WIDE = 17


def sql_unit_root(keys: str) -> str:
    """CTEs that end in adf(keys, n, stat, lags, p), over src(keys, month, v)."""
    lags = ", ".join(f"coalesce(lag(d, {j}) OVER w, 0)" for j in range(1, WIDE + 1))
    padded = f"list_transform(range(1, {WIDE + 1}), lambda j: CASE WHEN j <= LIMIT THEN dl[j] ELSE 0 END)"
    surface = "CASE WHEN stat <= -1.61 THEN 2.1659 + 1.4412 * stat + 0.038269 * stat * stat ELSE 1.7339 + 0.93202 * stat - 0.12745 * stat * stat - 0.010368 * stat * stat * stat END"
    return f"""adf_z AS (SELECT {keys}, month, CASE WHEN max(v) OVER g > min(v) OVER g THEN (v - avg(v) OVER g) / stddev_pop(v) OVER g END AS z, count(*) OVER g AS all_n, row_number() OVER (PARTITION BY {keys} ORDER BY month) AS t FROM src WHERE v IS NOT NULL WINDOW g AS (PARTITION BY {keys})),
adf_d AS (SELECT *, greatest(0, least(CAST(ceil(12 * power(all_n / 100.0, 0.25)) AS BIGINT), all_n // 2 - 2)) AS most, lag(z) OVER w AS y, z - lag(z) OVER w AS d FROM adf_z WINDOW w AS (PARTITION BY {keys} ORDER BY t)),
adf_l AS (SELECT * FROM (SELECT *, [{lags}] AS dl FROM adf_d WINDOW w AS (PARTITION BY {keys} ORDER BY t)) WHERE all_n >= 20 AND z IS NOT NULL),
adf_v AS (SELECT {keys}, most, list_concat(list_concat([1.0, y], {padded.replace('LIMIT', 'most')}), [d]) AS v FROM adf_l WHERE t >= most + 2),
{sql_elimination('adf_1', 'adf_v', f'{keys}, most', WIDE + 2, WIDE + 3)},
adf_k AS (SELECT {keys}, first(l ORDER BY aic, l) AS lags FROM (SELECT {keys}, l, n * ln(greatest(rss[l + 3], 1e-300) / n) + 2 * (l + 2) AS aic FROM (SELECT *, unnest(range(0, most + 1)) AS l FROM adf_1)) GROUP BY {keys}),
adf_w AS (SELECT {keys}, lags, list_concat(list_concat([1.0], {padded.replace('LIMIT', 'lags')}), [y, d]) AS v FROM adf_l JOIN adf_k USING ({keys}) WHERE t >= lags + 2),
{sql_elimination('adf_2', 'adf_w', f'{keys}, lags', WIDE + 1, WIDE + 3)},
adf_s AS (SELECT {keys}, lags, CASE WHEN xx > 1e-10 * n AND yy - xy * xy / xx > 0 THEN xy / xx / sqrt((yy - xy * xy / xx) / (n - lags - 2) / xx) END AS stat FROM (SELECT *, m[{WIDE + 2}][{WIDE + 2}] AS xx, m[{WIDE + 2}][{WIDE + 3}] AS xy, m[{WIDE + 3}][{WIDE + 3}] AS yy FROM adf_2)),
adf_p AS (SELECT *, {surface} AS surface FROM adf_s),
adf AS (SELECT {keys}, c.n, stat, lags, CASE WHEN stat IS NULL OR stat > 2.74 THEN 1.0 WHEN stat < -18.83 THEN 0.0 ELSE {sql_normal('surface')} END AS p FROM (SELECT {keys}, count(*) AS n FROM src WHERE v IS NOT NULL GROUP BY {keys}) c LEFT JOIN adf_p USING ({keys}))"""


@query(f"""WITH RECURSIVE {PANEL}, src AS (SELECT bank_name, card_type, 0 AS diff_order, month, outstanding AS v FROM panel UNION ALL SELECT bank_name, card_type, 1, month, outstanding - lag(outstanding) OVER (PARTITION BY bank_name, card_type ORDER BY month) FROM panel),
{sql_unit_root('bank_name, card_type, diff_order')}
SELECT bank_name, card_type, diff_order, n, CAST(lags AS INTEGER) AS lags, round(stat, 5) AS stat, round(p, 6) AS p, p < 0.05 AS stationary FROM adf""")
def j1_stationarity(spark, sf):
    """Unit-root tests of levels and of first differences."""
    both = gram.differenced(fx.panel(spark, sf), KEY, "month", "outstanding").filter("order < 2").withColumnRenamed("order", "diff_order")
    tests = gram.unit_root(both, [*KEY, "diff_order"], "month", "outstanding")
    return tests.select(*KEY, "diff_order", "n", "lags", F.round("stat", 5).alias("stat"), F.round("p", 6).alias("p"), (F.col("p") < 0.05).alias("stationary"))


_LINE = f"""{PANEL}, r AS (SELECT bank_name, card_type, outstanding AS v, row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS t FROM panel),
d AS (SELECT bank_name, card_type, t, v - regr_intercept(v, t) OVER g - t * regr_slope(v, t) OVER g AS e FROM r WINDOW g AS (PARTITION BY bank_name, card_type)),
s AS (SELECT bank_name, card_type, count(*) AS n, list(e ORDER BY t) AS e, sum(e * e) AS e0 FROM d GROUP BY 1, 2)"""


def sql_autocovariance(lag: str) -> str:
    return f"coalesce(list_sum(list_transform(range(1, n - {lag} + 1), lambda q: e[q] * e[q + {lag}])), 0)"


@query(f"""WITH {_LINE}, sq AS (SELECT bank_name, card_type, sum(part * part) AS squares FROM (SELECT bank_name, card_type, sum(e) OVER (PARTITION BY bank_name, card_type ORDER BY t) AS part FROM d) GROUP BY 1, 2),
a AS (SELECT bank_name, card_type, i, {sql_autocovariance('i')} / (n / 2.0) AS g FROM (SELECT *, unnest(range(1, CAST(floor(power(n, 2.0 / 9)) AS BIGINT) + 1)) AS i FROM s)),
c0 AS (SELECT bank_name, card_type, sum(i * g) AS s1, sum(g) AS s0 FROM a GROUP BY 1, 2),
c AS (SELECT s.*, least(CAST(floor(1.1447 * power(power(s1 / (e0 / n + s0), 2), 1.0 / 3) * power(n, 1.0 / 3)) AS BIGINT), n - 1) AS lags FROM s JOIN c0 USING (bank_name, card_type) WHERE n >= 20),
l AS (SELECT *, coalesce(list_sum(list_transform(range(1, lags + 1), lambda i: (1 - i / (lags + 1.0)) * {sql_autocovariance('i')})), 0) AS weighted FROM c),
k AS (SELECT bank_name, card_type, n, lags, squares / (n * n) / ((e0 + 2 * weighted) / n) AS stat FROM l JOIN sq USING (bank_name, card_type))
SELECT bank_name, card_type, CAST(n AS INTEGER) AS n, CAST(lags AS INTEGER) AS lags, round(stat, 6) AS stat,
 round(CASE WHEN stat <= 0.119 THEN 0.1 WHEN stat <= 0.146 THEN 0.1 - 0.05 * (stat - 0.119) / 0.027 WHEN stat <= 0.176 THEN 0.05 - 0.025 * (stat - 0.146) / 0.03 WHEN stat <= 0.216 THEN 0.025 - 0.015 * (stat - 0.176) / 0.04 ELSE 0.01 END, 6) AS p FROM k""")
def j2_trend_stationarity(spark, sf):
    """Tests whether series are stationary about a line."""
    tests = gram.trend_stationarity(fx.panel(spark, sf), KEY, "month", "outstanding")
    return tests.select(*KEY, "n", "lags", F.round("stat", 6).alias("stat"), F.round("p", 6).alias("p"))


@query(f"""WITH {_LINE}, q AS (SELECT bank_name, card_type, n, lags, CASE WHEN n > lags + 1 THEN n * (n + 2) * list_sum(list_transform(range(1, lags + 1), lambda i: power({sql_autocovariance('i')} / e0, 2) / (n - i))) END AS stat FROM s CROSS JOIN (VALUES (6), (12)) l(lags))
SELECT bank_name, card_type, CAST(n AS INTEGER) AS n, lags, round(stat, 5) AS q, round(CASE WHEN stat IS NOT NULL THEN {sql_chi2_tail('stat', 'lags')} END, 6) AS p FROM q""")
def j5_residual_autocorrelation(spark, sf):
    """Whether what a line leaves of each series is related over 6 and over 12 months."""
    tests = gram.residual_autocorrelation(fx.panel(spark, sf), KEY, "month", "outstanding")
    return tests.select(*KEY, "n", "lags", F.round("q", 5).alias("q"), F.round("p", 6).alias("p"))


_SIX = range(1, 7)
_GRANGER = f"""{PANEL}, pr AS (SELECT bank_name, card_type, month, outstanding AS y, txn_vol AS x, count(*) OVER (PARTITION BY bank_name, card_type) AS all_rows FROM panel WHERE outstanding IS NOT NULL AND txn_vol IS NOT NULL),
lg AS (SELECT bank_name, card_type, 'y' AS side, month, y AS v FROM pr WHERE all_rows >= 30 UNION ALL SELECT bank_name, card_type, 'x', month, x FROM pr WHERE all_rows >= 30),
src AS (SELECT bank_name, card_type, side, 0 AS diff_order, month, v FROM lg UNION ALL SELECT bank_name, card_type, side, 1, month, v - lag(v) OVER (PARTITION BY bank_name, card_type, side ORDER BY month) FROM lg),
{sql_unit_root('bank_name, card_type, side, diff_order')},
od AS (SELECT bank_name, card_type, max(CASE WHEN side = 'y' THEN o END) AS y_order, max(CASE WHEN side = 'x' THEN o END) AS x_order FROM (SELECT bank_name, card_type, side, CASE WHEN max(CASE WHEN diff_order = 0 THEN p END) < 0.05 THEN 0 WHEN max(CASE WHEN diff_order = 1 THEN p END) < 0.05 THEN 1 ELSE 2 END AS o FROM adf GROUP BY 1, 2, 3) GROUP BY 1, 2),
df AS (SELECT *, y - lag(y) OVER w AS y1, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS y2, x - lag(x) OVER w AS x1, x - 2 * lag(x) OVER w + lag(x, 2) OVER w AS x2 FROM pr JOIN od USING (bank_name, card_type) WINDOW w AS (PARTITION BY bank_name, card_type ORDER BY month)),
mv AS (SELECT bank_name, card_type, month, y_order, x_order, CASE y_order WHEN 0 THEN y WHEN 1 THEN y1 ELSE y2 END AS y, CASE x_order WHEN 0 THEN x WHEN 1 THEN x1 ELSE x2 END AS x FROM df),
st AS (SELECT bank_name, card_type, month, y_order, x_order, count(*) OVER g AS all_n, (y - avg(y) OVER g) / nullif(stddev_pop(y) OVER g, 0) AS y, (x - avg(x) OVER g) / nullif(stddev_pop(x) OVER g, 0) AS x FROM mv WHERE y IS NOT NULL AND x IS NOT NULL WINDOW g AS (PARTITION BY bank_name, card_type)),
wy AS (SELECT bank_name, card_type, y_order, x_order, month, all_n, 'forward' AS direction, y AS e, x AS c FROM st UNION ALL SELECT bank_name, card_type, y_order, x_order, month, all_n, 'reverse', x, y FROM st),
la AS (SELECT *, row_number() OVER w AS t, [{', '.join(f'lag(e, {k}) OVER w' for k in _SIX)}] AS el, [{', '.join(f'lag(c, {k}) OVER w' for k in _SIX)}] AS cl FROM wy WINDOW w AS (PARTITION BY bank_name, card_type, direction ORDER BY month)),
vs AS (SELECT bank_name, card_type, direction, y_order, x_order, lag_n, list_concat(list_concat([1.0], list_concat(list_transform(range(1, 7), lambda j: CASE WHEN j <= lag_n THEN el[j] ELSE 0 END), list_transform(range(1, 7), lambda j: CASE WHEN j <= lag_n THEN cl[j] ELSE 0 END))), [e]) AS v
  FROM la CROSS JOIN (SELECT unnest(range(1, 7)) AS lag_n) WHERE t > lag_n AND lag_n <= CASE WHEN all_n < 16 THEN greatest(1, all_n // 5) ELSE 6 END),
{sql_elimination('gr', 'vs', 'bank_name, card_type, direction, y_order, x_order, lag_n', 13, 14)},
ft AS (SELECT *, n - 2 * lag_n - 1 AS free, CASE WHEN n - 2 * lag_n - 1 > 0 AND rss[14] > 0 THEN (rss[8] - rss[14]) / lag_n / (rss[14] / (n - 2 * lag_n - 1)) END AS f FROM gr),
pt AS (SELECT *, CASE WHEN f IS NOT NULL THEN {sql_f_tail('f', 'lag_n', 'free')} END AS p FROM ft),
bt AS (SELECT *, first(lag_n) OVER b AS best, first(p) OVER b AS best_p FROM pt WINDOW b AS (PARTITION BY bank_name, card_type, direction ORDER BY p NULLS LAST, lag_n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
tests AS (SELECT bank_name, card_type, direction, y_order, x_order, CAST(lag_n AS INTEGER) AS lag, n, f, p, CAST(CASE WHEN best_p IS NOT NULL THEN best END AS INTEGER) AS best_lag,
   CASE WHEN best_p < 0.01 THEN 'CONFIRMED (p < 0.01)' WHEN best_p < 0.05 THEN 'CONFIRMED (p < 0.05)' WHEN best_p < 0.1 THEN 'WEAK' ELSE 'NOT CONFIRMED' END AS verdict FROM bt
  UNION ALL SELECT bank_name, card_type, direction, NULL, NULL, 0, all_rows, 0, 1, 0, 'INSUFFICIENT DATA' FROM (SELECT DISTINCT bank_name, card_type, all_rows FROM pr WHERE all_rows < 30) CROSS JOIN (VALUES ('forward'), ('reverse')) v(direction))"""


def _tests(spark, sf):
    return gram.relations(fx.panel(spark, sf), KEY, "month", "outstanding", "txn_vol")


@query(f"WITH RECURSIVE {_GRANGER} SELECT bank_name, card_type, direction, y_order, x_order, lag, n, round(f, 4) AS f, round(p, 6) AS p, best_lag, verdict FROM tests")
def j3_granger(spark, sf):
    return _tests(spark, sf).withColumns({"f": F.round("f", 4), "p": F.round("p", 6)})


@query(f"""WITH RECURSIVE {_GRANGER}, v AS (SELECT bank_name, card_type, count(*) AS n_valid FROM panel WHERE txn_vol IS NOT NULL GROUP BY 1, 2), b AS (SELECT bank_name, card_type, min(p) AS best_p FROM tests WHERE direction = 'forward' AND lag IN (0, 1, 3, 6) GROUP BY 1, 2)
SELECT bank_name, card_type, n_valid, round(best_p, 6) AS best_p, CASE WHEN best_p < 0.01 AND n_valid >= 36 THEN 'USE' WHEN best_p < 0.05 AND n_valid >= 24 THEN 'CONSIDER' WHEN best_p < 0.1 AND n_valid >= 24 THEN 'WEAK' ELSE 'drop' END AS verdict FROM v JOIN b USING (bank_name, card_type)""")
def j4_verdicts(spark, sf):
    """Whether a series is of use as a regressor: by its least p at lags 1, 3 and 6, and its number of values."""
    valid = fx.panel(spark, sf).filter("txn_vol is not null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_valid"))
    best = _tests(spark, sf).filter("direction = 'forward' and lag in (0, 1, 3, 6)").groupBy(*KEY).agg(F.min("p").alias("best_p"))
    return valid.join(best, KEY).select(*KEY, "n_valid", F.round("best_p", 6).alias("best_p"), evaluate.usefulness(F.col("best_p"), F.col("n_valid")).alias("verdict"))


@query(f"WITH RECURSIVE {_GRANGER} SELECT bank_name, card_type, direction, lag, round(p, 6) AS p, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars FROM tests")
def b16_stars(spark, sf):
    """Tests of causality with stars for their p-values."""
    return _tests(spark, sf).select(*KEY, "direction", "lag", F.round("p", 6).alias("p"), evaluate.stars(F.col("p")).alias("stars"))


_REGRESSORS = ["outstanding", "txn_vol", "n_rows", "row_index"]


def _vif(y: str, others: list[str]) -> str:
    """1 / (1 - R2) by the determinants of the correlation matrix with and without a regressor."""
    r = {(a, b): "1.0" if a == b else f"corr({a}, {b})" for a in _REGRESSORS for b in _REGRESSORS}

    def determinant(rows: list[str], columns: list[str]) -> str:
        if not rows:
            return "1.0"
        parts = [f"{'-' if i % 2 else '+'} {r[rows[0], c]} * ({determinant(rows[1:], columns[:i] + columns[i + 1 :])})" for i, c in enumerate(columns)]
        return " ".join(parts)

    return f"({determinant(others, others)}) / ({determinant(_REGRESSORS, _REGRESSORS)})"


@query(f"""WITH {PANEL}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY bank_name, card_type ORDER BY month) AS DOUBLE) AS row_index FROM panel),
w AS (SELECT bank_name, card_type, {', '.join(f'{_vif(c, [o for o in _REGRESSORS if o != c])} AS v_{c}' for c in _REGRESSORS)}, count(*) AS n FROM r GROUP BY 1, 2)
SELECT bank_name, card_type, regressor, round(vif, 4) AS vif, CASE WHEN vif >= 10 THEN 'HIGH' WHEN vif >= 5 THEN 'MODERATE' WHEN vif IS NOT NULL THEN 'LOW' END AS band FROM ({' UNION ALL '.join(f"SELECT bank_name, card_type, '{c}' AS regressor, v_{c} AS vif FROM w" for c in _REGRESSORS)})""")
def j6_inflation(spark, sf):
    """How far each of four regressors is told by the other three."""
    rows = fx.panel(spark, sf).withColumn("row_index", F.row_number().over(Window.partitionBy(*KEY).orderBy("month")).cast("double"))
    v = F.col("vif")
    return gram.inflation(rows, KEY, _REGRESSORS).select(*KEY, "regressor", F.round(v, 4).alias("vif"), F.when(v >= 10, "HIGH").when(v >= 5, "MODERATE").when(v.isNotNull(), "LOW").alias("band"))


_RANKED = "(rank() OVER (PARTITION BY bank_name, card_type, variable, lag ORDER BY {0}) + (count(*) OVER (PARTITION BY bank_name, card_type, variable, lag, {0}) - 1) / 2.0)"


@query(f"""WITH {PANEL}, x AS (SELECT bank_name, card_type, month, outstanding AS a, 'txn_vol' AS variable, txn_vol AS x FROM panel UNION ALL SELECT bank_name, card_type, month, outstanding, 'n_rows', n_rows FROM panel),
g AS (SELECT bank_name, card_type, variable, l.lag, a, CASE l.lag WHEN 0 THEN x WHEN 1 THEN lag(x, 1) OVER w WHEN 3 THEN lag(x, 3) OVER w WHEN 6 THEN lag(x, 6) OVER w END AS b FROM x CROSS JOIN (VALUES (0), (1), (3), (6)) l(lag) WINDOW w AS (PARTITION BY bank_name, card_type, variable, l.lag ORDER BY month)),
r AS (SELECT bank_name, card_type, variable, lag, {_RANKED.format('a')} AS ra, {_RANKED.format('b')} AS rb FROM g WHERE a IS NOT NULL AND b IS NOT NULL),
c AS (SELECT bank_name, card_type, variable, lag, count(*) AS n, corr(ra, rb) AS rho FROM r GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
t AS (SELECT *, rho * sqrt((n - 2) / nullif(1 - rho * rho, 0)) AS t, n - 2 AS free FROM c), p AS (SELECT *, CASE WHEN abs(rho) >= 1 THEN 0.0 WHEN t IS NOT NULL THEN {sql_t_tail('t', 'free')} END AS p FROM t)
SELECT card_type, variable, lag, count(rho) AS n_series, round(median(rho), 6) AS median_rho, round(min(rho), 6) AS min_rho, round(max(rho), 6) AS max_rho, round(min(p), 8) AS least_p, count(*) FILTER (WHERE p < 0.05) AS n_significant FROM p GROUP BY 1, 2, 3""")
def e8_spearman_summary(spark, sf):
    """Rank correlation of each candidate with the target some months later, over all banks."""
    found = profile.lagged_spearman(fx.panel(spark, sf), KEY, "month", "outstanding", ["txn_vol", "n_rows"], [0, 1, 3, 6])
    out = profile.spearman_summary(found, ["card_type", "variable", "lag"])
    return out.select("card_type", "variable", "lag", "n_series", *(F.round(c, 6).alias(c) for c in ("median_rho", "min_rho", "max_rho")), F.round("least_p", 8).alias("least_p"), "n_significant")

"""Registered queries of forecasts by folds over a series, with SQL that runs the same recursions row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import evaluate, folded
from tallyloom.plans.queries import KEY, query
from tallyloom.plans.relation_queries import sql_elimination
from tallyloom.sources import fixtures as fx
from tallyloom.sources.fixtures import PANEL

_K = "bank_name, card_type"
_VALUES = f"""vals AS (SELECT {_K}, row_number() OVER (PARTITION BY {_K} ORDER BY month) AS t, count(*) OVER (PARTITION BY {_K}) AS n, ln(1 + greatest(outstanding, 0)) AS v FROM panel)"""

_GRID = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {g}::DOUBLE)" for a, b, g in folded.SMOOTHING)
_ETS = f"""hi AS (SELECT {_K}, any_value(n) AS n, list(v ORDER BY t) AS y FROM vals WHERE n >= 24 AND t <= 24 GROUP BY {_K}),
hw AS (SELECT {_K}, n, a, b, g, 12::BIGINT AS t, list_sum(y[1:12]) / 12 AS lev, (list_sum(y[13:24]) - list_sum(y[1:12])) / 144 AS trend, list_transform(y[1:12], lambda x: x - list_sum(y[1:12]) / 12) AS seasons, 0.0::DOUBLE AS sse FROM hi CROSS JOIN (VALUES {_GRID}) q(a, b, g)
  UNION ALL SELECT {_K}, n, a, b, g, t + 1, lev + 0.98 * trend + a * err, 0.98 * trend + a * b * err, list_append(seasons[2:12], seasons[1] + g * (1 - a) * err), sse + err * err FROM (SELECT hw.*, v.v - (lev + 0.98 * trend + seasons[1]) AS err FROM hw JOIN vals v ON v.bank_name = hw.bank_name AND v.card_type = hw.card_type AND v.t = hw.t + 1)),
hb AS (SELECT * FROM hw WHERE t = n QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY sse, a, b, g) = 1),
ets AS (SELECT {_K}, step, lev + trend * 0.98 * (1 - power(0.98, step)) / 0.02 + seasons[(step - 1) % 12 + 1] AS yhat FROM hb CROSS JOIN (SELECT unnest(range(1, 7)) AS step))"""


def _round(k: int, wide: float) -> str:
    near = f"greatest(-0.97, least(0.97, {{0}} + {wide!r} * ({{1}} - 6) / 6.0))"
    return f"""p{k} AS (SELECT DISTINCT {_K}, {near.format('phi', 'i')} AS phi, {near.format('theta', 'j')} AS theta FROM b{k - 1} CROSS JOIN (SELECT unnest(range(0, 13)) AS i) CROSS JOIN (SELECT unnest(range(0, 13)) AS j)),
a{k} AS (SELECT p{k}.*, z.t, z.z AS before, 0.0::DOUBLE AS e, 0.0::DOUBLE AS sse FROM p{k} JOIN z USING ({_K}) WHERE z.t = 2
  UNION ALL SELECT bank_name, card_type, phi, theta, t + 1, z, err, sse + err * err FROM (SELECT a{k}.*, z.z, z.z - phi * before - theta * e AS err FROM a{k} JOIN z ON z.bank_name = a{k}.bank_name AND z.card_type = a{k}.card_type AND z.t = a{k}.t + 1)),
b{k} AS (SELECT * FROM (SELECT a{k}.* FROM a{k} JOIN (SELECT DISTINCT {_K}, n FROM vals) c USING ({_K}) WHERE t = n) QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY sse, phi, theta) = 1)"""


_ARIMA = f"""z AS (SELECT {_K}, t, d - avg(d) OVER (PARTITION BY {_K}) AS z, avg(d) OVER (PARTITION BY {_K}) AS mean FROM (SELECT *, v - lag(v) OVER (PARTITION BY {_K} ORDER BY t) AS d FROM vals WHERE n >= 12) WHERE d IS NOT NULL),
b0 AS (SELECT DISTINCT {_K}, 0.0::DOUBLE AS phi, 0.0::DOUBLE AS theta FROM z),
{', '.join(_round(k, w) for k, w in enumerate(folded.WIDTHS, 1))},
arima AS (SELECT {_K}, step, v + mean * step + (phi * before + theta * e) * (1 - power(phi, step)) / (1 - phi) AS yhat FROM b3 JOIN (SELECT {_K}, v FROM vals WHERE t = n) USING ({_K}) JOIN (SELECT DISTINCT {_K}, mean FROM z) USING ({_K}) CROSS JOIN (SELECT unnest(range(1, 7)) AS step))"""


def _basis(t: str) -> str:
    waves = [f"{f}(2 * pi() * {w} * ({t}) / 12)" for w in (1, 2, 3) for f in ("sin", "cos")]
    return ", ".join(["1.0", f"({t}) / 12.0", *(f"greatest(({t}) - {b}, 0) / 12.0" for b in folded.BENDS), *waves])


_STRUCTURAL = f"""sv AS (SELECT {_K}, n AS cut, list_append([{_basis('t - 1')}], v) AS v FROM vals WHERE n >= 24),
{sql_elimination('sm', 'sv', f'{_K}, cut', 13, 14, folded.PENALTY, both=True)},
sc AS (SELECT {_K}, cut, list_transform(range(1, 14), lambda i: CASE WHEN m[i][i] > 1e-10 * cut THEN m[i][14] / m[i][i] ELSE 0 END) AS c FROM sm),
structural AS (SELECT {_K}, step, list_sum(list_transform(range(1, 14), lambda i: c[i] * x[i])) AS yhat FROM (SELECT *, [{_basis('cut + step - 1')}] AS x FROM sc CROSS JOIN (SELECT unnest(range(1, 7)) AS step)))"""


@query(f"""WITH RECURSIVE {PANEL}, {_VALUES}, {_ETS}, {_ARIMA}, {_STRUCTURAL},
f AS (SELECT *, 'ets' AS model FROM ets UNION ALL SELECT *, 'arima' FROM arima UNION ALL SELECT *, 'structural' FROM structural)
SELECT bank_name, card_type, model, CAST(step AS INTEGER) AS step, CASE WHEN yhat IS NOT NULL THEN round(greatest(exp(yhat) - 1, 0), 3) END AS yhat
FROM (SELECT DISTINCT {_K} FROM panel) CROSS JOIN (VALUES ('ets'), ('arima'), ('structural')) m(model) CROSS JOIN (SELECT unnest(range(1, 7)) AS step) LEFT JOIN f USING (bank_name, card_type, model, step)""")
def i3_i4_i5_forecasts(spark, sf):
    """Six months ahead by Holt-Winters, ARIMA(1,1,1) and structural regression."""
    return folded.forecasts(fx.panel(spark, sf), KEY, "month", "outstanding").withColumn("yhat", F.round("yhat", 3))


@query(f"""WITH RECURSIVE {PANEL}, {_VALUES}, {_STRUCTURAL}, names AS (SELECT unnest([{', '.join(repr(x) for x in folded.NAMES)}]) AS component, unnest(range(1, 14)) AS i)
SELECT bank_name, card_type, component, round(c[i], 6) AS coefficient FROM sc CROSS JOIN names""")
def i5_coefficients(spark, sf):
    """What each part of the structural regression of a series weighs."""
    fits = folded.structural(fx.panel(spark, sf), KEY, "month", "outstanding")
    named = F.arrays_zip(F.array(*map(F.lit, folded.NAMES)).alias("component"), F.col("coefficients").alias("coefficient"))
    return fits.select(*KEY, F.explode(named).alias("x")).select(*KEY, F.col("x.component").alias("component"), F.round("x.coefficient", 6).alias("coefficient"))


_RUNS = f"""folds AS (SELECT DISTINCT {_K}, unnest(range(36, n - 5, 6)) AS cut FROM vals WHERE n >= 42),
rs AS (SELECT f.bank_name, f.card_type, f.cut, list_append([{_basis('t - 1')}], v) AS v FROM folds f JOIN vals ON vals.bank_name = f.bank_name AND vals.card_type = f.card_type AND t <= cut),
{sql_elimination('rm', 'rs', f'{_K}, cut', 13, 14, folded.PENALTY, both=True)},
rc AS (SELECT {_K}, cut, list_transform(range(1, 14), lambda i: CASE WHEN m[i][i] > 1e-10 * cut THEN m[i][14] / m[i][i] ELSE 0 END) AS c FROM rm),
rf AS (SELECT {_K}, (cut - 36) // 6 AS fold, step, cut + step AS t, list_sum(list_transform(range(1, 14), lambda i: c[i] * x[i])) AS yhat FROM (SELECT *, [{_basis('cut + step - 1')}] AS x FROM rc CROSS JOIN (SELECT unnest(range(1, 7)) AS step)))"""


@query(f"""WITH RECURSIVE {PANEL}, {_VALUES}, {_RUNS}
SELECT bank_name, card_type, CAST(fold AS INTEGER) AS fold, CAST(step AS INTEGER) AS step, round(exp(v) - 1, 3) AS y, round(greatest(exp(yhat) - 1, 0), 3) AS yhat FROM rf JOIN vals USING (bank_name, card_type, t)""")
def i5_structural_folds(spark, sf):
    """Walk-forward forecasts of the structural regression, from running sums."""
    rows = fx.panel(spark, sf)
    fits = folded.structural(rows, KEY, "month", "outstanding", [36], 6)
    v = folded.series_arrays(rows, KEY, "month", "outstanding")
    ahead = folded.structural_forecast(fits, KEY).join(v, KEY).withColumn("_v", F.get("v", F.col("cut") + F.col("step") - 1)).filter(F.size("v") >= F.col("cut") + 6)
    return ahead.select(*KEY, ((F.col("cut") - 36) / 6).cast("int").alias("fold"), "step", F.round(F.expm1("_v"), 3).alias("y"), F.round(F.greatest(F.lit(0.0), F.expm1("yhat")), 3).alias("yhat"))


@query()
def i10_model_cv(spark, sf):
    """Scores of the three models on the folds."""
    return evaluate.cv_scores(folded.cross_validated(fx.panel(spark, sf), KEY, "month", "outstanding"), KEY)

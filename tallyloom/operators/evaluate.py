"""Forecasts in closed form, walk-forward folds, ensembles, intervals and scores, for all series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def folds(rows: DataFrame, series: list[str], month: str, initial: int = 36, horizon: int = 6, step: int = 6) -> DataFrame:
    """(series, fold, cut): the first `cut` rows train, the next `horizon` test. Kept where the series is long enough."""
    n = rows.groupBy(*series).agg(F.count(F.lit(1)).cast("int").alias("n")).filter(F.col("n") >= initial + horizon)
    return n.select(*series, F.posexplode(F.sequence(F.lit(initial), F.col("n") - horizon, F.lit(step))).alias("fold", "cut"))


def fold_forecasts(rows: DataFrame, series: list[str], month: str, y: str, initial: int = 36, horizon: int = 6, step: int = 6) -> DataFrame:
    """(series, fold, step, y, linear, drift, seasonal): forecasts of each fold's test rows from its training rows.

    Running sums up to each row give the line through all rows before a cut, so training rows aren't copied for each
    fold: the state at the cut's row is joined to its test rows. A seasonal forecast is the value 12 rows before,
    repeated where the horizon is longer.
    """
    w = Window.partitionBy(*series).orderBy(month)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    r = rows.select(*series, month, F.col(y).alias("y")).withColumn("i", F.row_number().over(w))
    total = F.count(F.lit(1)).over(Window.partitionBy(*series))
    r = r.withColumns({"n": total, "sx": F.sum("i").over(run), "sy": F.sum("y").over(run), "sxy": F.sum(F.col("i") * F.col("y")).over(run), "sxx": F.sum(F.col("i") * F.col("i")).over(run), "y1": F.first("y").over(run)})
    year = F.collect_list("y").over(w.rowsBetween(-11, 0))
    is_cut = (F.col("i") >= initial) & (F.col("i") <= F.col("n") - horizon) & ((F.col("i") - initial) % step == 0)
    slope = (F.col("i") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("i") * F.col("sxx") - F.col("sx") * F.col("sx"))
    states = r.withColumn("year", year).filter(is_cut).select(*series, F.col("i").alias("cut"), ((F.col("i") - initial) / step).cast("int").alias("fold"), F.col("y").alias("last"), "y1", slope.alias("slope"), "year", ((F.col("sy") - slope * F.col("sx")) / F.col("i")).alias("icept"))
    steps = states.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    out = steps.withColumn("_i", F.col("cut") + F.col("step")).join(r.select(*series, F.col("i").alias("_i"), "y"), [*series, "_i"])
    return out.select(
        *series,
        "fold",
        "step",
        "y",
        (F.col("icept") + F.col("slope") * F.col("_i")).alias("linear"),
        (F.col("last") + F.col("step") * (F.col("last") - F.col("y1")) / (F.col("cut") - 1)).alias("drift"),
        F.element_at("year", (F.size("year") - 11 + F.pmod(F.col("step") - 1, F.lit(12))).cast("int")).alias("seasonal"),
    )


MEMBERS = ("linear", "drift", "seasonal")


def long_members(wide: DataFrame, keys: list[str], members: tuple[str, ...] = MEMBERS) -> DataFrame:
    """(keys, model, yhat) from a column for each member."""
    return wide.unpivot(keys, list(members), "model", "yhat")


def mape(actual: Column, forecast: Column) -> Column:
    """Mean absolute error in shares of the actual; actuals of zero are left out."""
    return F.avg(F.abs((actual - forecast) / F.nullif(actual, F.lit(0.0))))


def cv_scores(cv: DataFrame, series: list[str], cap: float = 1.0) -> DataFrame:
    """For each series and model: folds, mean, median, least and largest of the folds' errors (each capped), and how many were capped."""
    fold = cv.groupBy(*series, "model", "fold").agg(mape(F.col("y"), F.col("yhat")).alias("m")).filter("m is not null")
    m = F.least("m", F.lit(cap))
    return fold.groupBy(*series, "model").agg(F.count(F.lit(1)).alias("n_folds"), F.avg(m).alias("mape_mean"), F.percentile(m, F.lit(0.5)).alias("mape_median"), F.min(m).alias("mape_min"), F.max(m).alias("mape_max"), F.count_if(F.col("m") > cap).alias("n_capped"))


def ensemble(members: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """Weighted mean over the members that are there, weights made to sum to one; equal weights if all are zero."""
    w = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in weights.items() for x in p)), F.col("model")), F.lit(0.0))
    total = F.sum(F.when(F.col("yhat").isNotNull(), w))
    return members.groupBy(*keys).agg(F.when(total > 0, F.sum(w * F.col("yhat")) / total).otherwise(F.avg("yhat")).alias("ensemble"))


def inverse_error_ensemble(members: DataFrame, keys: list[str], scores: DataFrame, by: list[str]) -> DataFrame:
    """Weights are the reciprocals of the members' errors."""
    j = members.join(scores.select(*by, "model", (1 / F.col("mape_mean")).alias("_w")), [*by, "model"])
    return j.groupBy(*keys).agg((F.sum(F.col("_w") * F.col("yhat")) / F.sum("_w")).alias("ensemble"))


def conformal(cv: DataFrame, series: list[str], low: float = 0.05, high: float = 0.95, least: int = 3) -> DataFrame:
    """Offsets of an interval for each series and step from the residuals' percentiles; 1.645 sigma sqrt(h) where there are fewer than `least`."""
    e = F.col("y") - F.col("yhat")
    per = cv.groupBy(*series, "step").agg(F.count(F.lit(1)).alias("n"), F.percentile(e, F.lit(low)).alias("p_low"), F.percentile(e, F.lit(high)).alias("p_high"))
    sigma = cv.groupBy(*series).agg(F.stddev_pop(e).alias("sigma"))
    wide = 1.645 * F.col("sigma") * F.sqrt("step")
    few = F.col("n") < least
    return per.join(sigma, series).select(*series, "step", F.when(few, -wide).otherwise(F.col("p_low")).alias("lower"), F.when(few, wide).otherwise(F.col("p_high")).alias("upper"), F.when(few, "normal").otherwise("conformal").alias("how"))


def weight_grid(cv: DataFrame, series: list[str], a: str, b: str, step: float = 0.05) -> DataFrame:
    """The best weight of a (the rest is b's) on a grid, by mean error; the smallest of equal ones.

    The mean error of every weight is one aggregate of an array expression: rows aren't multiplied by the grid.
    """
    best = F.array_min("_g")
    return weight_errors(cv, series, a, b, step).select(*series, best["w"].alias("weight"), best["m"].alias("mape"))


def weight_errors(cv: DataFrame, series: list[str], a: str, b: str, step: float = 0.05, digits: int = 10) -> DataFrame:
    """(series, _g): for each weight of the grid its mean error and itself."""
    grid = [round(i * step, 10) for i in range(round(1 / step) + 1)]
    errors = [F.avg(F.abs((F.col("y") - (w * F.col(a) + (1 - w) * F.col(b))) / F.nullif("y", F.lit(0.0)))) for w in grid]
    return cv.groupBy(*series).agg(F.array(*(F.struct(F.round(e, digits).alias("m"), F.lit(w).alias("w")) for e, w in zip(errors, grid, strict=True))).alias("_g"))


def weight_ranks(cv: DataFrame, series: list[str], a: str, b: str, n: int, step: float = 0.05) -> DataFrame:
    """(series, place, weight, mape): the n best weights; the smaller of equal ones first."""
    out = weight_errors(cv, series, a, b, step, 8).select(*series, F.posexplode(F.slice(F.array_sort("_g"), 1, n)).alias("_p", "_w"))
    return out.select(*series, (F.col("_p") + 1).alias("place"), F.col("_w.w").alias("weight"), F.col("_w.m").alias("mape"))


def full_frame(rows: DataFrame, ahead: DataFrame, ensemble: DataFrame, series: list[str], month: str, y: str, last: int = 16) -> DataFrame:
    """(series, month, y, fitted, forecast, kind): history with the line's fitted values in its last rows, and the forecast months.

    `ahead` is a trend_forecast of rows; where the ensemble has a value for a month it takes the forecast's place.
    """
    line = ahead.groupBy(*series).agg(F.min_by("forecast", "step").alias("_f1"), F.lit(True).alias("_there"))
    w = Window.partitionBy(*series).orderBy(F.desc(month))
    fit = rows.withColumn("_k", F.row_number().over(w)).join(line, series, "left")
    near = fit.filter(F.col("_there") & (F.col("_k") <= last)).groupBy(*series).agg(F.regr_slope(y, -F.col("_k")).alias("_s"), F.regr_intercept(y, -F.col("_k")).alias("_c"))
    fitted = F.when(F.col("_k") <= last, F.col("_c") - F.col("_s") * F.col("_k"))
    history = fit.join(near, series, "left").select(*series, month, F.col(y).alias("y"), fitted.alias("fitted"), F.lit(None).cast("double").alias("forecast"), F.lit("actual").alias("kind"))
    future = ahead.join(ensemble, [*series, month], "left").select(*series, month, F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("fitted"), F.coalesce("ensemble", "forecast").alias("forecast"), F.lit("forecast").alias("kind"))
    return history.unionByName(future)


def trend_forecast(rows: DataFrame, series: list[str], month: str, y: str, last: int = 16, horizon: int = 6, least: int = 48) -> DataFrame:
    """(series, month, step, forecast): a line through the last rows of each series of at least `least`, never below zero."""
    w = Window.partitionBy(*series).orderBy(F.desc(month))
    r = rows.withColumns({"_k": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(*series))}).filter((F.col("_n") >= least) & (F.col("_k") <= last))
    fit = r.groupBy(*series).agg(F.regr_slope(y, -F.col("_k")).alias("_s"), F.regr_intercept(y, -F.col("_k")).alias("_c"), F.max(month).alias("_end"))
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(*series, F.add_months("_end", F.col("step")).alias("month"), "step", F.greatest(F.lit(0.0), F.col("_c") + F.col("_s") * (F.col("step") - 1)).alias("forecast"))


def trend_label(pct: Column) -> Column:
    """Bands of a change in percent at 10 and 50, up and down (null: null)."""
    return F.when(pct > 50, "strong growth").when(pct > 10, "growth").when(pct > -10, "flat").when(pct > -50, "declining").when(pct.isNotNull(), "strong decline")


def usefulness(p: Column, n: Column) -> Column:
    """What a regressor's least p-value and its number of values make of it; null p: drop."""
    return F.when((p < 0.01) & (n >= 36), "USE").when((p < 0.05) & (n >= 24), "CONSIDER").when((p < 0.1) & (n >= 24), "WEAK").otherwise("drop")


def stars(p: Column) -> Column:
    """Three, two and one for p-values under 0.001, 0.01 and 0.05; none for others, null and NaN."""
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def within_shares(members: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, within_5, within_10, within_20, good, ok, bad): shares of errors under 5, 10 and 20 percent, and counts up to 5, 15 and beyond; actuals of zero are left out."""
    rows = members.withColumn("_e", F.round(F.abs((F.col("y") - F.col("yhat")) / F.nullif("y", F.lit(0.0))), 8))
    e = F.col("_e")
    shares = [F.avg(F.when(e.isNotNull(), (e < t).cast("double"))).alias(f"within_{round(100 * t)}") for t in (0.05, 0.1, 0.2)]
    return rows.groupBy(*by).agg(F.count(e).alias("n"), *shares, F.count_if(e < 0.05).alias("good"), F.count_if((e >= 0.05) & (e < 0.15)).alias("ok"), F.count_if(e >= 0.15).alias("bad"))


def regression_errors(rows: DataFrame, series: list[str], y: str, variants: dict[str, Column], month: str, horizon: int = 6, least: int = 36) -> DataFrame:
    """(series, variant, p, n, mape): error over the next `horizon` rows of a line on each variant's column, fitted on all rows up to p.

    Rows in which a variant's column is null are left out of it; p counts rows from 1. Fits come from running sums, so
    every p costs one row, and test rows are joined to it. At least `least` rows are fitted on. A null column variant is
    the mean alone.
    """
    by = Window.partitionBy(*series).orderBy(month)
    r = rows.withColumns({"_i": F.row_number().over(by), "_n": F.count(F.lit(1)).over(Window.partitionBy(*series)), **{f"_v_{k}": c for k, c in variants.items()}})
    long = r.select(*series, "_i", "_n", F.col(y).alias("_y"), F.explode(F.array(*(F.struct(F.lit(k).alias("variant"), F.col(f"_v_{k}").cast("double").alias("x")) for k in variants))).alias("_s")).select("*", "_s.*").filter("x is not null")
    w = Window.partitionBy(*series, "variant").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    flat = F.var_pop("x").over(w) > 0
    fitted = long.select(*series, "variant", F.col("_i").alias("p"), "_n", F.count(F.lit(1)).over(w).alias("_k"), F.when(flat, F.regr_slope("_y", "x").over(w)).otherwise(0.0).alias("_b"), F.when(flat, F.regr_intercept("_y", "x").over(w)).otherwise(F.avg("_y").over(w)).alias("_a"))
    fitted = fitted.filter((F.col("p") + horizon <= F.col("_n")) & (F.col("_k") >= least))
    ahead = fitted.withColumn("_i", F.explode(F.sequence(F.col("p") + 1, F.col("p") + horizon))).join(long.select(*series, "variant", "_i", "_y", "x"), [*series, "variant", "_i"])
    return ahead.groupBy(*series, "variant", "p").agg(F.first("_n").alias("n"), mape(F.col("_y"), F.col("_a") + F.col("_b") * F.col("x")).alias("mape"))


def nested_choice(errors: DataFrame, series: list[str], initial: int = 48, horizon: int = 6, step: int = 6, inner: int = 3) -> DataFrame:
    """(series, cut, chosen, outer_mape): the variant with the least mean error over the inner folds before each cut, and its error after it.

    Inner folds end at the cut and every `step` rows before it. Ties go to the first variant by name.
    """
    cuts = errors.filter((F.col("p") >= initial) & ((F.col("p") - initial) % step == 0))
    folds_of = cuts.select(*series, F.col("p").alias("cut")).distinct().withColumn("p", F.explode(F.array(*(F.col("cut") - k * step - horizon for k in range(inner)))))
    scored = folds_of.join(errors, [*series, "p"]).groupBy(*series, "cut", "variant").agg(F.avg("mape").alias("_m"))
    best = scored.groupBy(*series, "cut").agg(F.min(F.struct(F.round("_m", 9), "variant"))["variant"].alias("chosen"))
    outer = errors.select(*series, F.col("p").alias("cut"), F.col("variant").alias("chosen"), F.col("mape").alias("outer_mape"))
    return best.join(outer, [*series, "cut", "chosen"], "left")


def ablation(errors: DataFrame, series: list[str], without: str, band: float = 0.1) -> DataFrame:
    """(series, variant, with_pct, without_pct, delta, verdict): each variant's mean error against that of `without`, in points of a percent.

    KEEP where leaving the feature out costs more than `band` points, REMOVE where it gains as much, else MARGINAL.
    """
    mean = errors.groupBy(*series, "variant").agg((F.avg("mape") * 100).alias("m"))
    base = mean.filter(F.col("variant") == without).select(*series, F.col("m").alias("without_pct"))
    out = mean.filter(F.col("variant") != without).join(base, series).withColumn("delta", F.round(F.col("without_pct") - F.col("m"), 6))
    return out.select(*series, "variant", F.col("m").alias("with_pct"), "without_pct", "delta", F.when(F.col("delta") > band, "KEEP").when(F.col("delta") < -band, "REMOVE").otherwise("MARGINAL").alias("verdict"))


def forecast_delta(forecasts: DataFrame, series: list[str], with_it: str, without: str, threshold: float = 1.0) -> DataFrame:
    """How far a feature moves the forecast, in percent of the forecast without it: (series, n, mean_abs_pct, max_abs_pct, decision).

    DROP where the mean is under `threshold`, else ESCALATE; null where no forecast without it differs from zero.
    """
    pct = F.abs((F.col(with_it) - F.col(without)) / F.nullif(F.col(without), F.lit(0.0))) * 100
    out = forecasts.groupBy(*series).agg(F.count(pct).alias("n"), F.avg(pct).alias("mean_abs_pct"), F.max(pct).alias("max_abs_pct"))
    return out.withColumn("decision", F.when(F.round("mean_abs_pct", 9) < threshold, "DROP").when(F.col("mean_abs_pct").isNotNull(), "ESCALATE"))


def holdout_scores(scored: DataFrame, series: list[str], month: str, y: str, forecast: str, half_width: str, window: tuple[str, str], points: float = 5.0) -> DataFrame:
    """Error and interval coverage of a holdout, and of a given window of it: (series, n, mape, coverage, n_window, mape_window, stressed).

    A window is stressed if its error is over `points` points of a percent worse than that of the whole holdout.
    """
    inside = (F.abs(F.col(y) - F.col(forecast)) <= F.col(half_width)).cast("double")
    here = F.col(month).between(*(F.lit(d).cast("date") for d in window))
    at = lambda c: F.when(here, c)
    out = scored.groupBy(*series).agg(
        F.count(F.lit(1)).alias("n"), mape(F.col(y), F.col(forecast)).alias("mape"), F.avg(inside).alias("coverage"), F.count_if(here).alias("n_window"), mape(at(F.col(y)), F.col(forecast)).alias("mape_window")
    )
    return out.withColumn("stressed", F.round((F.col("mape_window") - F.col("mape")) * 100, 9) > points)

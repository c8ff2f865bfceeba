"""Regressions of very many short series from sums of products.

`gram` is one aggregate: the sums of products of all pairs of columns, combined before the shuffle. What is left of a series
is a small matrix in one row, and `eliminated` takes columns out of it one after another. The last diagonal element is then
the residual sum of squares of each nested fit, so the orders of a lagged model all come from one matrix, and no series is
gathered to be fitted.

Columns that are constant or linear in those before them are passed over; so are the zero columns that pad a shorter model
to the width of the longest one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import tails

#: Share of a unit column's sum of squares below which what is left of a column counts as nothing.
NOTHING = 1e-10
#: Least rows of a unit-root test and of a test of causality.
UNIT_ROOT_ROWS, CAUSAL_ROWS = 20, 30


def gram(rows: DataFrame, keys: list[str], vector: list[Column]) -> DataFrame:
    """(keys, n, m): rows and sums of products of the vector's columns, of each key."""
    k = len(vector)
    rows = rows.select(*keys, *(v.cast("double").alias(f"_z{i}") for i, v in enumerate(vector)))
    sums = [F.expr(f"sum(_z{i} * _z{j}) AS _s{i}_{j}") for i in range(k) for j in range(i, k)]
    m = F.expr("array(" + ", ".join("array(" + ", ".join(f"_s{min(i, j)}_{max(i, j)}" for j in range(k)) + ")" for i in range(k)) + ")")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums).select(*keys, "n", m.alias("m"))


def _at(m: Column, i: Column | int, j: Column | int) -> Column:
    return F.get(F.get(m, i if isinstance(i, Column) else F.lit(i)), j if isinstance(j, Column) else F.lit(j))


def eliminated(m: Column, pivots: int, width: int, n: Column, both: bool = False) -> Column:
    """struct(m, rss): the matrix without its first columns' part, and its last diagonal element before the first and after each.

    both: rows above a pivot are cleared too, so that m[i][last] / m[i][i] is the coefficient of column i.
    """

    def step(state: Column, k: Column) -> Column:
        old = state["m"]
        pivot, own = _at(old, k, k), F.get(old, k)
        here = (lambda i: i != k) if both else (lambda i: i > k)
        new = F.transform(old, lambda row, i: F.when(here(i), F.transform(row, lambda x, j: x - F.get(row, k) * F.get(own, j) / pivot)).otherwise(row))
        new = F.when(pivot > NOTHING * n, new).otherwise(old)
        return F.struct(new.alias("m"), F.concat(state["rss"], F.array(_at(new, width - 1, width - 1))).alias("rss"))

    start = F.struct(m.alias("m"), F.array(_at(m, width - 1, width - 1)).alias("rss"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(pivots - 1)), start, step)


def reordered(m: Column, order: list[int]) -> Column:
    """The matrix with its columns in another order."""
    return F.array(*(F.array(*(_at(m, i, j) for j in order)) for i in order))


def standardised(value: str, keys: list[str]) -> Column:
    """The value in standard deviations from the mean of its key; null where all values are equal."""
    w = Window.partitionBy(*keys)
    deviation = F.stddev_pop(value).over(w)
    return F.when(F.max(value).over(w) > F.min(value).over(w), (F.col(value) - F.avg(value).over(w)) / deviation)


def unit_root(rows: DataFrame, keys: list[str], month: str, value: str, most: int | None = None) -> DataFrame:
    """(keys, n, stat, lags, p): the augmented Dickey-Fuller test with a constant, its lags chosen by AIC.

    Lags up to ceil(12 (n / 100)^(1/4)), at most n / 2 - 2, are compared on the rows that have all of them; the chosen number
    is then fitted on all rows that have as many. `most` is the widest model (default: that of the longest series). Null
    values are left out. Series of under 20 rows or of one value have a null statistic and p = 1.
    """
    rows = rows.filter(F.col(value).isNotNull()).select(*keys, month, F.col(value).cast("double").alias(value))
    if most is None:
        longest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1  # one number
        most = max(0, math.ceil(12 * (longest / 100) ** 0.25))
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(month)
    n = F.count(F.lit(1)).over(whole)
    base = rows.select(*keys, month, standardised(value, keys).alias("_z"), n.alias("_n"), F.row_number().over(w).alias("_t"))
    base = base.withColumn("_most", F.greatest(F.lit(0), F.least(F.ceil(12 * F.pow(F.col("_n") / 100.0, F.lit(0.25))), F.floor(F.col("_n") / 2) - 2, F.lit(most)).cast("int")))
    base = base.withColumns({"_y": F.lag("_z").over(w), "_d": F.col("_z") - F.lag("_z").over(w)}).withColumns({f"_d{j}": F.lag("_d", j).over(w) for j in range(1, most + 1)})
    fit = base.filter((F.col("_n") >= UNIT_ROOT_ROWS) & F.col("_z").isNotNull())

    used = lambda j, limit: F.when(F.lit(j) <= limit, F.col(f"_d{j}")).otherwise(0.0)
    chosen = gram(fit.filter("_t >= _most + 2"), [*keys, "_most"], [F.lit(1.0), F.col("_y"), *(used(j, F.col("_most")) for j in range(1, most + 1)), F.col("_d")])
    chosen = chosen.withColumn("_rss", eliminated(F.col("m"), most + 2, most + 3, F.col("n"))["rss"])
    criterion = lambda k: F.col("n") * F.ln(F.greatest(F.get("_rss", k + 2), F.lit(1e-300)) / F.col("n")) + 2 * (k + 2)
    order = F.array_min(F.transform(F.sequence(F.lit(0), F.col("_most")), lambda k: F.struct(criterion(k).alias("aic"), k.alias("lags"))))
    chosen = chosen.select(*keys, order["lags"].alias("lags"))

    last = gram(fit.join(chosen, keys).filter("_t >= lags + 2"), [*keys, "lags"], [F.lit(1.0), *(used(j, F.col("lags")) for j in range(1, most + 1)), F.col("_y"), F.col("_d")])
    last = last.withColumn("_m", eliminated(F.col("m"), most + 1, most + 3, F.col("n"))["m"])
    xx, xy, yy = _at(F.col("_m"), most + 1, most + 1), _at(F.col("_m"), most + 1, most + 2), _at(F.col("_m"), most + 2, most + 2)
    rss = yy - xy * xy / xx
    stat = F.when((xx > NOTHING * F.col("n")) & (rss > 0), xy / xx / F.sqrt(rss / (F.col("n") - F.col("lags") - 2) / xx))
    last = last.select(*keys, "lags", stat.alias("stat"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(last, keys, "left").select(*keys, "n", "stat", "lags", F.coalesce(tails.unit_root_p(F.col("stat")), F.lit(1.0)).alias("p"))


def differenced(rows: DataFrame, keys: list[str], month: str, value: str) -> DataFrame:
    """(keys, order, month, value): each series as it is (order 0), and its first and second differences."""
    w = Window.partitionBy(*keys).orderBy(month)
    one = F.col(value) - F.lag(value).over(w)
    rows = rows.filter(F.col(value).isNotNull()).withColumn("_1", one).withColumn("_2", F.col("_1") - F.lag("_1").over(w))
    all_three = F.array(*(F.struct(F.lit(k).alias("order"), c.alias(value)) for k, c in enumerate((F.col(value), F.col("_1"), F.col("_2")))))
    return rows.select(*keys, month, F.explode(all_three).alias("_x")).select(*keys, F.col("_x.order").alias("order"), month, F.col(f"_x.{value}").alias(value)).filter(F.col(value).isNotNull())


def stationary_order(rows: DataFrame, keys: list[str], month: str, value: str, alpha: float = 0.05) -> DataFrame:
    """(keys, order): how often a series is differenced until a unit root is rejected: 0, 1, or else 2."""
    tests = unit_root(differenced(rows, keys, month, value).filter("order < 2"), [*keys, "order"], month, value)
    p = lambda k: F.max(F.when(F.col("order") == k, F.col("p")))
    return tests.groupBy(*keys).agg(F.when(p(0) < alpha, 0).when(p(1) < alpha, 1).otherwise(2).alias("order"))


def relations(rows: DataFrame, keys: list[str], month: str, y: str, x: str, lags: int = 6) -> DataFrame:
    """(keys, direction, y_order, x_order, lag, n, f, p, best_lag, verdict): whether past values of one series help to tell another, for each lag.

    Forward is x to y, reverse y to x. Each side is differenced as often as its own unit-root test asks for. Of a series
    pair with fewer than `lags` + 10 rows after that, a fifth of the rows' number of lags is tested. The best lag has the
    least p (ties: the shortest), and gives the verdict. Pairs of under 30 rows have one row with lag 0, p = 1 and the
    verdict INSUFFICIENT DATA; where a side is constant or too few rows are left, f and p are null.
    """
    pairs = rows.filter(F.col(y).isNotNull() & F.col(x).isNotNull()).select(*keys, month, F.col(y).cast("double").alias("_y"), F.col(x).cast("double").alias("_x"))
    w = Window.partitionBy(*keys).orderBy(month)
    pairs = pairs.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    short = pairs.filter(F.col("_n") < CAUSAL_ROWS).groupBy(*keys).agg(F.max("_n").alias("n"))
    pairs = pairs.filter(F.col("_n") >= CAUSAL_ROWS)

    long = pairs.select(*keys, month, F.explode(F.array(F.struct(F.lit("y").alias("side"), F.col("_y").alias("v")), F.struct(F.lit("x").alias("side"), F.col("_x").alias("v")))).alias("_s")).select(*keys, month, "_s.side", "_s.v")
    orders = stationary_order(long, [*keys, "side"], month, "v")
    orders = orders.groupBy(*keys).agg(*(F.max(F.when(F.col("side") == s, F.col("order"))).alias(f"{s}_order") for s in ("y", "x")))
    steps = pairs.withColumns({f"_{s}1": F.col(f"_{s}") - F.lag(f"_{s}").over(w) for s in "yx"}).withColumns({f"_{s}2": F.col(f"_{s}1") - F.lag(f"_{s}1").over(w) for s in "yx"}).join(orders, keys)
    moved = steps.select(*keys, month, "y_order", "x_order", *(F.when(F.col(f"{s}_order") == 0, F.col(f"_{s}")).when(F.col(f"{s}_order") == 1, F.col(f"_{s}1")).otherwise(F.col(f"_{s}2")).alias(f"_{s}") for s in "yx"))
    moved = moved.filter("_y is not null and _x is not null")
    moved = moved.withColumns({"_y": standardised("_y", keys), "_x": standardised("_x", keys), "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})

    side = lambda name, effect, cause: F.struct(F.lit(name).alias("direction"), F.col(effect).alias("e"), F.col(cause).alias("c"))
    ways = moved.withColumn("_s", F.explode(F.array(side("forward", "_y", "_x"), side("reverse", "_x", "_y")))).select(*keys, "y_order", "x_order", month, "_n", "_s.direction", F.col("_s.e").alias("_e"), F.col("_s.c").alias("_c"))
    way = Window.partitionBy(*keys, "direction").orderBy(month)
    ways = ways.withColumns({"_t": F.row_number().over(way)} | {f"_{s}{k}": F.lag(f"_{s}", k).over(way) for s in "ec" for k in range(1, lags + 1)})
    tested = F.when(F.col("_n") < lags + 10, F.greatest(F.lit(1), F.floor(F.col("_n") / 5).cast("int"))).otherwise(lags)
    ways = ways.withColumn("lag", F.explode(F.sequence(F.lit(1), F.least(F.lit(lags), tested)))).filter("_t > lag")
    padded = lambda s: [F.when(F.lit(k) <= F.col("lag"), F.col(f"_{s}{k}")).otherwise(0.0) for k in range(1, lags + 1)]
    names = [*keys, "direction", "y_order", "x_order", "lag"]
    sums = gram(ways, names, [F.lit(1.0), *padded("e"), *padded("c"), F.col("_e")])
    sums = sums.withColumn("_rss", eliminated(F.col("m"), 2 * lags + 1, 2 * lags + 2, F.col("n"))["rss"])
    r0, r1, free = F.get("_rss", F.lit(lags + 1)), F.get("_rss", F.lit(2 * lags + 1)), F.col("n") - 2 * F.col("lag") - 1
    varies = _at(F.col("m"), lags + 1, lags + 1).isNotNull()  # the other series' first lag
    f = F.when((free > 0) & (r1 > 0) & varies, (r0 - r1) / F.col("lag") / (r1 / free))
    tests = sums.select(*names, "n", f.alias("f"), tails.f_tail(f, F.col("lag"), free).alias("p"))

    own = Window.partitionBy(*keys, "direction")
    least = F.min(F.when(F.col("p").isNotNull(), F.struct("p", "lag"))).over(own)
    tests = tests.withColumns({"best_lag": least["lag"], "_p": least["p"]})
    verdict = F.when(F.col("_p") < 0.01, "CONFIRMED (p < 0.01)").when(F.col("_p") < 0.05, "CONFIRMED (p < 0.05)").when(F.col("_p") < 0.1, "WEAK").otherwise("NOT CONFIRMED")
    tests = tests.select(*names, "n", "f", "p", "best_lag", verdict.alias("verdict"))
    none = F.lit(None).cast("int")
    short = short.withColumn("direction", F.explode(F.array(F.lit("forward"), F.lit("reverse"))))
    short = short.select(*keys, "direction", none.alias("y_order"), none.alias("x_order"), F.lit(0).alias("lag"), "n", F.lit(0.0).alias("f"), F.lit(1.0).alias("p"), F.lit(0).alias("best_lag"), F.lit("INSUFFICIENT DATA").alias("verdict"))
    return tests.unionByName(short)


def inflation(rows: DataFrame, keys: list[str], regressors: list[str]) -> DataFrame:
    """(keys, regressor, vif): how far each regressor is told by the others, from one matrix of sums; null where it is told wholly or constant."""
    complete = rows.filter(" and ".join(f"`{c}` is not null" for c in regressors))
    complete = complete.select(*keys, *(standardised(c, keys).alias(c) for c in regressors))
    k = len(regressors)
    sums = gram(complete, keys, [F.lit(1.0), *(F.coalesce(c, F.lit(0.0)) for c in regressors)])
    found = []
    for i, name in enumerate(regressors, 1):
        rss = eliminated(reordered(F.col("m"), [0, *(j for j in range(1, k + 1) if j != i), i]), k, k + 1, F.col("n"))["rss"]
        found.append(F.struct(F.lit(name).alias("regressor"), F.when(F.get(rss, F.lit(k)) > NOTHING * F.col("n"), F.get(rss, F.lit(1)) / F.get(rss, F.lit(k))).alias("vif")))
    return sums.select(*keys, F.explode(F.array(*found)).alias("_v")).select(*keys, "_v.regressor", "_v.vif")


# ---- tests on the residuals of a trend: the values of one series are a short array ----


def detrended(rows: DataFrame, keys: list[str], month: str, value: str) -> DataFrame:
    """(keys, e): each series' differences from its straight line over its rows, in order, as one array (as long as its calendar)."""
    w = Window.partitionBy(*keys)
    rows = rows.filter(F.col(value).isNotNull()).withColumn("_t", F.row_number().over(w.orderBy(month)).cast("double"))
    slope = F.regr_slope(F.col(value), F.col("_t")).over(w)
    e = F.col(value) - F.avg(value).over(w) - slope * (F.col("_t") - F.avg("_t").over(w))
    scaled = rows.select(*keys, "_t", e.alias("_e"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_t", "_e"))), lambda x: x["_e"])
    return scaled.groupBy(*keys).agg(ordered.alias("e"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def autocovariance(e: Column, lag: Column) -> Column:
    """Sum of products of an array's values that are `lag` places apart."""
    n = F.size(e) - lag
    return _total(F.zip_with(F.slice(e, F.lit(1), n), F.slice(e, lag + 1, n), lambda a, b: a * b))


def trend_stationarity(rows: DataFrame, keys: list[str], month: str, value: str) -> DataFrame:
    """(keys, n, lags, stat, p): the KPSS test with constant and trend; the lags of the long-run variance are chosen by the data.

    Series of under 20 rows, or that their line describes wholly, have null results.
    """
    s = detrended(rows, keys, month, value).withColumn("n", F.size("e")).filter(F.col("n") >= UNIT_ROOT_ROWS)
    n, e = F.col("n"), F.col("e")
    s = s.withColumn("_0", _total(F.transform(e, lambda x: x * x)))
    first = F.transform(F.sequence(F.lit(1), F.floor(F.pow(n, F.lit(2.0 / 9))).cast("int")), lambda i: F.struct(i.cast("double").alias("i"), (autocovariance(e, i) / (n / 2.0)).alias("g")))
    s = s.withColumn("_first", first)
    s0 = F.col("_0") / n + _total(F.transform("_first", lambda x: x["g"]))
    s1 = _total(F.transform("_first", lambda x: x["i"] * x["g"]))
    s = s.withColumn("_ratio", s1 / F.when(s0 != 0, s0))
    chosen = F.least(F.floor(1.1447 * F.pow(F.col("_ratio") * F.col("_ratio"), F.lit(1.0 / 3)) * F.pow(n, F.lit(1.0 / 3))), n - 1).cast("int")
    s = s.withColumn("lags", F.when(F.col("_0") > 0, chosen))
    weighted = F.when(F.col("lags") > 0, _total(F.transform(F.sequence(F.lit(1), F.col("lags")), lambda i: (1 - i / (F.col("lags") + 1.0)) * autocovariance(e, i)))).otherwise(0.0)
    s = s.withColumn("_long", (F.col("_0") + 2 * weighted) / n)
    partial = F.aggregate(e, F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares")), lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["squares"] + (a["sum"] + x) * (a["sum"] + x)).alias("squares")))["squares"]
    stat = F.when((F.col("_0") > 0) & (F.col("_long") > 0), partial / (n * n) / F.col("_long"))
    return s.withColumn("stat", stat).select(*keys, "n", "lags", "stat", tails.trend_stationary_p(F.col("stat")).alias("p"))


def residual_autocorrelation(rows: DataFrame, keys: list[str], month: str, value: str, lags: tuple[int, ...] = (6, 12)) -> DataFrame:
    """(keys, n, lags, q, p): the Ljung-Box test of a series' differences from its line, for each number of lags; null where there is no variation or too few rows."""
    s = detrended(rows, keys, month, value).withColumn("n", F.size("e"))
    n = F.col("n")
    s = s.withColumn("_0", _total(F.transform("e", lambda x: x * x))).withColumn("lags", F.explode(F.array(*map(F.lit, lags))))
    r = lambda i: autocovariance(F.col("e"), i) / F.col("_0")
    q = n * (n + 2.0) * _total(F.transform(F.sequence(F.lit(1), F.col("lags")), lambda i: r(i) * r(i) / (n - i)))
    q = F.when((F.col("_0") > 0) & (n > F.col("lags") + 1), q)
    return s.withColumn("q", q).select(*keys, "n", "lags", "q", tails.chi2_tail(F.col("q"), F.col("lags")).alias("p"))

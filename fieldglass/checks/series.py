"""Queries over the time-series operators."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from ..operators import models, series
from .base import DAILY, GAPPED, check, daily, gapped_events, rounded, table

ORDER = ["ts", "event_id"]
GAPS = f"SELECT event_id, ts, user_id, event_type, {GAPPED} AS value FROM events"
EVENTS = "SELECT event_id, ts, user_id, event_type, value FROM events"


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


# --- time axis -----------------------------------------------------------------------------------


@check(
    "parse_and_sort",
    "SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS parsed FROM events",
)
def parse_and_sort(spark, sf_dir):
    text = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 13 = 0 THEN 'soon' ELSE string(ts) END AS at"
    )
    return series.parse_and_sort(text, "at", "parsed").select("event_id", "parsed")


@check(
    "artificial_daily_index",
    "SELECT event_id, CAST(DATE '2020-01-01' + CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS INTEGER) AS DATE) AS day FROM events",
)
def artificial_daily_index(spark, sf_dir):
    return series.artificial_daily_index(events(spark, sf_dir), ORDER, output="day").select("event_id", "day")


@check(
    "artificial_daily_index_by_user",
    "SELECT event_id, CAST(DATE '2020-01-01' + CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS DATE) AS day FROM events",
)
def artificial_daily_index_by_user(spark, sf_dir):
    return series.artificial_daily_index(events(spark, sf_dir), ORDER, ["user_id"], "day").select("event_id", "day")


CALENDAR = (
    "CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week, CAST(month({t}) AS INTEGER) AS month, CAST(quarter({t}) AS INTEGER) AS quarter, "
    "CAST(year({t}) AS INTEGER) AS year, CAST(dayofyear({t}) AS INTEGER) AS day_of_year"
)


@check("calendar_features", f"SELECT l_orderkey, l_shipdate, {CALENDAR.format(t='l_shipdate')} FROM lineitem")
def calendar_features(spark, sf_dir):
    return series.calendar_features(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"), "l_shipdate")


def _fourier_sql(t: str) -> str:
    return ", ".join(
        f"round({f}({order * 2 * pi!r} * dayofyear({t}) / {period}), 6) + 0.0 AS {f}_{period}_{order}"
        for period in (7, 30, 365)
        for order in (1, 2, 3)
        for f in ("sin", "cos")
    )


@check("fourier_features", f"SELECT event_id, {_fourier_sql('ts')} FROM events")
def fourier_features(spark, sf_dir):
    out = rounded(series.fourier_features(table(spark, sf_dir, "events").select("event_id", "ts"), "ts").drop("ts"))
    return out.select("event_id", *[(F.col(c) + 0.0).alias(c) for c in out.columns[1:]])


DOW = ", ".join(f"CAST(isodow({{t}}) - 1 = {i} AS INTEGER) AS day_of_week_{i}" for i in range(7))
MONTH = ", ".join(f"CAST(month({{t}}) = {i} AS INTEGER) AS month_{i}" for i in range(1, 13))
HOUR = ", ".join(f"CAST(hour({{t}}) = {i} AS INTEGER) AS hour_{i}" for i in range(24))


@check("dow_onehot", f"SELECT event_id, {DOW.format(t='ts')} FROM events")
def dow_onehot(spark, sf_dir):
    return series.dow_onehot(table(spark, sf_dir, "events").select("event_id", "ts")).drop("ts")


@check("month_onehot", f"SELECT o_orderkey, {MONTH.format(t='o_orderdate')} FROM orders")
def month_onehot(spark, sf_dir):
    return series.month_onehot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@check("hour_onehot", f"SELECT event_id, {HOUR.format(t='ts')} FROM events")
def hour_onehot(spark, sf_dir):
    return series.hour_onehot(table(spark, sf_dir, "events").select("event_id", "ts")).drop("ts")


@check("hour_onehot_dates_only", "SELECT o_orderkey, o_orderdate FROM orders")
def hour_onehot_dates_only(spark, sf_dir):
    """Order dates have no time of day, so no hour columns appear."""
    return series.hour_onehot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


# --- missing keys --------------------------------------------------------------------------------

# Two thirds of the rows belong to no user, the others to two users.
NO_USER = "CASE WHEN event_id % 6 = 0 THEN 1 WHEN event_id % 6 = 1 THEN 2 END"


def keyless_events(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", "ts", f"{NO_USER} AS u", "value")


@check(
    "artificial_daily_index_null_key",
    "SELECT event_id, CAST(DATE '2020-01-01' + CAST(row_number() OVER (PARTITION BY u ORDER BY ts, event_id) - 1 AS INTEGER) AS DATE) AS day "
    f"FROM (SELECT *, {NO_USER} AS u FROM events) e",
)
def artificial_daily_index_null_key(spark, sf_dir):
    return series.artificial_daily_index(keyless_events(spark, sf_dir), ORDER, ["u"], "day", chunk_rows=300).select("event_id", "day")


@check(
    "lags_null_key",
    "SELECT event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2 "
    f"FROM (SELECT *, {NO_USER} AS u FROM events) e WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)",
)
def lags_null_key(spark, sf_dir):
    out = series.lags(keyless_events(spark, sf_dir), "value", ORDER, ["u"], max_lag=2, chunk_rows=300)
    return out.select("event_id", "value_lag_1", "value_lag_2")


@check(
    "impute_ffill_null_order",
    "SELECT event_id, round(coalesce(f, avg(f) OVER ()), 6) AS value FROM (SELECT event_id, last_value(value IGNORE NULLS) OVER "
    "(ORDER BY t NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS f FROM "
    "(SELECT event_id, CASE WHEN event_id % 3 > 0 THEN ts END AS t, CASE WHEN event_id % 11 > 0 THEN value END AS value FROM events) g) x",
)
def impute_ffill_null_order(spark, sf_dir):
    gapped = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 3 > 0 THEN ts END AS t", "CASE WHEN event_id % 11 > 0 THEN value END AS value"
    )
    return rounded(series.impute_ffill(gapped, ["value"], ["t", "event_id"], chunk_rows=300).select("event_id", "value"))


@check(
    "transform_series_null_key",
    "SELECT event_id, round(value - (ic + sl * p), 6) AS value_detrended FROM (SELECT event_id, value, p, regr_slope(value, p) OVER (PARTITION BY u) AS sl, "
    "regr_intercept(value, p) OVER (PARTITION BY u) AS ic FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY ts, event_id) - 1.0 AS p "
    f"FROM (SELECT *, {NO_USER} AS u FROM events) e) f) g",
)
def transform_series_null_key(spark, sf_dir):
    out = series.transform_series(keyless_events(spark, sf_dir), "value", ORDER, ["u"], chunk_rows=300)
    return rounded(out.select("event_id", "value_detrended"))


# --- gaps ----------------------------------------------------------------------------------------


def _ffill_sql(partition: str) -> str:
    return (
        "SELECT event_id, round(coalesce(f, avg(f) OVER ()), 6) AS value FROM (SELECT event_id, "
        f"last_value(value IGNORE NULLS) OVER ({partition} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS f FROM ({GAPS}) g) x"
    )


@check("impute_ffill", _ffill_sql(""))
def impute_ffill(spark, sf_dir):
    return rounded(series.impute_ffill(gapped_events(spark, sf_dir), ["value"], ORDER).select("event_id", "value"))


@check("impute_ffill_by_user", _ffill_sql("PARTITION BY user_id"))
def impute_ffill_by_user(spark, sf_dir):
    return rounded(series.impute_ffill(gapped_events(spark, sf_dir), ["value"], ORDER, ["user_id"]).select("event_id", "value"))


def _neighbours(partition: str) -> str:
    back = f"OVER ({partition} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
    ahead = f"OVER ({partition} ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING)"
    known = "CASE WHEN value IS NOT NULL THEN ts END"
    return (
        f"SELECT event_id, epoch_us(ts) AS t, last_value(value IGNORE NULLS) {back} AS p, last_value({known} IGNORE NULLS) {back} AS pt, "
        f"last_value(value IGNORE NULLS) {ahead} AS n, last_value({known} IGNORE NULLS) {ahead} AS nt FROM ({GAPS}) g"
    )


def _interpolated(partition: str) -> str:
    return (
        "SELECT event_id, round(CASE WHEN p IS NULL THEN NULL WHEN n IS NULL OR pt = nt THEN p "
        "ELSE p + (n - p) * (CAST(t - epoch_us(pt) AS DOUBLE) / CAST(epoch_us(nt) - epoch_us(pt) AS DOUBLE)) END, 6) AS value "
        f"FROM ({_neighbours(partition)}) x"
    )


@check("interpolate_time", _interpolated(""))
def interpolate_time(spark, sf_dir):
    return rounded(series.interpolate_time(gapped_events(spark, sf_dir), ["value"], ORDER).select("event_id", "value"))


@check("interpolate_time_by_type", _interpolated("PARTITION BY event_type"))
def interpolate_time_by_type(spark, sf_dir):
    return rounded(series.interpolate_time(gapped_events(spark, sf_dir), ["value"], ORDER, ["event_type"]).select("event_id", "value"))


@check("ffill_bfill", f"SELECT event_id, coalesce(p, n) AS value FROM ({_neighbours('')}) x")
def ffill_bfill(spark, sf_dir):
    return series.ffill_bfill(gapped_events(spark, sf_dir), ["value"], ORDER).select("event_id", "value")


@check("ffill_bfill_by_user", f"SELECT event_id, coalesce(p, n) AS value FROM ({_neighbours('PARTITION BY user_id')}) x")
def ffill_bfill_by_user(spark, sf_dir):
    return series.ffill_bfill(gapped_events(spark, sf_dir), ["value"], ORDER, ["user_id"]).select("event_id", "value")


# --- frames --------------------------------------------------------------------------------------


def _lag_list(y: str, order: str, partition: str = "", n: int = 7) -> str:
    return ", ".join(f"lag({y}, {k}) OVER ({partition} ORDER BY {order}) AS {y}_lag_{k}" for k in range(1, n + 1))


def _rolling_list(y: str, order: str, partition: str = "", windows=(7, 14, 30), shift: int = 0) -> str:
    out = []
    for w in windows:
        frame = f"OVER ({partition} ORDER BY {order} ROWS BETWEEN {w - 1 + shift} PRECEDING AND {f'{shift} PRECEDING' if shift else 'CURRENT ROW'})"
        for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            out.append(f"CASE WHEN count({y}) {frame} = {w} THEN round({f}({y}) {frame}, 5) END AS {y}_rolling_{name}_{w}")
    return ", ".join(out)


KEYED = "PARTITION BY user_id"


@check("lags", f"SELECT event_id, {_lag_list('value', 'ts, event_id')} FROM ({EVENTS}) e")
def lags(spark, sf_dir):
    return series.lags(events(spark, sf_dir), "value", ORDER).drop("ts", "user_id", "event_type", "value")


@check("lags_by_user", f"SELECT event_id, {_lag_list('value', 'ts, event_id', KEYED)} FROM ({EVENTS}) e")
def lags_by_user(spark, sf_dir):
    return series.lags(events(spark, sf_dir), "value", ORDER, ["user_id"]).drop("ts", "user_id", "event_type", "value")


@check("rolling_stats", f"SELECT event_id, {_rolling_list('value', 'ts, event_id')} FROM ({GAPS}) e")
def rolling_stats(spark, sf_dir):
    return rounded(series.rolling_stats(gapped_events(spark, sf_dir), "value", ORDER).drop("ts", "user_id", "event_type", "value"), 5)


@check("rolling_stats_by_user", f"SELECT event_id, {_rolling_list('value', 'ts, event_id', KEYED)} FROM ({EVENTS}) e")
def rolling_stats_by_user(spark, sf_dir):
    return rounded(series.rolling_stats(events(spark, sf_dir), "value", ORDER, ["user_id"]).drop("ts", "user_id", "event_type", "value"), 5)


@check("rolling_stats_shifted", f"SELECT event_id, {_rolling_list('value', 'ts, event_id', '', (7,), 1)} FROM ({EVENTS}) e")
def rolling_stats_shifted(spark, sf_dir):
    out = series.rolling_stats(events(spark, sf_dir), "value", ORDER, windows=(7,), shift=1)
    return rounded(out.drop("ts", "user_id", "event_type", "value"), 5)


@check(
    "ts_feature_table",
    f"SELECT * FROM (SELECT event_id, ts, value, {_lag_list('value', 'ts, event_id')}, {_rolling_list('value', 'ts, event_id')}, {_fourier_sql('ts')}, "
    f"{DOW.format(t='ts')}, {MONTH.format(t='ts')}, {HOUR.format(t='ts')} FROM ({EVENTS}) e) x WHERE value_lag_7 IS NOT NULL AND value_rolling_mean_30 IS NOT NULL",
)
def ts_feature_table(spark, sf_dir):
    base = events(spark, sf_dir).drop("user_id", "event_type")
    out = series.ts_feature_table(base, "value", ORDER)
    shaped = []
    for c, t in out.dtypes:
        digits = 5 if "rolling" in c else 6
        shaped.append((F.round(c, digits) + 0.0).alias(c) if t == "double" and c != "value" and "lag" not in c else F.col(c))
    return out.select(*shaped)


SCALED = "SELECT *, (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS v FROM events"


@check(
    "lookback_sequences",
    f"SELECT event_id, {', '.join(f'round(lag(v, {30 - i}) OVER (ORDER BY ts, event_id), 6) AS x_{i}' for i in (0, 1, 15, 29))}, round(v, 6) AS label, 30 AS length "
    f"FROM ({SCALED}) s QUALIFY lag(v, 30) OVER (ORDER BY ts, event_id) IS NOT NULL",
)
def lookback_sequences(spark, sf_dir):
    table_ = series.lookback_sequences(events(spark, sf_dir), "value", ORDER)
    places = [F.get("sequence", F.lit(i)).alias(f"x_{i}") for i in (0, 1, 15, 29)]
    return rounded(table_.select("event_id", *places, "label", F.size("sequence").alias("length")))


@check(
    "align_exogenous",
    "SELECT event_id, hour, round(lag(v, 1) OVER (ORDER BY ts, event_id), 6) AS newest, round(v, 6) AS label FROM "
    f"(SELECT *, CAST(hour(ts) AS INTEGER) AS hour FROM ({SCALED}) s) t QUALIFY lag(v, 30) OVER (ORDER BY ts, event_id) IS NOT NULL",
)
def align_exogenous(spark, sf_dir):
    """The hour of the label's row stays beside it."""
    table_ = series.lookback_sequences(events(spark, sf_dir).withColumn("hour", F.hour("ts")), "value", ORDER)
    return rounded(table_.select("event_id", "hour", F.get("sequence", F.lit(29)).alias("newest"), "label"))


@check(
    "chronological_split",
    "SELECT event_id, CASE WHEN p < floor(floor(n * 0.8) * 0.9) THEN 'train' WHEN p < floor(n * 0.8) THEN 'validation' ELSE 'test' END AS part FROM "
    "(SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM events) x",
)
def chronological_split(spark, sf_dir):
    return series.chronological_split(events(spark, sf_dir), ORDER).select("event_id", "part")


@check(
    "rolling_origin_folds",
    "SELECT event_id, fold, CASE WHEN p < n - (n // 4) * (4 - fold) THEN 'train' ELSE 'test' END AS part FROM "
    "(SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events) x, "
    "(SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS fold) f WHERE p < n - (n // 4) * (4 - fold) + n // 4",
)
def rolling_origin_folds(spark, sf_dir):
    return series.rolling_origin_folds(events(spark, sf_dir), ORDER, ["user_id"]).select("event_id", "fold", "part")


# --- diagnostics ---------------------------------------------------------------------------------


def _dickey_fuller(keys: str, partition: str) -> str:
    shown = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return (
        f"SELECT {shown}n, round(sxy / sxx, 6) AS slope, round((sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx), 4) AS t_statistic FROM "
        f"(SELECT {shown}count(*) AS n, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy FROM "
        f"(SELECT {shown}value - lag(value) OVER ({partition} ORDER BY ts, event_id) AS y, lag(value) OVER ({partition} ORDER BY ts, event_id) AS x FROM events) d "
        f"WHERE x IS NOT NULL {group}) m"
    )


def _shown(df):
    return df.select(
        *[F.round(c, 4).alias(c) if c == "t_statistic" else F.round(c, 6).alias(c) if c == "slope" else F.col(c) for c in df.columns]
    )


@check("stationarity", _dickey_fuller("", ""))
def stationarity(spark, sf_dir):
    return _shown(series.stationarity(events(spark, sf_dir), "value", ORDER))


@check("stationarity_by_type", _dickey_fuller("event_type", "PARTITION BY event_type"))
def stationarity_by_type(spark, sf_dir):
    return _shown(series.stationarity(events(spark, sf_dir), "value", ORDER, ["event_type"]))


@check(
    "transform_series",
    "SELECT event_id, round(value - (b + a * p), 5) AS value_detrended, round(value - lag(value) OVER (ORDER BY p), 5) AS value_difference, round(ln(value), 5) AS value_log FROM "
    "(SELECT *, regr_slope(value, p) OVER () AS a, regr_intercept(value, p) OVER () AS b FROM "
    "(SELECT event_id, value, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS DOUBLE) AS p FROM events) x) y",
)
def transform_series(spark, sf_dir):
    out = series.transform_series(events(spark, sf_dir), "value", ORDER)
    return rounded(out.select("event_id", "value_detrended", "value_difference", "value_log"), 5)


@check(
    "transform_series_by_type",
    "SELECT event_id, round(value - (b + a * p), 5) AS value_detrended, round(value - lag(value) OVER (PARTITION BY event_type ORDER BY p), 5) AS value_difference, round(ln(value), 5) AS value_log FROM "
    "(SELECT *, regr_slope(value, p) OVER (PARTITION BY event_type) AS a, regr_intercept(value, p) OVER (PARTITION BY event_type) AS b FROM "
    "(SELECT event_id, event_type, value, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS DOUBLE) AS p FROM events) x) y",
)
def transform_series_by_type(spark, sf_dir):
    out = series.transform_series(events(spark, sf_dir), "value", ORDER, ["event_type"])
    return rounded(out.select("event_id", "value_detrended", "value_difference", "value_log"), 5)


def _decomposed(period: int, multiplicative: bool) -> str:
    half = period // 2
    frame = f"OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    one = "OVER (PARTITION BY event_type ORDER BY day)"
    total = f"sum(y) {frame}" + (f" - (lag(y, {half}) {one} + lead(y, {half}) {one}) / 2" if period % 2 == 0 else "")
    op, undo = ("/", "/") if multiplicative else ("-", "-")
    rest = "y / (trend * seasonal)" if multiplicative else "y - trend - seasonal"
    return (
        f"SELECT event_type, day, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round({rest}, 6) AS residual FROM (SELECT d.*, s.seasonal FROM d JOIN "
        f"(SELECT event_type, phase, m {undo} avg(m) OVER (PARTITION BY event_type) AS seasonal FROM "
        f"(SELECT event_type, phase, avg(y {op} trend) AS m FROM d GROUP BY 1, 2) a) s ON d.event_type = s.event_type AND d.phase = s.phase) z"
    ).replace(
        "FROM d",
        f"FROM (SELECT *, (row_number() {one} - 1) % {period} AS phase, CASE WHEN count(y) {frame} = {2 * half + 1} THEN ({total}) / {period} END AS trend FROM ({DAILY}) q) d",
    )


@check("decompose", _decomposed(7, False))
def decompose(spark, sf_dir):
    out = series.decompose(daily(spark, sf_dir), "y", ["day"], ["event_type"])
    return rounded(out.drop("y"))


@check("decompose_multiplicative", _decomposed(4, True))
def decompose_multiplicative(spark, sf_dir):
    out = series.decompose(daily(spark, sf_dir), "y", ["day"], ["event_type"], 4, "multiplicative")
    return rounded(out.drop("y"))


NO_TYPE = "nullif(event_type, 'view')"


@check(
    "decompose_null_key",
    _decomposed(7, False)
    .replace("d.event_type = s.event_type", "d.event_type IS NOT DISTINCT FROM s.event_type")
    .replace(f"({DAILY})", f"(SELECT {NO_TYPE} AS event_type, day, y FROM ({DAILY}) r)"),
)
def decompose_null_key(spark, sf_dir):
    series_without_name = daily(spark, sf_dir).selectExpr(f"{NO_TYPE} AS event_type", "day", "y")
    return rounded(series.decompose(series_without_name, "y", ["day"], ["event_type"]).drop("y"))


# --- forecasts -----------------------------------------------------------------------------------


@check(
    "seasonal_naive",
    f"SELECT event_type, day, round(y, 4) AS y, round(lag(y, 7) OVER (PARTITION BY event_type ORDER BY day), 4) AS forecast FROM ({DAILY}) d",
)
def seasonal_naive(spark, sf_dir):
    return rounded(series.seasonal_naive(daily(spark, sf_dir), "y", ["day"], ["event_type"]), 4)


@check(
    "seasonal_naive_horizon",
    "SELECT user_id, step, forecast FROM (SELECT user_id, value AS forecast, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) "
    "- count(*) OVER (PARTITION BY user_id) + 6 AS o FROM events) x, (SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS step) s WHERE o >= 0 AND (step - 1) % 7 = o",
)
def seasonal_naive_horizon(spark, sf_dir):
    return series.seasonal_naive_horizon(events(spark, sf_dir), "value", ORDER, ["user_id"])


@check(
    "forecast_overlay",
    f"SELECT a.event_type, a.day, round(a.y, 4) AS y, round(f.forecast, 4) AS forecast FROM ({DAILY}) a LEFT JOIN "
    f"(SELECT event_type, day, lag(y, 7) OVER (PARTITION BY event_type ORDER BY day) AS forecast FROM ({DAILY}) d "
    "QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day DESC) <= 7) f ON a.event_type = f.event_type AND a.day = f.day",
)
def forecast_overlay(spark, sf_dir):
    """Predictions for the last seven days beside the whole series."""
    actual = daily(spark, sf_dir)
    forecast = series.seasonal_naive(actual, "y", ["day"], ["event_type"])
    split = series._placed_with_size(forecast, ["event_type"], ["day"], None)
    tail = split.filter("_pos >= _size - 7").select("event_type", "day", "forecast")
    return rounded(series.forecast_overlay(actual, tail, ["event_type", "day"]), 4)


@check(
    "full_ts_prepare",
    "SELECT event_id, ts, round(CASE WHEN p IS NULL THEN n WHEN n IS NULL OR pt = nt THEN p "
    "ELSE p + (n - p) * (CAST(t - epoch_us(pt) AS DOUBLE) / CAST(epoch_us(nt) - epoch_us(pt) AS DOUBLE)) END, 6) AS value, "
    f"{CALENDAR.format(t='ts')} FROM ({_neighbours('')}) x JOIN (SELECT event_id, ts FROM events) e USING (event_id)",
)
def full_ts_prepare(spark, sf_dir):
    gaps = gapped_events(spark, sf_dir).drop("user_id", "event_type")
    return rounded(series.full_ts_prepare(gaps, ["value"], ["event_id"], time_column="ts"))


@check(
    "full_ts_prepare_artificial",
    "SELECT event_id, day AS ts, round(CASE WHEN p IS NULL THEN n WHEN n IS NULL OR pp = np THEN p ELSE p + (n - p) * (CAST(i - pp AS DOUBLE) / (np - pp)) END, 6) AS value, "
    + CALENDAR.format(t="day")
    + " FROM (SELECT event_id, i, CAST(DATE '2020-01-01' + CAST(i AS INTEGER) AS DATE) AS day, "
    "last_value(value IGNORE NULLS) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS p, last_value(k IGNORE NULLS) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS pp, "
    "last_value(value IGNORE NULLS) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS n, last_value(k IGNORE NULLS) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS np "
    f"FROM (SELECT *, CASE WHEN value IS NOT NULL THEN i END AS k FROM (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS i FROM ({GAPS}) g) a) b) c",
)
def full_ts_prepare_artificial(spark, sf_dir):
    """No usable time column: one day per row."""
    gaps = gapped_events(spark, sf_dir).select("event_id", "value")
    return rounded(series.full_ts_prepare(gaps, ["value"], ["event_id"]))


@check(
    "naive_mase",
    "SELECT 'seasonal_naive' AS model, round(avg(e) FILTER (WHERE p >= floor(n * 0.8)), 5) AS mae, "
    "round(avg(e) FILTER (WHERE p >= floor(n * 0.8)) / avg(e) FILTER (WHERE p < floor(n * 0.8)), 5) AS mase FROM "
    "(SELECT abs(value - lag7) AS e, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM "
    "(SELECT ts, event_id, value, lag(value, 7) OVER (ORDER BY ts, event_id) AS lag7, row_number() OVER (ORDER BY ts, event_id) AS r FROM events) x WHERE r > 30) y",
)
def naive_mase(spark, sf_dir):
    return rounded(models.naive_mase(events(spark, sf_dir), "value", ORDER), 5)

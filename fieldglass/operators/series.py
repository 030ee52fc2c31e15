"""Time-series operators. All take an optional series key and order columns that identify a row.

Whatever depends on row order goes through ``ordered``, so one long or hot series is spread over many
tasks; ``chunk_rows`` says how many rows a task should hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import (
    calendar_columns,
    day_of_week_flags,
    fourier_columns,
    hour_flags,
    month_flags,
)
from ..functions.missing import fields, known, known_double, quoted, row_per
from ..sources.scratch import materialize
from .encode import fit_range, minmax_column
from .impute import fill_with, fit_means
from .ordered import POSITION, frame_windows, nearest_known, with_positions
from .quality import drop_rows_any_null

Names = Sequence[str]


def _add(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in added.items()])


def _clean(df: DataFrame, columns: Names) -> DataFrame:
    """NaN becomes NULL in the given columns."""
    replaced = {f.name: known(f) for f in fields(df, columns)}
    return df.select(*[replaced[c].alias(c) if c in replaced else quoted(c) for c in df.columns])


# --- time axis -----------------------------------------------------------------------------------


def parse_and_sort(df: DataFrame, time_column: str, output: str = "ts") -> DataFrame:
    """Add the time as TIMESTAMP_NTZ (NULL if unreadable). Order is taken from it where it matters."""
    dtype = fields(df, [time_column])[0].dataType.simpleString()
    source = quoted(time_column)
    parsed = F.try_to_timestamp(source) if dtype == "string" else source
    return df.withColumn(output, parsed.cast("timestamp_ntz"))


def artificial_daily_index(
    df: DataFrame, order_by: Names, series_key: Names = (), output: str = "ts", start: str = "2020-01-01", chunk_rows: int | None = None
) -> DataFrame:
    """Row number i of the series becomes the day ``start + i``."""
    placed = with_positions(df, series_key, order_by, chunk_rows)
    # NULL for rows so late that their day has no number
    day = F.date_add(F.lit(start).cast("date"), F.col(POSITION).try_cast("int"))
    return placed.select(*[quoted(c) for c in df.columns], day.alias(output))


def has_usable_time(df: DataFrame, time_column: str | None) -> bool:
    """Whether the column exists and every value of it can be read as a time."""
    if not time_column or time_column not in df.columns:
        return False
    parsed = parse_and_sort(df, time_column, "_parsed")
    return parsed.agg(F.count_if(F.col("_parsed").isNull())).first()[0] == 0


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    return _add(df, calendar_columns(quoted(ts)))


def fourier_features(df: DataFrame, ts: str = "ts", periods: Sequence[int] = (7, 30, 365)) -> DataFrame:
    return _add(df, fourier_columns(quoted(ts), periods))


def dow_onehot(df: DataFrame, ts: str = "ts") -> DataFrame:
    return _add(df, day_of_week_flags(quoted(ts)))


def month_onehot(df: DataFrame, ts: str = "ts") -> DataFrame:
    return _add(df, month_flags(quoted(ts)))


def hour_onehot(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Only if some row has an hour other than 0."""
    latest = df.agg(F.max(F.hour(quoted(ts)))).first()[0]
    return _add(df, hour_flags(quoted(ts))) if latest else df


# --- filling gaps --------------------------------------------------------------------------------


def carry_forward(
    df: DataFrame, columns: Names, order_by: Names, series_key: Names = (), chunk_rows: int | None = None
) -> DataFrame:
    """Carry the last value forward as DOUBLE; gaps at the start stay."""
    carried = nearest_known(_clean(df, columns), columns, series_key, order_by, chunk_rows)
    forward = {c: quoted(f"_prev_{c}")["value"].cast("double") for c in columns}
    return carried.select(*[forward[c].alias(c) if c in forward else quoted(c) for c in df.columns])


def impute_ffill(
    df: DataFrame, columns: Names, order_by: Names, series_key: Names = (), chunk_rows: int | None = None
) -> DataFrame:
    """Carry the last value forward; gaps at the start get the column's mean over the filled values.

    The mean is taken after carrying forward, as filling in that order does. Filled columns are DOUBLE.
    """
    filled = materialize(carry_forward(df, columns, order_by, series_key, chunk_rows), "filled")  # read for the means, then for the result
    return fill_with(filled, fit_means(filled, columns))


def interpolate_time(
    df: DataFrame, columns: Names, order_by: Names, series_key: Names = (), backfill: bool = False, chunk_rows: int | None = None
) -> DataFrame:
    """Linear in the first order column. A gap at the end gets the last value, one at the start stays
    (or, with ``backfill``, gets the first value)."""
    found = nearest_known(_clean(df, columns), columns, series_key, order_by, chunk_rows)
    numeric = fields(df, [order_by[0]])[0].dataType.typeName() not in ("timestamp", "timestamp_ntz", "date")

    def seconds(at: Column) -> Column:
        return at.cast("double") if numeric else F.unix_micros(at.cast("timestamp")).cast("double")

    out = {}
    for c in columns:
        before, after = quoted(f"_prev_{c}"), quoted(f"_next_{c}")
        low, high = before["value"].cast("double"), after["value"].cast("double")
        start, end, now = seconds(before["at"]), seconds(after["at"]), seconds(quoted(order_by[0]))
        between = low + (high - low) * F.coalesce(F.try_divide(now - start, end - start), F.lit(0.0))
        value = F.when(before.isNotNull() & after.isNotNull(), between).when(before.isNotNull(), low)
        out[c] = F.coalesce(value, high) if backfill else value
    return found.select(*[out[c].alias(c) if c in out else quoted(c) for c in df.columns])


def ffill_bfill(
    df: DataFrame, columns: Names, order_by: Names, series_key: Names = (), chunk_rows: int | None = None
) -> DataFrame:
    """Carry forward, then backward for what remains at the start."""
    found = nearest_known(_clean(df, columns), columns, series_key, order_by, chunk_rows)
    filled = {c: F.coalesce(quoted(f"_prev_{c}")["value"], quoted(f"_next_{c}")["value"]) for c in columns}
    return found.select(*[filled[c].alias(c) if c in filled else quoted(c) for c in df.columns])


# --- row frames ----------------------------------------------------------------------------------


def _lag_columns(target: str, max_lag: int):
    def build(w) -> dict[str, Column]:
        return {f"{target}_lag_{k}": F.lag(quoted(target), k).over(w) for k in range(1, max_lag + 1)}

    return build


def _rolling_columns(target: str, windows: Sequence[int], shift: int):
    measures = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}

    def build(w) -> dict[str, Column]:
        out = {}
        for size in windows:
            frame = w.rowsBetween(-(size - 1) - shift, -shift)
            full = F.count(quoted(target)).over(frame) == size
            for name, measure in measures.items():
                out[f"{target}_rolling_{name}_{size}"] = F.when(full, measure(quoted(target)).over(frame))
        return out

    return build


def lags(df: DataFrame, target: str, order_by: Names, series_key: Names = (), max_lag: int = 7, chunk_rows: int | None = None) -> DataFrame:
    """``<target>_lag_1..max_lag``."""
    return frame_windows(df, series_key, order_by, _lag_columns(target, max_lag), max_lag, 0, chunk_rows)


def rolling_stats(
    df: DataFrame,
    target: str,
    order_by: Names,
    series_key: Names = (),
    windows: Sequence[int] = (7, 14, 30),
    shift: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of the last rows, NULL until the window is full or
    while it holds a missing value. The current row is included; ``shift=1`` leaves it out."""
    clean = _clean(df, [target])
    return frame_windows(
        clean, series_key, order_by, _rolling_columns(target, windows, shift), max(windows) - 1 + shift, 0, chunk_rows
    )


def ts_feature_table(
    df: DataFrame,
    target: str,
    order_by: Names,
    series_key: Names = (),
    ts: str = "ts",
    max_lag: int = 7,
    windows: Sequence[int] = (7, 14, 30),
    periods: Sequence[int] = (7, 30, 365),
    shift: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Lags, rolling statistics, Fourier terms and calendar flags; rows with any gap are dropped.

    Lags and rolling statistics share one windowing pass.
    """
    lagging, rolling = _lag_columns(target, max_lag), _rolling_columns(target, windows, shift)
    reach = max(max_lag, max(windows) - 1 + shift)
    table = frame_windows(
        _clean(df, [target]), series_key, order_by, lambda w: lagging(w) | rolling(w), reach, 0, chunk_rows
    )
    hourly = df.agg(F.max(F.hour(quoted(ts)))).first()[0]
    moment = quoted(ts)
    table = _add(table, fourier_columns(moment, periods) | day_of_week_flags(moment) | month_flags(moment))
    if hourly:
        table = _add(table, hour_flags(moment))
    return drop_rows_any_null(table)


def lookback_sequences(
    df: DataFrame,
    target: str,
    order_by: Names,
    series_key: Names = (),
    lookback: int = 30,
    scaled: bool = True,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``sequence`` (the ``lookback`` values before the row) and ``label`` (the row's own value).

    Rows without a full history are dropped: n - lookback remain per series. The exogenous columns of
    the row stay beside its label. Missing targets must be filled beforehand.
    """
    value = minmax_column(df, target, fit_range(df, [target])[target]) if scaled else known_double(df, target)
    labelled = df.withColumn("label", value)

    def build(w) -> dict[str, Column]:
        return {"sequence": F.collect_list("label").over(w.rowsBetween(-lookback, -1))}

    table = frame_windows(labelled, series_key, order_by, build, lookback, 0, chunk_rows)
    return table.filter(F.size("sequence") == lookback)


def chronological_split(
    df: DataFrame,
    order_by: Names,
    series_key: Names = (),
    test_size: float = 0.2,
    validation_size: float = 0.1,
    skip: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``part``: the first ``int(n * (1 - test_size))`` rows train, their last tenth validates, the
    rest test; per series. The first ``skip`` rows of a series do not count and get no part."""
    placed = _placed_with_size(df, series_key, order_by, chunk_rows)
    train = F.floor((F.col("_size") - skip) * F.lit(1 - test_size))
    fit = F.floor(train * F.lit(1 - validation_size))
    at = F.col(POSITION) - skip
    part = F.when(at < 0, None).when(at < fit, "train").when(at < train, "validation").otherwise("test")
    return placed.select(*[quoted(c) for c in df.columns], part.alias("part"))


def _placed_with_size(df: DataFrame, series_key: Names, order_by: Names, chunk_rows: int | None) -> DataFrame:
    from .ordered import running_sums

    counted = running_sums(df, series_key, order_by, {"_at": F.lit(1)}, ["_at"], chunk_rows)
    return counted.withColumnsRenamed({"_at_total": "_size"}).withColumn(POSITION, F.col("_at") - 1).drop("_at")


def rolling_origin_folds(
    df: DataFrame, order_by: Names, series_key: Names = (), folds: int = 3, chunk_rows: int | None = None
) -> DataFrame:
    """Rows repeated per fold with ``fold`` and ``part``: an expanding past trains, the next block tests.

    A series of n rows is cut into ``folds + 1`` blocks of ``n // (folds + 1)`` rows, the first block
    taking the remainder.
    """
    placed = _placed_with_size(df, series_key, order_by, chunk_rows)
    block = F.floor(F.col("_size") / F.lit(folds + 1))
    repeated = placed.select("*", F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold"))
    start = F.col("_size") - block * (F.lit(folds + 1) - F.col("fold"))
    part = F.when(F.col(POSITION) < start, "train").when(F.col(POSITION) < start + block, "test")
    return repeated.select(*[quoted(c) for c in df.columns], "fold", part.alias("part")).filter(F.col("part").isNotNull())


# --- diagnostics and transforms ------------------------------------------------------------------


def stationarity(
    df: DataFrame, target: str, order_by: Names, series_key: Names = (), chunk_rows: int | None = None
) -> DataFrame:
    """Lag-0 Dickey-Fuller statistic per series: t of the slope of the change on the previous value."""

    def build(w) -> dict[str, Column]:
        return {"_before": F.lag(known_double(df, target), 1).over(w)}

    stepped = frame_windows(df, series_key, order_by, build, 1, 0, chunk_rows)
    both = stepped.select(
        *[quoted(k) for k in series_key],
        F.col("_before").alias("x"),
        (known_double(df, target) - F.col("_before")).alias("y"),
    ).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    moments = both.groupBy(*[quoted(k) for k in series_key]).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.regr_syy("y", "x").alias("syy"),
        F.regr_sxy("y", "x").alias("sxy"),
    )
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    residual = F.try_divide(F.col("syy") - slope * F.col("sxy"), (F.col("n") - 2).cast("double"))
    error = F.sqrt(F.try_divide(residual, F.col("sxx")))
    return moments.select(
        *[quoted(k) for k in series_key], "n", slope.alias("slope"), F.try_divide(slope, error).alias("t_statistic")
    )


def _join_on_series(rows: DataFrame, parameters: DataFrame, keys: Names) -> DataFrame:
    """Rows with the parameters of their series; the NULL series has its own."""
    named = parameters.select(*[quoted(k).alias(f"_of_{i}") for i, k in enumerate(keys)], *[c for c in parameters.columns if c not in keys])
    same = [quoted(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)]
    return rows.join(named, reduce(lambda a, b: a & b, same), "left").drop(*[f"_of_{i}" for i in range(len(keys))])


def transform_series(
    df: DataFrame, target: str, order_by: Names, series_key: Names = (), chunk_rows: int | None = None
) -> DataFrame:
    """Add ``<target>_detrended`` (residual of the line over positions), ``_difference`` and ``_log``."""
    y = known_double(df, target)
    placed = materialize(with_positions(df, series_key, order_by, chunk_rows).drop("_gpos"), "placed")
    at = F.col(POSITION).cast("double")
    keys = list(series_key)

    def build(w) -> dict[str, Column]:
        return {f"{target}_difference": y - F.lag(y, 1).over(w)}

    stepped = frame_windows(placed, series_key, order_by, build, 1, 0, chunk_rows)
    lines = placed.groupBy(*[quoted(k) for k in keys]).agg(
        F.regr_slope(y, at).alias("_slope"), F.regr_intercept(y, at).alias("_icept")
    )
    if keys:
        # AQE broadcasts the fitted lines if they are few and splits hot series otherwise
        joined = _join_on_series(stepped, lines, keys)
    else:
        line = lines.first()
        joined = stepped.select("*", F.lit(line[0]).cast("double").alias("_slope"), F.lit(line[1]).cast("double").alias("_icept"))
    return joined.select(
        *[quoted(c) for c in df.columns],
        (y - (F.col("_icept") + F.col("_slope") * at)).alias(f"{target}_detrended"),
        quoted(f"{target}_difference"),
        F.when(y > 0, F.ln(y)).alias(f"{target}_log"),
    )


def decompose(
    df: DataFrame,
    target: str,
    order_by: Names,
    series_key: Names = (),
    period: int = 7,
    model: str = "additive",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``residual``.

    Trend: centred moving average over a period (an even period averages two neighbouring windows).
    Seasonal: mean detrended value per phase, centred over the phases.
    """
    y = known_double(df, target)
    half = period // 2

    def build(w) -> dict[str, Column]:
        middle = w.rowsBetween(-half, half)
        full = F.count(y).over(middle) == 2 * half + 1
        total = F.sum(y).over(middle)
        if period % 2 == 0:
            total = total - (F.lag(y, half).over(w) + F.lead(y, half).over(w)) / 2
        return {"trend": F.when(full, total / period)}

    placed = materialize(with_positions(df, series_key, order_by, chunk_rows).drop("_gpos"), "placed")
    trended = materialize(frame_windows(placed, series_key, order_by, build, half, half, chunk_rows), "trend")
    additive = model == "additive"
    detrended = y - F.col("trend") if additive else F.try_divide(y, F.col("trend"))
    keys = [quoted(k) for k in series_key]
    phased = trended.withColumn("_phase", F.pmod(F.col(POSITION), F.lit(period)))
    means = phased.groupBy(*keys, "_phase").agg(F.avg(detrended).alias("_mean"))
    centre = F.avg("_mean").over(Window.partitionBy(*(keys or [F.lit(0)])))
    seasons = means.select(
        *keys, "_phase", (F.col("_mean") - centre if additive else F.try_divide(F.col("_mean"), centre)).alias("seasonal")
    )
    joined = _join_on_series(phased, seasons if series_key else F.broadcast(seasons), [*series_key, "_phase"])
    rest = (
        y - F.col("trend") - F.col("seasonal")
        if additive
        else F.try_divide(y, F.col("trend") * F.col("seasonal"))
    )
    return joined.select(*[quoted(c) for c in df.columns], "trend", "seasonal", rest.alias("residual"))


# --- naive forecasts -----------------------------------------------------------------------------


def seasonal_naive(
    df: DataFrame, target: str, order_by: Names, series_key: Names = (), period: int = 7, chunk_rows: int | None = None
) -> DataFrame:
    """Add ``forecast``: the value one period earlier."""

    def build(w) -> dict[str, Column]:
        return {"forecast": F.lag(quoted(target), period).over(w)}

    return frame_windows(df, series_key, order_by, build, period, 0, chunk_rows)


def seasonal_naive_horizon(
    df: DataFrame, target: str, order_by: Names, series_key: Names = (), period: int = 7, horizon: int = 24, chunk_rows: int | None = None
) -> DataFrame:
    """``(series key, step, forecast)`` for the ``horizon`` rows after the end of each series."""
    keys = [quoted(k) for k in series_key]
    placed = _placed_with_size(df, series_key, order_by, chunk_rows)
    # the last period of each series: at most `period` rows each
    tail = placed.filter(F.col(POSITION) >= F.col("_size") - period)
    offset = (F.col(POSITION) - (F.col("_size") - period)).cast("int")
    steps = F.expr(f"filter(sequence(1, {horizon}), s -> (s - 1) % {period} = _offset)")
    return (
        tail.withColumn("_offset", offset)
        .select(*keys, known_double(df, target).alias("forecast"), F.explode(steps).alias("step"))
        .select(*keys, "step", "forecast")
    )


def forecast_overlay(actual: DataFrame, forecast: DataFrame, on: Names) -> DataFrame:
    """The whole series with predictions beside the rows that have one."""
    return actual.join(forecast, list(on), "left")


def full_ts_prepare(
    df: DataFrame,
    columns: Names,
    order_by: Names,
    series_key: Names = (),
    time_column: str | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Time axis (read, or one day per row), time interpolation, forward and backward fill, calendar."""
    if has_usable_time(df, time_column):
        timed = parse_and_sort(df, time_column, "ts")
        order = ["ts", *[c for c in order_by if c not in ("ts", time_column)]]
    else:
        timed = materialize(artificial_daily_index(df, order_by, series_key, "ts", chunk_rows=chunk_rows), "timed")
        order = ["ts"]
    # interpolation leaves only a gap at the start, which the backward fill closes in the same pass
    filled = interpolate_time(timed, columns, order, series_key, backfill=True, chunk_rows=chunk_rows)
    return calendar_features(filled, "ts")

"""Chunked order-dependent operators against the same windows over the whole table."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldglass.operators import ordered

CHUNKS = [37, 150, 5_000]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(events):
    """A third of the rows belong to one user; one series is longer than several chunks."""
    return events.select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id") + 2).alias("u"),
        F.expr("CASE WHEN event_id % 11 = 0 OR event_id BETWEEN 400 AND 560 OR event_id < 3 THEN NULL ELSE value END").alias("v"),
    )


@pytest.mark.parametrize("chunk_rows", CHUNKS)
@pytest.mark.parametrize("key", [[], ["u"]])
def test_positions(skewed, key, chunk_rows):
    got = ordered.with_positions(skewed, key, ["ts", "event_id"], chunk_rows)
    every = Window.partitionBy(F.lit(0)).orderBy(*key, "ts", "event_id")
    series = Window.partitionBy(*(key or [F.lit(0)])).orderBy("ts", "event_id")
    want = skewed.select(
        "event_id",
        (F.row_number().over(series) - 1).alias("_pos"),
        (F.row_number().over(every) - 1).alias("_gpos"),
    )
    assert rows(got, "event_id", "_pos", "_gpos") == rows(want, "event_id", "_pos", "_gpos")


@pytest.mark.parametrize("chunk_rows", CHUNKS)
@pytest.mark.parametrize("key", [[], ["u"]])
def test_running_sums(skewed, key, chunk_rows):
    got = ordered.running_sums(skewed, key, ["ts", "event_id"], {"s": F.col("event_id")}, ["s"], chunk_rows)
    series = Window.partitionBy(*(key or [F.lit(0)]))
    want = skewed.select(
        "event_id",
        F.sum("event_id").over(series.orderBy("ts", "event_id")).alias("s"),
        F.sum("event_id").over(series).alias("s_total"),
    )
    assert rows(got, "event_id", "s", "s_total") == rows(want, "event_id", "s", "s_total")


@pytest.mark.parametrize("chunk_rows", CHUNKS)
@pytest.mark.parametrize("key", [[], ["u"]])
def test_frames(skewed, key, chunk_rows):
    def build(w):
        return {
            "lagged": F.lag("v", 7).over(w),
            "led": F.lead("v", 3).over(w),
            "top": F.max("v").over(w.rowsBetween(-29, 0)),
            "past": F.collect_list("event_id").over(w.rowsBetween(-30, -1)),
        }

    got = ordered.frame_windows(skewed, key, ["ts", "event_id"], build, 30, 3, chunk_rows)
    series = Window.partitionBy(*(key or [F.lit(0)])).orderBy("ts", "event_id")
    want = skewed.select("*", *[c.alias(n) for n, c in build(series).items()])
    columns = ["event_id", "lagged", "led", "top", "past"]
    assert rows(got, *columns) == rows(want, *columns)


@pytest.mark.parametrize("chunk_rows", CHUNKS)
@pytest.mark.parametrize("key", [[], ["u"]])
def test_nearest_known(skewed, key, chunk_rows):
    got = ordered.nearest_known(skewed, ["v"], key, ["ts", "event_id"], chunk_rows)
    series = Window.partitionBy(*(key or [F.lit(0)])).orderBy("ts", "event_id")
    want = skewed.select(
        "event_id",
        F.last("v", True).over(series.rowsBetween(Window.unboundedPreceding, 0)).alias("p"),
        F.first("v", True).over(series.rowsBetween(0, Window.unboundedFollowing)).alias("n"),
    )
    assert rows(got, "event_id", "_prev_v.value", "_next_v.value") == rows(want, "event_id", "p", "n")


def test_cut_points_of_every_type(spark, events):
    frame = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("t"),
        "ts",
        F.col("value").alias("d"),
        F.col("value").cast("decimal(12,3)").alias("dec"),
        F.concat(F.lit("k'\\\"\n"), F.col("event_id").cast("string")).alias("s"),
        F.when(F.col("event_id") % 3 > 0, F.col("ts").cast("date")).alias("day"),
    )
    for column in ["t", "ts", "d", "dec", "s", "day"]:
        got = ordered.with_positions(frame, [], [column, "event_id"], 90)
        want = frame.select(
            "event_id",
            (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(column, "event_id")) - 1).alias("_pos"),
        )
        assert rows(got, "event_id", "_pos") == rows(want, "event_id", "_pos")


def test_chained_operators_on_split_series(spark, events):
    """Trend, seasons and differences of one long series, cut and uncut."""
    from fieldglass.operators import series

    base = events.select("event_id", "ts", "value")
    for run in (
        lambda size: series.decompose(base, "value", ["ts", "event_id"], period=7, chunk_rows=size),
        lambda size: series.transform_series(base, "value", ["ts", "event_id"], chunk_rows=size),
        lambda size: series.rolling_stats(base, "value", ["ts", "event_id"], windows=(7, 14), chunk_rows=size),
    ):
        cut, whole = run(60), run(10_000)
        shown = [F.round(c, 8).alias(c) if t == "double" else F.col(c) for c, t in whole.dtypes]
        assert rows(cut.select(*shown), *whole.columns) == rows(whole.select(*shown), *whole.columns)


def test_cuts_are_short_unless_a_series_is_hot(skewed):
    chunking = ordered.find_chunks(skewed, ["u", "ts", "event_id"], 100)
    inner = [cut for cut in chunking.cuts if len(cut) > 1]
    assert inner and {cut[0] for cut in inner} == {"1"}
    assert all(len(cut) < 3 for cut in chunking.cuts)
    assert len(chunking.split_chunks(1)) <= len(inner) + 1


@pytest.mark.parametrize("chunk_rows", [5, 12, 30, 90, 400])
@pytest.mark.parametrize("where", ["series", "order", "both"])
def test_null_keys_beside_a_second_long_group(events, chunk_rows, where):
    """NULL series and NULL order values sort first; both the NULL group and another group are longer than a chunk."""
    some = F.col("event_id") % 3
    frame = events.select(
        "event_id",
        F.when(some == 0, F.lit(None) if where != "order" else F.lit(0)).when(some == 1, 5).otherwise(F.col("user_id") + 10).alias("u"),
        (F.col("ts") if where == "series" else F.when(F.col("event_id") % 2 == 0, F.col("ts"))).alias("t"),
        F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("v"),
    )
    series = Window.partitionBy("u").orderBy("t", "event_id")
    every = Window.partitionBy(F.lit(0)).orderBy("u", "t", "event_id")
    want = frame.select("event_id", (F.row_number().over(series) - 1).alias("_pos"), (F.row_number().over(every) - 1).alias("_gpos"))
    got = ordered.with_positions(frame, ["u"], ["t", "event_id"], chunk_rows)
    assert rows(got, "event_id", "_pos", "_gpos") == rows(want, "event_id", "_pos", "_gpos")
    want = frame.select("event_id", F.last("v", True).over(series.rowsBetween(Window.unboundedPreceding, 0)).alias("p"))
    got = ordered.nearest_known(frame, ["v"], ["u"], ["t", "event_id"], chunk_rows)
    assert rows(got, "event_id", "_prev_v.value") == rows(want, "event_id", "p")
    got = ordered.frame_windows(frame, ["u"], ["t", "event_id"], lambda w: {"lagged": F.lag("v", 3).over(w)}, 3, 0, chunk_rows)
    assert rows(got, "event_id", "lagged") == rows(frame.select("event_id", F.lag("v", 3).over(series).alias("lagged")), "event_id", "lagged")


def test_long_null_series_is_split(events):
    frame = events.select("event_id", "ts", F.when(F.col("event_id") % 3 > 0, F.col("user_id")).alias("u"))
    chunking = ordered.find_chunks(frame, ["u", "ts", "event_id"], 90)
    counts = frame.filter("u IS NULL").groupBy(chunking.column().alias("c")).count().collect()
    assert len(counts) > 2 and max(r["count"] for r in counts) < 250


def test_few_and_many_cuts_agree(skewed):
    want = rows(ordered.with_positions(skewed, ["u"], ["ts", "event_id"], 5_000), "event_id", "_pos", "_gpos")
    for size in (5, 11, 60, 250):
        assert rows(ordered.with_positions(skewed, ["u"], ["ts", "event_id"], size), "event_id", "_pos", "_gpos") == want

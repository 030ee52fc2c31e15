"""Properties of samples, splits, selections and models that have no SQL twin."""

import pytest
from pyspark.sql import functions as F

from fieldglass.checks.base import MEASURES, line_measures
from fieldglass.operators import models, sampling, selection, series

SF = "/root/testdata/sf0.001"
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


@pytest.fixture(scope="module")
def lines(spark):
    return line_measures(spark, SF)


def keys(df):
    return sorted(tuple(r) for r in df.select(*KEY).collect())


def test_split_is_complete_disjoint_and_independent_of_partitions(lines):
    split = sampling.holdout_split(lines, KEY)
    parts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    assert sum(parts.values()) == lines.count()
    assert 0.75 < parts["train"] / lines.count() < 0.85
    again = sampling.holdout_split(lines.repartition(7), KEY)
    assert keys(split.filter("part = 'test'")) == keys(again.filter("part = 'test'"))


def test_sample_size_is_exact_and_repeatable(lines):
    sample = sampling.calibration_sample(lines, KEY, 0.1)
    assert sample.count() == int(lines.count() * 0.1)
    assert keys(sample) == keys(sampling.calibration_sample(lines.repartition(5), KEY, 0.1))
    few = lines.limit(0).unionAll(lines.filter("l_orderkey < 3"))
    assert sampling.calibration_sample(few, KEY).count() == min(10, few.count())


def test_bounded_sample(lines):
    whole = selection.bounded_sample(lines, KEY, 1.0)
    assert whole.count() == lines.count() and not whole.first()["approximate"]
    part = selection.bounded_sample(lines, KEY, 0.1)
    assert 0.07 < part.count() / lines.count() < 0.13 and part.first()["approximate"]


def test_lasso_ignores_what_does_not_matter(lines):
    noise = lines.withColumn("noise", F.pmod(F.xxhash64(*KEY), F.lit(1000)).cast("double"))
    exact = noise.withColumn("y", 5 * F.col("l_quantity"))
    scores = {r["feature"]: r["score"] for r in selection.lasso_importance(exact, "y", ["l_quantity", "noise", "l_tax"], 1.0).collect()}
    assert scores["noise"] == scores["l_tax"] == 0.0 and scores["l_quantity"] > 4


def test_elimination_keeps_what_matters(lines):
    exact = lines.withColumn("y", 5 * F.col("l_quantity") - 200 * F.col("l_discount"))
    kept = selection.recursive_elimination(exact, "y", MEASURES, 2).filter("kept").collect()
    assert {r["feature"] for r in kept} == {"l_quantity", "l_discount"}


def test_components(spark, lines):
    reduced, names, model = selection.pca(lines, MEASURES, 0.95)
    assert names == ["pca_0", "pca_1", "pca_2"] and reduced.count() == lines.count()
    ratios = [r["ratio"] for r in selection.explained_variance(model, spark).orderBy("component").collect()]
    assert ratios == sorted(ratios, reverse=True)
    assert selection.pca_by_variance(lines, MEASURES, 0.95)[1] == ["pca_0"]


def test_oversampling_balances(lines):
    skewed = lines.withColumn("c", (F.col("l_linenumber") == 1).cast("int"))
    counts = [r["count"] for r in selection.oversample(skewed, "c", KEY).groupBy("c").count().collect()]
    assert max(counts) / min(counts) < 1.1


def test_univariate_selection(lines):
    chosen = selection.univariate_selection(lines, "volume", MEASURES, 2).filter("kept").collect()
    assert {r["feature"] for r in chosen} == {"l_quantity", "l_extendedprice"}


def test_linear_models_win_on_a_line(lines):
    exact = lines.withColumn("y", 5 * F.col("l_quantity") - 200 * F.col("l_discount"))
    board = models.compare_regressors(exact, "y", MEASURES, KEY, exclude=["gbt", "random_forest"]).orderBy("rank").collect()
    assert board[0]["rmse"] < 0.1 and board[-1]["model"] == "decision_tree"


def test_clusters_and_their_centres(lines):
    scored = models.centre_distance(lines, ["l_quantity", "l_extendedprice"], 3)
    assert scored.select("cluster").distinct().count() == 3
    assert scored.agg(F.min("distance")).first()[0] >= 0


def test_forecasts_cover_the_tail(events):
    base = events.select("event_id", "ts", "value")
    scored = models.score_and_compare(base, "value", ["ts", "event_id"], lookback=10)
    sequences = series.lookback_sequences(base, "value", ["ts", "event_id"], lookback=10).count()
    assert {r["count"] for r in scored.groupBy("model").count().collect()} == {sequences - int(sequences * 0.8)}


def test_sample_of_hot_keys_and_equal_rows(spark, monkeypatch):
    """A key with most of the rows, and rows that are the same: sizes stay exact, and the choice does not depend on partitions."""
    from collections import Counter

    monkeypatch.setattr(sampling, "BORDER_ROWS", 3)
    rows = [(1, i, "a") for i in range(400)] + [(2, 0, "b")] * 300 + [(i, i, "ab"[i % 2]) for i in range(10, 60)] + [(None, 5, None)] * 40
    df = spark.createDataFrame(rows, "k int, v int, s string")
    have = Counter(rows)
    for share in (0.0, 0.013, 0.4, 0.77, 1.0):
        got = Counter(map(tuple, sampling.calibration_sample(df.repartition(7), ["k"], share, least=0).collect()))
        assert sum(got.values()) == int(len(rows) * share) and all(n <= have[r] for r, n in got.items())
        assert got == Counter(map(tuple, sampling.calibration_sample(df.repartition(2), ["k"], share, least=0).collect()))
    per = Counter(r[2] for r in rows)
    got = Counter(r["s"] for r in sampling.calibration_sample(df, ["k"], 0.1, strata="s").collect())
    assert got == Counter({s: -(-n // 10) for s, n in per.items()})
    assert sampling.calibration_sample(df.limit(0), ["k"]).count() == 0


def test_splits_by_a_given_number(lines):
    by = F.expr("double(l_orderkey % 10) / 10")
    assert {r["part"] for r in sampling.holdout_split(lines, KEY, by=by).filter("l_orderkey % 10 < 8").select("part").distinct().collect()} == {"train"}
    assert selection.bounded_sample(lines, KEY, 0.2, by=by).filter("l_orderkey % 10 > 1").count() == 0

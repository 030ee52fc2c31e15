import numpy as np
import pandas as pd
import pytest

from fieldglass.operators import association


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 700
    x = rng.integers(0, 12, n).astype(float)
    x[: n // 3] = 4.0  # a third of the rows share one value
    pdf = pd.DataFrame({"t": np.round(x + rng.normal(0, 4, n), 1), "x": x, "z": rng.normal(size=n), "c": 1.0})
    pdf.loc[::13, "x"] = np.nan
    pdf.loc[::17, "t"] = np.nan
    return pdf


def brute(pdf, a, b, method):
    both = pdf[[a, b]].dropna()
    x, y = both[a].to_numpy(), both[b].to_numpy()
    if method == "spearman":
        x, y = both[a].rank().to_numpy(), both[b].rank().to_numpy()
    if method != "kendall":
        return 0.0 if x.std() == 0 or y.std() == 0 else float(np.corrcoef(x, y)[0, 1])
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    scale = np.sqrt((sx**2).sum()) * np.sqrt((sy**2).sum())
    return 0.0 if scale == 0 else float((sx * sy).sum() / scale)


@pytest.mark.parametrize("chunk_rows", [60, 100_000])
@pytest.mark.parametrize("method", association.METHODS)
def test_against_brute_force(spark, frame, method, chunk_rows):
    df = spark.createDataFrame(frame)
    pairs = [("t", "x"), ("t", "z"), ("z", "x"), ("t", "c")]
    args = () if method == "pearson" else (chunk_rows,)
    got = {(r["a"], r["b"]): r["r"] for r in getattr(association, method)(df, pairs, *args).collect()}
    for pair in pairs:
        assert got[pair] == pytest.approx(brute(frame, *pair, method), abs=1e-9)


def test_wide_and_long_pearson_agree(spark, frame, monkeypatch):
    df = spark.createDataFrame(frame)
    pairs = [("t", "x"), ("t", "z"), ("t", "c")]
    wide = sorted(map(tuple, association.pearson(df, pairs).collect()))
    monkeypatch.setattr(association, "WIDE_PAIRS", 0)
    long = sorted(map(tuple, association.pearson(df, pairs).collect()))
    assert [(a, b, round(r, 12)) for a, b, r in wide] == [(a, b, round(r, 12)) for a, b, r in long]


def test_many_pairs_of_large_numbers(spark):
    """Values near 1e9 that differ by about 1: many pairs give what each pair gives alone."""
    df = spark.range(400).selectExpr(*[f"1e9 + (id * {i + 3}) % 17 / 20 AS c{i}" for i in range(12)])
    pairs = [(f"c{i}", f"c{j}") for i in range(12) for j in range(i + 1, 12)]
    together = {(r.a, r.b): r.r for r in association.pearson(df, pairs).collect()}
    for pair in pairs[:12]:
        assert together[pair] == pytest.approx(association.pearson(df, [pair]).first().r, abs=1e-11)


def test_many_pairs_send_each_row_once(spark, monkeypatch):
    """Rows with gaps, infinities, constants and far-off values in one pass; no long form with a row per pair and row."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(900, 1)) + rng.normal(size=(900, 7))
    pdf = pd.DataFrame(base, columns=[f"c{i}" for i in range(7)])
    pdf["c1"] += 1e9
    pdf.loc[pdf.index % 3 == 0, "c2"] = np.nan
    pdf.loc[pdf.index % 3 == 0, "c3"] -= 1e8  # far from the rows where c2 is known
    pdf["c4"] = 0.1
    pdf.loc[7, "c5"] = np.inf
    pdf["c6"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    pairs = [(a, b) for a in pdf for b in pdf if a < b]
    alone = {p: association.pearson(df, [p]).first().r for p in pairs}
    monkeypatch.setattr(association, "_pair_columns", None)
    monkeypatch.setattr(association.pairs_, "TILE", 4)
    monkeypatch.setattr(association.pairs_, "ROWS", 100)
    assert {(r.a, r.b): r.r for r in association.pearson(df, pairs).collect()} == pytest.approx(alone, abs=1e-9)
    assert [r.r for r in association.pearson(df.limit(0), pairs).collect()] == [0.0] * len(pairs)


@pytest.mark.parametrize("chunk_rows", [None, 7, 150])
def test_kendall_parts(spark, chunk_rows, monkeypatch):
    """Parts of few rows, values too frequent for one, infinities; no running sums of digits, whose rows are five times the pairs of values."""
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.integers(0, 3, 600).astype(float), "b": np.round(rng.normal(size=600), 1), "c": rng.normal(size=600)})
    pdf.loc[::50, "c"], pdf.loc[::70, "b"], pdf.loc[3::60, "b"] = np.inf, -np.inf, np.nan
    pdf["d"], pdf["e"] = -pdf["c"], 1.0
    monkeypatch.setattr(association, "running_sums", None)
    pairs = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("c", "a"), ("a", "e"), ("e", "e")]
    got = {(r.a, r.b): r.r for r in association.kendall(spark.createDataFrame(pdf), pairs, chunk_rows).collect()}
    finite = pdf.replace([np.inf, -np.inf], [1e9, -1e9])
    assert got == {p: pytest.approx(brute(finite, *p, "kendall"), abs=1e-12) for p in pairs[:-1]} | {("e", "e"): 0.0}

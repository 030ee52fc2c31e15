"""Empty, constant and awkward inputs, and the functions without a query of their own."""

import pytest
from pyspark.sql import functions as F

from fieldglass.config import EtlConfig
from fieldglass.operators import association, encode, impute, models, profile, quality, schema, selection, series
from fieldglass.sources import files, registry, sinks
from fieldglass.sources.scratch import materialize, scratch_path

SF = "/root/testdata/sf0.001"


def by_column(report):
    return {r["column_name"]: r.asDict() for r in report.collect()}


def test_profile_of_an_empty_table(spark):
    report = by_column(profile.profile_columns(spark.createDataFrame([], "a int, b string, c double")))
    assert set(report) == {"a", "b", "c"}
    assert all(r["total_rows"] == r["missing_count"] == r["distinct_count"] == 0 for r in report.values())
    assert not any(r["is_constant"] for r in report.values())


def test_profile_of_every_type(spark):
    df = spark.sql(
        "SELECT CAST(1 AS TINYINT) a, CAST(2.50 AS DECIMAL(5,2)) b, DATE'2024-01-01' c, TIMESTAMP'2024-01-01 00:00:00' d, true e, "
        "array(1, 2) f, named_struct('x', 1) g, map('k', 1) h, X'00' i, repeat('x', 500) j, CAST('NaN' AS DOUBLE) k, -0.0D l UNION ALL "
        "SELECT NULL, 2.5, NULL, NULL, false, array(2, 1), NULL, map('k', 2), NULL, repeat('x', 499) || 'y', NULL, 0.0D"
    )
    found = by_column(profile.profile_columns(df))
    assert {c: r["distinct_count"] for c, r in found.items()} == dict(a=1, b=1, c=1, d=1, e=2, f=2, g=1, h=2, i=1, j=2, k=1, l=1)
    assert found["k"]["missing_count"] == 2 and found["k"]["nonnull_count"] == 1
    assert found["b"]["is_constant"] and found["l"]["is_constant"]


def test_quantiles_of_small_and_skewed_columns(spark):
    df = spark.createDataFrame([(float(i // 2), 5.0, None, float(i % 2) * 1e9) for i in range(41)], "a double, b double, c double, d double")
    for margin in (0.003, 0.0):  # without a margin brackets miss and are widened
        profile.MARGIN, kept = margin, profile.MARGIN
        try:
            got = {r["column_name"]: r for r in profile.exact_quantiles(df, ["a", "b", "c", "d"], {"lo": 0.0, "q": 0.31, "hi": 1.0}, 7).collect()}
        finally:
            profile.MARGIN = kept
        want = df.toPandas()
        for c in ("a", "b", "d"):
            assert [got[c]["lo"], got[c]["q"], got[c]["hi"]] == pytest.approx([want[c].quantile(p) for p in (0.0, 0.31, 1.0)])
        assert "c" not in got


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "c d", "e-f"])
    clean, names = schema.sanitize_names(df)
    assert clean.columns == ["a_b", "c_d", "e_f"]
    assert schema.restore_names(clean, names).columns == df.columns
    assert schema.sanitize_names(clean)[1] == {}
    with pytest.raises(ValueError):
        schema.sanitize_names(spark.createDataFrame([(1, 2)], ["a.b", "a_b"]))


def test_targets_and_fallback():
    assert schema.resolve_targets(["a_b", "c"], ["a.b", "z"], "z") == (["a_b"], "a_b")
    assert schema.resolve_targets(["a_b", "c"], ["a.b", "c"], "c") == (["a_b", "c"], "c")
    with pytest.raises(ValueError):
        schema.resolve_targets(["a"], ["b"])
    assert schema.fallback_features([], [str(i) for i in range(12)]) == [str(i) for i in range(12)]
    assert schema.fallback_features([], ["a", "b", "c"], 2) == ["a", "b"]
    assert schema.fallback_features(["x"], ["y"]) == ["x"]


def test_roles(spark):
    df = spark.sql("SELECT 1 a, 2L b, 1.5D c, CAST(1 AS DECIMAL(4,1)) d, 's' e, DATE'2024-01-01' f, true g, CAST(1 AS SMALLINT) h")
    roles = {r[0]: r[1] for r in schema.classify_columns(df, profile.profile_columns(df), ["c"], numerical=["a"]).collect()}
    assert roles == dict(a="numerical", b="numerical", d="numerical", e="categorical", f="temporal", h="numerical")


def test_settings_reject_unknown_names():
    assert EtlConfig().replaced(missing_threshold=0.5).missing_threshold == 0.5
    with pytest.raises(ValueError):
        EtlConfig().replaced(missing_treshold=0.5)


def test_thresholds_are_strict(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 95, 1).alias("a"), F.lit(None).cast("int").alias("b"))
    report = profile.profile_columns(df)
    assert quality.drop_high_missing(df, report).columns == ["a"]
    assert quality.drop_high_missing(df, report, 1.0).columns == ["a", "b"]
    assert quality.drop_constant(df, report).columns == ["b"]


def test_means_keep_their_fraction(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b double")
    assert [r[0] for r in impute.impute_mean(df, ["a", "b"]).select("a").collect()] == [1.0, 2.0, 1.5]
    assert {r[0] for r in impute.impute_ffill_as_mean(df, ["b"]).select("b").collect()} == {0.0}


def test_indicators_and_scaling(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 4.0), (None, 9.0)], "c string, v double")
    hot = encode.one_hot(df, "c").collect()
    assert [sum(r["c_encoded"]) for r in hot if r["c"]] == [1.0] * 3
    assert [sum(r["c_encoded"]) for r in hot if not r["c"]] == [0.0]
    wide, names = encode.indicator_columns(df, "c")
    assert names == ["c_x", "c_y"] and wide.agg(F.sum("c_x")).first()[0] == 2.0
    unit = encode.scale(df, ["v"], "minmax").agg(F.min("v_scaled"), F.max("v_scaled")).first()
    assert tuple(unit) == (0.0, 1.0)
    standard = encode.scale(df, ["v"]).agg(F.avg("v_scaled"), F.stddev_samp("v_scaled")).first()
    assert tuple(standard) == pytest.approx((0.0, 1.0), abs=1e-12)
    assert encode.scale(df, ["v"], "none") is df


def test_many_labels_are_joined_in_two_ways(spark, monkeypatch):
    df = spark.createDataFrame([(w,) for w in "aaabbcde"] + [(None,)], "c string")
    want = sorted(map(tuple, encode.string_index(df, "c").collect()), key=str)
    monkeypatch.setattr(encode, "MAX_BROADCAST_LABELS", 2)
    assert sorted(map(tuple, encode.string_index(df, "c", chunk_rows=2).collect()), key=str) == want


def test_undefined_correlations_are_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0, None), (2.0, 7.0, 1.0)], "a double, b double, c double")
    for method in association.METHODS:
        scores = association.correlation_scores(df, ["a"], ["b", "c"], method).collect()
        assert [r["score"] for r in scores] == [0.0, 0.0]
    zero = association.correlation_scores(df, ["a"], ["b", "c"])
    kept = selection.rank_and_keep(zero, {"correlation": 1.0}, ["correlation"]).filter("kept").collect()
    assert [r["feature"] for r in kept] == ["b", "c"]


def test_component_counts():
    assert selection.component_count(1, 0.95) == 1
    assert selection.component_count(10, 0.95) == 9
    assert selection.component_count(10, 3) == 3


def test_series_shorter_than_the_look_back(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "t int, y double")
    assert series.lookback_sequences(df, "y", ["t"], lookback=5).count() == 0
    assert series.lookback_sequences(df, "y", ["t"], lookback=4).count() == 1


def test_single_row_and_empty_series(spark):
    one = spark.createDataFrame([(1, None)], "t int, y double")
    assert series.ffill_bfill(one, ["y"], ["t"]).first()["y"] is None
    assert series.interpolate_time(one.limit(0), ["y"], ["t"]).count() == 0
    assert series.impute_ffill(one, ["y"], ["t"]).first()["y"] is None


def test_unreadable_times_fall_back_to_days(spark):
    df = spark.createDataFrame([(2, "x"), (1, "2024-01-01")], "i int, at string")
    assert not series.has_usable_time(df, "at")
    days = series.full_ts_prepare(df.withColumn("y", F.lit(1.0)), ["y"], ["i"], time_column="at").orderBy("i").collect()
    assert [str(r["ts"]) for r in days] == ["2020-01-01", "2020-01-02"]


# --- sources -------------------------------------------------------------------------------------


def test_formats(spark):
    df = spark.range(3)
    path = scratch_path(spark, "sniffed")
    df.write.option("header", "true").csv(path)
    assert files.sniff_format(spark, path) == "csv"
    assert files.load_table(spark, path).dtypes == [("id", "string")]
    with pytest.raises(FileNotFoundError):
        files.load_table(spark, path + "-absent")
    with pytest.raises(ValueError):
        files.load_table(spark, path, "orc?")
    if not files.delta_available(spark):
        with pytest.raises(RuntimeError):
            files.delta_scan(spark, path)
        assert sinks.write_with_fallback(df, scratch_path(spark))[0] == "parquet"
        with pytest.raises(RuntimeError):
            sinks.write_with_fallback(df, scratch_path(spark), ["delta"])


def test_absent_report_is_empty(spark):
    assert sinks.read_report(spark, scratch_path(spark)).count() == 0


def test_only_bad_files(spark):
    table, names, rejected, accepted = files.read_csv_files(spark, [scratch_path(spark)])
    assert table is None and names == [] and rejected.first()["reason"] == "not found"


def test_device_and_date_from_the_path(spark, tmp_path):
    (tmp_path / "dev1_2024-01-02.csv").write_text("a,b\n1,x\n")
    (tmp_path / "dev2_2024-01-03.csv").write_text("a,b\n2,\n")
    read, names, _, _ = files.read_csv_files(spark, [str(tmp_path)], origin=True)
    assert sorted(map(tuple, read.selectExpr("a", "b", "device", "string(file_date)").collect())) == [
        (1, "x", "dev1", "2024-01-02"),
        (2, None, "dev2", "2024-01-03"),
    ]
    assert names == ["a", "b", "device", "file_date"]


def test_artifact_paths(spark):
    from datetime import datetime

    path = scratch_path(spark)
    for run, day in (("r1", 1), ("r2", 2)):
        registry.record_artifacts(spark, path, run, datetime(2024, 1, day), [("a", f"/{run}", "{}")])
    catalog = registry.read(spark, path, registry.ARTIFACTS)
    assert registry.latest_artifact_path(catalog, "a") == "/r2"
    assert registry.latest_artifacts(catalog, datetime(2024, 1, 1)).first()["path"] == "/r1"
    with pytest.raises(LookupError):
        registry.latest_artifact_path(catalog, "b")


def test_materialized_tables_keep_their_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert materialize(df).agg(F.sum("x")).first()[0] == 90


# --- models --------------------------------------------------------------------------------------


def test_failing_target_does_not_stop_the_rest(spark):
    def body(target):
        if target == "bad":
            raise ValueError("no")
        return spark.range(1)

    results, status = models.per_target_runs(spark, ["a", "bad", "c"], body)
    assert list(results) == ["a", "c"]
    assert [r["status"] for r in status.orderBy("target").collect()] == ["ok", "failed", "ok"]


def test_missing_target(spark):
    with pytest.raises(ValueError):
        models.prepare_ml(spark.range(1), "y")


def test_corrupt_and_empty_files_are_skipped(spark, tmp_path):
    import gzip

    (tmp_path / "good.csv").write_text("a,b\n1,x\n2,y\n")
    (tmp_path / "other.csv").write_text("a,c\n3,z\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bad.csv.gz").write_bytes(gzip.compress(b"a,b\n" + b"5,q\n" * 5000)[:60] + b"broken")
    read, names, rejected, accepted = files.read_csv_files(spark, [str(tmp_path)])
    assert sorted(r.a for r in read.collect()) == [1, 2, 3] and names == ["a", "b", "c"] and accepted == 2
    assert {r.path.rsplit("/", 1)[1] for r in rejected.collect()} == {"empty.csv", "bad.csv.gz"}


def test_declared_schema_reads_without_inference(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,x\n")
    (tmp_path / "two.csv").write_text("a,b\nnone,y\n")
    read = files.read_csv_files(spark, [str(tmp_path)], schema="a INT, b STRING")[0]
    assert sorted(map(tuple, read.collect()), key=str) == [(1, "x"), (None, "y")]


def test_declared_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("x,y\n10,20\n")
    (tmp_path / "two.csv").write_text("y,z,x\n21,0,11\n")
    (tmp_path / "lacks.csv").write_text("x,z\n5,6\n")
    (tmp_path / "bad.csv.gz").write_bytes(b"no archive " * 50)
    read, names, rejected, accepted = files.read_csv_files(spark, [str(tmp_path)], schema="x INT, y INT")
    assert sorted(map(tuple, read.collect())) == [(10, 20), (11, 21)] and names == ["x", "y"] and accepted == 2
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in rejected.collect()}
    assert reasons["lacks.csv"] == "without column y" and "header check" in reasons["bad.csv.gz"] and len(reasons) == 2


def test_odd_heads_and_paths(spark, tmp_path):
    import bz2
    import gzip

    folder = tmp_path / "day=1" / "with space"
    folder.mkdir(parents=True)
    (tmp_path / "_hidden.csv").write_text("h\n1\n")
    (folder / "q%20#.csv").write_text("\n\ufeff\"a,1\",b,b,\n1,x,y,z\n\"2\",\"p,q\",,w\n")
    (folder / "g.csv.gz").write_bytes(gzip.compress(b"b0,k\r\n7,true\r\n"))
    (folder / "b.csv.bz2").write_bytes(bz2.compress(b"k\nfalse\n"))
    (folder / "cut.csv.gz").write_bytes(gzip.compress(b"k\n" + b"true\n" * 9)[:-4])
    (folder / "header_only.csv").write_text("k,m")
    read, names, rejected, accepted = files.read_csv_files(spark, [str(tmp_path), str(tmp_path / "none.csv")])
    assert accepted == 4 and set(names) == {"a,1", "b1", "b2", "_c3", "b0", "k", "m"}
    types = dict(read.dtypes)
    assert types["a,1"] == types["b0"] == "int" and types["k"] == "boolean" and types["m"] == types["b1"] == "string"
    rows = sorted(((r["a,1"], r.b1, r.b2, r._c3, r.b0, r.k) for r in read.collect()), key=str)
    assert rows == sorted([(1, "x", "y", "z", None, None), (2, "p,q", None, "w", None, None), (None, None, None, None, 7, True), (None, None, None, None, None, False)], key=str)
    assert {r.path.rsplit("/", 1)[1]: r.reason for r in rejected.collect()}.keys() == {"cut.csv.gz", "none.csv"}


@pytest.mark.parametrize("value, kind", [("1", "int"), ("+3000000000", "bigint"), ("9" * 25, "decimal(38,0)"), ("9" * 50, "double"), ("1.5", "double"), ("-1e3", "double"),
                                         ("2024-02-29", "date"), ("2023-02-29", "string"), ("2024-01-01 10:00:00.5", "timestamp"), ("True", "boolean"), (" 1", "double"), ("", "string"), ("2024", "int")])
def test_types_of_text(spark, tmp_path, value, kind):
    (tmp_path / "one.csv").write_text(f"a,b\n{value},x\n,y\n")
    read = files.read_csv_files(spark, [str(tmp_path)])[0]
    assert read.dtypes[0] == ("a", kind)
    assert [r.b for r in read.filter("a IS NULL").collect()] == (["y"] if value else ["x", "y"])


def test_types_widen_over_files():
    assert [files.type_of(k).simpleString() for k in (0, files.INT | files.LONG, files.LONG | files.DOUBLE, files.DATE | files.TIMESTAMP, files.INT | files.DATE, files.BOOLEAN | files.INT)] == [
        "string", "bigint", "double", "timestamp", "string", "string"]


def test_heads_of_a_store_only_spark_opens(spark, tmp_path):
    import gzip

    (tmp_path / "one.csv").write_text("\na,b\n1,x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bad.csv.gz").write_bytes(gzip.compress(b"a\n")[:5])
    heads = {r.path.rsplit("/", 1)[1]: (r.header, r.reason) for r in files._scanned_heads(spark, [str(tmp_path), str(tmp_path / "none.csv")]).collect()}
    assert heads == {"one.csv": ("a,b", None), "empty.csv": (None, "empty file"), "bad.csv.gz": (None, "unreadable"), "none.csv": (None, "not found")}
    assert not files.openable(["viewfs://store/in"]) and files.openable(["/data", "file:/data"])


def test_heads_read_one_block_of_plain_files(spark, tmp_path):
    """The plan of the heads has no text scan, and that of the table one scan for all files."""
    from fieldglass.sources.heads import file_heads

    for i in range(5):
        (tmp_path / f"f{i}.csv").write_text(f"a,c{i}\n{i},1\n")
    assert "FileScan" not in file_heads(spark, [str(tmp_path)])._jdf.queryExecution().toString()
    read = files.read_csv_files(spark, [str(tmp_path)])[0]
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert sorted(r.a for r in read.filter("c3 = 1 OR c4 = 1").collect()) == [3, 4]


def test_failed_write_falls_back(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(RuntimeError, match="parquet.*csv"):
        sinks.write_with_fallback(spark.range(3), str(tmp_path / "file" / "table"))
    nested = spark.range(3).selectExpr("array(id) AS a")
    assert sinks.write_with_fallback(spark.range(3), str(tmp_path / "t"))[0] == "parquet"
    with pytest.raises(RuntimeError):
        sinks.write_with_fallback(nested, str(tmp_path / "u"), ["csv"])
    assert not (tmp_path / "u").exists()


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_with_fallback(spark.range(3), path)
    failing = spark.range(3).select(F.raise_error(F.lit("no value")).alias("x"))
    with pytest.raises(RuntimeError):
        sinks.write_with_fallback(failing, path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sinks.write_with_fallback(spark.read.parquet(path).limit(2), path)[0] == "parquet"
    assert spark.read.parquet(path).count() == 2


def test_constants_are_found_without_distinct_values(spark):
    nan = float("nan")
    rows = [(1, 1.0, nan, None, "x" * 100, [1], -0.0), (1, 2.0, nan, None, "x" * 100, [1], 0.0), (None, 1.0, None, None, "x" * 100, [1], 0.0)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d string, e string, f array<int>, g double")
    flags = profile.constant_flags(df)
    assert {r["column_name"] for r in flags.filter("is_constant").collect()} == {"a", "c", "e", "f", "g"}
    assert {r["column_name"]: r["is_constant"] for r in profile.profile_columns(df).collect()} == {r["column_name"]: r["is_constant"] for r in flags.collect()}
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and "hashpartitioning" not in plan
    assert quality.drop_constant(df).columns == ["b", "d"] and not profile.constant_flags(df.limit(0)).filter("is_constant").count()


def test_encoding_many_labels_loses_nothing(spark):
    many = spark.range(300).selectExpr("id", "CASE WHEN id % 10 > 0 THEN concat('s', id % 150) END AS c")
    long = encode.one_hot_long(many, ["id"], "c")
    assert long.count() == 270 and long.select("label_index").distinct().count() == 135
    assert len(encode.indicator_columns(many, "c")[1]) == 135
    with pytest.raises(ValueError):
        encode.indicator_columns(many, "c", 100)

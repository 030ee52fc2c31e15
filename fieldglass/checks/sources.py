"""Queries over readers, writers and run tables. Files are written from the tables, then read back."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..operators import profile, sampling
from ..sources import files, heads, registry, sinks
from ..sources.scratch import scratch_path
from .base import MEASURES, check, columns_of, profile_sql, rounded, table

EVENT = ["event_id", "user_id", "event_type", "value"]


def _text_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value")


def _write_csv(df, path, by=None):
    writer = df.write.option("header", "true")
    (writer.partitionBy(by) if by else writer).csv(path)
    return path


def day_files(spark, sf_dir):
    """Events as CSV, one folder per day."""
    events = _text_events(spark, sf_dir)
    return _write_csv(events.withColumn("day", F.substring("ts", 1, 10)).repartition("day"), scratch_path(spark, "days"), "day")


def _paths(spark, folder):
    return [r["path"] for r in files.list_files(spark, folder).filter("path LIKE '%.csv'").select("path").collect()]


READ = "SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value FROM events"


@check("csv_scan", READ)
def csv_scan(spark, sf_dir):
    read = files.csv_scan(spark, _write_csv(_text_events(spark, sf_dir), scratch_path(spark, "csv")))
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check("csv_scan_empty_text_is_null", "SELECT CAST(event_id AS INTEGER) AS event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type FROM events")
def csv_scan_empty_text_is_null(spark, sf_dir):
    sparse = table(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 11 = 0 THEN '' ELSE event_type END AS event_type")
    return files.csv_scan(spark, _write_csv(sparse, scratch_path(spark, "csv")))


@check("csv_scan_untyped", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS VARCHAR) AS value FROM events")
def csv_scan_untyped(spark, sf_dir):
    kept = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return files.csv_scan_untyped(spark, _write_csv(kept, scratch_path(spark, "csv")))


def drifting_files(spark, sf_dir):
    """Five kinds of day files: a column more, one less, another order, text among the numbers."""
    events = table(spark, sf_dir, "events").withColumn("kind", F.dayofmonth("ts") % 5)
    root = scratch_path(spark, "drift")
    kinds = [
        ["event_id", "user_id", "value"],
        ["event_id", "user_id", "value", "event_type"],
        ["event_id", "value"],
        ["value", "user_id", "event_id"],
        ["event_id", "user_id", "CASE WHEN event_id % 7 = 0 THEN 'broken' ELSE string(value) END AS value"],
    ]
    for kind, shown in enumerate(kinds):
        _write_csv(events.filter(F.col("kind") == kind).selectExpr(*shown), f"{root}/kind_{kind}")
    return root


@check(
    "union_by_name_widen",
    "SELECT CAST(event_id AS INTEGER) AS event_id, CASE WHEN k <> 2 THEN CAST(user_id AS INTEGER) END AS user_id, CASE WHEN k = 1 THEN event_type END AS event_type, "
    "CASE WHEN k = 4 AND event_id % 7 = 0 THEN 'broken' ELSE CAST(value AS VARCHAR) END AS value FROM (SELECT *, day(ts) % 5 AS k FROM events) e",
)
def union_by_name_widen(spark, sf_dir):
    return files.read_csv_files(spark, _paths(spark, drifting_files(spark, sf_dir)))[0]


@check("skip_bad_files", READ)
def skip_bad_files(spark, sf_dir):
    """A missing path and an empty file among the good ones."""
    folder = day_files(spark, sf_dir)
    spark.range(0).select(F.lit("").alias("x")).coalesce(1).write.text(f"{folder}/day=empty")
    empty = [r["path"] for r in files.list_files(spark, f"{folder}/day=empty").filter("length = 0").select("path").collect()]
    read = files.read_csv_files(spark, [f"{folder}/absent.csv", *empty, *_paths(spark, folder)])[0]
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check("skip_corrupt_file", READ)
def skip_corrupt_file(spark, sf_dir):
    """A file that is no archive in spite of its name, among the good ones."""
    folder = day_files(spark, sf_dir)
    _broken_archive(spark, f"{folder}/day=broken/part.csv.gz")
    return files.read_csv_files(spark, [folder])[0].withColumn("ts", F.col("ts").cast("timestamp_ntz"))


DECLARED = "event_id INT, user_id INT, value DOUBLE"


@check("csv_declared_schema_reordered", "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, value FROM events")
def csv_declared_schema_reordered(spark, sf_dir):
    """Day files whose columns come in three orders, two with a column more, read by declared names."""
    events = table(spark, sf_dir, "events").withColumn("kind", F.dayofmonth("ts") % 3)
    root = scratch_path(spark, "reordered")
    for kind, shown in enumerate((["event_id", "user_id", "value"], ["value", "event_type", "event_id", "user_id"], ["user_id", "value", "event_id", "event_type"])):
        _write_csv(events.filter(F.col("kind") == kind).select(*shown), f"{root}/kind_{kind}")
    return files.read_csv_files(spark, [root], schema=DECLARED)[0]


def _broken_archive(spark, path):
    system, where = files._filesystem(spark, path)
    stream = system.create(where)
    stream.write(bytearray(b"no archive " * 50))
    stream.close()


@check("csv_declared_schema_corrupt", "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, value FROM events")
def csv_declared_schema_corrupt(spark, sf_dir):
    """A file that is no archive and one that lacks a column, among the good ones."""
    folder = day_files(spark, sf_dir)
    _broken_archive(spark, f"{folder}/day=broken/part.csv.gz")
    _write_csv(table(spark, sf_dir, "events").select("event_id", "value").limit(5), f"{folder}/day=narrow")
    return files.read_csv_files(spark, [folder], schema=DECLARED)[0]


@check("file_heads", "SELECT 'event_id,ts,user_id,event_type,value' AS header, CAST(NULL AS VARCHAR) AS reason, count(DISTINCT CAST(ts AS DATE)) AS files FROM events")
def file_heads(spark, sf_dir):
    """Headers of the day files, one block read of each."""
    found = heads.file_heads(spark, [day_files(spark, sf_dir)])
    return found.groupBy("header", "reason").agg(F.count(F.lit(1)).alias("files"))


@check("reject_empty_file", "SELECT 'empty file' AS reason, count(DISTINCT CAST(ts AS DATE)) AS n FROM events")
def reject_empty_file(spark, sf_dir):
    """One empty file per day."""
    folder = day_files(spark, sf_dir)
    for path in _paths(spark, folder):
        system, empty = files._filesystem(spark, path.rsplit("/", 1)[0] + "/empty.csv")
        system.create(empty).close()
    return files.read_csv_files(spark, [folder])[2].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@check("rejected_files", "SELECT reason, count(*) AS n FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, 'not found' AS reason FROM events) x GROUP BY reason")
def rejected_files(spark, sf_dir):
    """One absent path per day present."""
    folder = day_files(spark, sf_dir)
    paths = _paths(spark, folder)
    rejected = files.read_csv_files(spark, paths[:1] + [p + ".gone" for p in paths])[2]
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@check("file_window", f"SELECT r.*, CAST(r.ts AS DATE) AS file_date FROM ({READ}) r WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) - 3 FROM events)")
def file_window(spark, sf_dir):
    """The last three days of files, with the date taken from each file's path."""
    recent = files.file_window(spark, day_files(spark, sf_dir), 3)
    read = files.read_csv_files(spark, [r["path"] for r in recent.select("path").collect()], origin=True)[0]
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz")).drop("device")


@check("load_table", "SELECT * FROM lineitem")
def load_table(spark, sf_dir):
    return files.load_table(spark, f"{sf_dir}/lineitem.parquet")


@check("load_table_csv", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def load_table_csv(spark, sf_dir):
    path = _write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), scratch_path(spark, "stored"))
    return files.load_table(spark, path)


@check("parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark, sf_dir):
    return files.parquet_scan(spark, f"{sf_dir}/orders.parquet")


# --- sinks ---------------------------------------------------------------------------------------


@check("write_with_fallback", "SELECT *, CASE WHEN true THEN 'parquet' END AS format FROM orders")
def write_with_fallback(spark, sf_dir):
    """Without the Delta connector the first usable format is Parquet."""
    fmt, path = sinks.write_with_fallback(table(spark, sf_dir, "orders"), scratch_path(spark, "stored"))
    return files.load_table(spark, path, fmt).withColumn("format", F.lit(fmt))


@check("single_csv", "SELECT c_mktsegment, CAST(count(*) AS VARCHAR) AS n FROM customer GROUP BY c_mktsegment")
def single_csv(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    path = sinks.single_csv(counts, scratch_path(spark, "single"))
    return files.csv_scan_untyped(spark, path)


@check("report_roundtrip", profile_sql("SELECT * FROM orders", columns_of("orders")))
def report_roundtrip(spark, sf_dir):
    path = sinks.write_report(profile.profile_columns(table(spark, sf_dir, "orders")), scratch_path(spark, "report"))
    return rounded(sinks.read_report(spark, path))


@check("selected_features_sink", "SELECT l_quantity, l_tax, l_extendedprice FROM lineitem")
def selected_features_sink(spark, sf_dir):
    artifacts = sinks.write_selected_features(
        table(spark, sf_dir, "lineitem"), scratch_path(spark, "features"), {"l_extendedprice": ["l_quantity", "l_tax"]}, ["l_extendedprice"]
    )
    return files.load_table(spark, artifacts[0][1], "parquet")


@check("selected_features_sink_per_target", "SELECT l_tax, l_discount FROM lineitem")
def selected_features_sink_per_target(spark, sf_dir):
    chosen = {"l_extendedprice": ["l_quantity"], "l_discount": ["l_tax"]}
    artifacts = sinks.write_selected_features(table(spark, sf_dir, "lineitem"), scratch_path(spark, "features"), chosen, list(chosen))
    return files.load_table(spark, dict((a, p) for a, p, _ in artifacts)["features_l_discount"], "parquet")


@check("model_store", "SELECT l_orderkey, l_partkey, round(3 * l_quantity + 200 * l_discount, 3) AS prediction FROM lineitem")
def model_store(spark, sf_dir):
    """A fitted pipeline, saved, loaded and applied: the target is exactly linear."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", (3 * F.col("l_quantity") + 200 * F.col("l_discount")).alias("y")
    )
    stages = [
        VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="x"),
        LinearRegression(featuresCol="x", labelCol="y", solver="normal"),
    ]
    path = sinks.save_model(Pipeline(stages=stages).fit(lines), scratch_path(spark, "model"))
    scored = sinks.load_model(path).transform(lines)
    return rounded(scored.select("l_orderkey", "l_partkey", "prediction"), 3)


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


@check("calibration_sample_sink", "SELECT CAST(floor(count(*) * 0.1) AS BIGINT) AS rows, CAST(floor(count(*) * 0.1) AS BIGINT) AS matched FROM lineitem")
def calibration_sample_sink(spark, sf_dir):
    """The stored sample has exactly a tenth of the rows, all of them found in the table."""
    lines = table(spark, sf_dir, "lineitem")
    path = sinks.write_sample(sampling.calibration_sample(lines, LINE_KEY), scratch_path(spark, "sample"))
    read = files.csv_scan(spark, path).select(*LINE_KEY, "l_quantity")
    found = read.join(lines.select(*LINE_KEY).distinct(), LINE_KEY, "left_semi")
    total = read.agg(F.count(F.lit(1)).alias("rows"))
    return total.join(F.broadcast(found.agg(F.count(F.lit(1)).alias("matched"))), F.lit(True))


# --- run tables ----------------------------------------------------------------------------------


@check(
    "artifact_catalog_latest",
    "SELECT artifact, ts, run_id, path FROM (SELECT o_orderpriority AS artifact, o_orderdate AS ts, CAST(o_orderkey AS VARCHAR) AS run_id, concat('run/', CAST(o_orderkey AS VARCHAR)) AS path, "
    "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS r FROM orders) x WHERE r = 1",
)
def artifact_catalog_latest(spark, sf_dir):
    """Orders as catalogue entries, appended in two runs."""
    entries = table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS run_id", "o_orderdate AS ts", "o_orderpriority AS artifact", "concat('run/', o_orderkey) AS path", "'{}' AS schema_json"
    )
    path = scratch_path(spark, "catalog")
    registry.append(entries.filter("CAST(run_id AS BIGINT) % 2 = 0"), path)
    registry.append(entries.filter("CAST(run_id AS BIGINT) % 2 = 1"), path)
    return registry.latest_artifacts(registry.read(spark, path, registry.ARTIFACTS))


MODEL_ENTRIES = "string(o_orderkey) AS run_id", "o_orderdate AS ts", "o_orderpriority AS target", "o_orderstatus AS model", "concat('m/', o_orderkey) AS path"


@check(
    "model_registry_latest",
    "SELECT target, ts, run_id, model, path FROM (SELECT o_orderpriority AS target, o_orderdate AS ts, CAST(o_orderkey AS VARCHAR) AS run_id, o_orderstatus AS model, concat('m/', CAST(o_orderkey AS VARCHAR)) AS path, "
    "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS r FROM orders) x WHERE r = 1",
)
def model_registry_latest(spark, sf_dir):
    path = registry.append(table(spark, sf_dir, "orders").selectExpr(*MODEL_ENTRIES), scratch_path(spark, "models"))
    return registry.latest_models(registry.read(spark, path, registry.MODELS))


def _metric_rows(spark, sf_dir):
    """Naive forecasts of two neighbours as two models, measured per return flag; the third has no value."""
    lines = table(spark, sf_dir, "lineitem")
    found = lines.groupBy(F.col("l_returnflag").alias("target")).agg(
        F.avg(F.abs(F.col("l_discount") - F.col("l_tax"))).alias("tax"), F.avg("l_discount").alias("zero"), F.lit(None).cast("double").alias("void")
    )
    return found.selectExpr(
        "'r1' AS run_id", "target", "stack(3, 'tax', tax, 'zero', zero, 'void', void) AS (model, value)"
    ).selectExpr("run_id", "target", "model", "'rmse' AS metric", "value")


METRIC_SQL = (
    "SELECT 'r1' AS run_id, l_returnflag AS target, 'tax' AS model, 'rmse' AS metric, avg(abs(l_discount - l_tax)) AS value FROM lineitem GROUP BY l_returnflag "
    "UNION ALL SELECT 'r1', l_returnflag, 'zero', 'rmse', avg(l_discount) FROM lineitem GROUP BY l_returnflag "
    "UNION ALL SELECT 'r1', l_returnflag, 'void', 'rmse', NULL FROM lineitem GROUP BY l_returnflag"
)


@check("metrics_sink", f"SELECT run_id, target, model, metric, round(value, 6) AS value FROM ({METRIC_SQL}) m")
def metrics_sink(spark, sf_dir):
    path = registry.record_metrics(_metric_rows(spark, sf_dir), scratch_path(spark, "metrics"))
    return rounded(registry.read(spark, path, registry.METRICS))


@check(
    "leaderboard",
    f"SELECT target, row_number() OVER (PARTITION BY target ORDER BY value ASC NULLS LAST, model) AS rank, model, round(value, 6) AS value FROM ({METRIC_SQL}) m",
)
def leaderboard(spark, sf_dir):
    return rounded(registry.leaderboard(_metric_rows(spark, sf_dir)))


@check("profile_of_measures", profile_sql(f"SELECT {', '.join(MEASURES)} FROM lineitem", [(m, "double") for m in MEASURES]))
def profile_of_measures(spark, sf_dir):
    """Only the listed columns are read from the file."""
    return rounded(profile.profile_columns(table(spark, sf_dir, "lineitem"), MEASURES))

from pyspark.sql import functions as F

from fieldglass.sources import scratch
from fieldglass.sources.files import path_exists


def test_release_deletes_only_what_this_application_wrote(spark):
    root = scratch.scratch_root(spark)
    other = f"{root}/elsewhere"
    spark.range(2).write.mode("overwrite").parquet(other)
    table = scratch.materialize(spark.range(5).withColumn("x", F.lit(1)))
    assert table.count() == 5 and path_exists(spark, f"{root}/fieldglass")
    scratch.release_scratch(spark)
    assert not path_exists(spark, f"{root}/fieldglass/{spark.sparkContext.applicationId}")
    assert spark.read.parquet(other).count() == 2


def test_a_scope_deletes_what_is_not_kept(spark):
    outer = scratch.scratch_path(spark)
    with scratch.scratch_scope(spark):
        gone = scratch.materialize(spark.range(5))
        with scratch.scratch_scope(spark):
            scratch.materialize(spark.range(3))
            inner = scratch.materialize(spark.range(2), keep=True)
        kept = scratch.materialize(gone.unionByName(inner), keep=True)
        paths = [f.rsplit("/", 1)[0] for df in (gone, inner) for f in df.inputFiles()]
        assert path_folder(paths[0]) != path_folder(outer)
    assert kept.count() == 7 and path_folder(kept.inputFiles()[0].rsplit("/", 1)[0]).rstrip("/") == path_folder(outer)
    assert not any(path_exists(spark, p) for p in paths)


def test_a_scope_ends_with_an_error_too(spark):
    try:
        with scratch.scratch_scope(spark):
            path = scratch.materialize(spark.range(5)).inputFiles()[0]
            raise ValueError
    except ValueError:
        assert not path_exists(spark, path) and scratch._scopes() == []


def path_folder(path: str) -> str:
    return path.removeprefix("file://").rsplit("/", 1)[0]

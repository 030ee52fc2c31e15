"""Reading many files whose columns drift, and reading tables by format."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from .heads import file_heads, openable
from .scratch import materialize

#: How a failed read or write arrives: found while planning, or by a job.
FAILURES = (PySparkException, Py4JJavaError)
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "nullValue": ""}
DATE_IN_PATH = r"(\d{4}-\d{2}-\d{2})"
DEVICE_IN_PATH = r"([^/]+?)_\d{4}-\d{2}-\d{2}"


# --- the file system -----------------------------------------------------------------------------


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, jvm_path = _filesystem(spark, path)
    found = files.globStatus(jvm_path)
    return found is not None and len(found) > 0


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what a failed write has left at ``path``, if anything."""
    files, jvm_path = _filesystem(spark, path)
    try:
        files.delete(jvm_path, True)
    except Py4JJavaError:  # nothing can be there, for example below a file
        pass


def replace_path(spark: SparkSession, new: str, target: str) -> None:
    """Move ``new`` to ``target``; what was there goes only once the new one is complete, and comes back if it cannot be moved."""
    files, new_path = _filesystem(spark, new)
    _, path = _filesystem(spark, target)
    _, old = _filesystem(spark, f"{new}.old")
    held = files.exists(path) and files.rename(path, old)
    if not files.rename(new_path, path):
        if held:
            files.rename(old, path)
        raise AnalysisException(f"{new} could not be moved to {target}")
    if held:
        files.delete(old, True)


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, length, modified)`` of the files under folders, files or globs, listed by Spark."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def empty_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files of length 0 under folders, files or globs. A scan never shows them, so the file system is asked."""
    empty = []
    for path in paths:
        system, jvm_path = _filesystem(spark, path)
        for status in system.globStatus(jvm_path) or []:
            found = system.listFiles(status.getPath(), True)
            while found.hasNext():
                entry = found.next()
                name = entry.getPath().getName()
                if entry.getLen() == 0 and name[0] not in "._":
                    empty.append(entry.getPath().toString())
    return empty


def row_path() -> Column:
    """Path of the file a row comes from, as it is on disk; Spark shows it with percent signs for special characters."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def origin_columns(path: Column) -> list[Column]:
    """``device`` and ``file_date`` as read from a file's path."""
    date = F.nullif(F.regexp_extract(path, DATE_IN_PATH, 1), F.lit(""))
    device = F.nullif(F.regexp_extract(path, DEVICE_IN_PATH, 1), F.lit(""))
    return [device.alias("device"), F.try_to_date(date).alias("file_date")]


def file_window(spark: SparkSession, paths: str | Sequence[str], days: int = 2) -> DataFrame:
    """The listed files whose path date lies in the last ``days`` days present."""
    date = F.try_to_date(F.nullif(F.regexp_extract("path", DATE_IN_PATH, 1), F.lit("")))
    dated = list_files(spark, paths).withColumn("file_date", date).filter(F.col("file_date").isNotNull())
    latest = dated.agg(F.max("file_date")).first()[0]
    return dated.filter(F.col("file_date") > F.date_sub(F.lit(latest).cast("date"), days))


# --- CSV -----------------------------------------------------------------------------------------


def csv_scan(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Header, malformed fields NULL, empty text NULL; types are inferred unless a schema is given."""
    reader = spark.read.options(**CSV_OPTIONS)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def csv_scan_untyped(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header only; every column is text."""
    return spark.read.option("header", "true").csv(paths if isinstance(paths, str) else list(paths))


def _wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """Type that holds values of both: equal, BIGINT for integers, DOUBLE for numbers, else STRING."""
    if left == right:
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return T.LongType()
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def union_by_name_widen(frames: Sequence[DataFrame]) -> tuple[DataFrame, list[str]]:
    """Union by name; absent columns are NULL and differing types widened. Also all column names."""
    types: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema:
            types[field.name] = _wider(types[field.name], field.dataType) if field.name in types else field.dataType

    def widened(frame: DataFrame) -> DataFrame:
        return frame.select(*[quoted(f.name).cast(types[f.name]).alias(f.name) for f in frame.schema])

    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [widened(f) for f in frames])
    return out, list(types)


# How a text value may be read, as bits: what a column holds in all files decides its type.
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
MOMENT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
#: Files that differ from the most common header are broadcast up to this number and joined by a shuffle beyond it.
BROADCAST_FILES = 100_000


def _kind(value: Column) -> Column:
    """The narrowest way to read a text value; 0 for a missing one."""
    fits = lambda t: value.try_cast(t).isNotNull()
    whole = F.when(fits("int"), INT).when(fits("bigint"), LONG).when(fits("decimal(38,0)"), DECIMAL).otherwise(DOUBLE)
    return (
        F.when(value.isNull(), 0)
        .when(value.rlike(WHOLE_NUMBER), whole)
        .when(fits("double"), DOUBLE)
        .when(value.rlike(DAY) & fits("date"), DATE)
        .when(value.rlike(MOMENT) & fits("timestamp"), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> T.DataType:
    """The type that holds all values of these kinds; text if there is no value at all."""
    within = lambda *some: kinds and not kinds & ~sum(some)
    if within(INT):
        return T.IntegerType()
    if within(INT, LONG):
        return T.LongType()
    if within(INT, LONG, DECIMAL):
        return T.DecimalType(38, 0)
    if within(INT, LONG, DECIMAL, DOUBLE):
        return T.DoubleType()
    if within(DATE):
        return T.DateType()
    if within(DATE, TIMESTAMP):
        return T.TimestampType()
    return T.BooleanType() if within(BOOLEAN) else T.StringType()


def parsed(value: Column, kind: T.DataType) -> Column:
    """The value in the type, NULL where it is malformed."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.IntegralType):
        return F.when(value.rlike(WHOLE_NUMBER), value.try_cast(kind))
    return value.try_cast(kind)


def column_names(header: str) -> list[str]:
    """Names in a header line: repeated ones get their place added, empty ones are named by it."""
    names = next(csv.reader([header]))
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _local(path: Column) -> Column:
    """One spelling of a file's path; Spark and pyarrow differ in the slashes after the scheme."""
    return F.regexp_replace(path, "^file:/*", "/")


def _scanned_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Heads of files in a store that only Spark opens: its text reader has to go through them."""
    present = [p for p in paths if path_exists(spark, p)]
    lines = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(present) if present else None
    rows = [(p, None, None, "not found") for p in paths if p not in present] + [(p, 0, None, "empty file") for p in empty_files(spark, present)]
    heads = spark.createDataFrame(rows, "path string, size long, header string, reason string")
    if lines is None:
        return heads
    start = F.col("_metadata.file_block_start")
    some = lines.where((start == 0) & (F.trim("value") != "")).select(row_path().alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    # rows of a file's first block stay in file order within one partition, so the least id is the first line
    first = some.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    listed = list_files(spark, present).where("length > 0").select("path", F.col("length").alias("size"))
    known = listed.join(first, "path", "left")
    known = known.select("path", "size", "header")
    return heads.unionByName(known.withColumn("reason", F.when(F.col("header").isNull(), "unreadable")))


def read_csv_files(
    spark: SparkSession, files: Sequence[str], origin: bool = False, schema: T.StructType | str | None = None
) -> tuple[DataFrame | None, list[str], DataFrame, int]:
    """``(table, all column names, rejected files, number of accepted files)`` for CSV files with drifting columns.

    The heads of all files are read first (``sources.heads``): which columns a file has, and whether it is missing, empty or a
    broken archive. Such files are reported in ``rejected(path, reason)`` and skipped. All others are read by one scan as text by
    position; a file's header says which position a column of the table has in it. Types come from one more pass over the
    values, the same for all files: integers widen to BIGINT, numbers to DOUBLE, anything mixed to STRING.

    With a ``schema`` the columns are those declared, found by their names in each header, and no types are inferred; files that lack one are rejected.
    The driver holds the different headers, not the files.
    """
    readable = openable(files)
    heads = file_heads(spark, files) if readable else _scanned_heads(spark, files)
    heads = materialize(heads.dropDuplicates(["path"]), "heads")
    counted = heads.where("reason IS NULL").groupBy("header").agg(F.count(F.lit(1)).alias("n")).orderBy("header").collect()
    headers = {r["header"]: column_names(r["header"]) for r in counted}
    declared = None
    if schema is not None:
        declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = [f.name for f in declared] if declared is not None else list(dict.fromkeys(n for own in headers.values() for n in own))
    lacking = {h: [n for n in names if n not in own] for h, own in headers.items()} if declared is not None else {}
    lacking = {h: absent for h, absent in lacking.items() if absent}
    known = [(h, [own.index(n) if n in own else None for n in names], f"without column {', '.join(lacking[h])}" if h in lacking else None) for h, own in headers.items()]
    known = spark.createDataFrame(known, "of string, positions array<int>, lack string")
    joined = heads.join(F.broadcast(known), F.col("header") == F.col("of"), "left")
    joined = joined.select("path", "header", F.coalesce("reason", "lack").alias("reason"), "positions")
    rejected = joined.where("reason IS NOT NULL").select("path", "reason")
    accepted = sum(r["n"] for r in counted if r["header"] not in lacking)
    if not accepted:
        return None, [], rejected, 0
    usual = max((r for r in counted if r["header"] not in lacking), key=lambda r: r["n"])["header"]
    odd = joined.where(F.col("reason").isNotNull() | (F.col("header") != usual))
    odd = odd.select(_local(F.col("path")).alias("_odd"), F.when(F.col("reason").isNull(), F.col("positions")).alias("_positions"))
    absent = {r["path"] for r in rejected.where("reason = 'not found'").collect()}
    roots = [p for p in files if re.sub("^file:/*", "/", p) not in {re.sub("^file:/*", "/", a) for a in absent}]
    values = [f"_v{i}" for i in range(max(len(own) for h, own in headers.items() if h not in lacking))]
    # Broken archives are known by now; in stores that Python cannot check, a broken one is an error.
    reader = spark.read.options(**CSV_OPTIONS, recursiveFileLookup="true", ignoreCorruptFiles=str(readable).lower())
    scan = reader.schema(", ".join(f"{v} string" for v in values)).csv(roots).select(*values, row_path().alias("_path"))
    few = odd.count()
    if few:
        side = F.broadcast(odd) if few <= BROADCAST_FILES else odd
        scan = scan.join(side, _local(F.col("_path")) == F.col("_odd"), "left").where("_odd IS NULL OR _positions IS NOT NULL")
    columns = _by_position(scan, names, headers[usual], values, few > 0)
    if declared is not None:
        types = {f.name: f.dataType for f in declared}
    else:
        kinds = columns.agg(*[F.bit_or(_kind(quoted(n))).alias(f"k{i}") for i, n in enumerate(names)]).first()
        types = {n: type_of(kinds[i] or 0) for i, n in enumerate(names)}
    table = columns.select(*[parsed(quoted(n), types[n]).alias(n) for n in names], *(origin_columns(F.col("_path")) if origin else []))
    return table, table.columns, rejected, accepted


def _by_position(scan: DataFrame, names: list[str], usual: list[str], values: list[str], drifting: bool) -> DataFrame:
    """The named columns as text and the file's path. Files of the usual header are read column by column, others through their positions."""
    at = {n: usual.index(n) for n in names if n in usual}
    plain = {n: F.col(values[at[n]]) if n in at else F.lit(None).cast("string") for n in names}
    if not drifting:
        return scan.select(*[plain[n].alias(n) for n in names], "_path")
    packed = scan.withColumn("_all", F.when(F.col("_odd").isNotNull(), F.array(*values)))
    moved = lambda i: F.get("_all", F.get("_positions", F.lit(i)))
    return packed.select(*[F.when(F.col("_odd").isNull(), plain[n]).otherwise(moved(i)).alias(n) for i, n in enumerate(names)], "_path")


# --- tables --------------------------------------------------------------------------------------


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def delta_available(spark: SparkSession) -> bool:
    """Whether the Delta connector is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName(
            "io.delta.sql.DeltaSparkSessionExtension", False, spark._jvm.Thread.currentThread().getContextClassLoader()
        )
        return True
    except Exception:  # the gateway wraps ClassNotFoundException
        return False


def delta_scan(spark: SparkSession, path: str) -> DataFrame:
    if not delta_available(spark):
        raise RuntimeError("reading Delta tables needs the Delta connector on the classpath")
    return spark.read.format("delta").load(path)


def sniff_format(spark: SparkSession, path: str) -> str:
    """Format named in the path, else shown by the folder's content, else by the suffix."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    files, jvm_path = _filesystem(spark, path)
    if not files.exists(jvm_path):
        raise FileNotFoundError(path)
    if files.getFileStatus(jvm_path).isDirectory():
        for fmt in ("parquet", "delta", "csv"):
            if fmt in name:
                return fmt
        content = [s.getPath().getName() for s in files.listStatus(jvm_path)]
        if "_delta_log" in content:
            return "delta"
        for fmt in ("parquet", "csv"):
            if any(c.endswith("." + fmt) for c in content):
                return fmt
    for fmt in ("parquet", "csv"):
        if name.endswith("." + fmt):
            return fmt
    raise ValueError(f"cannot tell the format of {path}")


def load_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read a table in the given format, or the one ``sniff_format`` finds; a missing path raises."""
    fmt = fmt or sniff_format(spark, path)
    readers = {"parquet": parquet_scan, "delta": delta_scan, "csv": csv_scan_untyped}
    if fmt not in readers:
        raise ValueError(f"unknown format {fmt!r}")
    try:
        return readers[fmt](spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise

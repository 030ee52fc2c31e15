"""Pearson, Spearman and Kendall association of column pairs, exact on the whole table.

Every method works on pairwise complete rows and gives 0 where it is undefined. Spearman and Kendall
count equal pairs of values first and then need only sorted running sums or counts inside parts of bounded
size: no pair of rows is ever formed, and no value, however frequent, has to fit one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import known_double, quoted, row_per
from ..sources.scratch import materialize
from . import pairs as pairs_
from .ordered import running_sums
from .states import task_states, tree_merged

WIDE_PAIRS = 12
#: Distinct values of a column whose ranks are broadcast (two numbers each); beyond it rows meet them by a shuffle.
BROADCAST_VALUES = 200_000

Pairs = Sequence[tuple[str, str]]


def _pearson(x: Column, y: Column) -> Column:
    """Pearson's r of the rows where both are known, by stable built-in moments."""
    both = x.isNotNull() & y.isNotNull()
    r = F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    )
    return F.coalesce(F.nanvl(r, F.lit(None).cast("double")), F.lit(0.0))


def _near_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as DOUBLE less their value in some row: r stays as it is, and values far from zero keep their digits in the moments."""
    names = list(dict.fromkeys(columns))
    values = df.select(*[known_double(df, c).alias(c) for c in names])
    row = values.first()
    shifts = {c: row[c] if row is not None and row[c] is not None and abs(row[c]) < float("inf") else 0.0 for c in names}
    return values.select(*[(quoted(c) - F.lit(shifts[c])).alias(c) for c in names])


def _pair_columns(df: DataFrame, pairs: Pairs) -> DataFrame:
    """Long form ``(pair_id, x, y)``."""
    entries = [{"pair_id": F.lit(i), "x": known_double(df, a), "y": known_double(df, b)} for i, (a, b) in enumerate(pairs)]
    return df.select(row_per(entries)).select("r.*").filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def _labelled(df: DataFrame, spark, pairs: Pairs, r: Column) -> DataFrame:
    names = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair_id int, a string, b string")
    value = F.coalesce(r, F.lit(0.0)).alias("r")
    # df has at most one row per pair
    return names.join(F.broadcast(df), "pair_id", "left").select("a", "b", value)


def pearson(df: DataFrame, pairs: Pairs) -> DataFrame:
    """``(a, b, r)``, signed. One aggregate and one formula; from matrices of products once there are many pairs."""
    pairs = list(pairs)
    df = _near_zero(df, [c for pair in pairs for c in pair])
    if len(pairs) <= WIDE_PAIRS:
        wide = df.agg(*[_pearson(known_double(df, a), known_double(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
        return wide.select(row_per([{"a": F.lit(a), "b": F.lit(b), "r": F.col(f"r{i}")} for i, (a, b) in enumerate(pairs)])).select("r.*")
    return df.sparkSession.createDataFrame(_many(df, pairs), "a string, b string, r double")


def _many(df: DataFrame, pairs: Pairs) -> list[tuple[str, str, float]]:
    """``(a, b, r)`` from one pass that adds up the products of the left columns with the right ones, each row sent once whatever the pairs."""
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    lefts, rights = (list(dict.fromkeys(pair[side] for pair in pairs)) for side in (0, 1))
    wanted = {(lefts.index(a), rights.index(b)) for a, b in pairs}
    places = [[columns.index(c) for c in side] for side in (lefts, rights)]
    rows = df.select(*[known_double(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    tiles = tree_merged(task_states(rows, pairs_.tile_moments(len(columns), *places, wanted)), pairs_.merged_moments)

    def r(a: str, b: str) -> float:
        i, j = lefts.index(a), rights.index(b)
        tile = tiles.get(f"{i // pairs_.TILE * pairs_.TILE}/{j // pairs_.TILE * pairs_.TILE}")
        return 0.0 if tile is None else pairs_.correlation(tile, i % pairs_.TILE, j % pairs_.TILE)

    return [(a, b, r(a, b)) for a, b in pairs]


def _counted_pairs(df: DataFrame, pairs: Pairs) -> DataFrame:
    return materialize(
        _pair_columns(df, pairs).groupBy("pair_id", "x", "y").agg(F.count(F.lit(1)).alias("n")), "pairs"
    )


def _rank_tables(df: DataFrame, tables: Sequence[tuple[str, frozenset[str]]], chunk_rows: int | None) -> DataFrame:
    """``(table_id, value, n, rank)``: the distinct values of a column, counted over the rows where some columns are known, with the average
    rank of their rows less the middle one."""
    entries = []
    for i, (column, required) in enumerate(tables):
        complete = F.lit(True)
        for c in sorted(required):
            complete = complete & known_double(df, c).isNotNull()
        entries.append({"table_id": F.lit(i), "value": F.when(complete, known_double(df, column))})
    long = df.select(row_per(entries)).select("r.*").where("value IS NOT NULL")
    counted = materialize(long.groupBy("table_id", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    ran = running_sums(counted, ["table_id"], ["value"], {"_upto": F.col("n")}, chunk_rows=chunk_rows)
    sizes = counted.groupBy("table_id").agg(((F.sum("n") + 1) / F.lit(2.0)).alias("middle"))
    # ranks have mean (N + 1) / 2; taking it off keeps the sums exact enough at any N
    rank = F.col("_upto") - F.col("n") + (F.col("n") + 1) / F.lit(2.0) - F.col("middle")
    return materialize(ran.join(F.broadcast(sizes), "table_id").select("table_id", "value", "n", rank.alias("rank")), "ranks")


def spearman(df: DataFrame, pairs: Pairs, chunk_rows: int | None = None) -> DataFrame:
    """``(a, b, r)``: Pearson's r of the average ranks.

    Ranks are kept per distinct value of a column and per set of rows they are taken over, and all pairs share them: pairs of complete
    columns need one table per column, others also one for the rows where both are known. Rows then meet the tables of their
    values (broadcast if small), so the work follows the columns, not the pairs.
    """
    pairs = list(pairs)
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    gaps = df.agg(*[F.count_if(known_double(df, c).isNull()).alias(f"g{i}") for i, c in enumerate(columns)]).first()
    gappy = {c for i, c in enumerate(columns) if gaps[i]}
    required = [frozenset({a, b} & gappy) for a, b in pairs]
    tables = list(dict.fromkeys((c, rows) for pair, rows in zip(pairs, required) for c in pair))
    number = {t: i for i, t in enumerate(tables)}
    ranks = _rank_tables(df, tables, chunk_rows)
    facts = ranks.groupBy("table_id").agg(F.count(F.lit(1)).alias("values"), F.sum(F.expr("double(n) * rank * rank")).alias("spread"))
    facts = {r["table_id"]: r for r in facts.collect()}  # one row per table
    rows = df.select(*[known_double(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    for i, (column, _) in enumerate(tables):
        own = ranks.where(F.col("table_id") == i).select(F.col("value").alias(f"v{i}"), F.col("rank").alias(f"r{i}"))
        own = F.broadcast(own) if i not in facts or facts[i]["values"] <= BROADCAST_VALUES else own
        rows = rows.join(own, F.col(f"c{columns.index(column)}") == F.col(f"v{i}"), "left").drop(f"v{i}")
    sums = []
    for k, ((a, b), both) in enumerate(zip(pairs, required)):
        product = F.col(f"r{number[a, both]}") * F.col(f"r{number[b, both]}")
        for c in sorted(both):
            product = F.when(F.col(f"c{columns.index(c)}").isNotNull(), product)
        sums.append(F.sum(product).alias(f"s{k}"))
    found = rows.agg(*sums)

    def spread(table: tuple) -> float:
        return float(facts[number[table]]["spread"]) if number[table] in facts else 0.0

    entries = []
    for k, ((a, b), both) in enumerate(zip(pairs, required)):
        scale = (spread((a, both)) ** 0.5) * (spread((b, both)) ** 0.5)
        entries.append({"a": F.lit(a), "b": F.lit(b), "r": F.coalesce(F.try_divide(F.col(f"s{k}"), F.lit(scale)), F.lit(0.0))})
    return found.select(row_per(entries)).select("r.*")


#: Rows of a part, about, and the most parts along a column.
PART_ROWS = 250_000
MOST_PARTS = 512


def _placed(counted: DataFrame, chunk_rows: int | None) -> DataFrame:
    """The counted pairs of values with the parts of x and y they are in. A part is a range of values; those of a frequent value hold only it."""
    sizes = {r["pair_id"]: r["n"] for r in counted.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per pair
    parts = min(MOST_PARTS, -(-max(sizes.values(), default=1) // (chunk_rows or PART_ROWS)))
    cuts = {i: (*pairs_.cut_points(None), *pairs_.cut_points(None)) for i in sizes}
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        # at most MOST_PARTS numbers per column of a pair
        quantiles = counted.groupBy("pair_id").agg(*[F.percentile_approx(c, shares, 20 * MOST_PARTS).alias(c) for c in "xy"])
        cuts = {r["pair_id"]: (*pairs_.cut_points(r["x"]), *pairs_.cut_points(r["y"])) for r in quantiles.collect()}
    return counted.select("pair_id", "x", "y", "n").mapInArrow(pairs_.placed(cuts), pairs_.PLACED)


def _concordant(counted: DataFrame, chunk_rows: int | None) -> DataFrame:
    """``(pair_id, conc)``: number of pairs of rows ordered alike in x and y; pairs without any may be absent.

    Two such rows are in one part of x, or in different ones and one part of y, or in different ones of both: those inside a part are
    counted by its task, the others from the number of rows per part of x and part of y. In a part that is one value no rows are ordered.
    """
    placed = materialize(_placed(counted, chunk_rows), "parts")
    inside = placed.where("NOT x_alone").select("pair_id", "px", "x", "y", "n").groupBy("pair_id", "px").applyInArrow(pairs_.group_concordant("x", "y"), pairs_.MET)
    across = placed.where("NOT y_alone").select("pair_id", "py", "px", "y", "n").groupBy("pair_id", "py").applyInArrow(pairs_.group_concordant("y", "px"), pairs_.MET)
    # at most parts x parts rows per pair
    cells = placed.groupBy("pair_id", "px", "py").agg(F.sum("n").alias("n")).groupBy("pair_id").applyInArrow(pairs_.group_concordant("px", "py"), pairs_.MET)
    return inside.unionByName(across).unionByName(cells).groupBy("pair_id").agg(F.sum("conc").alias("conc"))


def kendall(df: DataFrame, pairs: Pairs, chunk_rows: int | None = None) -> DataFrame:
    """``(a, b, r)``: tau-b in N log N work on parts of bounded size."""
    pairs = list(pairs)
    counted = _counted_pairs(df, pairs)
    size = F.col("t").cast("double")

    def tied(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("pair_id").agg(F.sum(size * (size - 1) / 2).alias(name))

    def by(*keys: str) -> DataFrame:
        return counted.groupBy("pair_id", *keys).agg(F.sum("n").alias("t"))

    # one row per pair in each of these
    terms = tied(by(), "tied_")
    for part in (tied(by("x"), "tied_x"), tied(by("y"), "tied_y"), tied(counted.withColumnRenamed("n", "t"), "tied_xy"), _concordant(counted, chunk_rows)):
        terms = terms.join(F.broadcast(part), "pair_id", "left")
    untied = F.col("tied_") - F.col("tied_x") - F.col("tied_y") + F.col("tied_xy")
    scale = F.sqrt(F.col("tied_") - F.col("tied_x")) * F.sqrt(F.col("tied_") - F.col("tied_y"))
    return _labelled(terms, df.sparkSession, pairs, F.try_divide(2 * F.coalesce("conc", F.lit(0.0)) - untied, scale))


METHODS = ("pearson", "spearman", "kendall")


def correlation_scores(
    df: DataFrame, targets: Sequence[str], features: Sequence[str], method: str = "pearson", chunk_rows: int | None = None
) -> DataFrame:
    """``(target, feature, method, score)``: absolute association of every feature with every target."""
    pairs = [(t, f) for t in targets for f in features if f != t]
    if method == "pearson":
        found = pearson(df, pairs)
    elif method in METHODS:
        found = (spearman if method == "spearman" else kendall)(df, pairs, chunk_rows)
    else:
        raise ValueError(f"unknown correlation method {method!r}")
    return found.select(
        F.col("a").alias("target"), F.col("b").alias("feature"), F.lit("correlation").alias("method"), F.abs("r").alias("score")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Signed Pearson ``(a, b, r)`` of every ordered pair of distinct columns, each computed once."""
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    half = pearson(df, upper)
    both = F.explode(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("r")))
    ).alias("p")
    return half.select(both).select("p.*")

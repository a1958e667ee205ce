"""Order statistics at scale: quantiles, running positions and average ranks.

All of them start from *value counts* ``(keys..., value, n)``: duplicates are
combined before the shuffle, so a value that fills a third of the table is one
row. They are cut into slices by a range partitioning over (keys, value); a hot
group simply spans many slices. The running position inside a slice plus the
total of the earlier slices is the global position, and no task ever holds a
whole group. Quantiles of a whole table need not even that, see ``quantiles``.

Slices are staged and brackets sampled when a frame is built, so building one
runs Spark jobs; only its rows are lazy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dqspark.functions.numbers import numeric
from dqspark.operators.skew import MAX_HOT_KEYS, spread_join
from dqspark.session import stage

#: Rows sampled to bracket the quantiles of a table, and how many standard
#: deviations of a sample quantile a bracket reaches to either side.
SAMPLE_ROWS = 200_000
SAMPLE_DEVIATIONS = 5


def long_numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., column, value)`` of the non-missing values of ``columns``."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), numeric(df, c).alias("value")) for c in columns]
    )
    return (
        df.select(*[F.col(b) for b in by], F.explode(cells).alias("_cell"))
        .select(*by, F.col("_cell.column").alias("column"), F.col("_cell.value").alias("value"))
        .where(F.col("value").isNotNull())
    )


def value_counts(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    return values.groupBy(*keys, "value").agg(F.count("*").alias("n"))


def modes(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Most frequent value per group, the smallest one on a tie: ``(keys..., mode)``."""
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value").alias("value")))
    return counts.groupBy(*keys).agg(best["value"].alias("mode"))


def slices(
    counts: DataFrame, keys: Sequence[str], order: Sequence[str] = ("value",)
) -> tuple[DataFrame, DataFrame]:
    """Range-partitioned counts with their slice number, and one row per slice.

    The slice number is a partition id, so the table is staged before it is
    used twice. The second frame holds ``slice_n``, ``slice_before`` and the
    group ``total``; it has about one row per partition and group.
    """
    sliced = stage(
        counts.repartitionByRange(*keys, *order).withColumn("slice", F.spark_partition_id())
    )
    groups = W.partitionBy(*keys)
    earlier = groups.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        sliced.groupBy(*keys, "slice")
        .agg(F.sum("n").alias("slice_n"))
        .withColumn("slice_before", F.coalesce(F.sum("slice_n").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("slice_n").over(groups))
    )
    return sliced, totals


def _running(keys: Sequence[str], order: Sequence[str] = ("value",)) -> Column:
    """Rows of the window's partition with a smaller value."""
    before = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(before), F.lit(0))


def positions(counts: DataFrame, keys: Sequence[str], order: Sequence[str] = ("value",)) -> DataFrame:
    """Add ``before`` (rows of the group with a smaller value) and ``total``."""
    sliced, totals = slices(counts, keys, order)
    return (
        sliced.join(totals.drop("slice_n"), [*keys, "slice"])
        .withColumn("before", F.col("slice_before") + _running([*keys, "slice"], order))
        .drop("slice", "slice_before")
    )


def average_ranks(counts: DataFrame, keys: Sequence[str], order: Sequence[str] = ("value",)) -> DataFrame:
    """Add ``avg_rank``: ties share the mean of the ranks they cover.

    Columns after ``value`` in ``order`` rank the rows of one value apart.
    """
    return positions(counts, keys, order).withColumn("avg_rank", F.col("before") + (F.col("n") + 1) / 2)


def ranks_and_sizes(counts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict[tuple, int]]:
    """``average_ranks``, staged for several readers, and the number of distinct values of each of a few groups."""
    ranks = stage(average_ranks(counts, keys))
    sizes = ranks.groupBy(*keys).count().collect()
    return ranks, {tuple(r[k] for k in keys): r["count"] for r in sizes}


def _covers(rank: Column) -> Column:
    return (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))


def quantile_ends(sliced: DataFrame, totals: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(keys..., total, _low0.., _high0..)``: the values around each quantile."""
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    low, high = [F.floor(x) for x in place], [F.ceil(x) for x in place]
    # Only the slices that hold a wanted rank are read again.
    start, size = F.col("slice_before"), F.col("slice_n")
    wanted = F.exists(F.array(*low, *high), lambda r: (r >= start) & (r < start + size))
    placed = sliced.join(totals.where(wanted), [*keys, "slice"]).withColumn(
        "before", start + _running([*keys, "slice"])
    )
    return _pick(placed, keys, low, high)


def _ends_of_sample(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Like ``quantile_ends`` for a column's sample, which SAMPLE_ROWS bounds."""
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    whole = W.partitionBy("column").orderBy("value").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = counts.withColumn("before", _running(["column"])).withColumn("total", F.sum("n").over(whole))
    return _pick(placed, ["column"], [F.floor(x) for x in place], [F.ceil(x) for x in place])


def _pick(placed: DataFrame, keys: Sequence[str], low: Sequence[Column], high: Sequence[Column]) -> DataFrame:
    return placed.groupBy(*keys, "total").agg(
        *[F.max(F.when(_covers(r), F.col("value"))).alias(f"_low{i}") for i, r in enumerate(low)],
        *[F.max(F.when(_covers(r), F.col("value"))).alias(f"_high{i}") for i, r in enumerate(high)],
    )


def _interpolated(ends: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    def between(i: int, p: float) -> Column:
        a, b, x = F.col(f"_low{i}"), F.col(f"_high{i}"), F.lit(float(p)) * (F.col("total") - 1)
        return F.when(a == b, a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b)

    q = F.array(*[between(i, p) for i, p in enumerate(probs)])
    return ends.select(*keys, "total", q.alias("q"))


def quantile_table(
    counts: DataFrame, keys: Sequence[str], probs: Sequence[float], order: Sequence[str] = ("value",)
) -> DataFrame:
    """Exact, linearly interpolated quantiles: ``(keys..., total, q array)``.

    Columns after ``value`` in ``order`` only cut the rows of one value into slices.
    """
    return quantiles_of_slices(*slices(counts, keys, order), keys, probs)


def quantiles_of_slices(
    sliced: DataFrame, totals: DataFrame, keys: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """``quantile_table`` of counts that are sliced already."""
    return _interpolated(quantile_ends(sliced, totals, keys, probs), keys, probs)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of several columns at once: ``(by..., column, total, q array)``.

    Over a whole table a sample tells where each quantile roughly lies.
    The values inside these brackets keep their identity, all others are only
    counted, so that next to nothing is shuffled. The result is checked to lie
    inside its bracket, which makes it exact; else the full way is taken.
    """
    keys = [*by, "column"]
    if not by:
        found = _bracketed(df, columns, probs)
        if found is not None:
            return found
    return quantile_table(value_counts(long_numbers(df, columns, by), keys), keys, probs)


def _bracketed(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame | None:
    brackets = _brackets(df, columns, probs)
    if set(brackets) != set(columns):
        return None
    coarse = df.select(*[_coarse(numeric(df, c), brackets[c]).alias(c) for c in columns])
    ends = quantile_ends(*slices(value_counts(long_numbers(coarse, columns), ["column"]), ["column"]), ["column"], probs)
    rows = ends.collect()  # one row per column
    inside = all(
        any(low <= value <= high for low, high in brackets[row["column"]])
        for row in rows
        for name, value in row.asDict().items()
        if name.startswith("_")
    )
    if not inside:
        return None
    small = df.sparkSession.createDataFrame(rows, ends.schema)
    return _interpolated(small, ["column"], probs)


def _brackets(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[tuple[float, float]]]:
    """Ascending, disjoint value ranges around each quantile, from a sample."""
    share = min(1.0, SAMPLE_ROWS / max(df.count(), 1))
    margin = SAMPLE_DEVIATIONS * 0.5 / math.sqrt(SAMPLE_ROWS)
    edges = [edge for p in sorted(probs) for edge in (max(p - margin, 0.0), min(p + margin, 1.0))]
    counts = value_counts(long_numbers(df.sample(share, seed=17), columns), ["column"])
    table = _interpolated(_ends_of_sample(counts, edges), ["column"], edges)
    brackets = {}
    for row in table.collect():  # one row per column
        spans = [
            (-math.inf if edges[i] == 0.0 else row["q"][i], math.inf if edges[i + 1] == 1.0 else row["q"][i + 1])
            for i in range(0, len(edges), 2)
        ]
        merged = [spans[0]]
        for low, high in spans[1:]:
            if low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        brackets[row["column"]] = merged
    return brackets


def _coarse(value: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    """Values inside a bracket as they are, those of a gap as one value in it."""
    rule = F.when(value < brackets[0][0], F.lit(math.nextafter(brackets[0][0], -math.inf)))
    for (low, high), (following, _) in zip(brackets, [*brackets[1:], (math.inf, math.inf)]):
        rule = rule.when(value.between(low, high), value)
        rule = rule.when((value > high) & (value < following), F.lit(math.nextafter(high, math.inf)))
    return rule.otherwise(value)


def scalar_struct(table: DataFrame, columns: Sequence[str], fields: dict[str, Column]) -> Column:
    """Per-column rows folded into one struct value, as a scalar subquery.

    ``fields`` names expressions over a row of ``table``; the result is read as
    ``result[column][field]``. One row by construction, so nothing is broadcast
    and the main query keeps a single narrow scan.
    """
    packed = F.struct(*[expr.alias(name) for name, expr in fields.items()])
    row = F.struct(
        *[F.max(F.when(F.col("column") == c, packed)).alias(c) for c in columns]
    )
    return table.groupBy().agg(row.alias("row")).scalar()


def attach_ranks(
    rows: DataFrame, ranks: DataFrame, keys: Sequence[str], value: str, out: str, distinct: int | None = None
) -> DataFrame:
    """Join ``avg_rank`` to rows by ``(keys, value)``, hot values spread out.

    ``distinct`` tells how many values ``ranks`` holds. Up to MAX_HOT_KEYS their
    table is broadcast and the rows stay where they are.
    """
    table = ranks.select(
        *keys, F.col("value").alias(value), F.col("avg_rank").alias(out), F.col("n").alias("_n"), "total"
    )
    if distinct is not None and distinct <= MAX_HOT_KEYS:
        return rows.join(F.broadcast(table.drop("_n", "total")), [*keys, value], "left").select(*rows.columns, out)
    return spread_join(rows, table, [*keys, value], [out], F.col("_n"), F.col("total"))


def with_average_rank(df: DataFrame, column: str, out: str = "avg_rank") -> DataFrame:
    """Rows whose ``column`` is present, with the average rank of its value."""
    rows = df.withColumn("_value", numeric(df, column)).where(F.col("_value").isNotNull())
    counts = rows.withColumn("column", F.lit(column)).groupBy("column", F.col("_value").alias("value")).agg(
        F.count("*").alias("n")
    )
    ranks = average_ranks(counts, ["column"]).drop("column")
    return attach_ranks(rows, ranks, [], "_value", out).drop("_value")

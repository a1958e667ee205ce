"""Pearson and Spearman correlation between numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions.numbers import numeric
from dqspark.operators.describe import present
from dqspark.operators.ranks import attach_ranks, average_ranks, long_numbers, ranks_and_sizes, value_counts


def _pearson(x: Column, y: Column) -> Column:
    """Pearson over the rows where both exist; missing if one does not vary.

    Built from covariance and variances, since ``corr`` itself fails then.
    """
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def _pair_rows(pairs: dict[int, tuple[str, str]], fields) -> Column:
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("pair"),
                    F.lit(a).alias("variable_1"),
                    F.lit(b).alias("variable_2"),
                    *fields(i, a, b),
                )
                for i, (a, b) in pairs.items()
            ]
        )
    )


def pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(pair, variable_1, variable_2, n, correlation)``; one aggregate for all pairs."""
    names = sorted({c for pair in pairs for c in pair})
    data = df.select(*[numeric(df, c).alias(c) for c in names])
    sums = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        sums += [F.count_if(both).alias(f"n{i}"), _pearson(F.col(a), F.col(b)).alias(f"r{i}")]
    return data.agg(*sums).select(
        _pair_rows(dict(enumerate(pairs)), lambda i, a, b: (F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("correlation")))
    )


def spearman_pairs(
    df: DataFrame, pairs: Sequence[tuple[str, str]], ranked: tuple[DataFrame, dict[tuple, int]] | None = None
) -> DataFrame:
    """Like ``pearson_pairs`` for average ranks over each pair's complete rows.

    Columns without a gap have one rank for all their pairs. A first, one-row
    aggregate finds out which those are. ``ranked`` may bring their
    ``ranks_and_sizes`` if they are there already.
    """
    names = sorted({c for pair in pairs for c in pair})
    data = df.select(*[numeric(df, c).alias(c) for c in names])
    gaps = data.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    complete = {i for i, (a, b) in enumerate(pairs) if gaps[a] == 0 and gaps[b] == 0}
    parts = []
    if complete:
        whole = {i: pairs[i] for i in sorted(complete)}
        parts.append(correlations_of_ranks(data, whole, *ranked) if ranked else _ranked_columns(data, whole))
    if len(complete) < len(pairs):
        parts.append(_ranked_pairs(data, {i: p for i, p in enumerate(pairs) if i not in complete}))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _centred(ranks: DataFrame) -> DataFrame:
    """Ranks less their mean, which is (total + 1) / 2 whatever the ties."""
    return ranks.withColumn("avg_rank", F.col("avg_rank") - (F.col("total") + 1) / 2)


def _ranked_columns(data: DataFrame, pairs: dict[int, tuple[str, str]]) -> DataFrame:
    """Every column is ranked once, all of them from one table of value counts.

    The ranks of a column with few distinct values are broadcast. Only columns
    with more than that cost an exchange of the rows, those with the most last.
    """
    names = sorted({c for pair in pairs.values() for c in pair})
    return correlations_of_ranks(data, pairs, *ranks_and_sizes(value_counts(long_numbers(data, names), ["column"]), ["column"]))


def correlations_of_ranks(
    data: DataFrame, pairs: dict[int, tuple[str, str]], ranks: DataFrame, sizes: dict[tuple, int]
) -> DataFrame:
    """Spearman of columns without gaps from ``ranks_and_sizes`` of their value counts."""
    names = sorted({c for pair in pairs.values() for c in pair})
    rows = data.select(*names)
    for c in sorted(names, key=lambda c: sizes.get((c,), 0)):
        own = _centred(ranks.where(F.col("column") == c)).drop("column")
        rows = attach_ranks(rows, own, [], c, f"rank_{c}", sizes.get((c,), 0))
    squares = {c: F.sum(F.col(f"rank_{c}") * F.col(f"rank_{c}")).alias(f"s_{c}") for c in names}
    products = [
        F.sum(F.col(f"rank_{a}") * F.col(f"rank_{b}")).alias(f"p_{i}") for i, (a, b) in pairs.items()
    ]
    sums = rows.agg(F.count("*").alias("n"), *squares.values(), *products)

    def fields(i: int, a: str, b: str):
        size = F.sqrt(F.col(f"s_{a}")) * F.sqrt(F.col(f"s_{b}"))
        return F.col("n"), F.try_divide(F.col(f"p_{i}"), size).alias("correlation")

    return sums.select(_pair_rows(pairs, fields))


def _ranked_pairs(data: DataFrame, pairs: dict[int, tuple[str, str]]) -> DataFrame:
    """Both columns are ranked per pair, over the rows where both exist.

    Equal (x, y) rows are combined first; all pairs are ranked in one go.
    """
    cells = (
        data.select(_pair_rows(pairs, lambda i, a, b: (F.col(a).alias("x"), F.col(b).alias("y"))))
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("pair", "x", "y")
        .agg(F.count("*").alias("n"))
    )
    sides = F.inline(
        F.array(
            F.struct(F.lit("x").alias("side"), F.col("x").alias("value"), F.col("n").alias("n")),
            F.struct(F.lit("y").alias("side"), F.col("y").alias("value"), F.col("n").alias("n")),
        )
    )
    keys = ["pair", "side"]
    counts = cells.select("pair", sides).groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    ranks = _centred(average_ranks(counts, keys))
    ranked = attach_ranks(cells, ranks.where(F.col("side") == "x"), ["pair"], "x", "rx")
    ranked = attach_ranks(ranked, ranks.where(F.col("side") == "y"), ["pair"], "y", "ry")
    xx, yy, xy = (F.sum(F.col("n") * F.col(a) * F.col(b)) for a, b in (("rx", "rx"), ("ry", "ry"), ("rx", "ry")))
    sums = ranked.groupBy("pair").agg(
        F.sum("n").alias("n"), F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)).alias("correlation")
    )
    names_of = data.sparkSession.createDataFrame(
        [(i, a, b) for i, (a, b) in pairs.items()], "pair int, variable_1 string, variable_2 string"
    )
    return names_of.join(sums, "pair", "left").select(
        "pair", "variable_1", "variable_2", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "correlation"
    )


_METHODS = {"pearson": pearson_pairs, "spearman": spearman_pairs}


def correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson"
) -> DataFrame:
    """Every unordered pair of columns with its correlation."""
    cols = present(df, columns)
    return _METHODS[method](df, list(combinations(cols, 2)))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson"
) -> DataFrame:
    """Square matrix, one row per column name in ``index``.

    The diagonal is a column's correlation with itself: 1, or missing when the
    column does not vary.
    """
    cols = present(df, columns)
    themselves, others = [(c, c) for c in cols], list(combinations(cols, 2))
    if method == "pearson" or not others:  # one aggregate for all cells
        long = pearson_pairs(df, [*others, *themselves])
    else:
        long = _METHODS[method](df, others).unionByName(pearson_pairs(df, themselves))
    own = F.col("variable_1") == F.col("variable_2")
    long = long.withColumn("correlation", F.when(own & F.col("correlation").isNotNull(), 1.0).otherwise(F.col("correlation")))
    both_ways = long.select(
        F.inline(
            F.array(
                F.struct(F.col("variable_1").alias("index"), F.col("variable_2").alias("other"), "correlation"),
                F.struct(F.col("variable_2").alias("index"), F.col("variable_1").alias("other"), "correlation"),
            )
        )
    )
    cell = [F.max(F.when(F.col("other") == c, F.col("correlation"))).alias(c) for c in cols]
    position = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("index"))
    return both_ways.groupBy("index").agg(*cell).orderBy(position)


def top_correlated_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson", top_n: int = 10
) -> DataFrame:
    """The ``top_n`` pairs by absolute correlation; names decide ties."""
    return (
        correlation_pairs(df, columns, method)
        .orderBy(F.abs("correlation").desc_nulls_last(), "variable_1", "variable_2")
        .limit(top_n)
        .select("variable_1", "variable_2", F.lit(method).alias("method"), "correlation")
    )

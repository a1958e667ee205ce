"""Exact and key-based duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.operators.skew import spread_join

#: Copies written out by one task at a time when duplicate rows are listed.
COPIES_PER_TASK = 100_000


def _quoted(columns: Sequence[str]):
    return [F.col(f"`{c}`") for c in columns]


def full_duplicates(df: DataFrame) -> DataFrame:
    """All rows that occur more than once, sorted by all columns, missing last.

    Copies are alike in every column, so counting them (combined before the
    shuffle) says everything. They are then written out again in chunks that
    are spread over the cluster: a row with a billion copies is no single task.
    """
    cols = df.columns
    repeated = df.groupBy(*_quoted(cols)).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    chunks = repeated.withColumn(
        "_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES_PER_TASK).cast("long")))
    ).repartition(F.xxhash64(*_quoted(cols), F.col("_first")))
    last = F.least(F.col("_first") + COPIES_PER_TASK, F.col("_n")) - 1
    copies = chunks.withColumn("_copy", F.explode(F.sequence(F.col("_first"), last)))
    # The copy number as last sort key lets the range partitioning cut inside a group.
    return copies.orderBy(*[c.asc_nulls_last() for c in _quoted(cols)], "_copy").select(*_quoted(cols))


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """One copy of every row. Copies are combined before the shuffle."""
    return df.dropDuplicates()


def key_duplicates(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """All rows whose key occurs more than once, sorted by key."""
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    total = df.agg(F.count("*").alias("n")).scalar()
    marked = spread_join(df, repeated, [key], ["_n"], F.col("_n"), total, null_safe=True)
    others = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c != key]
    return marked.where(F.col("_n") > 1).drop("_n").orderBy(F.col(key).asc_nulls_last(), *others)


def dedup_by_key(
    df: DataFrame,
    key: str | Sequence[str] = "customer_id",
    sort_column: str = "signup_date",
    keep: str | bool = "last",
    missing: str = "latest",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the latest (or earliest) by ``sort_column``.

    A missing sort value counts as the latest one, or as the earliest one with
    ``missing="earliest"``. Ties are decided by ``tie_breakers``, by default all other columns,
    so the choice does not depend on the order of the rows. ``keep=False``
    drops every row of a repeated key. The rank filter is applied before the
    shuffle too, so a hot key sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if keep is False:
        return _unrepeated(df, keys)
    if keep not in ("last", "first"):
        raise ValueError("keep must be 'last', 'first' or False")
    rest = list(tie_breakers) if tie_breakers is not None else [c for c in df.columns if c not in {*keys, sort_column}]
    main, late = F.col(f"`{sort_column}`"), missing == "latest"
    if keep == "last":
        first = main.desc_nulls_first() if late else main.desc_nulls_last()
        ties = [c.desc_nulls_last() for c in _quoted(rest)]
    else:
        first = main.asc_nulls_last() if late else main.asc_nulls_first()
        ties = [c.asc_nulls_last() for c in _quoted(rest)]
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*_quoted(keys)).orderBy(first, *ties)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _unrepeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    packed = F.first(F.struct(*_quoted(others))) if others else F.first(F.lit(1))
    single = df.groupBy(*_quoted(keys)).agg(F.count("*").alias("_n"), packed.alias("_row")).where(F.col("_n") == 1)
    return single.select(*[F.col(f"`{c}`") if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def duplicate_counts(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row: rows, extra full copies, distinct rows and keys, rows in repeated keys.

    Two combining aggregations in a row; the second reads only the first's result.
    """
    rows = df.groupBy(*_quoted(df.columns)).agg(F.count("*").alias("_n"))
    per_key = rows.groupBy(key).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_distinct"))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0).cast("long"))

    return per_key.agg(
        total(F.col("_rows")).alias("total_rows"),
        total(F.col("_rows") - F.col("_distinct")).alias("full_duplicate_rows"),
        total(F.when(F.col("_rows") > 1, F.col("_rows"))).alias("rows_in_repeated_keys"),
        F.count(key).alias("distinct_keys"),
        total(F.col("_distinct")).alias("distinct_rows"),
        F.count("*").alias("key_groups"),
    ).withColumn("rows_minus_keys", F.col("total_rows") - F.col("distinct_keys"))


def dedup_summary(df: DataFrame, fuzzy_pairs: DataFrame, key: str = "customer_id") -> DataFrame:
    """The five steps of deduplication with their record counts.

    ``fuzzy_pairs`` is a ``fuzzy_duplicates`` result for the deduplicated rows.
    """
    found = fuzzy_pairs.agg(F.coalesce(F.sum("record_pairs"), F.lit(0).cast("long"))).scalar()
    counts = duplicate_counts(df, key).withColumn("_fuzzy", found)
    values = [
        F.col("total_rows"),
        F.col("full_duplicate_rows"),
        F.col("distinct_rows") - F.col("key_groups"),
        F.col("key_groups"),
        F.col("_fuzzy"),
    ]
    rows = [
        F.struct(F.lit(step).alias("etapa"), value.alias("quantidade"))
        for step, value in zip(fixed.DEDUP_STEPS, values)
    ]
    return counts.select(F.inline(F.array(*rows)))

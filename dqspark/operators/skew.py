"""Left join of a skewed table with a per-key table, spread over all tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least this many rows is hot: one task need not read more of one key ...
ROWS_PER_TASK = 1_000_000
#: ... unless there are more rows than MAX_HOT_KEYS such keys hold, so that there
#: are never more hot keys than this and their table may be broadcast.
MAX_HOT_KEYS = 100_000
SALTS = 1024


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [
        F.col(k).eqNullSafe(F.col(f"_k{i}")) if null_safe else F.col(k) == F.col(f"_k{i}")
        for i, k in enumerate(keys)
    ]
    return reduce(lambda a, b: a & b, pairs)


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: Column,
    total: Column,
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``values`` of ``table`` (one row per key) to ``rows``; no row is lost.

    ``weight`` and ``total`` tell how many rows a key has and how many there are
    at all. The few hot keys form a table whose size is bounded by MAX_HOT_KEYS
    and is broadcast. Rows that need no partner from the other keys, because
    their key is hot or NULL (which matches nothing unless ``null_safe``), get a
    salt, so in the second join they lie evenly over all tasks instead of piling
    up on their key.
    """
    payload = F.struct(*[F.col(v) for v in values])
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    own = [f"_k{i}" for i in range(len(keys))]
    hot = weight >= F.greatest(F.lit(rows_per_task).cast("double"), total / MAX_HOT_KEYS)
    few = table.where(hot).select(*renamed, payload.alias("_hot"))
    rest = table.where(~hot).select(*renamed, payload.alias("_rest"), F.lit(0).alias("_slot"))
    # Row numbers of a partition: even, also among equal rows, and the same when a task is repeated.
    salt = (F.monotonically_increasing_id() % SALTS).cast("int") + 1
    settled = F.col("_hot").isNotNull()
    if not null_safe:
        settled = settled | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    joined = (
        rows.withColumn("_number", salt)
        .join(F.broadcast(few), _match(keys, null_safe), "left")
        .drop(*own)
        .withColumn("_salt", F.when(settled, F.col("_number")).otherwise(0))
        .join(rest, _match(keys, null_safe) & (F.col("_salt") == F.col("_slot")), "left")
        .withColumn("_payload", F.coalesce("_hot", "_rest"))
    )
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_payload.{v}").alias(v) for v in values])

"""Rows of a table by id and key, whatever else their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def pick(docs: DataFrame, listed: DataFrame, id_col: str, key: Column, how: str, once: bool = False) -> DataFrame:
    """Semi- or anti-join (``how``) of ``docs`` with the (id, key) rows of ``listed``.

    ``key`` is computed from ``docs``; null ids match each other. ``once`` leaves
    one of the rows that agree in id and key. The columns of ``docs`` stay as
    they are.
    """
    own, other_id, other_key = fresh(docs, "_key", "_listed_id", "_listed_key")
    first, second = listed.columns
    other = listed.select(column(first).alias(other_id), column(second).alias(other_key)).distinct()
    same = column(id_col).eqNullSafe(column(other_id)) & (column(own) == column(other_key))
    found = docs.withColumn(own, key).join(other, same, how)
    return (found.dropDuplicates([id_col, own]) if once else found).drop(own)

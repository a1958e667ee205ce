"""Cleaning operators. All are narrow: no shuffle, no action, streaming-safe."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark import fixed
from dqspark.functions import dates, numbers, text

#: Maps up to this many entries are looked up in the row, larger ones are joined.
INLINE_MAP_ENTRIES = 256


def _snake(name: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """snake_case names; two columns that would get one name are an error."""
    names = [_snake(c) for c in df.columns]
    clashes = [n for n, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"columns would share a name: {clashes}")
    return df.toDF(*names)


def _rewrite(df: DataFrame, columns: Iterable[str], rule) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: rule(F.col(c).cast("string")) for c in present}) if present else df


def clean_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _rewrite(df, columns, text.collapse_spaces)


def title_case_names(df: DataFrame, column: str = "customer_name") -> DataFrame:
    return _rewrite(df, [column], text.title_case)


def clean_email(df: DataFrame, column: str = "email") -> DataFrame:
    """Normalise addresses and flag their shape in ``email_valido`` (never NULL)."""
    if column not in df.columns:
        return df
    cleaned = _rewrite(df, [column], text.clean_email)
    return cleaned.withColumn("email_valido", text.is_email(F.col(column)))


def state_variants() -> dict[str, str]:
    """Every known spelling of a state -> its code."""
    by_code = {code.lower(): code for code in fixed.STATE_NAMES}
    by_name = {name: code for code, name in fixed.STATE_NAMES.items()}
    return by_code | by_name


def map_category(df: DataFrame, column: str, mapping: Mapping[str, str], default: str) -> DataFrame:
    """Replace spellings by their category; unknown ones by ``default``, NULL stays.

    Keys of ``mapping`` are compared accent-free, trimmed and in lower case. A
    large dictionary becomes a table and is joined; its size is that of a Python
    dictionary in the driver, so broadcasting it is safe.
    """
    if column not in df.columns:
        return df
    key = text.norm_key(F.col(column).cast("string"))
    if len(mapping) <= INLINE_MAP_ENTRIES:
        table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        found = F.try_element_at(table, key)
        return df.withColumn(column, F.coalesce(found, F.when(key.isNotNull(), F.lit(default))))
    lookup = df.sparkSession.createDataFrame(list(mapping.items()), "_spelling string, _category string")
    joined = df.withColumn("_key", key).join(F.broadcast(lookup), F.col("_key") == F.col("_spelling"), "left")
    category = F.coalesce("_category", F.when(F.col("_key").isNotNull(), F.lit(default)))
    return joined.withColumn(column, category).drop("_key", "_spelling", "_category")


def unmapped_categories(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Normalised values the mapping does not know, with their counts."""
    keys = df.select(text.norm_key(F.col(column).cast("string")).alias("value"))
    unknown = keys.where(F.col("value").isNotNull() & ~F.col("value").isin(list(mapping)))
    return unknown.groupBy("value").agg(F.count("*").alias("row_count"))


def standardize_gender(df: DataFrame, column: str = "gender") -> DataFrame:
    return map_category(df, column, fixed.GENDER_CATEGORIES, fixed.GENDER_DEFAULT)


def standardize_state(df: DataFrame, column: str = "state") -> DataFrame:
    return map_category(df, column, state_variants(), fixed.STATE_DEFAULT)


def convert_numeric(
    df: DataFrame,
    money_columns: Iterable[str] = fixed.MONEY_COLUMNS,
    plain_columns: Iterable[str] = fixed.PLAIN_NUMERIC_COLUMNS,
    count_columns: Iterable[str] = fixed.COUNT_COLUMNS,
) -> DataFrame:
    """Text to numbers: money layouts, plain numbers, whole counts (ties to even)."""
    rules: dict[str, Column] = {}
    for c in money_columns:
        if c in df.columns:
            is_text = isinstance(df.schema[c].dataType, T.StringType)
            rules[c] = numbers.parse_money(F.col(c)) if is_text else numbers.numeric(df, c)
    for c in plain_columns:
        if c in df.columns:
            rules[c] = numbers.numeric(df, c)
    for c in count_columns:
        if c in df.columns:
            rules[c] = numbers.half_even_long(rules.get(c, numbers.numeric(df, c)))
    return df.withColumns(rules) if rules else df


def convert_dates(df: DataFrame, column: str = "signup_date", keep_time: bool = False) -> DataFrame:
    """Parse a date column and add its year, month, quarter and weekday name."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, T.StringType):
        parse = dates.parse_timestamp if keep_time else dates.parse_date
        df = df.withColumn(column, parse(F.col(column)))
    elif not keep_time:
        df = df.withColumn(column, F.col(column).cast("date"))
    return df.withColumns(
        {
            f"{column}_year": F.year(column),
            f"{column}_month": F.month(column),
            f"{column}_quarter": F.quarter(column),
            f"{column}_weekday": dates.weekday_name(F.col(column)),
        }
    )


def _out_of_range(df: DataFrame, column: str, low: float, high: float) -> Column:
    value = numbers.numeric(df, column)
    return value.isNotNull() & ~value.between(low, high)


def validate_range(
    df: DataFrame,
    column: str = "age",
    low: float = fixed.AGE_RANGE[0],
    high: float = fixed.AGE_RANGE[1],
) -> DataFrame:
    """Blank values outside the closed range; every row is kept."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.when(~_out_of_range(df, column, low, high), F.col(column)))


RANGE_REPORT_SCHEMA = (
    "coluna string, regra string, quantidade_invalida bigint, percentual_invalido double, estrategia string"
)


def range_report(
    df: DataFrame,
    column: str = "age",
    low: float = fixed.AGE_RANGE[0],
    high: float = fixed.AGE_RANGE[1],
) -> DataFrame:
    """One row on the values ``validate_range`` would blank; empty without the column."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], RANGE_REPORT_SCHEMA)
    counts = df.agg(
        F.count_if(_out_of_range(df, column, low, high)).alias("bad"), F.count("*").alias("total")
    )
    return counts.select(
        F.lit(column).alias("coluna"),
        F.lit(fixed.RANGE_RULE.format(low=low, high=high, column=column)).alias("regra"),
        F.col("bad").alias("quantidade_invalida"),
        numbers.share(F.col("bad"), F.col("total")).alias("percentual_invalido"),
        F.lit(fixed.RANGE_STRATEGY).alias("estrategia"),
    )

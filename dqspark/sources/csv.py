"""CSV and Parquet scans and sinks of the customer data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.fixed import NA_TOKENS
from dqspark.sources.records import csv_records

PROCESSED_SCHEMA = (
    "customer_id string, customer_name string, email string, age double, gender string, "
    "city string, state string, signup_date date, income double, purchase_count bigint, "
    "total_spent double, satisfaction_score double, email_valido boolean, "
    "signup_date_year int, signup_date_month int, signup_date_quarter int, "
    "signup_date_weekday string, customer_segment string"
)


def null_tokens(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """Turn the usual spellings of "missing" into NULL in every string column."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(list(tokens)), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV: every column as text, missing tokens as NULL.

    The header alone gives the schema. Line breaks inside quotes belong to the
    field, and yet a large file is read by many tasks, see ``records``.
    """
    options = {"header": "true", "inferSchema": "false", "escape": '"', "multiLine": "true", "encoding": "UTF-8"}
    head = spark.read.options(**options).csv(path)
    if not head.columns:
        return head
    names = ", ".join(f"`{c.replace('`', '``')}` string" for c in head.columns)
    rows = csv_records(spark, path).where(~F.col("first"))
    fields = F.from_csv("value", names, {"escape": '"', "multiLine": "true"})
    return null_tokens(rows.select(fields.alias("_fields")).select("_fields.*"))


def load_processed(spark: SparkSession, path: str, file_format: str = "csv", rescued: str | None = None) -> DataFrame:
    """Processed customers with their declared types.

    A cell that is no value of its column's type becomes NULL and fails nothing.
    ``rescued`` names an extra column that keeps such cells: a map from column
    to text, NULL for rows without any.
    """
    if file_format == "parquet":
        return null_tokens(spark.read.schema(PROCESSED_SCHEMA).parquet(path))
    # Read as text first: a missing token in a number must not spoil its row.
    wanted = T.StructType.fromDDL(PROCESSED_SCHEMA)
    raw = load_raw(spark, path)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in wanted}
    out = [c.alias(name) for name, c in typed.items()]
    if rescued is not None:
        lost = [
            F.when(F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull(), F.struct(F.lit(f.name).alias("name"), F.col(f"`{f.name}`").alias("text")))
            for f in wanted
            if not isinstance(f.dataType, T.StringType)
        ]
        cells = F.filter(F.array(*lost), lambda x: x.isNotNull())
        out.append(F.when(F.size(cells) > 0, F.map_from_entries(cells)).alias(rescued))
    return raw.select(*out)


def save_frame(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write CSV with header, replacing what is there.

    ``single_file`` is for reports of a few rows; data keeps its partitions.
    Text is written as it is: no trimming, missing as an empty field.
    """
    # A shuffle, unlike coalesce, leaves the report's own last stage to many tasks.
    out = df.repartition(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("encoding", "UTF-8")
        .csv(path)
    )

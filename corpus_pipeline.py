"""From raw documents to packed training sequences, in stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm.decontamination import drop_contaminated
from dqspark.llm.outliers import keep_good
from dqspark.llm.packing import pack, public_encoding
from dqspark.llm.simhash import keep_one
from dqspark.llm.staging import Staged
from dqspark.llm.suffixes import drop_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the stretches that one of a smaller id has too."""
    cut = drop_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 2048 tokens."""
    return pack(docs, *public_encoding())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: Robust covariances, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again."""
    staged, docs, last = Staged(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = staged.write(stage(spark, docs, sf_dir))
        if last is not None:
            staged.drop(last)
        last = docs
    return docs

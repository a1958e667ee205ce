"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

The features are densities of a hand-written and of a learned lexicon, hits near
a second person, capitals, punctuation and obfuscation. The learned lexicon
holds words and beginnings of words that toxic training rows have far more
often, so languages without a hand-written list are covered too. Training rows
get their lexicon features from a lexicon of the other fold, as else the trees
would trust terms that only chance has put there.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

#: Insults and second-person words of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons loser losers scum trash garbage stupid dumb worthless pathetic disgusting clown clowns "
    "imbecile retard bastard bitch asshole jerk freak pig vermin filth shut hate kill die ugly fool fools "
    "idioten dumm dummkopf arschloch versager abschaum blöd trottel depp drecksau widerlich wertlos "
    "idiote imbécile connard crétin ordure débile minable nul dégoûtant abruti raclure "
    "idiota imbécil estúpido estúpida basura payaso asqueroso inútil tonto cabrón escoria".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton vous votre vos tú ti usted ustedes vosotros".split()
)
LEET = str.maketrans("0134578@$!*", "oieastbasii")

#: Labelled rows that are used at most (those with the smallest hash of their id).
TRAINING_ROWS = 20_000
#: Toxic rows a learned term stands in at least, and how much likelier it is there.
LEAST_TOXIC_ROWS, LEAST_RATIO = 3, 6.0
PREFIXES = (4, 5, 6)
NEAR, MEMO = 4, 400_000
FOLDS, CALIBRATION = 2, 5
FEATURES = 12

_words = re.compile(r"\w+").findall
_disguised = re.compile(r"[^\W\d_]+[0-9@$!*]+[^\W\d_]+[^\W_]*").findall


def terms(text: str) -> set[str]:
    """Words and beginnings of words (marked with ``*``) of a text."""
    words = set(_words(text.lower()))
    return words | {f"{w[:n]}*" for n in PREFIXES for w in words if len(w) > n}


class Memo(dict):
    """Code of a word: 1 insult, 2 second person, 4 in the learned lexicon."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned

    def weight(self, word: str) -> float:
        found = [self.learned.get(word, 0.0)]
        found += [self.learned.get(f"{word[:n]}*", 0.0) for n in PREFIXES if len(word) > n]
        return max(found)

    def __missing__(self, word: str) -> int:
        code = (word in INSULTS) + 2 * (word in SECOND_PERSON) + 4 * (self.weight(word) > 0)
        if len(self) < MEMO:
            self[word] = code
        return code


def features(text: str, memo: Memo) -> list[float]:
    words = _words(text.lower())
    n = max(1, len(words))
    codes = np.frombuffer(bytes(map(memo.__getitem__, words)), np.uint8)
    insults, learned = np.flatnonzero(codes & 1), np.flatnonzero(codes & 4)
    hits, persons = np.flatnonzero(codes & 5), np.flatnonzero(codes & 2)
    near = 0
    if len(hits) and len(persons):
        at = np.searchsorted(persons, hits)
        before = np.abs(hits - persons[np.maximum(at - 1, 0)])
        after = np.abs(hits - persons[np.minimum(at, len(persons) - 1)])
        near = int((np.minimum(before, after) <= NEAR).sum())
    weights = [memo.weight(words[i]) for i in learned.tolist()]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    letters = int((((raw | 32) >= 97) & ((raw | 32) <= 122)).sum())
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    disguised = _disguised(text)
    unmasked = sum(w.lower().translate(LEET) in INSULTS for w in disguised)
    marks = text.count("!") + text.count("?")
    return [
        100 * len(insults) / n,
        float(len(insults)),
        100 * sum(weights) / n,
        max(weights, default=0.0),
        math.log1p(len({words[i] for i in learned.tolist()})),
        100 * near / n,
        capitals / max(1, letters),
        marks / n,
        (text.count("!!") + text.count("??")) / n,
        len(disguised) / n,
        float(unmasked),
        math.log1p(len(words)),
    ]


def featured(rows: DataFrame, keep: list[str], text_col: str, lexicons: list[dict[str, float]], fold: Column) -> DataFrame:
    """``keep`` columns and ``x``: the features by the lexicon number ``fold``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", x array<double>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [Memo(x) for x in lexicons]
        for batch in worker.slices(batches):
            texts, folds = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            found = [features(t or "", memos[f]) for t, f in zip(texts, folds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, pa.list_(pa.float64()))], [*keep, "x"])

    return rows.select(*keep, F.col(text_col).alias("_text"), fold.cast("int").alias("_fold")).mapInArrow(work, schema)


def learn_lexicons(rows: DataFrame, text_col: str = "text") -> list[dict[str, float]]:
    """Log ratios of terms for each fold (from the other rows), then from all rows.

    ``rows`` has fold, toxic and the text. The result holds the terms that
    LEAST_TOXIC_ROWS toxic ones of at most TRAINING_ROWS rows share.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches):
            texts, folds, toxic = (c.to_pylist() for c in batch.columns)
            found = [(t, f, x) for s, f, x in zip(texts, folds, toxic) for t in terms(s or "")]
            columns = list(zip(*found)) or [(), (), ()]
            kinds = (pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "fold", "toxic"])

    listed = rows.select(F.col(text_col), F.col("fold").cast("int"), F.col("toxic").cast("int"))
    bad = [F.sum(F.when(F.col("fold") == f, F.col("toxic")).otherwise(0)).alias(f"t{f}") for f in range(FOLDS)]
    all_ = [F.sum((F.col("fold") == f).cast("int")).alias(f"n{f}") for f in range(FOLDS)]
    counted = listed.mapInArrow(work, "term string, fold int, toxic int").groupBy("term").agg(*bad, *all_)
    totals = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()
    rows_in, toxic_in = {r.fold: r.n for r in totals}, {r.fold: r.t for r in totals}
    counted = counted.where(sum(F.col(f"t{f}") for f in range(FOLDS)) >= LEAST_TOXIC_ROWS).persist()
    out = []
    for without in [*range(FOLDS), None]:
        used = [f for f in range(FOLDS) if f != without]
        toxic, both = sum(F.col(f"t{f}") for f in used), sum(F.col(f"n{f}") for f in used)
        n_toxic = sum(toxic_in.get(f, 0) for f in used)
        n_clean = sum(rows_in.get(f, 0) for f in used) - n_toxic
        ratio = ((toxic + 0.5) / (n_toxic + 1)) / ((both - toxic + 0.5) / (n_clean + 1))
        chosen = counted.select("term", toxic.alias("toxic"), F.log(ratio).alias("weight"))
        chosen = chosen.where((F.col("toxic") >= LEAST_TOXIC_ROWS) & (F.col("weight") >= math.log(LEAST_RATIO)))
        out.append({r.term: r.weight for r in chosen.collect()})
    counted.unpersist()
    return out


def fit(rows: DataFrame) -> tuple[GBTClassificationModel, list[tuple[float, float]]]:
    """Trees on four fifths of ``rows`` (id, x, toxic), calibration points on the rest."""
    part = F.pmod(F.xxhash64(F.col("id"), F.lit("part")), F.lit(CALIBRATION))
    table = rows.select(array_to_vector("x").alias("features"), F.col("toxic").cast("double").alias("label"), part.alias("part"))
    trees = GBTClassifier(maxDepth=3, maxIter=24, stepSize=0.3, maxBins=64, subsamplingRate=1.0, seed=1, cacheNodeIds=False)
    model = trees.fit(table.where("part <> 0"))
    apart = table.where("part = 0")
    if apart.agg(F.countDistinct("label")).first()[0] < 2:
        return model, []
    scored = model.transform(apart).select(vector_to_array("probability")[1].alias("features"), "label")
    steps = IsotonicRegression(featuresCol="features").fit(scored)
    return model, list(zip(steps.boundaries.toArray().tolist(), steps.predictions.toArray().tolist()))


def calibrated(p: Column, points: list[tuple[float, float]]) -> Column:
    """Interpolated isotonic score; a thousandth of ``p`` keeps the order on its steps."""
    if not points:
        return p
    at = F.lit(points[0][1])
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        slope = (y1 - y0) / (x1 - x0) if x1 > x0 else 0.0
        at = F.when(p > x0, F.least(F.lit(y1), y0 + (p - x0) * slope)).otherwise(at)
    return F.lit(0.999) * at + F.lit(0.001) * p


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of each row of ``docs``, learned from ``training`` (id, toxic).

    At most TRAINING_ROWS training rows are used. A null id or label does not
    train; repeated ids train once, by the text of the smallest hash and as toxic
    if any of their labels is. Null and
    empty texts are scored by their features, all zero. Without rows of both
    labels every score is the mean label (0 without any row). Other columns of
    ``docs`` are not read. Each row keeps its row.
    """
    staged = Staged(docs.sparkSession, "toxicity")
    labels = training.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    # Bounded by TRAINING_ROWS, so it may be broadcast.
    sample = labels.orderBy(F.xxhash64("id"), "id").limit(TRAINING_ROWS)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = staged.write(rows.withColumn("fold", F.pmod(F.xxhash64(F.col("id"), F.lit("fold")), F.lit(FOLDS)).cast("int")))
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        return texts.select("id", F.lit(float(toxic) / max(1, n)).alias("score"))
    lexicons = learn_lexicons(rows)
    model, points = fit(staged.write(featured(rows, ["id", "toxic"], "text", lexicons[:FOLDS], F.col("fold"))))
    found = featured(texts, ["id"], "text", lexicons[FOLDS:], F.lit(0))
    scored = model.transform(found.withColumn("features", array_to_vector("x")))
    return scored.withColumn("p", vector_to_array("probability")[1]).select("id", calibrated(F.col("p"), points).alias("score"))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def op4_toxicity_trees(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    training = labels.where(~held_out("doc_id")).select(F.col("doc_id").alias("id"), "toxic")
    return score(docs, training).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

"""Quality rules and robust multivariate outliers among documents.

Per language and source, the minimum covariance determinant (Rousseeuw, 1984)
gives a centre and a scatter that a quarter of bad documents cannot move; a
document whose transformed statistics lie too far out by Mahalanobis distance
is rejected. Several starts that need no random subsets (Hubert, Rousseeuw and
Verdonck, 2012) are concentrated until their determinants stand still, the
smallest one stays and is reweighted. Estimates of few rows lean on those of
their language, and these on those of all rows, as if they had seen a fixed
number of rows of theirs.

The concentration steps run as aggregates: each document's squared distance
falls into a fine bin, counts and moments are summed per group, start and bin,
and the innermost bins that hold the wanted share of the group (the last one in
part) give the next estimate. A group of any size is a few hundred rows after
the partial sums.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.rows import pick
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

#: Fixed values of the base rules.
WHITE, SYMBOLS = " \t\n\r\x0b\x0c", "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper")
#: Least standard deviation of each feature: below it, differences are no sign of bad text.
FLOORS = (1.0, 0.25, 0.07, 0.14, 0.12, 0.1)
SHARE, TAIL = 0.75, 1e-7
#: Rows within this share of the chi-square distribution make up the reweighted estimate.
REWEIGHT = 0.975
#: Rows that the estimate of the level above counts as.
PRIOR_ROWS = 100
#: Share of the correlations given up, so that any scatter has an inverse.
RIDGE = 0.05
#: Steps of all starts, how many go on, and the fall of the log determinant that still counts.
FIRST_STEPS, GO_ON, STILL = 2, 2, 1e-3
BINS_PER_OCTAVE = 16
#: Parts of a group that are joined apart.
SALTS = 16


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + each[k : n + k]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    places = np.zeros(n, bool)
    places[order[1:][same]] = places[order[:-1][same]] = True
    found = np.flatnonzero(places).tolist()
    times = Counter(tuple(words[p : p + window]) for p in found)
    covered = np.zeros(len(words), bool)
    for p in found:
        if times[tuple(words[p : p + window])] > 1:
            covered[p : p + window] = True
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    letters = np.frombuffer(raw, np.uint8)
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(((letters >= 65) & (letters <= 90)).sum()),
    )


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """id, row_key, lang, source, COUNTS and base_failed of each row."""
    names = ["id", "row_key", "lang", "source", *COUNTS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches):
            found = [counts(t) for t in batch.column(4).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], names)

    read = docs.select(
        F.col(id_col).cast("long").alias("id"),
        row_key(text_col, lang_col, source_col).alias("row_key"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).alias("text"),
    )
    schema = "id long, row_key long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return read.mapInArrow(work, schema).withColumn("base_failed", failed)


def row_key(text_col: str, lang_col: str, source_col: str) -> Column:
    return F.xxhash64(F.col(text_col), F.col(lang_col).cast("string"), F.col(source_col).cast("string"))


def features() -> list[Column]:
    """Logarithm of the size, mean word length and square roots of rates."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.col("word_chars") / words,
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))),
    ]


def chi_square(share: float, k: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty, 1931)."""
    z = NormalDist().inv_cdf(share)
    return k * (1 - 2 / (9 * k) + z * (2 / (9 * k)) ** 0.5) ** 3


def consistency(share: float, k: int, draws: int = 200_001) -> float:
    """Factor that makes the scatter of the inner ``share`` right for normal data.

    It is share / P(chi2(k + 2) <= quantile of chi2(k)); the mean of the inner
    part of chi2(k) is taken over evenly spaced probabilities.
    """
    p = (np.arange(draws) + 0.5) / draws * share
    z = np.array([NormalDist().inv_cdf(x) for x in p[:: max(1, draws // 2000)]])
    inner = k * np.maximum(0, 1 - 2 / (9 * k) + z * (2 / (9 * k)) ** 0.5) ** 3
    return float(k / inner.mean())


def regular(scatter: np.ndarray) -> np.ndarray:
    """A scatter with each feature's variance at least its floor and an inverse."""
    scatter = scatter + np.diag(np.maximum(0, np.square(FLOORS) - np.diag(scatter)))
    return (1 - RIDGE) * scatter + RIDGE * np.diag(np.diag(scatter))


def invert(mean: np.ndarray, scatter: np.ndarray) -> list[float]:
    """Centre and inverse of the regular scatter."""
    return [*mean, *np.linalg.inv(regular(scatter)).ravel()]


def matrix(row: pd.Series, prefix: str) -> np.ndarray:
    """The symmetric matrix of the columns ``prefix``i_j."""
    k = len(FEATURES)
    return np.array([[row[f"{prefix}{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])


def spread(row: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scatter of the sums n, s0.., s0_0.."""
    mean = np.array([row[f"s{i}"] for i in range(len(FEATURES))]) / row["n"]
    return mean, matrix(row, "s") / row["n"] - np.outer(mean, mean)


def next_estimate(rows: pd.DataFrame, share: float, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of the innermost bins that hold ``share`` of a group.

    The last of these bins counts in part, so that determinants compare alike.
    """
    rows = rows.sort_values("bin")
    before = rows["n"].cumsum() - rows["n"]
    wanted = share * rows["n"].sum()
    part = ((wanted - before) / rows["n"]).clip(0, 1)
    mean, scatter = spread(rows.drop(columns=["g", "start", "bin"]).astype(float).mul(part, axis=0).sum())
    return mean, factor * scatter


def distance(k: int = len(FEATURES)) -> Column:
    """Squared Mahalanobis distance of x0.. to the estimate ``e`` (centre, inverse)."""
    d = [F.col(f"x{i}") - F.col("e")[i] for i in range(k)]
    terms = [d[i] * d[j] * F.col("e")[k + i * k + j] for i in range(k) for j in range(k)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def pairs(k: int = len(FEATURES)) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def sums() -> list[Column]:
    """n, s0.. and s0_0..: number, sums and sums of products of x0.."""
    out = [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(FEATURES))]]
    return out + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs()]


def salted(small: DataFrame) -> DataFrame:
    """``small`` once for each part of a group."""
    return small.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))


ESTIMATE = "g string, start int, e array<double>, log_det double"


def starts(rows: DataFrame, staged: Staged) -> DataFrame:
    """ESTIMATE rows: three starts of each group, their determinants unknown (infinite).

    All begin at the middle of each feature (to a 64th of a floor). Their scatters
    are the squared quartile distances, those with the correlations of hyperbolic
    tangents, and those with the correlations of spatial signs.
    """
    k = len(FEATURES)
    width = [f / 64 for f in FLOORS]
    binned = F.array(*[F.floor(F.col(f"x{i}") / width[i]) for i in range(k)])
    tallied = rows.select("g", F.posexplode(binned).alias("feature", "bin")).groupBy("g", "feature", "bin").agg(F.count("*").alias("n"))

    def middle(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        centre, scale = np.zeros(k), np.zeros(k)
        for i, part in frame.groupby("feature"):
            part = part.sort_values("bin")
            upto, values = part["n"].cumsum(), (part["bin"] + 0.5) * width[i]
            low, centre[i], high = (values[upto >= q * upto.iloc[-1]].iloc[0] for q in (0.25, 0.5, 0.75))
            scale[i] = max(FLOORS[i], (high - low) / 1.349)
        return pd.DataFrame({"g": [key[0]], "m": [centre], "w": [scale]})

    # A group has as many rows here as its features have bins, however large it is.
    middles = staged.write(tallied.groupBy("g").applyInPandas(middle, "g string, m array<double>, w array<double>"))
    placed = rows.join(salted(middles), ["g", "salt"])
    placed = placed.select("g", *[((F.col(f"x{i}") - F.col("m")[i]) / F.col("w")[i]).alias(f"z{i}") for i in range(k)])
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, k)), F.col("z0") * F.col("z0")))
    placed = placed.withColumn("length", F.greatest(length, F.lit(1e-9)))
    placed = placed.select("g", *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(k)], *[(F.col(f"z{i}") / F.col("length")).alias(f"u{i}") for i in range(k)])
    products = [F.avg(F.col(f"{c}{i}") * F.col(f"{c}{j}")).alias(f"{c}{i}_{j}") for c in "tu" for i, j in pairs()]
    shapes = placed.groupBy("g").agg(*products).join(middles, "g")

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for _, row in frame.iterrows():
                found = [np.eye(k)]
                for c in "tu":
                    shape = matrix(row, c)
                    size = np.sqrt(np.maximum(np.diag(shape), 1e-9))
                    found.append(shape / np.outer(size, size))
                for start, shape in enumerate(found):
                    out.append((row["g"], start, invert(row["m"], shape * np.outer(row["w"], row["w"])), np.inf))
            yield pd.DataFrame(out, columns=["g", "start", "e", "log_det"])

    return staged.write(shapes.mapInPandas(begin, ESTIMATE).withColumn("done", F.lit(False)))


def concentrate(rows: DataFrame, current: DataFrame, staged: Staged, share: float) -> DataFrame:
    """One concentration step of the estimates that are not ``done``.

    One whose determinant does not fall any more keeps what it has and is done.
    """
    factor = consistency(share, len(FEATURES))

    def step(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        mean, scatter = next_estimate(frame, share, factor)
        log_det = np.linalg.slogdet(regular(scatter))[1]
        return pd.DataFrame({"g": [key[0]], "start": [key[1]], "e": [invert(mean, scatter)], "log_det": [log_det]})

    placed = rows.join(salted(current.where("NOT done").select("g", "start", "e")), ["g", "salt"])
    binned = placed.withColumn("bin", F.floor(F.log2(1 + distance()) * BINS_PER_OCTAVE))
    moments = binned.groupBy("g", "start", "bin").agg(*sums())
    stepped = moments.groupBy("g", "start").applyInPandas(step, ESTIMATE)
    stepped = stepped.select("g", "start", F.col("e").alias("next_e"), F.col("log_det").alias("next_det"))
    fell = F.coalesce(F.col("next_det") < F.col("log_det") - STILL, F.lit(False))
    following = staged.write(
        current.join(stepped, ["g", "start"], "left").select(
            "g", "start", F.when(fell, F.col("next_e")).otherwise(F.col("e")).alias("e"),
            F.when(fell, F.col("next_det")).otherwise(F.col("log_det")).alias("log_det"), (~fell).alias("done"),
        )
    )
    staged.drop(current)
    return following


def best(current: DataFrame, n: int) -> DataFrame:
    """The ``n`` estimates of each group with the smallest determinants."""
    place = F.row_number().over(Window.partitionBy("g").orderBy("log_det", "start"))
    return current.withColumn("place", place).where(F.col("place") <= n).drop("place")


def determinants(rows: DataFrame, staged: Staged, share: float = SHARE) -> DataFrame:
    """ESTIMATE rows: the minimum covariance determinant of each group ``g`` of rows x0..

    ``rows`` also have a number ``salt``. Steps go on while a determinant falls;
    as floors bound it from below, they end. Of a group with fewer rows than
    features it may be a local minimum only; such estimates hardly count.
    """
    current = starts(rows, staged)
    for _ in range(FIRST_STEPS):
        current = concentrate(rows, current, staged, share)
    current = staged.write(best(current, GO_ON))
    while current.where("NOT done").head(1):
        current = concentrate(rows, current, staged, share)
    return best(current, 1)


def reweighted(rows: DataFrame, found: DataFrame, staged: Staged) -> DataFrame:
    """(g, n, m, c): rows, mean and scatter of those of a group near its estimate."""
    k = len(FEATURES)
    factor, limit = consistency(REWEIGHT, k), chi_square(REWEIGHT, k)
    near = rows.join(salted(found.select("g", "e")), ["g", "salt"]).where(distance() <= limit)
    summed = near.groupBy("g").agg(*sums()).join(rows.groupBy("g").agg(F.count("*").alias("rows")), "g")

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for _, row in frame.iterrows():
                mean, scatter = spread(row.drop("g").astype(float))
                out.append((row["g"], row["rows"], mean, (factor * scatter).ravel()))
            yield pd.DataFrame(out, columns=["g", "n", "m", "c"])

    return staged.write(summed.mapInPandas(finish, "g string, n long, m array<double>, c array<double>"))


def lean(n: int, mean: np.ndarray, scatter: np.ndarray, over: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An estimate of ``n`` rows after PRIOR_ROWS rows of the level above."""
    total, apart = n + PRIOR_ROWS, mean - over
    joint = (n * scatter + PRIOR_ROWS * wide + n * PRIOR_ROWS / total * np.outer(apart, apart)) / total
    return (n * mean + PRIOR_ROWS * over) / total, joint


def leaning(levels: DataFrame, found: DataFrame) -> DataFrame:
    """(l, s, e): each group's estimate, leaning on its language's and that on the whole's."""
    k = len(FEATURES)
    for c in ("g0", "g1", "g2"):
        own = found.select(F.col("g").alias(c), F.struct("n", "m", "c").alias(f"of_{c}"))
        levels = levels.join(own, c)

    def blend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for _, row in frame.iterrows():
                each = [(x["n"], np.array(x["m"]), np.array(x["c"]).reshape(k, k)) for x in row[["of_g0", "of_g1", "of_g2"]]]
                mean, scatter = each[0][1:]
                for own in each[1:]:
                    mean, scatter = lean(*own, mean, scatter)
                out.append((row["l"], row["s"], invert(mean, scatter)))
            yield pd.DataFrame(out, columns=["l", "s", "e"])

    return levels.mapInPandas(blend, "l string, s string, e array<double>")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    tail: float = TAIL,
) -> DataFrame:
    """One row per row of ``docs``: id, row_key, COUNTS, base_failed, distance, kept.

    Rows that pass the base rules make up the estimates of their language and
    source and are kept if their squared distance is at most the chi-square
    quantile 1 - ``tail``. Null languages and sources are groups of their own.
    A group of any size is judged in the same way: it leans on its language and
    that on all rows, by PRIOR_ROWS rows each.
    Null texts have no words and fail. Rows that fail have no distance. Equal
    rows get equal verdicts. No rows give no rows. Other columns are not read.
    """
    staged = Staged(docs.sparkSession, "outliers")
    rows = staged.write(statistics(docs, id_col, text_col, lang_col, source_col))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    passed = rows.where(~F.col("base_failed")).select(
        named("lang").alias("l"), named("source").alias("s"), *[x.alias(f"x{i}") for i, x in enumerate(features())]
    )
    keys = [F.lit("[]"), F.to_json(F.array("l")), F.to_json(F.array("l", "s"))]
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")
    xs = [f"x{i}" for i in range(len(FEATURES))]
    grouped = staged.write(passed.select(F.explode(F.array(*keys)).alias("g"), salt, *xs))
    found = reweighted(grouped, determinants(grouped, staged), staged)
    staged.drop(grouped)
    levels = passed.select("l", "s").distinct().select("l", "s", *[x.alias(f"g{i}") for i, x in enumerate(keys)])
    named_rows = rows.withColumns({"l": named("lang"), "s": named("source")})
    named_rows = named_rows.withColumns({f"x{i}": x for i, x in enumerate(features())})
    judged = named_rows.join(staged.write(leaning(levels, found)), ["l", "s"], "left").withColumn(
        "distance", F.when(~F.col("base_failed"), distance())
    )
    limit = chi_square(1 - tail, len(FEATURES))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return judged.select("id", "row_key", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that the quality rules keep, with all their columns."""
    names = {"id_col": "doc_id", "text_col": "text", "lang_col": "lang", "source_col": "source"} | columns
    bad = quality_rules(docs, **names).where(~F.col("kept")).select("id", "row_key")
    key = row_key(names["text_col"], names["lang_col"], names["source_col"])
    return pick(docs, bad, names["id_col"], key, "left_anti")


def op2_robust_outliers(spark, sf_dir: str) -> DataFrame:
    rows = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(F.col("id").alias("doc_id"), *COUNTS[:5], "base_failed", "kept", "distance")

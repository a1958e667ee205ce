"""Hypothesis tests as aggregates: a test is one result row.

Tests on ranks stage the table of value counts when they are built.

``*_stats`` functions give the unrounded numbers behind a test; the ``*_test``
functions put them into the common report row (statistic to 4, p to 6 decimals).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark import fixed
from dqspark.functions.numbers import numeric
from dqspark.operators import corr
from dqspark.operators.ranks import average_ranks, quantile_table, ranks_and_sizes
from dqspark.operators.tails import EXACT_SAMPLE, beta_tail, normal_tail, rank_sum_tail
from dqspark.session import stage


def _verdict(stats: DataFrame, texts: dict[str, Column], alpha: float) -> DataFrame:
    reject = F.col("p_value") < F.lit(alpha)
    return stats.select(
        texts["test"].alias("test"),
        texts["h0"].alias("null_hypothesis"),
        texts["h1"].alias("alternative_hypothesis"),
        F.round("statistic", 4).alias("statistic"),
        F.round("p_value", 6).alias("p_value"),
        F.lit(float(alpha)).alias("alpha"),
        F.when(reject, fixed.VERDICTS[0]).otherwise(fixed.VERDICTS[1]).alias("result"),
        F.when(reject, texts["reject"]).otherwise(texts["keep"]).alias("interpretation"),
    )


def _texts(kind: str, shown: Sequence[Column] = (), **names) -> dict[str, Column]:
    """Texts of a test; ``shown`` are the numbers printed when H0 is rejected."""
    filled = {k: v.format(**names) for k, v in fixed.TEST_TEXTS[kind].items()}
    texts = {k: F.lit(v) for k, v in filled.items()}
    if shown:
        texts["reject"] = F.format_string(filled["reject"], *shown)
    return texts


# --- correlation ---------------------------------------------------------------


def correlation_stats(df: DataFrame, pairs: Sequence[tuple[str, str]], method: str, **ranked) -> DataFrame:
    """``pair, variable_1, variable_2, n, statistic, p_value`` for each pair."""
    found = {"pearson": corr.pearson_pairs, "spearman": corr.spearman_pairs}[method](df, pairs, **ranked)
    r, free = F.col("correlation"), F.col("n") - 2
    # t^2 / df of the t statistic with n - 2 degrees of freedom.
    ratio = F.try_divide(r * r, F.lit(1.0) - r * r)
    p = (
        F.when(r.isNull(), F.lit(None))
        .when(free <= 0, 1.0)
        .when(F.abs(r) >= 1, 0.0)
        .otherwise(beta_tail(free / 2.0, F.lit(0.5), ratio))
    )
    return found.select(
        "pair", "variable_1", "variable_2", "n", r.alias("statistic"), p.cast("double").alias("p_value")
    )


def correlation_tests(
    df: DataFrame, pairs: Sequence[tuple[str, str]], method: str, alpha: float = fixed.ALPHA, **ranked
) -> DataFrame:
    """Report rows of several pairs from one pass, with their ``pair`` number."""
    stats = correlation_stats(df, pairs, method, **ranked)
    rows = []
    for i, (x, y) in enumerate(pairs):
        texts = _texts(method, [F.col("statistic")], x=x, y=y)
        rows.append((i, texts))

    def pick(key: str) -> Column:
        return reduce(lambda acc, it: F.when(F.col("pair") == it[0], it[1][key]).otherwise(acc), rows, F.lit(None))

    texts = {key: pick(key) for key in ("test", "h0", "h1", "reject", "keep")}
    return _verdict(stats, texts, alpha)


def pearson_test(df: DataFrame, x: str, y: str, alpha: float = fixed.ALPHA) -> DataFrame:
    return correlation_tests(df, [(x, y)], "pearson", alpha)


def spearman_test(df: DataFrame, x: str, y: str, alpha: float = fixed.ALPHA) -> DataFrame:
    return correlation_tests(df, [(x, y)], "spearman", alpha)


# --- two groups ----------------------------------------------------------------


def _two_groups(df: DataFrame, value: str, group: str, a, b, **more: Column) -> DataFrame:
    """``value`` and ``in_a`` of the rows of either group, and the columns ``more``."""
    label = F.col(group)
    found = [numeric(df, value).alias("value"), (label == F.lit(a)).alias("in_a"), label.isin([a, b]).alias("_kept")]
    rows = df.select(*found, *[c.alias(name) for name, c in more.items()])
    return rows.where(F.col("_kept") & F.col("value").isNotNull()).drop("_kept")


def welch_stats(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """One row: sizes, means and variances of both groups, t, df and p."""
    rows = _two_groups(df, value, group, a, b)
    sides = [("a", F.col("in_a")), ("b", ~F.col("in_a"))]
    sums = rows.agg(
        *[
            agg
            for name, here in sides
            for agg in (
                F.count_if(here).alias(f"n_{name}"),
                F.avg(F.when(here, F.col("value"))).alias(f"mean_{name}"),
                F.var_samp(F.when(here, F.col("value"))).alias(f"var_{name}"),
            )
        ]
    )
    ea, eb = F.try_divide(F.col("var_a"), F.col("n_a")), F.try_divide(F.col("var_b"), F.col("n_b"))
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(ea + eb))
    free = F.try_divide(
        (ea + eb) * (ea + eb),
        F.try_divide(ea * ea, F.col("n_a") - 1) + F.try_divide(eb * eb, F.col("n_b") - 1),
    )
    stats = sums.withColumn("statistic", t).withColumn("df", free)
    squared = F.try_divide(F.col("statistic") * F.col("statistic"), F.col("df"))
    return stats.withColumn("p_value", beta_tail(F.col("df") / 2.0, F.lit(0.5), squared))


def welch_test(df: DataFrame, value: str, group: str, a, b, alpha: float = fixed.ALPHA) -> DataFrame:
    """Difference of two means, unequal variances."""
    shown = [F.col("mean_a"), F.col("mean_b")]
    return _verdict(welch_stats(df, value, group, a, b), _texts("welch", shown, value=value, a=a, b=b), alpha)


def mann_whitney_stats(
    df: DataFrame, value: str, group: str, a, b, method: str = "auto", apart: str | None = None
) -> DataFrame:
    """One row: sizes, medians, U of group ``a`` and the two-sided p.

    Works on the table of distinct values, never on ranked rows. ``auto`` takes
    the exact distribution without ties and with a sample of at most
    EXACT_SAMPLE, whatever the size of the other, else the normal one with tie
    and continuity corrections. ``asymptotic`` always takes the normal one;
    ``exact`` fails where the exact one does not apply.

    With ``apart``, rows of one value have ranks of their own, in the order of
    that column. Rows that agree in it too change no rank sum by their order if
    they are on one side; only those of both sides are still tied.
    """
    more = {} if apart is None else {"apart": F.col(apart)}
    order = ["value", *more]
    rows = _two_groups(df, value, group, a, b, **more)
    counts = (
        rows.groupBy(F.lit(value).alias("column"), *order)
        .agg(F.count("*").alias("n"), F.count_if("in_a").alias("in_a"))
    )
    return rank_sums(average_ranks(counts, ["column"], order), method, order)


def rank_sums(ranked: DataFrame, method: str = "auto", order: Sequence[str] = ("value",)) -> DataFrame:
    """``mann_whitney_stats`` from the ranks of the distinct values (value, n, in_a, avg_rank).

    Rows that further columns in ``order`` ranked apart tie with the other side only.
    """
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError(f"unknown method {method!r}")
    n = F.col("n").cast("double")
    tied = F.lit(True) if len(order) == 1 else (F.col("in_a") > 0) & (F.col("in_a") < F.col("n"))
    sums = ranked.agg(
        F.coalesce(F.sum("in_a"), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum(F.col("n") - F.col("in_a")), F.lit(0)).alias("n_b"),
        F.sum(F.col("in_a") * F.col("avg_rank")).alias("rank_sum"),
        F.sum(F.when(tied, n * n * n - n).otherwise(0.0)).alias("ties"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    u = F.col("rank_sum") - na * (na + 1) / 2
    spread = F.sqrt(na * nb / 12.0 * (na + nb + 1 - F.try_divide(F.col("ties"), (na + nb) * (na + nb - 1))))
    with_u = sums.withColumn("statistic", u).withColumn("_spread", spread)
    larger = F.greatest(F.col("statistic"), na * nb - F.col("statistic"))
    z = F.try_divide(larger - na * nb / 2 - 0.5, F.col("_spread"))
    exact = (F.least("n_a", "n_b") <= EXACT_SAMPLE) & (F.col("ties") == 0)
    normal = F.coalesce(F.least(normal_tail(z), F.lit(1.0)), F.lit(1.0))
    cannot = F.raise_error(F.lit(f"the exact distribution needs a sample of at most {EXACT_SAMPLE} and no ties"))
    p = {
        "auto": F.when(exact, rank_sum_tail("statistic", "n_a", "n_b")).otherwise(normal),
        "exact": F.when(exact, rank_sum_tail("statistic", "n_a", "n_b")).otherwise(cannot.cast("double")),
        "asymptotic": normal,
    }[method]
    sides = F.inline(
        F.array(
            F.struct(F.lit("a").alias("side"), F.col("in_a").alias("n")),
            F.struct(F.lit("b").alias("side"), (F.col("n") - F.col("in_a")).alias("n")),
        )
    )
    # The counts of both sides are in the staged table of the ranks.
    medians = quantile_table(ranked.select(*order, sides).where("n > 0"), ["side"], [0.5], order)
    folded = medians.groupBy().agg(
        F.struct(*[F.max(F.when(F.col("side") == s, F.col("q")[0])).alias(s) for s in "ab"]).alias("m")
    )
    both = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    return (
        with_u.withColumn("_m", folded.scalar())
        .withColumn("p_value", F.when(both, p))
        .select(
            "n_a", "n_b", F.col("_m.a").alias("median_a"), F.col("_m.b").alias("median_b"),
            F.when(both, F.col("statistic")).alias("statistic"), "p_value",
        )
    )


def mann_whitney_test(df: DataFrame, value: str, group: str, a, b, alpha: float = fixed.ALPHA) -> DataFrame:
    """Difference of two distributions by ranks; the statistic is U of ``a``."""
    shown = [F.col("median_a"), F.col("median_b")]
    texts = _texts("mann_whitney", shown, value=value, a=a, b=b)
    return _verdict(mann_whitney_stats(df, value, group, a, b), texts, alpha)


# --- several groups ------------------------------------------------------------


def anova_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """One row: groups seen and used, rows used, F, its degrees of freedom and p.

    Groups with at most one value are left out.
    """
    seen = (
        df.select(F.col(group).alias("g"), numeric(df, value).alias("value"))
        .where(F.col("g").isNotNull())
        .groupBy("g")
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))
    )
    used = F.col("n") > 1
    centre = seen.where(used).agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    away = F.col("mean") - F.col("centre")
    sums = (
        seen.withColumn("centre", centre)
        .agg(
            F.count("*").alias("groups_seen"),
            F.count_if(used).alias("groups"),
            F.sum(F.when(used, F.col("n"))).alias("n"),
            F.sum(F.when(used, F.col("n") * away * away)).alias("between"),
            F.sum(F.when(used, (F.col("n") - 1) * F.col("var"))).alias("within"),
        )
        .withColumn("df_between", F.col("groups") - 1)
        .withColumn("df_within", F.col("n") - F.col("groups"))
    )
    f = F.try_divide(
        F.try_divide(F.col("between"), F.col("df_between")), F.try_divide(F.col("within"), F.col("df_within"))
    )
    with_f = sums.withColumn("statistic", f)
    ratio = F.try_divide(F.col("df_between") * F.col("statistic"), F.col("df_within"))
    p = beta_tail(F.col("df_within") / 2.0, F.col("df_between") / 2.0, ratio)
    return with_f.withColumn("p_value", p).drop("between", "within")


def anova_test(df: DataFrame, value: str, group: str, alpha: float = fixed.ALPHA) -> DataFrame:
    """Difference of the means of several groups."""
    return _verdict(anova_stats(df, value, group), _texts("anova", value=value, group=group), alpha)


# --- standard battery ------------------------------------------------------------

#: Stands for the values of the rows that the Mann-Whitney test compares.
OF_SEGMENTS = "satisfaction_score of two segments"


def _battery_ranks(df: DataFrame, names: Sequence[str], segments: tuple[str, str] | None):
    """Ranks of the values of each column, and among the rows of two segments; one table."""
    never = F.lit(False)
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), never.alias("in_a")) for c in names]
    if segments is not None:
        label = F.col("customer_segment")
        value = F.when(label.isin(list(segments)), F.col("satisfaction_score"))
        in_a = F.coalesce(label == F.lit(segments[0]), never)
        cells.append(F.struct(F.lit(OF_SEGMENTS).alias("column"), value.alias("value"), in_a.alias("in_a")))
    long = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"), F.count_if("in_a").alias("in_a"))
    return ranks_and_sizes(counts, ["column"])


def standard_battery(
    df: DataFrame,
    segment_pair: tuple[str, str] = fixed.SEGMENT_TEST_PAIR,
    gender_pair: tuple[str, str] = fixed.GENDER_TEST_PAIR,
    alpha: float = fixed.ALPHA,
) -> DataFrame:
    """The standard questions on the customer table, one row per test.

    ``df`` is scanned once, for a narrow copy of the seven columns that the
    tests read. All tests on ranks share one table of value counts. Group tests
    appear only when their groups occur: two segments, three segments, both
    genders.
    """
    linear = [("income", "total_spent"), ("purchase_count", "total_spent")]
    by_rank = [*linear, ("satisfaction_score", "total_spent"), ("age", "total_spent")]
    names = sorted({c for pair in by_rank for c in pair})
    groups = [c for c in ("customer_segment", "gender") if c in df.columns]
    df = stage(df.select(*[numeric(df, c).alias(c) for c in names], *groups))
    a, b = segment_pair
    ranks, sizes = _battery_ranks(df, names, segment_pair if "customer_segment" in groups else None)
    parts = [
        correlation_tests(df, linear, "pearson", alpha),
        correlation_tests(df, by_rank, "spearman", alpha, ranked=(ranks, sizes)),
    ]
    if "customer_segment" in df.columns:
        stats = rank_sums(ranks.where(F.col("column") == OF_SEGMENTS))
        shown = [F.col("median_a"), F.col("median_b")]
        texts = _texts("mann_whitney", shown, value="satisfaction_score", a=a, b=b)
        parts.append(_verdict(stats.where((F.col("n_a") > 0) & (F.col("n_b") > 0)), texts, alpha))
        variance = anova_stats(df, "income", "customer_segment").where(F.col("groups_seen") >= 3)
        parts.append(_verdict(variance, _texts("anova", value="income", group="customer_segment"), alpha))
    if "gender" in df.columns:
        a, b = gender_pair
        stats = welch_stats(df, "total_spent", "gender", a, b).where((F.col("n_a") > 0) & (F.col("n_b") > 0))
        shown = [F.col("mean_a"), F.col("mean_b")]
        parts.append(_verdict(stats, _texts("welch", shown, value="total_spent", a=a, b=b), alpha))
    return reduce(DataFrame.unionByName, parts)

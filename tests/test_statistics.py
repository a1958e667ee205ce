"""Descriptive statistics, ranks, correlation, tests and chart data against NumPy."""

import math
import os
import random
import subprocess
import sys
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tests.conftest import by, rows

from dqspark.operators import charts, corr, describe, hypothesis, ranks, segments, tails
from dqspark.operators.skew import spread_join


def skewed(n=6000, seed=5):
    """A third of the rows holds one value, another column has heavy ties and gaps."""
    rng = np.random.default_rng(seed)
    x = np.where(rng.random(n) < 1 / 3, 7.0, np.round(rng.lognormal(3, 1.2, n), 3))
    y = np.round(x / 10 + rng.normal(0, 3, n))
    z = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 5, n))
    g = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c"], n))
    return pd.DataFrame({"x": x, "y": y, "z": z, "g": g})


@pytest.fixture(scope="module")
def data():
    return skewed()


@pytest.fixture
def table(spark, data):
    df = spark.createDataFrame(data).repartition(6)
    return df.withColumn("z", F.nanvl("z", F.lit(None)))


def test_quantiles(table, data):
    probs = [0, 0.01, 1 / 3, 0.5, 0.95, 1]
    found = by(ranks.quantiles(table, ["x", "y", "z"], probs))
    for c in "xyz":
        assert found[c]["q"] == pytest.approx(data[c].quantile(probs).tolist(), rel=1e-12)
        assert found[c]["total"] == data[c].count()


def test_quantiles_from_a_real_sample(table, data, monkeypatch):
    monkeypatch.setattr(ranks, "SAMPLE_ROWS", 1500)
    probs = [0.25, 0.5, 0.75]
    assert ranks._bracketed(table, ["x", "y", "z"], probs) is not None
    found = by(ranks.quantiles(table, ["x", "y", "z"], probs))
    for c in "xyz":
        assert found[c]["q"] == pytest.approx(data[c].quantile(probs).tolist(), rel=1e-12)


def test_wrong_brackets_are_noticed(table, data, monkeypatch):
    monkeypatch.setattr(ranks, "_brackets", lambda *a: {"x": [(0.0, 1.0)]})
    assert ranks._bracketed(table, ["x"], [0.5]) is None
    assert ranks.quantiles(table, ["x"], [0.5]).first().q == [data.x.median()]


def test_quantiles_by_group(table, data):
    found = {(r.g, r.column): r.q for r in ranks.quantiles(table, ["x", "y"], [0.25, 0.5], ["g"]).collect()}
    for g, part in data.groupby("g"):
        for c in "xy":
            assert found[g, c] == pytest.approx(part[c].quantile([0.25, 0.5]).tolist(), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert rows(ranks.quantiles(df, ["x"], [0.5])) == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_average_ranks_of_random_ties(spark, numbers):
    df = spark.createDataFrame([(float(v),) for v in numbers], "v double")
    found = sorted(rows(ranks.with_average_rank(df, "v")))
    series = pd.Series(sorted(numbers), dtype=float)
    assert [r[1] for r in found] == series.rank().tolist()


def test_average_ranks_with_a_hot_value(table, data):
    found = ranks.with_average_rank(table.select("x"), "x").distinct().toPandas().set_index("x").avg_rank
    expected = data.assign(r=data.x.rank()).groupby("x").r.first()
    assert len(found) == len(expected) and np.allclose(found.sort_index(), expected.sort_index())


def test_spread_join_keeps_every_row(spark):
    left = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"), "id")
    left = left.union(spark.createDataFrame([(None, 1)], "k string, id long"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    plain = spread_join(left, counts, ["k"], ["n"], F.col("n"), F.lit(5001), rows_per_task=100)
    safe = spread_join(left, counts, ["k"], ["n"], F.col("n"), F.lit(5001), null_safe=True, rows_per_task=100)
    assert plain.count() == safe.count() == 5001
    assert plain.where("n IS NULL").count() == 1 and safe.where("n IS NULL").count() == 0
    assert plain.where("k = 'hot'").agg(F.min("n"), F.count("*")).first() == (1667, 1667)


@pytest.mark.parametrize("rows_per_task", [1000, 10**6])
def test_spread_join_deals_hot_and_missing_keys_evenly(spark, rows_per_task):
    """Half of the rows without a key, one key with 0.09 %, one with a tenth."""
    n = 200_000
    key = (
        F.when(F.col("id") % 2 == 0, None)
        .when(F.col("id") < 0.0018 * n, "warm")
        .when((F.col("id") % 10 == 1) & (F.lit(rows_per_task) < n), "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    )
    left = spark.range(n).select(key.alias("k"), F.lit("same").alias("v"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = spread_join(left, counts, ["k"], ["n"], F.col("n"), F.lit(n), rows_per_task=rows_per_task)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and len(sizes) == 8 and max(sizes) <= 1.5 * n / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_describe(table, data):
    found = by(describe.describe_numeric(table, ["x", "y", "z"]))
    for c in "xyz":
        s, f = data[c].dropna(), found[c]
        centred = s - s.mean()
        m2 = (centred**2).mean()
        expected = {
            "count": len(s), "mean": s.mean(), "median": s.median(), "mode": s.mode().iloc[0], "std": s.std(),
            "variance": s.var(), "min": s.min(), "max": s.max(), "range": s.max() - s.min(),
            "q1": s.quantile(0.25), "q3": s.quantile(0.75), "p99": s.quantile(0.99),
            "skewness": (centred**3).mean() / m2**1.5, "kurtosis": (centred**4).mean() / m2**2 - 3,
            "coefficient_of_variation": s.std() / s.mean() * 100,
        }
        for name, value in expected.items():
            assert f[name] == pytest.approx(value, rel=1e-9), (c, name)


def test_describe_odd_columns(spark):
    df = spark.createDataFrame([(3.0, None, 1.0, "4"), (3.0, None, -1.0, "x"), (3.0, None, float("nan"), None)], "a double, b double, c double, d string")
    found = by(describe.describe_numeric(df, ["a", "b", "c", "d"]))
    assert set(found) == {"a", "c", "d"}
    assert (found["a"]["skewness"], found["a"]["variance"]) == (None, 0.0)
    assert (found["c"]["count"], found["c"]["max"], found["c"]["coefficient_of_variation"]) == (2, 1.0, None)
    assert (found["d"]["count"], found["d"]["std"], found["d"]["mode"]) == (1, None, 4.0)


def test_shape_labels(spark):
    stats = spark.createDataFrame([("a", 1.5, 2.0), ("b", -0.6, -1.5), ("c", None, None)], '`column` string, skewness double, kurtosis double')
    found = by(describe.distribution_shape(stats))
    assert found["a"]["assimetria"].startswith("fortemente assimétrica à direita")
    assert found["b"]["assimetria"] == "moderadamente assimétrica à esquerda" and found["b"]["curtose"].startswith("platicúrtica")
    assert found["c"]["assimetria"] == "aproximadamente simétrica"


def test_outliers(table, data):
    found = by(describe.outliers_iqr(table, ["x", "z"]))
    for c in "xz":
        q1, q3 = data[c].quantile([0.25, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert found[c]["outlier_count"] == ((data[c] < low) | (data[c] > high)).sum()
        assert (found[c]["lower_bound"], found[c]["total_records"]) == (pytest.approx(low), data[c].count())
    actions = by(describe.outlier_actions(describe.outliers_iqr(table, ["z"])))
    assert actions["z"]["action"].startswith("Nenhum outlier")


# --- segments -------------------------------------------------------------------------


def test_segments_keep_ties_together(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 2, 2, 3, 9, 10, 11]] + [(None,)], "total_spent double")
    got = [r.customer_segment for r in segments.customer_segments(df).orderBy(F.col("total_spent").asc_nulls_last()).collect()]
    assert got == ["Low Value"] * 5 + ["Medium Value"] + ["High Value"] * 3 + [None]


def test_segment_source_must_exist(spark):
    with pytest.raises(ValueError, match="no column"):
        segments.customer_segments(spark.range(1))


def test_segment_summary_order_and_values(spark):
    df = spark.createDataFrame([("High Value", 9.0), ("Low Value", 1.0), ("Low Value", 2.0), ("Other", 5.0), (None, 4.0)], "customer_segment string, age double")
    assert rows(segments.segment_summary(df)) == [("Low Value", 1.5, 1.5, 2), ("High Value", 9.0, 9.0, 1)]


def test_median_split(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "satisfaction_score double")
    got = sorted(rows(segments.median_split_groups(df)))
    assert got == [(1.0, "satisfação < mediana"), (2.0, "satisfação >= mediana"), (3.0, "satisfação >= mediana")]


def test_segment_axis_cap(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 5.0)], "customer_segment string, total_spent double")
    assert segments.segment_axis_cap(df).first().upper_whisker == 5.0


# --- correlation ------------------------------------------------------------------------


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_matrix(table, data, method):
    found = by(corr.correlation_matrix(table, ["x", "y", "z"], method), "index")

    def expected(a, b):
        pair = data[[a, b]].dropna() if a != b else data[[a]].dropna().assign(b=data[a])
        ranked = pair.rank() if method == "spearman" else pair
        return np.corrcoef(ranked.iloc[:, 0], ranked.iloc[:, 1])[0, 1]

    for a in "xyz":
        for b in "xyz":
            assert found[a][b] == pytest.approx(expected(a, b), abs=1e-10)


def test_constant_columns_do_not_correlate(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    for method in ("pearson", "spearman"):
        found = by(corr.correlation_matrix(df, ["a", "b"], method), "index")
        assert (found["a"]["a"], found["a"]["b"], found["b"]["b"]) == (None, None, 1.0)


def test_top_pairs(table):
    top = corr.top_correlated_pairs(table, ["x", "y", "z"], top_n=2).collect()
    assert (top[0].variable_1, top[0].variable_2, top[0].method, len(top)) == ("x", "y", "pearson", 2)


# --- tail functions and tests -------------------------------------------------------------


def t_p(t, df):
    return tails.beta_tail_value(df / 2, 0.5, t * t / df)


def test_tails_against_closed_forms():
    for t in (0.01, 0.7, 1.0, 3.0, 40.0):
        assert t_p(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-13)
        assert t_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-13)
        assert t_p(t, 1e9) == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-8)
    for f in (0.1, 1.0, 5.0):
        # Two numerator degrees of freedom: (1 + 2 f / d2) ** (-d2 / 2).
        assert tails.beta_tail_value(50, 1, 2 * f / 100) == pytest.approx((1 + 2 * f / 100) ** -50, abs=1e-13)


def test_tails_reproduce_published_p_values():
    """Correlations and p of the published test table, n = 5070."""
    published = [(-0.009460992928630658, 0.500624), (0.011599137534707754, 0.408958), (0.0013214804077616349, 0.925052), (0.06811587292618607, 1e-06)]
    for r, p in published:
        assert round(t_p(r * math.sqrt(5068 / (1 - r * r)), 5068), 6) == p


def test_exact_rank_sum_distribution():
    rng = random.Random(1)
    for n1, n2 in ((1, 1), (3, 4), (5, 2)):
        from itertools import combinations

        sums = [sum(c) - n1 * (n1 + 1) / 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
        u = rng.choice(sums)
        top = max(u, n1 * n2 - u)
        assert tails.rank_sum_tail_value(u, n1, n2) == pytest.approx(min(1, 2 * sum(s >= top for s in sums) / len(sums)))


def test_correlation_tests(table, data):
    found = hypothesis.pearson_test(table, "x", "z").first()
    pair = data[["x", "z"]].dropna()
    r = np.corrcoef(pair.x, pair.z)[0, 1]
    assert found.statistic == round(r, 4) and found.alpha == 0.05
    assert found.p_value == pytest.approx(t_p(r * math.sqrt((len(pair) - 2) / (1 - r * r)), len(pair) - 2), abs=1e-6)
    strong = hypothesis.spearman_test(table, "x", "y").first()
    rho = np.corrcoef(data.x.rank(), data.y.rank())[0, 1]
    assert strong.result == "H0 rejeitada" and f"(rho={rho:.3f})" in strong.interpretation


def test_perfect_and_tiny_correlations(spark):
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(5)], "a double, b double")
    assert hypothesis.pearson_test(line, "a", "b").first().p_value == 0.0
    assert hypothesis.pearson_test(line.limit(2), "a", "b").first().p_value == 1.0
    constant = hypothesis.pearson_test(line.withColumn("b", F.lit(1.0)), "a", "b").first()
    assert (constant.statistic, constant.p_value, constant.result) == (None, None, "H0 não rejeitada")


def test_welch(table, data):
    a, b = (data.x[data.g == g] for g in "ab")
    va, vb = a.var() / len(a), b.var() / len(b)
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    df = (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))
    stats = hypothesis.welch_stats(table, "x", "g", "a", "b").first()
    assert (stats.statistic, stats.df) == (pytest.approx(t), pytest.approx(df))
    assert hypothesis.welch_test(table, "x", "g", "a", "b").first().p_value == pytest.approx(t_p(t, df), abs=1e-6)


def test_mann_whitney(table, data):
    a, b = (data.x[data.g == g] for g in ("hot", "a"))
    both = pd.concat([a, b])
    u = both.rank()[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    n, ties = len(both), both.value_counts()
    s = math.sqrt(len(a) * len(b) / 12 * (n + 1 - (ties**3 - ties).sum() / (n * (n - 1))))
    z = (max(u, len(a) * len(b) - u) - len(a) * len(b) / 2 - 0.5) / s
    found = hypothesis.mann_whitney_stats(table, "x", "g", "hot", "a").first()
    assert found.statistic == u and found.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-12)
    assert (found.median_a, found.median_b) == (a.median(), b.median())


def test_the_larger_sample_may_be_of_any_size():
    separated = [tails.rank_sum_tail_value(15, 5, n) for n in (1999, 2000, 2001, 10**5, 10**9)]
    assert separated == sorted(separated, reverse=True) and separated[1] == pytest.approx(3.0372e-12, rel=1e-4)
    assert tails.rank_sum_tail_value(4 * 10**6, 8, 10**6) == 1.0
    # The normal distribution is close in the middle of large samples.
    assert tails.rank_sum_tail_value(3e6, 8, 10**6) == pytest.approx(0.2207, abs=0.01)
    with pytest.raises(ValueError):
        tails.rank_sum_tail_value(50, 9, 20)


def test_tails_run_where_the_package_is_missing(tmp_path):
    cases = [(tails.rank_sum_tail, [3.0], [3], [20]), (tails.beta_tail, [1.5], [0.5], [2.0]), (tails.normal_tail, [1.0])]
    (tmp_path / "cases").write_bytes(cloudpickle.dumps([(udf.func, [pd.Series(a) for a in args]) for udf, *args in cases]))
    code = "import pickle; [print(f(*args)[0]) for f, args in pickle.load(open('cases', 'rb'))]"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    expected = [tails.rank_sum_tail_value(3, 3, 20), tails.beta_tail_value(1.5, 0.5, 2.0), math.erfc(math.sqrt(0.5))]
    assert (run.returncode, [float(x) for x in run.stdout.split()]) == (0, pytest.approx(expected)), run.stderr


def test_methods_of_mann_whitney(spark):
    one = [(float(i), "a") for i in range(5)] + [(float(i), "b") for i in range(10, 2012)]
    df = spark.createDataFrame(one, "v double, g string")
    p = {m: hypothesis.mann_whitney_stats(df, "v", "g", "a", "b", m).first().p_value for m in ("auto", "exact", "asymptotic")}
    assert p["auto"] == p["exact"] < 4e-12 and p["asymptotic"] > 1e-5
    tied = df.withColumn("v", F.floor(F.col("v") / 2).cast("double"))
    with pytest.raises(Exception, match="no ties"):
        hypothesis.mann_whitney_stats(tied, "v", "g", "a", "b", "exact").collect()
    with pytest.raises(ValueError):
        hypothesis.mann_whitney_stats(df, "v", "g", "a", "b", "best")


def test_rows_of_one_value_are_ranked_apart(spark):
    found = [(5.0, 1, "few"), (5.0, 2, "rest"), (5.0, 0, "rest"), (7.0, 3, "rest"), (7.0, 4, "rest"), (7.0, 4, "rest")]
    found += [(9.0, 8, "few"), (9.0, 8, "few"), (9.0, 9, "rest"), (1.0, 7, "rest"), (None, 6, "few")]
    df = spark.createDataFrame(found, "v double, k int, g string").repartition(3)
    ordered = sorted(r for r in found if r[0] is not None)
    places = [i for i, r in enumerate(ordered) if r[2] == "few"]
    sums = [sum(c) for c in combinations(range(10), 3)]
    low, high = np.mean([s <= sum(places) for s in sums]), np.mean([s >= sum(places) for s in sums])
    few, rest = ([r[0] for r in ordered if r[2] == g] for g in ("few", "rest"))
    expected = (3, 7, np.median(few), np.median(rest), sum(places) - 3, pytest.approx(min(1, 2 * min(low, high))))
    for method in ("auto", "exact"):
        assert rows(hypothesis.mann_whitney_stats(df, "v", "g", "few", "rest", method, apart="k")) == [expected]
    both = df.withColumn("k", F.lit(1))
    with pytest.raises(Exception, match="no ties"):
        hypothesis.mann_whitney_stats(both, "v", "g", "few", "rest", "exact", apart="k").collect()


def test_mann_whitney_small_samples_are_exact(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0)], "g string, v double")
    found = hypothesis.mann_whitney_stats(df, "v", "g", "a", "b").first()
    assert (found.statistic, found.p_value) == (0.0, pytest.approx(0.1))
    alone = hypothesis.mann_whitney_stats(df, "v", "g", "a", "nobody").first()
    assert (alone.n_b, alone.statistic, alone.p_value) == (0, None, None)
    same = hypothesis.mann_whitney_stats(df.withColumn("v", F.lit(1.0)), "v", "g", "a", "b").first()
    assert (same.statistic, same.p_value) == (4.5, 1.0)


def test_anova(table, data):
    parts = [p.x for _, p in data.groupby("g")]
    grand, n, k = data.x.mean(), len(data), len(parts)
    between = sum(len(p) * (p.mean() - grand) ** 2 for p in parts) / (k - 1)
    within = sum(((p - p.mean()) ** 2).sum() for p in parts) / (n - k)
    stats = hypothesis.anova_stats(table, "x", "g").first()
    assert (stats.statistic, stats.df_between, stats.df_within) == (pytest.approx(between / within), k - 1, n - k)
    single = table.limit(50).unionByName(table.limit(1).withColumn("g", F.lit("only one")))
    assert hypothesis.anova_stats(single, "x", "g").first().groups == hypothesis.anova_stats(single.limit(50), "x", "g").first().groups


def test_battery_runs_only_what_the_groups_allow(spark, clean):
    data = clean.withColumn("customer_segment", F.lit("Low Value"))
    assert hypothesis.standard_battery(data).count() == 7
    assert hypothesis.standard_battery(clean.drop("gender")).count() == 6


# --- chart data -----------------------------------------------------------------------------


def test_histogram(table, data):
    found = charts.histogram(table, "x", bins=10).toPandas()
    counts, edges = np.histogram(data.x, bins=10)
    assert found.row_count.tolist() == counts.tolist() and np.allclose(found.bin_start, edges[:-1])
    assert (found["mean"][0], found["median"][0]) == (pytest.approx(data.x.mean()), data.x.median())


def test_histogram_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, None)], "a double, b double")
    assert [r.row_count for r in charts.histogram(df, "a", 3).collect()] == [2, 0, 0]
    assert charts.histogram(df, "b", 3).count() == 0


def test_density(table, data):
    found = charts.kde_grid(table, "x", points=50).toPandas()
    v, n = data.x.to_numpy(), len(data)
    h = v.std(ddof=1) * n**-0.2
    grid = np.linspace(v.min(), v.max(), 50)
    expected = np.exp(-(((grid[:, None] - v) / h) ** 2) / 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    assert np.allclose(found.x, grid) and np.allclose(found.density, expected, rtol=1e-9, atol=1e-300)


def test_boxplots(table, data):
    found = {r.g: r for r in charts.boxplot_stats(table, ["x"], by="g").collect()}
    for g, part in data.groupby("g"):
        q1, q3 = part.x.quantile([0.25, 0.75])
        inside = part.x.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        assert found[g].whisker_high == part.x[inside].max() and found[g].flier_count == (~inside).sum()
    assert charts.boxplot_stats(table, ["x", "z"]).count() == 2


def test_scatter_counts_every_complete_row(table, data):
    plain = charts.scatter_bins(table, "x", "z", bins=8).toPandas()
    counts, _, _ = np.histogram2d(data.x[data.z.notna()], data.z.dropna(), bins=8)
    assert {(r.x_bin, r.y_bin): r.row_count for r in plain.itertuples()} == {
        (i, j): int(c) for (i, j), c in np.ndenumerate(counts) if c
    }
    logged = charts.scatter_bins(table, "x", "y", hue="g", log_x=True, log_y=True)
    assert logged.agg(F.sum("row_count")).first()[0] == len(data)


def test_counts_per_month_and_state(clean):
    assert [str(r.month) for r in charts.counts_per_month(clean).collect()] == ["2020-06-01", "2021-02-01", "2022-07-01", "2023-01-01"]
    assert rows(charts.counts_per_state(clean, top_n=1)) == [("PA", 2)]

import re
from collections import Counter

import numpy as np
import pytest

from dqspark.llm import outliers
from dqspark.llm.outliers import COUNTS, FLOORS, chi_square, consistency, counts, keep_good, quality_rules, repeated_words
from dqspark.llm.staging import Staged
from tests.llm.tables import make_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(lines[i] in lines[:i] for i in range(len(lines)))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [
    None, "", " \t\r\n", "a", "a b c \x0bd\x0ce", "x y z\nx y z\n\nx y z \n", "#*$%&|<>^~ <b>&amp;",
    "one two three four five six seven eight " * 3, "a " * 30, "one two three four five six seven eight", "Ünï 漢字 🙂 é",
    " ".join(["one two three four five six seven eight nine", prose(4, 40), "one two three four five six seven eight ten"]),
    prose(7, 2000) + "\n" + prose(7, 300),
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert counts(text)[:5] == slow_counts(text)


def test_equal_hashes_of_other_words_do_not_count(monkeypatch):
    monkeypatch.setattr(outliers, "hash", lambda w: 1, raising=False)
    assert repeated_words([b"%d" % i for i in range(30)]) == 0


def test_base_rules(spark):
    half = "one two three four five six seven eight "
    docs = make_docs(spark, [(1, prose(1, 19)), (2, prose(1, 20)), (3, half * 2 + prose(2, 60)), (4, half * 2 + prose(2, 20))])
    found = {r.id: (r.n_words, r.n_repeat_words, r.base_failed) for r in quality_rules(docs).collect()}
    assert found == {1: (19, 0, True), 2: (20, 0, False), 3: (76, 16, False), 4: (36, 16, True)}


def slow_distances(x, mean, scatter):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(outliers.regular(scatter)), x - mean)


def slow_determinant(x, share, draws=300, seed=0):
    """Smallest log determinant, with its mean and scatter, from random subsets.

    Concentration sorts all rows; the last row counts in part.
    """
    rng, k = np.random.default_rng(seed), x.shape[1]
    factor, wanted, best = consistency(share, k), share * len(x), (np.inf, None, None)
    for _ in range(draws):
        own = x[rng.choice(len(x), min(len(x), k + 1), replace=False)]
        mean, scatter, last = own.mean(0), np.cov(own.T, bias=True).reshape(k, k), np.inf
        while True:
            order = np.argsort(slow_distances(x, mean, scatter), kind="stable")
            w = np.clip(wanted - np.arange(len(x)), 0, 1)
            inner = x[order]
            next_mean = (w[:, None] * inner).sum(0) / wanted
            next_scatter = factor * ((w[:, None] * inner).T @ inner / wanted - np.outer(next_mean, next_mean))
            det = np.linalg.slogdet(outliers.regular(next_scatter))[1]
            if det > last - 1e-9:
                break
            mean, scatter, last = next_mean, next_scatter, det
        if last < best[0]:
            best = last, mean, scatter
    return best


def slow_reweighted(x):
    k = x.shape[1]
    _, mean, scatter = slow_determinant(x, outliers.SHARE, 100)
    near = x[slow_distances(x, mean, scatter) <= chi_square(outliers.REWEIGHT, k)]
    return len(x), near.mean(0), consistency(outliers.REWEIGHT, k) * np.cov(near.T, bias=True).reshape(k, k)


def slow_lean(own, above):
    """The estimate of rows ``own`` beside PRIOR_ROWS others of another mean and scatter."""
    (n, mean, scatter), (over, wide), p = own, above, outliers.PRIOR_ROWS
    centre = (n * mean + p * over) / (n + p)
    around = [w * (c + np.outer(m - centre, m - centre)) for w, m, c in ((n, mean, scatter), (p, over, wide))]
    return centre, sum(around) / (n + p)


def feature_rows(texts):
    out = []
    for t in texts:
        c = dict(zip(COUNTS, counts(t)))
        w, lines = max(1, c["n_words"]), max(1, c["n_lines"])
        out.append([
            np.log1p(c["n_words"]), c["word_chars"] / w, np.sqrt(c["n_symbols"] / w), np.sqrt(c["n_dup_lines"] / lines),
            np.sqrt(c["n_repeat_words"] / w), np.sqrt(c["n_upper"] / max(1, c["word_chars"])),
        ])
    return np.array(out)


def numbers(spark, groups):
    rows = [(g, i % 4, *map(float, x)) for g, xs in groups.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "g string, salt int, " + ", ".join(f"x{i} double" for i in range(len(FLOORS))))


def test_determinants_are_as_small_as_those_of_many_random_subsets(spark):
    rng, k = np.random.default_rng(3), len(FLOORS)
    groups = {}
    for name, n, bad in (("tiny", 3, 0), ("small", 30, 5), ("clean", 200, 0), ("tainted", 300, 66)):
        mix = rng.normal(size=(k, k))
        x = rng.normal(size=(n, k)) @ mix
        x[:bad] = rng.normal(size=(bad, k)) * 0.3 + 25 * rng.choice([-1, 1], k)
        groups[name] = x
    groups["equal"] = np.ones((50, k))
    found = {r.g: r for r in outliers.determinants(numbers(spark, groups), Staged(spark, "test")).collect()}
    assert set(found) == set(groups)
    assert np.isfinite(found["tiny"].log_det)  # fewer rows than features: any estimate will do, it leans
    for name in ("small", "clean", "tainted", "equal"):
        x = groups[name]
        assert found[name].log_det <= slow_determinant(x, outliers.SHARE)[0] + 0.1, name
    bad = np.array(found["tainted"].e[:k])
    assert np.abs(bad - groups["tainted"][66:].mean(0)).max() < 1


def test_distances_like_a_slow_estimate_by_group(spark):
    good = [(i, prose(i, 40 + i % 60), "en", "a" if i % 2 else "b") for i in range(100)]
    small = [(200 + i, prose(200 + i, 50), None, f"s{i % 3}") for i in range(40)]
    rest = [(300 + i, prose(300 + i, 50), f"l{i}", None) for i in range(8)]
    junk = [(400 + i, prose(400 + i, 50).replace(" ", "### "), "en", "a") for i in range(5)]
    docs = good + small + rest + junk
    found = {r.id: r for r in quality_rules(make_docs(spark, docs)).collect()}
    x = dict(zip((d[0] for d in docs), feature_rows([d[1] for d in docs])))
    levels = {}
    for i, _, lang, source in docs:
        for key in ((), (lang,), (lang, source)):
            levels.setdefault(key, []).append(x[i])
    own = {key: slow_reweighted(np.array(rows)) for key, rows in levels.items()}
    for i, _, lang, source in docs:
        estimate = slow_lean(own[lang, source], slow_lean(own[lang,], own[()][1:]))
        expected = slow_distances(x[i][None, :], *estimate)[0]
        assert found[i].distance == pytest.approx(expected, rel=0.2, abs=1)
        assert found[i].kept == (expected <= chi_square(1 - outliers.TAIL, len(FLOORS)))
    assert all(found[i].kept for i, *_ in good + small + rest) and not any(found[i].kept for i, *_ in junk)


def test_one_more_row_changes_little(spark):
    base = [(i, prose(i, 40 + i % 60), "en", "a") for i in range(199)]
    other = [(1000 + i, prose(5000 + i, 30 + i % 90), "en", "b") for i in range(60)]
    odd = (500, prose(500, 50).replace(" ", "# ", 12), "en", "a")
    found = []
    for more in range(3):
        rows = base[:198] + [odd] + [(2000 + i, prose(2000 + i, 55), "en", "a") for i in range(more)] + other
        found.append({r.id: r for r in quality_rules(make_docs(spark, rows)).collect()})
    for i in found[0]:
        assert len({f[i].kept for f in found}) == 1
        assert found[1][i].distance == pytest.approx(found[0][i].distance, rel=0.25, abs=0.5)
        assert found[2][i].distance == pytest.approx(found[1][i].distance, rel=0.25, abs=0.5)


def test_pages_of_copied_lines_are_outliers(spark):
    plain = [(i, prose(i, 80), "en", "a") for i in range(60)]
    lines = "\n".join(["ba ce di"] + [f"{w} pe qui ro su ta" for w in "fo gu ha je".split()])
    copied = [(900, "\n".join([prose(77, 12).replace("\n", " "), *["ba ce di"] * 40]), "en", "a"), (901, lines + "\n" + lines, "en", "a")]
    found = {r.id: r for r in quality_rules(make_docs(spark, plain + copied)).collect()}
    assert not found[900].kept and all(found[i].kept for i, *_ in plain)


def test_awkward_rows(awkward):
    rows = quality_rules(awkward).collect()
    assert len(rows) == awkward.count()
    by_words = {r.n_words: r.kept for r in rows}
    assert not by_words[0] and not by_words[1] and by_words[25_000]
    assert all((r.distance is None) == r.base_failed for r in rows)
    kept = keep_good(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 2, 7, 9, 10]


def test_quantiles_of_chi_square():
    assert chi_square(0.95, 6) == pytest.approx(12.592, rel=0.01)
    assert consistency(1 - 1e-9, 6) == pytest.approx(1, abs=0.01)


def test_empty_table(nothing):
    assert quality_rules(nothing).count() == 0 and keep_good(nothing).count() == 0

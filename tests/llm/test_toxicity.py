import random
import zlib

import pytest

from dqspark.llm import toxicity
from dqspark.llm.toxicity import Memo, features, op4_toxicity_trees, score, terms
from tests.llm.tables import make_docs, prose


def corpus(n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split(" ")
        toxic = i % 4 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "you moron", "worthless"] if i % 8 else ["zzgrok", "zzgrokin", "zzgrokle"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("toxic")
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "x " * 100_000), (None, "idiot"), (3, rows[3][1])]
    make_docs(spark, rows + extra).write.parquet(f"{folder}/documents.parquet")
    odd = [(None, 1, 1), (5, 1, None), (0, 0, 1), (0, 0, 1)]
    spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return op4_toxicity_trees(spark, str(folder)).collect(), dict((i, t) for i, _, t in labels), len(rows) + len(extra)


def test_held_out_rows_are_told_apart(scored):
    found, labels, n = scored
    assert len(found) == n
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_held_out_labels_do_not_matter(spark, tmp_path):
    rows, labels = corpus(120)
    out = []
    for flip in (0, 1):
        folder = f"{tmp_path}/{flip}"
        make_docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
        turned = [(i, q, 1 - t if flip and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
        spark.createDataFrame(turned, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        out.append(sorted((r.doc_id, r.score) for r in op4_toxicity_trees(spark, folder).collect()))
    assert out[0] == out[1]


def test_features():
    memo = Memo({"zz": 2.0, "grok*": 3.0})
    x = features("You are an IDIOT, zz groking! 1d10t w0rthless??", memo)
    assert len(x) == toxicity.FEATURES == len(features("", memo)) and not any(features("", memo))
    assert x[1] == 1 and x[3] == 3.0 and x[5] > 0 and x[10] == 1 and x[8] > 0
    assert {"groking", "grok*", "groki*"} <= terms("groking it")


def test_without_two_classes(spark, awkward, nothing):
    for toxic, expected in (([], 0.0), ([0], 0.0), ([1], 1.0)):
        training = spark.createDataFrame([(1, t) for t in toxic], "id long, toxic int")
        rows = score(awkward, training).collect()
        assert len(rows) == awkward.count() and {r.score for r in rows} == {expected}
    assert score(nothing, training).count() == 0

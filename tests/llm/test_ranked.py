"""Ranked search: terms, range maxima, pruning, full results against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np

from dqspark.llm import ranked
from tests.llm.tables import SCHEMA, make_docs, prose

ITEM = "item_id long, text string, query long, rank int, score long, term binary"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def items(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, b"t") for r in rows], ITEM)


def slow(docs, asked, top=20):
    counts = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total, df = len(counts), sum(c.total() for _, c in counts), Counter(t for _, c in counts for t in c)
    out = []
    for item, text in asked:
        scores = []
        for key, c in counts:
            m = 75 + (25 * c.total() * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in TERM.findall(lower(text))
                if t in c
            )
            if s > 0:
                scores.append((-s, key is None, key or 0))
        scores.sort()
        out += [(item, r + 1, None if none else key, -s) for r, (s, none, key) in enumerate(scores[:top])]
    return sorted(out, key=repr)


def fast(docs, asked, **kw):
    return sorted(map(tuple, ranked.rank(docs, asked, **kw).collect()), key=repr)


def test_terms():
    text = "Ab-CD_é É 1x\tΣß漢字.\x7fz"
    assert [t.decode() for t in ranked.terms(text)] == TERM.findall(lower(text))
    assert ranked.terms(None) == ranked.terms("") == ranked.terms(" \n.") == []


def test_like_brute_force(spark, awkward):
    asked = [(1, "ba CE di di"), (2, prose(1, 30)), (3, None), (4, ""), (5, "nowhere"), (None, "漢字 partie à part"), (1, "ba CE di di"), (7, prose(9, 25_000))]
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert fast(awkward, items(spark, asked)) == slow(docs, asked)


def test_many_documents_shards_and_ties(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, prose(rng.randrange(900), rng.choice([3, 10, 80]))) for i in range(1500)]
    docs += [(5000 + i, docs[7][1]) for i in range(40)]  # equal scores beyond the top
    asked = [(i, prose(rng.randrange(900), 25)) for i in range(12)] + [(99, docs[7][1])]
    frame = make_docs(spark, docs).repartition(3, "doc_id")
    assert fast(frame, items(spark, asked)) == slow(docs, asked)
    monkeypatch.setattr(ranked, "SHARD_DOCS", 200)  # the driver's copy goes to the workers by value
    monkeypatch.setattr(ranked, "ITEMS", 5)
    assert fast(frame, items(spark, asked)) == slow(docs, asked)


def test_nothing(spark, nothing, awkward):
    assert fast(nothing, items(spark, [(1, "ba")])) == []
    assert fast(awkward, items(spark, [])) == []
    assert fast(make_docs(spark, [(1, ""), (2, None)], SCHEMA), items(spark, [(1, "ba")])) == []


def make_shard(n, seed=1):
    rng = np.random.default_rng(seed)
    lists = {}
    for t in range(12):
        docs = np.flatnonzero(rng.random(n) < rng.choice([0.01, 0.2, 0.9])).astype(np.int32)
        lists[b"t%d" % t] = (docs, rng.integers(1, 9, len(docs)).astype(np.int32))
    return ranked.ShardIndex(list(range(n)), rng.integers(5, 400, n), lists, n, 100 * n)


def test_range_maxima():
    shard = make_shard(1000)
    for lo in range(shard.blocks):
        for hi in range(lo + 1, shard.blocks + 1):
            got = shard.maxima(np.arange(12), lo, hi)
            for row in range(12):
                a, b = shard.starts[row], shard.starts[row + 1]
                inside = shard.impact[a:b][(shard.docs[a:b] >= lo * 64) & (shard.docs[a:b] < hi * 64)]
                assert got[row] == (inside.max() if len(inside) else 0)


def test_bounds_prune_blocks():
    """Documents that hold a rare term are found without scoring the other blocks."""
    n = 64 * 128
    common = (np.arange(n, dtype=np.int32), np.ones(n, np.int32))
    rare = (np.array([70, 5000], np.int32), np.array([3, 3], np.int32))
    shard = ranked.ShardIndex(list(range(n)), np.full(n, 100), {b"c": common, b"r": rare}, n, 100 * n)
    best = []
    scored = ranked.search(shard, np.array([0, 1]), np.array([10, 9000]), best, 2)
    assert sorted(i for _, i in best) == [-5000, -70] and scored == 2

import random
from collections import Counter

import numpy as np
import pytest

from dqspark.llm import decontamination
from dqspark.llm.decontamination import (
    BLOCKS, RADIUS, HammingIndex, Items, drop_contaminated, find_passages, shingles, similarity, simhash, words_of,
)
from dqspark.llm.staging import Staged
from tests.llm.tables import make_docs, prose


def slow(items, text):
    """Best similarity of each item over all windows of its size, if enough."""
    words, out = words_of(text), {}
    for key, t in items:
        own = words_of(t)
        if own and words:
            m = min(len(own), len(words))
            bag = Counter(shingles(own))
            best = max(similarity(bag, Counter(shingles(words[s : s + m]))) for s in range(len(words) - m + 1))
            if best >= 0.8:
                out[key] = best
    return out


ITEMS = [(i, prose(900 + i, 15 + i)) for i in range(12)] + [(50, "two words"), (51, "a b c d e"), (52, ""), (53, None), (54, " ?!")]


def contaminated():
    rng = random.Random(5)
    rows = [(1000, prose(77, 300))]
    for i, t in ITEMS[:12]:
        rows.append((i, f"{prose(i, 40)} {t.upper()} {prose(i + 40, 50)}"))
        words = t.split()
        words[rng.randrange(2)] = "changed"
        rows.append((100 + i, f"{prose(i, 30)}\n{' '.join(words)}, {prose(i, 5)}"))
        rows.append((200 + i, " ".join(t.split()[: 12 + i])))  # the item but its end
        rows.append((300 + i, f"{t} {prose(3, 9)} {t}"))
    return rows + [(2000, "here are two words only"), (2001, "a b c d e"), (2002, "x a b c d e f"), (2003, None), (2004, "")]


def test_like_all_windows(spark):
    docs = make_docs(spark, contaminated())
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {}
    for r in find_passages(docs, items).collect():
        found.setdefault((r.id, r.item_id), []).append(r)
    expected = {(d, k): v for d, t in contaminated() for k, v in slow(ITEMS, t).items()}
    assert set(found) == set(expected)
    for key, rows in found.items():
        assert max(r.similarity for r in rows) == pytest.approx(expected[key])
        spans = sorted((r.start, r.start + r.n_words) for r in rows)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert all(len(found[300 + i, i]) == 2 for i in range(12))
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in contaminated()} - {d for d, _ in expected}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = make_docs(spark, contaminated())
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = {tuple(r) for r in find_passages(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 5)
    assert {tuple(r) for r in find_passages(docs, items).collect()} == whole
    many = items.unionByName(items).unionByName(items.where("item_id = 3"))
    staged = Staged(spark, "test")
    blocks, count = decontamination.blocks_of(many, "item_id", staged)
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert count == 7 and sum(sizes) == 33 and max(sizes) < 15
    assert {tuple(r) for r in find_passages(docs, many).collect()} == whole


def test_index_misses_no_fingerprint_within_the_radius():
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(400)]
    for _ in range(300):
        p = rng.choice(prints)
        prints.append(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, RADIUS + 2))))
    index = HammingIndex(prints)
    for q in prints[::7]:
        assert index.within(q) == [i for i, p in enumerate(prints) if (p ^ q).bit_count() <= RADIUS]
    assert BLOCKS * decontamination.BLOCK_BITS == 64


def test_simhash_is_the_sign_of_weighted_bits():
    import xxhash

    found = shingles(prose(3, 30).split())
    total = np.zeros(64)
    for s in found:
        bits = xxhash.xxh64_intdigest(s)
        total += [decontamination.weight(s) * (1 if bits >> i & 1 else -1) for i in range(64)]
    assert simhash(found) == sum(1 << i for i in range(64) if total[i] > 0)


def test_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, awkward.first().text, "x"), (1, awkward.first().text, "y"), (None, "short", "z")], "item_id long, text string, id string")
    rows = find_passages(awkward, items).collect()
    assert {(r.id, r.item_id) for r in rows} == {(1, 1), (2, 1), (None, 1), (10, 1), (8, None)}
    assert sorted((r.doc_id or 0) for r in drop_contaminated(awkward, items).collect()) == [0, 3, 4, 5, 6, 7, 9]
    assert find_passages(nothing, items).count() == 0
    none = items.where("item_id = 7")
    assert find_passages(awkward, none).count() == 0 and drop_contaminated(awkward, none).count() == awkward.count()


def test_items_without_words_are_ignored():
    assert Items([(1, "?"), (2, "")]).find("a b c") == []

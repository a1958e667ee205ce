import random
import re

import xxhash

import dqspark.llm.simhash as simhash
from dqspark.llm.simhash import fingerprint, keep_one, near_groups
from dqspark.llm.staging import Staged
from tests.llm.tables import make_docs, prose


def slow_fingerprint(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    found = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in found]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(ids))]


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    prints = [slow_fingerprint(t) for _, t in rows]
    expected = slow_components([i for i, _ in rows], prints)
    found = near_groups(awkward).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted([(r.id, r.fp & (1 << 64) - 1, r.component) for r in found], key=key) == sorted(
        [(i, p, c) for (i, _), p, c in zip(rows, prints, expected)], key=key
    )


def test_fingerprint_of_odd_texts():
    for text in (None, "", " \n", "One", "one TWO", "a b c", "É é \x0b x\x00y", prose(5, 300)):
        assert fingerprint(text) == slow_fingerprint(text)


def crowd(seed=3, n=150):
    """Fingerprints around a few centres, with chains and far ones."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(20)]
    while len(out) < n:
        value = rng.choice(out)
        for _ in range(rng.randint(0, 3)):
            value ^= 1 << rng.randrange(64)
        out.append(value)
    return out


def test_links_connect_all_within_two_bits(spark, monkeypatch):
    prints = sorted(set(crowd()))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    expected = slow_components(list(range(len(prints))), prints)
    for cell in (simhash.CELL, 1000, 1):  # mixed, pairs only, crowds only
        monkeypatch.setattr(simhash, "CELL", cell)
        edges = [(r.a, r.b) for r in simhash.links(nodes, Staged(spark, "t")).collect()]
        at = {p: i for i, p in enumerate(signed)}
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
        root = list(range(len(prints)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in edges:
            x, y = find(at[a]), find(at[b])
            root[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(prints))] == expected


def test_one_row_of_each_group_stays(awkward):
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    # 1, 2 and the null id share a text, 10 differs from it in case only; 3, 4, 5 and a null id are empty.
    assert sorted(i for i, _ in rows) == [1, 3, 6, 7, 8, 9]


def test_null_ids_alone_keep_one_of_each(spark):
    docs = make_docs(spark, [(None, prose(8, 40)), (None, prose(8, 40)), (None, prose(9, 40))])
    assert keep_one(docs).count() == 2


def test_empty_table(nothing):
    assert near_groups(nothing).count() == 0 and keep_one(nothing).count() == 0

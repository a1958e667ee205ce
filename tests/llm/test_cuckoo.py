"""Cuckoo-filter index: filter, shards, generations, groups."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from dqspark.llm import cuckoo
from tests.llm.tables import make_docs, prose


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_has_no_false_misses_and_few_false_hits():
    found = cuckoo.CuckooFilter(4096)
    keys = [digest(i) for i in range(12_000)]
    assert all(found.add(k) for k in keys)
    assert all(k in found for k in keys)
    assert sum(digest(-i) in found for i in range(1, 20_001)) < 20_000 * 8 / 65_536 * 4
    for k in keys[:6000]:
        found.remove(k)
    assert all(k in found for k in keys[6000:])
    assert sum(k in found for k in keys[:6000]) < 60


def test_overflow_resizes_from_stored_keys():
    shard = cuckoo.Shard()
    for i in range(9000):
        assert shard.insert(digest(i), 5, 1, (1, i, 0))
    assert shard.filter.mask + 1 > cuckoo.FIRST_BUCKETS and len(shard) == 9000
    assert all(shard.find(digest(i), 5)[3] == (1, i, 0) for i in range(9000))
    copy = cuckoo.Shard(list(shard), shard.filter.slots.tobytes())
    assert all(copy.find(digest(i), 5) for i in range(9000))


def test_hits_are_verified_by_content():
    """Digests of one tag and one pair of buckets stay apart."""
    shard, head = cuckoo.Shard(), b"\x07\x00" + bytes(8)
    twins = [head + bytes([i]) * 22 for i in range(1, 6)]
    assert all(shard.insert(t, 3, 1, (1, i, 0)) for i, t in enumerate(twins))
    assert head + bytes([9]) * 22 in shard.filter and shard.find(head + bytes([9]) * 22, 3) is None
    assert shard.find(twins[0], 4) is None
    assert not shard.insert(twins[2], 3, 2, (5, 7, 0)) and shard.find(twins[2], 3)[2:] == [3, (5, 7, 0)]
    shard.delete(twins[1], 3, 1, (1, 1, 0))
    assert [shard.find(t, 3) is not None for t in twins] == [True, False, True, True, True]


def slow_groups(rows):
    by = defaultdict(list)
    for key, text in rows:
        by[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key or 0))
    out = []
    for key, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(by[bare])
        out.append((key, None if best[1] else best[2], len(by[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_groups(docs):
    out = cuckoo.copies(docs)
    return sorted(((r.id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in out.collect()), key=repr)


def test_like_brute_force(spark, awkward):
    assert found_groups(awkward) == slow_groups([(r.doc_id, r.text) for r in awkward.collect()])


def test_hot_group_and_many_partitions(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng.choice([0] * 30 + list(range(60))), 12).replace(" ", rng.choice([" ", "\n", "  "]))) for i in range(1500)]
    docs = make_docs(spark, rows).repartition(13)
    assert found_groups(docs) == slow_groups(rows)


def test_nothing(spark, nothing):
    assert cuckoo.copies(nothing).count() == 0 and cuckoo.drop_copies(nothing).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(spark, awkward):
    left = cuckoo.drop_copies(awkward)
    assert left.columns == awkward.columns
    bare = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in left.collect()]
    everything = {re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in awkward.collect()}
    assert sorted(bare) == sorted(everything)


@pytest.fixture
def batches(spark):
    one = cuckoo.digests(make_docs(spark, [(1, "a b"), (2, "a  b"), (3, "c"), (4, "d")]))
    two = cuckoo.digests(make_docs(spark, [(5, "ab"), (6, "d"), (7, "e")]))
    return one, two


def live(index):
    return sorted((r.n_bytes, r.refs, r.id) for r in index.keys().collect())


def test_batches_deletion_and_repair(spark, batches):
    one, two = batches
    first = cuckoo.Index.empty(spark).insert(one)
    assert live(first) == [(1, 1, 3), (1, 1, 4), (2, 2, 2)]
    both = first.insert(two)
    assert live(both) == [(1, 1, 3), (1, 1, 7), (1, 2, 4), (2, 3, 2)]
    less = both.delete(one.where("id IN (2, 3)"))
    assert sorted(live(less), key=repr) == sorted([(1, 1, 7), (1, 2, 4), (2, 2, None)], key=repr)
    rest = one.where("id IN (1, 4)").unionByName(two)
    assert live(less.repair(rest)) == [(1, 1, 7), (1, 2, 4), (2, 2, 1)]
    assert live(both) == [(1, 1, 3), (1, 1, 7), (1, 2, 4), (2, 3, 2)]  # as it was
    seen = {bytes(r.digest): (r.live, r.refs) for r in less.probe(one).collect()}
    expected = {"ab": (True, 2), "c": (False, 0), "d": (True, 2)}
    assert seen == {hashlib.sha256(t.encode()).digest(): v for t, v in expected.items()}


def test_deleting_what_is_not_there_changes_nothing(spark, batches):
    one, two = batches
    index = cuckoo.Index.empty(spark).insert(one)
    assert live(index.delete(two.where("id = 7"))) == live(index)


def test_shards_split(spark, monkeypatch):
    docs = cuckoo.digests(make_docs(spark, [(i, f"text {i}") for i in range(300)]))
    index = cuckoo.Index.empty(spark).insert(docs.where("id < 200"))
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", 0)
    more = index.insert(docs.where("id >= 100"))
    assert more.shards == 4 * index.shards
    assert sorted((r.id, r.refs) for r in more.keys().collect()) == [(i, 1 + (100 <= i < 200)) for i in range(300)]

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dqspark.llm import suffixes
from dqspark.llm.suffixes import LENGTH, SPAN, drop_repeats, gram_hashes, parse, removed, repeats
from tests.llm.tables import make_docs, prose


def slow(rows):
    """Removed stretches of each row (id, bytes), in order of the rows."""
    first = {}
    for key, raw in rows:
        for p in range(len(raw) - LENGTH + 1) if key is not None else ():
            s = raw[p : p + LENGTH]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, raw in rows:
        gone = np.zeros(len(raw) + 2, bool)
        for p in range(len(raw) - LENGTH + 1) if key is not None else ():
            if first[raw[p : p + LENGTH]] < key:
                gone[p + 1 : p + LENGTH + 1] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def staged_with(monkeypatch, column):
    """Tables with that column, as they are staged from now on."""
    seen = []

    class Seen(suffixes.Staged):  # may be stacked
        def write(self, df):
            out = super().write(df)
            if column in df.columns:
                seen.append([r.asDict() for r in out.collect()])
            return out

    monkeypatch.setattr(suffixes, "Staged", Seen)
    return seen


def mixed(seed, n=60):
    """Texts with shared passages, near copies, repetitions and characters of several bytes."""
    rng = random.Random(seed)
    passages = [prose(seed * 50 + i, rng.randint(5, 30)) for i in range(8)] + ["é漢🙂" * 20, "ab" * 60, "x" * 49, "y" * 50]
    texts = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else prose(1000 + seed * n + i * 7 + k, 12) for k in range(rng.randint(0, 6))]
        text = " ".join(parts)
        if texts and rng.random() < 0.3:
            text = rng.choice(texts)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "changed", "x"]) + text[at + rng.randint(0, 3) :]
        texts.append(text)
    return [(rng.choice([i, i, i, i // 2]), t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (7, None), (8, "")]


@pytest.mark.parametrize("seed,crowd", [(1, None), (2, 3), (3, 0)])
def test_like_all_strings(spark, monkeypatch, seed, crowd):
    if crowd is not None:
        monkeypatch.setattr(suffixes, "RANGE_BYTES", 1 << 10)
        monkeypatch.setattr(suffixes, "PACK", 200)
        monkeypatch.setattr(suffixes, "CROWD_SIZE", crowd)
    rows = mixed(seed)
    docs = make_docs(spark, rows).repartition(5)
    expected = slow([(k, (t or "").encode()) for k, t in rows])
    found = repeats(docs, carry=("doc_id", "text")).select("doc_id", "text", "n_bytes", "spans", "kept", removed("spans").alias("r")).collect()
    order = lambda x: repr(x)
    got = [(r.doc_id, r.text, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept), r.r) for r in found]
    wanted = []
    for (k, t), spans in zip(rows, expected):
        raw = (t or "").encode()
        kept = bytes(c for i, c in enumerate(raw) if not any(a <= i < b for a, b in spans))
        wanted.append((k, t, len(raw), spans, kept, len(raw) - len(kept)))
    assert sorted(got, key=order) == sorted(wanted, key=order)
    assert any(spans for spans in expected)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=160), max_size=5))
def test_triggers_are_the_first_least_grams(texts):
    texts = [t.encode() for t in texts]
    found = {}
    for owner, h, trigger, lo, hi in parse(texts):
        for row in zip(owner.tolist(), h.tolist(), trigger.tolist(), lo.tolist(), hi.tolist()):
            for p in range(row[3], row[4] + 1):
                assert (row[0], p) not in found
                found[row[0], p] = row[2]
    expected = {}
    for i, t in enumerate(texts):
        if len(t) >= LENGTH:
            grams = gram_hashes(np.frombuffer(t, np.uint8)) >> np.uint64(6)
            expected |= {(i, p): p + int(np.argmin(grams[p : p + SPAN])) for p in range(len(t) - LENGTH + 1)}
    assert found == expected


def test_long_texts_in_parts(monkeypatch):
    texts = [prose(3, 3000).encode(), b"ab" * 4000]
    whole = [tuple(c.tolist() for c in x) for t in texts for x in parse([t])]
    monkeypatch.setattr(suffixes, "PARSE_BYTES", 1000)
    assert [tuple(c.tolist() for c in x) for t in texts for x in parse([t])] == whole


def test_awkward_rows(awkward, nothing):
    cut = drop_repeats(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    text = {r.doc_id: r.text for r in awkward.collect()}
    left = [(r.doc_id, r.text) for r in cut.collect()]
    assert sorted(left, key=repr) == sorted(
        [
            (r.doc_id, "" if r.doc_id == 2 else None if r.text is None else r.text)
            for r in awkward.collect() if r.doc_id != 10
        ] + [x for x in left if x[0] == 10],
        key=repr,
    )
    ten = next(t for i, t in left if i == 10)
    assert 0 < len(ten) < len(text[10])
    assert drop_repeats(nothing).count() == 0


def test_triggers_of_equal_texts_once(spark, monkeypatch):
    seen, text = staged_with(monkeypatch, "copy"), prose(5, 80)
    docs = make_docs(spark, [(i, text) for i in range(40)] + [(100, text + " and " + prose(6, 40))]).repartition(5)
    assert [r.doc_id for r in repeats(docs, carry=("doc_id",)).where("size(spans) = 0").collect()] == [0]
    (texts,) = seen
    assert [r["id"] for r in texts if not r["copy"]] and sum(r["copy"] for r in texts) == 39
    assert {r["shared"] and len(r["shared"]) for r in texts} == {None, 1}
    assert all(r["copy"] == (r["shared"] is None) for r in texts)


def test_triggers_crowded_only_over_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD_ROWS", 12)
    grouped, dealt, line = staged_with(monkeypatch, "stretch"), staged_with(monkeypatch, "head"), prose(3, 30)
    rows = [(i, f"{prose(100 + i, 12)} {line} {prose(300 + i, 12)}") for i in range(40)]
    found = repeats(make_docs(spark, rows).repartition(20), carry=("doc_id",)).select("doc_id", "spans").collect()
    expected = {k: s for (k, _), s in zip(rows, slow([(k, t.encode()) for k, t in rows]))}
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found} == expected
    counts = Counter(r["a"] for r in grouped[0] if r["kind"] == suffixes.PHRASE)
    crowded = {a for a, n in counts.items() if n > 12}
    assert crowded and {r["a"] for t in dealt for r in t} == crowded


def test_broken_characters_go(spark):
    shared = "é" * 40
    docs = make_docs(spark, [(1, "a" + shared), (2, "b" + shared[:30] + "漢" * 30)])
    rows = {r.doc_id: r.text for r in drop_repeats(docs).collect()}
    assert rows[1] == "a" + shared and rows[2] == "b" + "漢" * 30

import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dqspark.llm.packing import (
    EOS, INSTRUCTIONS, Encoder, Limits, Packer, cuts, first_line, op1_vector_packing, pack, public_encoding,
)
from tests.llm.tables import make_docs, prose


@pytest.fixture(scope="module")
def tokenizer():
    read = Tokenizer.from_file(public_encoding()[0])
    read.encode_special_tokens = True
    return read


def test_pieces_rebuild_the_ids_and_fill_sequences(awkward, tokenizer):
    rows = pack(awkward, *public_encoding(), with_ids=True).collect()
    expected = sorted(
        (-1 if r.doc_id is None else r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [EOS])
        for r in awkward.collect()
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[(-1 if r.doc_id is None else r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    found = []
    for (key, total), own in pieces.items():
        copies = sum(r.length for r in own) // total
        starts = sorted({r.start: r.ids for r in own}.items())
        found += [(key, [i for _, ids in starts for i in ids])] * copies
    assert sorted(found) == expected
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 2048 and len(own) <= Limits().segments


def test_prompts_bear_no_loss(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x y z"), (2, "e f", None), (3, None, "p")], "doc_id int, text string, ask string")
    rows = pack(docs, *public_encoding(), prompt_col="ask", limits=Limits(4, 2, 3)).collect()
    assert {(r.doc_id, sum(x.loss_tokens for x in rows if x.doc_id == r.doc_id)) for r in rows} == {(1, 5), (2, 3), (3, 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 40)), max_size=60), st.integers(0, 20))
def test_no_limit_is_broken_and_nothing_is_lost(sizes, keep):
    limits = Limits(40, 4, 30)
    packer = Packer(limits)
    pieces = [(i, t, min(x, t, 30)) for i, (t, x) in enumerate(sizes)]
    for p in pieces:
        packer.add(p[1], p[2], p)
    out = [*packer.close(keep)]
    assert packer.count <= keep
    out += packer.close(0)
    assert sorted(p for s in out for p in s) == pieces
    for s in out:
        assert len(s) <= 4 and sum(p[1] for p in s) <= 40 and sum(p[2] for p in s) <= 30


def test_leads_bear_no_loss(spark, tokenizer):
    texts = ["Do this:\nà la carte 漢字 and more", "no line end", "\n", "héé🙂\n\nb", None, "", "first\n" + prose(5, 4000)]
    docs = make_docs(spark, list(enumerate(texts)))
    rows = pack(docs, *public_encoding(), lead=first_line(), limits=INSTRUCTIONS).collect()
    for i, text in enumerate(texts):
        text = text or ""
        cut = text.index("\n") + 1 if "\n" in text else 0
        offsets = tokenizer.encode(text, add_special_tokens=False).offsets
        free = sum(start < cut for start, _ in offsets)
        own = sorted((r.start, r.length, r.loss_tokens) for r in rows if r.doc_id == i)
        assert sum(n for _, n, _ in own) == len(offsets) + 1
        assert all(loss == max(0, start + n - max(start, free)) for start, n, loss in own)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 40)), min_size=1, max_size=40))
def test_each_choice_has_the_greatest_dot_product(sizes):
    limits = Limits(40, 5, 25)
    caps = (40, 5, 25)
    waiting = [(t, 1, min(x, t, 25)) for t, x in sizes]
    packer = Packer(limits)
    for w in waiting:
        packer.add(w[0], w[2], w)
    for chosen in packer.close(0):
        demand = [sum(w[d] for w in waiting) / caps[d] for d in range(3)]
        room = list(caps)
        for piece in chosen:
            value = lambda w: sum(demand[d] * w[d] / caps[d] * room[d] / caps[d] for d in range(3))  # noqa: B023, E731
            fitting = [value(w) for w in waiting if all(w[d] <= room[d] for d in range(3))]
            assert value(piece) >= max(fitting) * (1 - 1e-9)
            waiting.remove(piece)
            room = [r - x for r, x in zip(room, piece)]
        assert not [w for w in waiting if all(w[d] <= room[d] for d in range(3))]
    assert not waiting


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_each_limit_of_the_query_closes_sequences(spark):
    rows = op1_vector_packing(spark, "/root/testdata/sf0.01").collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    sums = [(sum(r.length for r in own), len(own), sum(r.loss_tokens for r in own)) for own in sequences.values()]
    limits = (INSTRUCTIONS.tokens, INSTRUCTIONS.segments, INSTRUCTIONS.loss)
    closed = [sum(s[d] == limits[d] for s in sums) for d in range(3)]
    assert all(x <= y for s in sums for x, y in zip(s, limits)) and min(closed) > 0
    assert sum(s[0] for s in sums) > 0.985 * 2048 * len(sums)


def test_little_padding():
    rng = np.random.default_rng(0)
    sizes = np.minimum(2047, rng.lognormal(6.3, 1.0, 5000).astype(int) + 1).tolist()
    packer = Packer(Limits())
    for i, n in enumerate(sizes):
        packer.add(n, n, i)
    assert len(list(packer.close(0))) <= 1.01 * sum(sizes) / 2048 + 1


def test_cuts_cover_each_id_once():
    for total, prompt in ((1, 0), (9, 4), (5000, 3000), (7, 7)):
        found = list(cuts(total, prompt, Limits(10, 1, 4)))
        assert [s for s, _, _ in found] == [sum(n for _, n, _ in found[:i]) for i in range(len(found))]
        assert sum(n for _, n, _ in found) == total and sum(x for _, _, x in found) == total - prompt
        assert all(n <= 10 and x <= 4 for _, n, x in found)
    with pytest.raises(ValueError):
        Limits(0, 1, 1)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ranks_give_the_ids_of_the_tokenizer(text):
    reader = test_ranks_give_the_ids_of_the_tokenizer.__dict__.setdefault("reader", Encoder(*public_encoding()))
    if "slow" not in test_ranks_give_the_ids_of_the_tokenizer.__dict__:
        slow = Tokenizer.from_file(public_encoding()[0])
        slow.encode_special_tokens = True
        test_ranks_give_the_ids_of_the_tokenizer.slow = slow
    text = text.encode("utf-8", "ignore").decode()
    assert reader.ids(text).tolist() == test_ranks_give_the_ids_of_the_tokenizer.slow.encode(text, add_special_tokens=False).ids


def test_empty_table(nothing):
    assert pack(nothing, *public_encoding()).count() == 0

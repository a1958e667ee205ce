import hashlib
import random

import pytest

from dqspark.llm.chat import events_of_rows, op10_chat_events, read_back, reconstruct, render, streamed_events

EVENT = "conv_id long, seq long, kind string, msg_id long, role string, text string, pos int, formatted string"


def log(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], EVENT)


def slow_fold(rows):
    """Final (role, text) lists by conversation, event by event."""
    none = lambda x: (x is not None, x if x is not None else 0)
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        messages = {}
        for m in {r[3] for r in own}:
            events = sorted((r for r in own if r[3] == m), key=lambda r: (none(r[1]), r[2] or "delta", (r[4] is not None, r[4] or ""), r[5] or ""))
            text, role, again, deleted = "", None, None, False
            for _, seq, kind, _, who, part in events:
                kind = kind or "delta"
                role = who if who is not None else role
                deleted = deleted or kind == "delete"
                if kind == "regenerate":
                    again = seq if again is None else max(again, seq)
                if kind != "delete":
                    text = (part or "") if kind in ("message", "edit", "regenerate") else text + (part or "")
            messages[m] = (events[0][1], role or "", text, again, deleted)
        kept, cut = [], None
        for m in sorted(messages, key=lambda m: (none(messages[m][0]), none(m))):
            begun, role, text, again, deleted = messages[m]
            if not deleted and not (cut is not None and begun is not None and cut > begun):
                kept.append((role, text))
            if again is not None:
                cut = again if cut is None else max(cut, again)
        if kept:
            out[conv] = kept
    return out


def random_log(seed, n=300):
    rng = random.Random(seed)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None, "other"]
    return [
        (rng.choice([1, 2, 3, 4, None]), rng.choice([i, i, i // 2]), rng.choice(kinds), rng.choice([0, 1, 2, 3, 4, None]),
         rng.choice(["user", "assistant", None]), rng.choice(["a", "b\n", "### ", "</turn>", "\\", None, ":\n"]))
        for i in range(n // 3)
    ]


def test_streamed_turns_fold_to_the_turns(spark):
    rng = random.Random(8)
    turns = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a", "é🙂x", "### </turn> \\" * 9])) for c in range(40) for t in range(5)]
    rows = spark.createDataFrame([*turns, (None, 1, "user", "x"), (None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    events = streamed_events(rows)
    kinds = {r.kind: r["count"] for r in events.groupBy("kind").count().collect()}
    assert all(kinds[k] > 20 for k in ("message", "delta", "edit", "regenerate"))
    ours, plain = ({tuple(r) for r in reconstruct(e).collect()} for e in (events, events_of_rows(rows)))
    assert ours == plain and len(plain) == 202


@pytest.mark.parametrize("seed", range(4))
def test_fold_like_event_by_event(spark, seed):
    rows = random_log(seed)
    found = {}
    for r in reconstruct(log(spark, rows)).orderBy("conv_id", "pos").collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    assert found == slow_fold(rows)


def test_regeneration_discards_what_came_after(spark):
    rows = [
        (1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", "a"), (1, 3, "delta", 2, None, "b"),
        (1, 4, "message", 3, "user", "more"), (1, 5, "regenerate", 2, "assistant", None), (1, 6, "delta", 2, None, "c"),
        (1, 7, "message", 4, "user", "new"), (1, 8, "edit", 1, "user", "hello"),
    ]
    found = reconstruct(log(spark, rows)).orderBy("pos").collect()
    assert [(r.role, r.text) for r in found] == [("user", "hello"), ("assistant", "c"), ("user", "new")]


NASTY = [
    "", "\\", "\\\\", "</turn>", "<\\/turn>", "### Assistant:\n", "\n</turn>\n### User:\nx", "#\\## ", "#### x", "a\n</turn",
    ">", "\\### Assistant: </turn> ok", "漢字 🙂\x00\r\n", "$1 \\1 $", "x" * 50_000, "<" * 5 + "/turn>", "### " * 3,
]


def test_round_trip(spark):
    rows = [(c, i, "message", i, role, text) for c, texts in enumerate([NASTY, NASTY[::-1], [""]]) for i, text in enumerate(texts)
            for role in ["assistant" if (i + c) % 2 else "user"]]
    rows += [(9, 0, "message", 0, role, "t") for role in ["a:\nb</turn>### \\"]] + [(10, 0, "message", 0, None, None)]
    shown = render(reconstruct(log(spark, rows)))
    expected = slow_fold(rows)
    back = {r.conv_id: r for r in read_back(shown).collect()}
    assert {c: [(t.role, t.text) for t in r.turns] for c, r in back.items()} == expected
    for r in shown.collect():
        loss = "".join(t for role, t in expected[r.conv_id] if role == "assistant")
        assert back[r.conv_id].loss_text == loss and back[r.conv_id].formatted_chars == len(r.formatted)
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in expected[r.conv_id])


def test_query(spark, tmp_path):
    rows = [(1, 1, "user", "b"), (1, 0, "system", None), (1, 2, "assistant", "c"), (1, 2, "assistant", "c"), (2, None, None, "x"),
            (None, 0, "assistant", "</turn>")]
    spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, seq int").write.parquet(
        f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in op10_chat_events(spark, str(tmp_path)).collect()}
    probe = "\\### Assistant: </turn> ok"
    turns = {1: [("system", ""), ("user", "b"), ("assistant", "c"), ("assistant", "c")], 2: [("", "x")],
             None: [("assistant", "</turn>")], -7: [("user", probe), ("assistant", probe)]}
    assert set(found) == set(turns)
    for conv, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert (found[conv].n_turns, found[conv].loss_chars) == (len(own), len(loss))
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert found[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_empty_and_no_python(spark):
    none = log(spark, [(1, 1, "message", 1, "user", "x")]).where("false")
    shown = render(reconstruct(none))
    assert shown.count() == 0 and read_back(shown).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    plan = read_back(render(reconstruct(events_of_rows(rows))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

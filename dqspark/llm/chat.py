"""Chat formatting: fold an event log into final messages and render them.

Everything is made of native expressions; there is no Python on the data path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, COLON, TAIL = "### ", ":\n", "\n</turn>\n"
#: Events that set a message's text anew; any other kind (``delta``) appends.
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Break every control string inside ``text``; ``unescape`` is the inverse.

    A backslash doubles; ``</turn>`` and ``### `` get a backslash inside, so
    neither stands in an escaped text and splitting on the markers is safe.
    """
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit(HEAD), F.lit("#\\## "))


def escape_role(role: Column) -> Column:
    """Line breaks get a backslash too, so the first colon at a line's end closes the head."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, pos, role, text) of an event log.

    ``events`` has conv_id, seq, kind, msg_id, role, text; other columns are
    ignored. Kinds: ``message`` starts a message, ``delta`` appends to it,
    ``edit`` replaces its text, ``regenerate`` empties it (its text, if any, is
    the first part of the new one) and discards every later message that had
    begun by then, ``delete`` removes it. Unknown or null kinds append. Events
    with equal seq are folded in the order of kind, role, text. Null text is
    empty, a null role takes the message's last known role, else ''. Null ids
    form a conversation and a message of their own. A message begins at its
    first event. Empty log: no rows.

    Deltas meet per message, not per conversation; the discarding is a running
    maximum over a conversation's messages.
    """
    event = F.struct(
        F.col("seq"),
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.col("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    folded = events.groupBy("conv_id", "msg_id").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.array_max(
        F.transform("log", lambda e, i: F.when(e.kind.isin(*RESETS), i + 1).otherwise(F.lit(0)))
    )
    messages = folded.select(
        "conv_id",
        "msg_id",
        F.col("log")[0].seq.alias("begun"),
        F.array_max(F.transform("log", lambda e: F.when(e.kind == "regenerate", e.seq))).alias("again"),
        F.coalesce(
            F.try_element_at(F.filter(F.col("log.role"), lambda r: r.isNotNull()), F.lit(-1)), F.lit("")
        ).alias("role"),
        F.concat_ws(
            "", F.transform(F.slice("log", F.greatest(last, F.lit(1)), F.size("log")), lambda e: F.when(e.kind != "delete", e.text))
        ).alias("text"),
        F.exists("log", lambda e: e.kind == "delete").alias("deleted"),
    )
    order = Window.partitionBy("conv_id").orderBy("begun", "msg_id")
    before = F.max("again").over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = (
        messages.withColumn("_cut", before)
        .where(~F.col("deleted") & ~F.coalesce(F.col("_cut") > F.col("begun"), F.lit(False)))
    )
    return kept.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, length).

    Spans count code points of ``formatted`` from 0 and cover the escaped text
    of each assistant message, without its head and end marker. Conversations
    without a message give no row.
    """
    order = Window.partitionBy("conv_id").orderBy("pos")
    head = F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(COLON))
    turn = messages.select("conv_id", "pos", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turn = turn.withColumn("whole", F.concat("head", "body", F.lit(TAIL)))
    start = F.sum(F.length("whole")).over(order) - F.length("whole") + F.length("head")
    span = F.when(
        F.col("role") == "assistant",
        F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("length")),
    )
    placed = turn.select("conv_id", "pos", "whole", span.alias("span"))
    parts = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "whole", "span"))).alias("p"))
    return parts.select(
        "conv_id",
        F.concat_ws("", F.col("p.whole")).alias("formatted"),
        F.filter(F.col("p.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Inverse of ``render``: conv_id, turns (role, text), loss_text, formatted_chars."""
    whole = F.col("formatted")
    parts = F.filter(F.split(whole, r"\n</turn>\n", -1), lambda p: p != "")
    cut = lambda p: F.instr(p, COLON)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(len(HEAD) + 1), cut(p) - len(HEAD) - 1)).alias("role"),
            unescape(F.substring(p, cut(p) + len(COLON), F.length(p))).alias("text"),
        ),
    )
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substring(whole, (s.start + 1).cast("int"), s.length.cast("int")))
    )
    return formatted.select(
        "conv_id",
        turns.alias("turns"),
        F.concat_ws("", loss).alias("loss_text"),
        F.length(whole).cast("long").alias("formatted_chars"),
    )


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """Event log of a table with one row per turn; repeated rows stay apart.

    Rows with equal turn are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    seq = F.row_number().over(order).cast("long")
    return conversations.select(
        "conv_id", seq.alias("seq"), F.lit("message").alias("kind"), seq.alias("msg_id"), "role", "text"
    )


#: Events that a turn's log has room for.
ROOM = 8


def streamed_events(conversations: DataFrame) -> DataFrame:
    """Event log in which the turns of ``events_of_rows`` arrive as a chat service would log them.

    By a hash of conversation and place a turn is (0) one message, (1) a message
    and two deltas, (2) a wrong draft, an edit that replaces it, and a delta, or
    (3) an answer begun, a follow-up to it, and a regeneration that discards
    both, with a delta. Their fold is the turn. Only the first event of a message
    has the role.
    """
    turns = events_of_rows(conversations).withColumn("text", F.coalesce("text", F.lit("")))
    way = F.pmod(F.xxhash64("conv_id", "seq"), F.lit(4))
    a = F.floor(F.length("text") / 3).cast("int")
    b = F.floor(2 * F.length("text") / 3).cast("int")
    piece = lambda start, stop: F.substring("text", start + 1, stop - start)
    one, two, three = piece(F.lit(0), a), piece(a, b), piece(b, F.length("text"))
    at, no_role = F.col("seq") * ROOM, F.lit(None).cast("string")

    def event(place: int, kind: str, text: Column, role: Column = no_role, other: bool = False) -> Column:
        return F.struct(
            (at + place).alias("seq"), F.lit(kind).alias("kind"), (at + int(other)).alias("msg_id"),
            role.alias("role"), text.alias("text"),
        )

    role = F.col("role")
    logs = [
        F.array(event(0, "message", F.col("text"), role)),
        F.array(event(0, "message", one, role), event(1, "delta", two), event(2, "delta", three)),
        F.array(event(0, "message", F.reverse("text"), role), event(1, "edit", F.concat(one, two)), event(2, "delta", three)),
        F.array(
            event(0, "message", two, role), event(1, "delta", three), event(2, "message", one, F.lit("user"), other=True),
            event(3, "regenerate", one), event(4, "delta", F.concat(two, three)),
        ),
    ]
    log = F.when(way == 0, logs[0]).when(way == 1, logs[1]).when(way == 2, logs[2]).otherwise(logs[3])
    return turns.select("conv_id", F.inline(log))


#: Fixed conversation that every result of the query contains.
PROBE = "\\### Assistant: </turn> ok"


def op10_chat_events(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    back = read_back(render(reconstruct(streamed_events(rows.unionByName(probe)))))
    joined = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP10_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS erole,
    replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS etext FROM r)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(replace(erole, chr(10), '\' || chr(10))) + 2 + length(etext) + 9) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

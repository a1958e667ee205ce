"""Exact substring deduplication by prefix-free parsing.

A text is cut into phrases at rolling-hash triggers: of the grams in every
window of LENGTH bytes the one with the least hash is a trigger, so equal
windows have equal triggers at equal places, and each window belongs to one
trigger. The windows of a trigger lie in a short stretch of text, its phrase
with what surrounds it. Distinct phrases are the dictionary, each text is a
sequence of them. No suffix array is built, of the dictionary or of the parse:
for windows of LENGTH bytes all that matters is which of them are equal, not
their order, and equal ones share their trigger. So windows are matched by hash
within a trigger. A phrase that an earlier document has as a whole needs no
windows at all.

The steps, all of them Spark jobs over rows that grow with the input:

1. Each task packs the hashes of its triggers by range; ranges that meet tell
   each text which of its triggers other texts have too. Of equal texts only the
   one with the smallest id goes on; the others are repeated as a whole.
2. Documents write down the phrases of those triggers.
3. By trigger, the smallest id of each phrase is found; where a trigger has
   several phrases, a hash table of their windows tells which windows of the one
   are in another.
4. The covered bytes are cut out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.rows import column, fresh
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1  # grams, and so at most windows of one trigger, in a window
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = [np.uint64(int(x) | 1) for x in _rng.integers(0, 2**63, 8, dtype=np.uint64)]
_LOW = np.uint64(63)

#: Bytes of text per hash range, bytes a task parses at once, triggers it packs at once.
RANGE_BYTES, PARSE_BYTES, PACK = 8 << 20, 1 << 18, 500_000
#: Parts in which phrases are shuffled, one after the other, to need less disk at once.
PARTS = 2
#: Phrases of one trigger in one task from which on its windows are dealt by themselves.
CROWD_SIZE = 512
#: Phrases of one trigger in all tasks together, equal ones of several tasks counted each,
#: beyond which the same is done. So no group of step 3 holds more.
CROWD_ROWS = 8192
MANY = np.uint32(0xFFFFFFFF)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Rolling hash of each GRAM bytes, from hashes of 1, 2, 4 ... bytes."""
    powers, size = {1: _BYTE[raw]}, 1
    while size * 2 <= GRAM:
        h = powers[size]
        powers[2 * size] = h[:-size] * _FACTOR[size.bit_length() - 1] + h[size:]
        size *= 2
    out, length = powers[size], size
    for part in sorted(powers, reverse=True):
        while length + part <= GRAM:
            behind = powers[part][length:]
            n = min(len(out), len(behind))
            out = out[:n] * _FACTOR[6] + behind[:n]
            length += part
    out = (out ^ (out >> np.uint64(32))) * _FACTOR[7]
    return out ^ (out >> np.uint64(29))


def window_triggers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams, and for each window the place of its trigger.

    The trigger is the first of the least grams. Minima over sliding windows
    come from prefix and suffix minima of blocks as long as the window.
    """
    hashes = gram_hashes(raw)
    n = len(raw) - LENGTH + 1
    padded = np.concatenate([hashes, np.full(-len(hashes) % SPAN, 2**64 - 1, np.uint64)]).reshape(-1, SPAN)
    key = (padded & ~_LOW) | np.arange(SPAN, dtype=np.uint64)
    first = np.minimum.accumulate(key, axis=1).ravel()[SPAN - 1 : SPAN - 1 + n]
    last = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    at = np.arange(n)
    later = (first & ~_LOW) < (last & ~_LOW)
    block = np.where(later, at + SPAN - 1, at) // SPAN * SPAN
    return hashes, block + (np.where(later, first, last) & _LOW).astype(np.int64)


def parse(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Phrases of several texts: (number of the text, trigger's hash, trigger, first and last window).

    Places are relative to the text. Long texts are parsed in overlapping parts,
    and the phrases at their borders joined.
    """
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= PARSE_BYTES):
            size += len(texts[stop])
            stop += 1
        if size > 2 * PARSE_BYTES:
            yield _parse_long(start, texts[start])
        elif max(map(len, texts[start:stop])) >= LENGTH:
            yield _parse_short(start, texts[start:stop])
        start = stop


def _parse_short(number: int, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    hashes, trigger = window_triggers(np.frombuffer(b"".join(texts), np.uint8))
    windows = np.maximum(sizes - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    begin = (ends - sizes)[owner]
    at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + begin
    mine = trigger[at]
    new = np.ones(len(at), bool)
    new[1:] = (mine[1:] != mine[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    base = begin[heads]
    return owner[heads] + number, hashes[mine[heads]], mine[heads] - base, at[heads] - base, at[tails] - base


def _parse_long(number: int, text: bytes) -> tuple[np.ndarray, ...]:
    parts = []
    for start in range(0, len(text) - LENGTH + 1, PARSE_BYTES):
        found = _parse_short(number, [text[start : start + PARSE_BYTES + LENGTH - 1]])
        parts.append((found[0], found[1], *[c + start for c in found[2:]]))
    out = [np.concatenate(c) for c in zip(*parts)]
    again = np.zeros(len(out[2]), bool)
    again[1:] = out[2][1:] == out[2][:-1]
    keep = np.flatnonzero(~again)
    last = np.append(keep[1:], len(again)) - 1
    return out[0][keep], out[1][keep], out[2][keep], out[3][keep], out[4][last]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _batch(names: str, columns: list, kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names.split())


PACKED = "batch long, range int, rows binary, owners binary, rests binary, told boolean"


def _pack(bits: int):
    """Task of step 1: packed triggers by range, and what is shared inside the task."""

    def flush(number: int, rows: list[int], hashes: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # Equal texts are one owner: they are dealt with as wholes.
        keys, number_of = np.unique(np.array(rows, np.int64), return_inverse=True)
        h, owner = np.concatenate(hashes), number_of[np.concatenate(owners)].astype(np.uint32)
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[once], owner[once]
        head = np.ones(len(h), bool)
        head[1:] = h[1:] != h[:-1]
        group = np.cumsum(head) - 1
        several = (np.bincount(group) > 1)[group]
        edges = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        rest = (h >> np.uint64(32 - bits) & np.uint64(0xFFFFFFFF)).astype("<u4")
        shipped = np.where(several, MANY, owner)
        out = []
        for r in range(1 << bits):
            one = slice(edges[r], edges[r + 1])
            if edges[r + 1] > edges[r]:
                used = head[one]
                out.append((number, r, *_with_rows(keys, shipped[one][used]), rest[one][used].tobytes(), False))
                told = several[one]
                if told.any():
                    out.append((number, r, *_with_rows(keys, owner[one][told]), rest[one][told].tobytes(), True))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
        for i in range(0, len(out), 64):
            yield _batch("batch range rows owners rests told", list(zip(*out[i : i + 64])), kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, hashes, owners, count = [], [], [], 0
        number = TaskContext.get().partitionId() << 20
        for batch in worker.slices(batches):
            texts = _bytes(batch.column(1))
            for owner, h, *_ in parse(texts):
                hashes.append(h)
                owners.append(owner + len(rows))
                count += len(h)
            rows += batch.column(0).to_pylist()
            if count >= PACK:
                yield from flush(number, rows, hashes, owners)
                rows, hashes, owners, count = [], [], [], 0
                number += 1
        if count:
            yield from flush(number, rows, hashes, owners)

    return work


def _with_rows(keys: np.ndarray, owner: np.ndarray) -> tuple[bytes, bytes]:
    """Keys of the rows in use, and each trigger's place among them."""
    used, place = np.unique(owner, return_inverse=True)
    known = used[used != MANY]
    place = place.astype("<u4")
    return keys[known.astype(np.int64)].astype("<i8").tobytes(), place.tobytes()


MET = "batch long, range int, rows binary, owners binary, rests binary"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by range: which triggers other rows have too, told to each batch."""
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def finish(number: int, parts: list) -> Iterator[pa.RecordBatch]:
        rests = np.concatenate([np.frombuffer(p[3], "<u4") for p in parts])
        owners = [np.frombuffer(p[2], "<u4").astype(np.int64) for p in parts]
        # An owner beyond the rows stands for several texts, MANY; none is like another.
        texts = [np.append(np.frombuffer(p[1], "<i8"), 0)[np.minimum(o, len(p[1]) // 8)] for p, o in zip(parts, owners)]
        several = np.concatenate([o >= len(p[1]) // 8 for p, o in zip(parts, owners)])
        texts = np.concatenate(texts)
        order = np.lexsort((texts, rests))
        first = np.append(True, rests[order][1:] != rests[order][:-1])
        group = np.cumsum(first) - 1
        other = ~first & np.append(False, (texts[order][1:] != texts[order][:-1]) | several[order][1:] | several[order][:-1])
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[other]] = True
        met = np.zeros(len(rests), bool)
        met[order] = mixed[group]
        at = 0
        for batch, rows, owners, own_rests in parts:
            owner, rest = np.frombuffer(owners, "<u4"), np.frombuffer(own_rests, "<u4")
            one = met[at : at + len(rest)] & (owner < len(rows) // 8)  # beyond: MANY, told already
            at += len(rest)
            if one.any():
                row = (batch, number, rows, owner[one].tobytes(), rest[one].tobytes())
                yield _batch("batch range rows owners rests", [[x] for x in row], kinds)

    number, parts = None, []
    for batch in batches:
        for source, r, rows, owners, rests, told in zip(*(c.to_pylist() for c in batch.columns)):
            if told:
                yield _batch("batch range rows owners rests", [[x] for x in (source, r, rows, owners, rests)], kinds)
                continue
            if r != number and parts:
                yield from finish(number, parts)
                parts = []
            number = r
            parts.append((source, rows, owners, rests))
    if parts:
        yield from finish(number, parts)


SHARED = "row long, triggers binary"


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """End of step 1, for rows sorted by batch: the shared triggers (range and rest) of each row.

    They are sorted, so that equal texts of several batches have equal lists.
    """

    def finish(parts: list) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([np.frombuffer(r, "<i8")[np.frombuffer(o, "<u4")] for _, r, o, _ in parts])
        found = [np.frombuffer(s, "<u4").astype("<u8") | np.uint64(number << 32) for number, _, _, s in parts]
        triggers = np.concatenate(found)
        order = np.lexsort((triggers, rows))
        rows, triggers = rows[order], triggers[order]
        cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        stops = np.append(cuts[1:], len(rows))
        for i in range(0, len(cuts), 4096):
            blobs = [triggers[x:y].tobytes() for x, y in zip(cuts[i : i + 4096], stops[i : i + 4096])]
            yield _batch("row triggers", [rows[cuts[i : i + 4096]], blobs], [pa.int64(), pa.binary()])

    source, parts = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != source and parts:
                yield from finish(parts)
                parts = []
            source = row[0]
            parts.append(row[1:])
    if parts:
        yield from finish(parts)


PHRASES = "kind int, a long, id long, text_key long, lo int, n int, skip int, stretch binary"
#: Kinds of rows of step 2: a trigger has too many phrases here for one group; a
#: phrase; a phrase of such a trigger; windows that are known to be repeated.
CROWDED, PHRASE, CROWD, DONE = range(4)


def _phrases(bits: int):
    """Task of step 2: the phrases of shared triggers, each once per task.

    ``stretch`` is the text of a phrase's windows, ``skip`` where its trigger
    stands in it. Rows with a larger id than another one with that phrase here
    are settled at once. Later groups are so bounded by the number of tasks.
    """

    def flush(found: dict[tuple, list[tuple]], done: dict[tuple, list]) -> Iterator[pa.RecordBatch]:
        phrases: dict[int, int] = {}
        for a, _, _ in found:
            phrases[a] = phrases.get(a, 0) + 1
        crowded = {a for a, n in phrases.items() if n > CROWD_SIZE}
        out = [(CROWDED, a, None, None, None, None, None, None) for a in crowded]
        for (a, skip, stretch), rows in found.items():
            kind, n = CROWD if a in crowded else PHRASE, len(stretch) - LENGTH + 1
            out += [(kind, a, key, text_key, lo, n, skip, stretch) for key, text_key, lo in rows]
        for (key, text_key), spans in done.items():
            out += [(DONE, 0, key, text_key, lo, n, None, None) for lo, n in _merged(spans)]
        kinds = [pa.int32(), *[pa.int64()] * 3, *[pa.int32()] * 3, pa.binary()]
        for i in range(0, len(out), 8192):
            yield _batch("kind a id text_key lo n skip stretch", list(zip(*out[i : i + 8192])), kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[tuple]] = {}
        done: dict[tuple, list] = {}
        for batch in worker.slices(batches, 128):
            ids, keys, shared = (batch.column(i).to_pylist() for i in (0, 1, 3))
            texts = _bytes(batch.column(2))
            known = [np.concatenate([np.frombuffer(s, "<u8") for s in one]) for one in shared]
            for owner, h, trigger, lo, hi in parse(texts):
                short = h >> np.uint64(32 - bits)  # range and rest
                cuts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])).tolist()
                for i, j in zip(cuts, [*cuts[1:], len(owner)]):
                    o = int(owner[i])
                    at = np.flatnonzero(np.isin(short[i:j], known[o])) + i
                    key, text_key, text = ids[o], keys[o], texts[o]
                    columns = (h[at].view(np.int64), trigger[at] - lo[at], lo[at], hi[at] + LENGTH)
                    for a, skip, start, end in zip(*(c.tolist() for c in columns)):
                        phrase = (a, skip, text[start:end])
                        rows = found.setdefault(phrase, [])
                        if not rows or rows[0][0] == key:
                            rows.append((key, text_key, start))
                            continue
                        if rows[0][0] < key:
                            lost = [(key, text_key, start)]
                        else:
                            lost, found[phrase] = rows, [(key, text_key, start)]
                        for k, t, s in lost:
                            done.setdefault((k, t), []).append((s, end - start - LENGTH + 1))
            if len(found) >= PACK // 8:
                yield from flush(found, done)
                found, done = {}, {}
        yield from flush(found, done)

    return work


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same windows in as few (first, number) spans as possible."""
    out: list[list[int]] = []
    for lo, n in sorted(spans):
        if out and lo <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], lo + n - out[-1][0])
        else:
            out.append([lo, n])
    return [(lo, n) for lo, n in out]


SPANS = "id long, text_key long, lo int, n int, mask long, a long, stretch binary"


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, for rows sorted by trigger and kind: which windows an earlier row has.

    A trigger's phrases are taken in the order of the ids that have them first;
    a dict has the first id of each of their windows. Phrases of crowded triggers
    are passed on with their stretch.
    """

    def settle(rows: list[tuple]) -> Iterator[tuple]:
        least: dict[tuple, int] = {}
        for _, _, key, _, _, _, skip, stretch in rows:
            phrase = (skip, stretch)
            if phrase not in least or key < least[phrase]:
                least[phrase] = key
        masks = dict.fromkeys(least, 0)
        if len(least) > 1:
            seen: dict[bytes, int] = {}
            for phrase, key in sorted(least.items(), key=lambda x: x[1]):
                stretch = phrase[1]
                for i in range(len(stretch) - LENGTH + 1):
                    if seen.setdefault(stretch[i : i + LENGTH], key) < key:
                        masks[phrase] |= 1 << i
        for _, _, key, text_key, lo, n, skip, stretch in rows:
            if key > least[skip, stretch]:
                yield key, text_key, lo, n, None, None, None
            elif masks[skip, stretch]:
                yield key, text_key, lo, n, masks[skip, stretch], None, None

    def written(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return _batch("id text_key lo n mask a stretch", list(zip(*out)), kinds)

    rows, trigger, crowded, out = [], None, False, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[1] != trigger:
                out += settle(rows)
                rows, trigger, crowded = [], row[1], False
            if row[0] == CROWDED:
                crowded = True
            elif crowded:
                out.append((*row[2:6], None, row[1], row[7]))
            else:
                rows.append(row)
            if len(out) >= 8192:
                yield written(out)
                out = []
    out += settle(rows)
    if out:
        yield written(out)


SUFFIXES = "a long, id long, text_key long, lo int, n int, shift int, head long"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of crowded triggers' phrases, each as a hash of its LENGTH bytes."""
    kinds = [*[pa.int64()] * 3, *[pa.int32()] * 3, pa.int64()]
    for batch in worker.slices(batches, 4096):
        a, ids, keys, los, ns, stretches = (c.to_pylist() for c in batch.columns)
        heads = [xxhash.xxh64_intdigest(s[i : i + LENGTH]) for s, n in zip(stretches, ns) for i in range(n)]
        columns = [np.repeat(np.array(c, np.int64), ns) for c in (a, ids, keys)]
        columns += [np.repeat(np.array(c, np.int32), ns) for c in (los, ns)]
        shift = np.concatenate([np.arange(n, dtype=np.int32) for n in ns]) if ns else np.array([], np.int32)
        yield _batch("a id text_key lo n shift head", [*columns, shift, np.array(heads, np.uint64).view(np.int64)], kinds)


def _crowds(phrases: DataFrame, staged: Staged) -> DataFrame:
    """Masks of the windows that an earlier row has, without groups by trigger."""
    suffixes = staged.write(phrases.select("a", "id", "text_key", "lo", "n", "stretch").mapInArrow(_suffixes, SUFFIXES))
    first = suffixes.groupBy("a", "head").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    later = suffixes.join(first.select("a", "head", "first"), ["a", "head"]).where("id > first")
    mask = F.bit_or(F.expr("shiftleft(1L, shift)")).alias("mask")
    return later.groupBy("id", "text_key", "lo", "n").agg(mask).select("id", "text_key", "lo", "n", "mask")


def _runs(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal removed stretches (start, end) of a text."""
    edges = np.zeros(size + 1, np.int64)
    for s in spans:
        if s["mask"] is None:
            edges[s["lo"]] += 1
            edges[s["lo"] + s["n"] - 1 + LENGTH] -= 1
        else:
            for i in range(s["n"]):
                if s["mask"] >> i & 1:
                    edges[s["lo"] + i] += 1
                    edges[s["lo"] + i + LENGTH] -= 1
    covered = np.concatenate([[False], np.cumsum(edges[:size]) > 0, [False]])
    turns = np.flatnonzero(covered[1:] != covered[:-1]).tolist()
    return list(zip(turns[::2], turns[1::2]))


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_text: bool = False
) -> DataFrame:
    """Each row of ``docs`` with what is left of its text.

    Columns: ``carry``, n_bytes, spans (removed stretches as start and end, in
    bytes of the text), kept (remaining bytes; ``as_text``: as a string without
    broken characters). A byte is removed if a string of
    LENGTH bytes that covers it also starts in a row with a smaller id; all is
    judged on the input. Null texts are empty. Texts shorter than LENGTH stay.
    Rows with a null id neither lose anything nor take anything from others;
    rows with equal ids take nothing from each other. No rows give no rows.
    """
    staged = Staged(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)]
    keys = [F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")]
    read = docs.select(*own, *keys)
    searched = (F.col("id").isNotNull()) & (F.octet_length("text") >= LENGTH)
    # Bytes of all texts give the number of hash ranges; one scan, one row.
    size = read.where(searched).agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(3, int(size // RANGE_BYTES).bit_length())
    packed = read.where(searched).select(F.col("text_key").alias("row"), "text").mapInArrow(_pack(bits), PACKED)
    met = packed.repartition(F.col("range")).sortWithinPartitions("range").mapInArrow(_meet, MET)
    shared = staged.write(met.repartition(F.col("batch")).sortWithinPartitions("batch").mapInArrow(_by_row, SHARED))
    staged.free()
    # Of equal texts all but the one with the smallest id are repeated as a whole.
    equal = read.where(searched).select("id", F.col("text_key").alias("row"), F.md5("text").alias("md5"))
    equal = equal.groupBy("row", "md5").agg(F.min("id").alias("least"), F.max("id").alias("last")).where("least < last")
    told = shared.select("row", "triggers", F.lit(None).cast("struct<md5:string,least:bigint>").alias("copies"))
    told = told.unionByName(equal.select("row", F.lit(None).cast("binary").alias("triggers"), F.struct("md5", "least").alias("copies")))
    by_row = told.groupBy(F.col("row").alias("_row")).agg(
        F.collect_set("triggers").alias("shared"), F.collect_list("copies").alias("copies")
    )
    joined = read.join(by_row, F.col("text_key") == F.col("_row"), "left").drop("_row")
    # Texts with equal keys may still differ, so the digest decides.
    copy = F.exists("copies", lambda c: (c["least"] < F.col("id")) & (c["md5"] == F.md5("text")))
    joined = joined.withColumn("copy", F.coalesce(searched & (F.size("copies") > 0) & copy, F.lit(False))).drop("copies")
    texts = staged.write(joined.withColumn("shared", F.when(~F.col("copy"), F.col("shared"))))
    staged.drop(shared)
    staged.free()

    some = texts.where(searched & ~F.col("copy") & (F.size("shared") > 0)).select("id", "text_key", "text", "shared")
    phrases = staged.write(some.mapInArrow(_phrases(bits), PHRASES))
    counted = phrases.where(F.col("kind") == PHRASE).groupBy("a").agg(F.count("*").alias("rows"))
    crowded = staged.write(counted.where(F.col("rows") > CROWD_ROWS).select("a"))
    parts = []
    for part in range(PARTS):
        own = phrases.where(F.col("kind").isin(CROWDED, PHRASE) & (F.pmod("a", F.lit(PARTS)) == part))
        own = own.join(crowded, "a", "left_anti").select(*phrases.columns)
        by_trigger = own.repartition(F.col("a")).sortWithinPartitions("a", "kind")
        parts.append(staged.write(by_trigger.mapInArrow(_order, SPANS)))
        staged.free()
    settled = reduce(DataFrame.unionByName, parts)
    crowd = phrases.where(F.col("kind") == CROWD).unionByName(settled.where(F.col("a").isNotNull()), allowMissingColumns=True)
    crowd = crowd.unionByName(phrases.where(F.col("kind") == PHRASE).join(crowded, "a", "left_semi"), allowMissingColumns=True)
    whole = F.lit(None).cast("long").alias("mask")
    lost = (
        settled.where(F.col("a").isNull())
        .select("id", "text_key", "lo", "n", "mask")
        .unionByName(phrases.where(F.col("kind") == DONE).select("id", "text_key", "lo", "n", whole))
        .unionByName(_crowds(crowd, staged))
    )
    by_text = lost.groupBy("id", "text_key").agg(F.collect_list(F.struct("lo", "n", "mask")).alias("spans"))
    spans = staged.write(by_text)
    for done in (phrases, crowded, *parts):
        staged.drop(done)
    staged.free()
    whole_text = F.array(F.struct(F.lit(0).alias("lo"), (F.octet_length("text") - LENGTH + 1).alias("n"), F.lit(None).cast("long").alias("mask")))
    joined = texts.drop("shared").join(
        spans.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "spans"),
        (F.col("id") == F.col("_id")) & (F.col("text_key") == F.col("_key")),
        "left",
    )
    own_types = [joined.schema[f"_c{i}"].dataType.simpleString() for i in range(len(carry))]
    schema = ", ".join([*[f"_c{i} {t}" for i, t in enumerate(own_types)], "n_bytes long, spans array<struct<start:long,end:long>>, kept " + ("string" if as_text else "binary")])
    cut = joined.select(*[f"_c{i}" for i in range(len(carry))], "text", F.when(F.col("copy"), whole_text).otherwise(F.col("spans")).alias("spans")).mapInArrow(_cut(len(carry), as_text), schema)
    return cut.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "n_bytes", "spans", "kept")


def _cut(width: int, as_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*[f"_c{i}" for i in range(width)], "n_bytes", "spans", "kept"]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in worker.slices(batches):
            texts, spans = _bytes(batch.column(width)), batch.column(width + 1).to_pylist()
            runs = [_runs(s, len(t)) if s else [] for t, s in zip(texts, spans)]
            kept = [b"".join(t[i:j] for i, j in zip([0, *[e for _, e in r]], [*[s for s, _ in r], len(t)])) for t, r in zip(texts, runs)]
            if as_text:
                kept = [k.decode("utf-8", "ignore") for k in kept]
            listed = [[{"start": s, "end": e} for s, e in r] for r in runs]
            own = [*batch.columns[:width], pa.array([len(t) for t in texts], pa.int64()), pa.array(listed, kind), pa.array(kept, pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays(own, names)

    return work


def removed(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated stretches cut out of the texts; no row is dropped.

    Null texts stay null. Bytes of characters that a cut has broken go too.
    """
    others = [c for c in docs.columns if c != text_col]
    (missing,) = fresh(docs, "_no_text")
    marked = docs.withColumn(missing, column(text_col).isNull())
    # Carried as one column, so that their names cannot clash with those of results.
    (row,) = fresh(marked, "_row")
    marked = marked.select(column(id_col), column(text_col), F.struct(*[column(c) for c in (*others, missing)]).alias(row))
    found = repeats(marked, id_col, text_col, (row,), as_text=True)
    text = F.when(~column(row)[missing], F.col("kept"))
    return found.select(*[text.alias(c) if c == text_col else column(row)[c].alias(c) for c in docs.columns])


def op6_prefix_free_parsing(spark, sf_dir: str) -> DataFrame:
    found = repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=("doc_id",))
    return found.select(
        "doc_id",
        "n_bytes",
        removed(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: Every string of 50 bytes, by a hash of its hexadecimal digits, with the smallest id that has it.
OP6_SQL = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
x AS (
  SELECT doc_id, unnest(list_transform(range(0, greatest(0, length(h) // 2 - 49), 256),
    lambda b: {'b': b, 'h': substr(h, 2 * b + 1, 610)})) AS u FROM d),
w AS (
  SELECT doc_id, v.p AS p, v.s AS s FROM (
    SELECT doc_id, unnest(list_transform(range(0, length(u.h) // 2 - 49),
      lambda i: {'p': u.b + i, 's': hash(substr(u.h, 2 * i + 1, 100))})) AS v FROM x)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT w.doc_id, p FROM w JOIN f ON f.s = w.s WHERE w.doc_id > least),
m AS (SELECT doc_id, p, sum(CASE WHEN p > before + 50 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
      FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM c)),
r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM m GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
t AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
        list(struct_pack(s := before, e := a) ORDER BY a) AS kept FROM k GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE
    array_to_string(list_transform(kept, lambda x: substr(h, 2 * x.s + 1, 2 * (x.e - x.s))), '') || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""

"""Exact duplicates through an index of cuckoo filters over live digests.

The index is split into shards by digest. A shard holds a cuckoo filter (a short
tag per live digest, in one of two buckets) and, by the digest's first bucket,
the stored content of each digest: the whole digest, the text's byte length, how
many rows hold it and which of them stays. A text whose tag the filter lacks is
new; a hit is held against the bucket's content, so a false hit costs a
comparison and never joins different texts. Where a tag finds no place, the
filter doubles and is filled again from the stored keys.

Each generation of the index is a Parquet table in the shared folder. A step
reads one generation and writes the next, so it can be repeated at any time.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm.rows import pick
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Slots of a bucket, moves before a filter counts as full, buckets of a new filter.
SLOTS, MAX_KICKS, FIRST_BUCKETS = 4, 400, 256
#: Keys that a shard is made for, shards of a new index at least, keys a task gathers before it passes them on.
SHARD_KEYS, LEAST_SHARDS, TASK_KEYS = 16_384, 64, 65_536
#: A digest that over one in so many rows hold is hot; there are fewer hot digests than this.
HOT_SHARE = 1000
#: Characters that do not count.
BLANKS = " \t\n\x0b\x0c\r"

CLAIM = "shard int, digest binary, n_bytes long, refs long, points long, id long, text_key long"
STATE = f"{CLAIM}, slots binary"


class CuckooFilter:
    """Tags of 16 bits, SLOTS to a bucket; the number of buckets is a power of two."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        self.mask = buckets - 1
        self.slots = array("H", slots if slots is not None else bytes(2 * SLOTS * buckets))

    def place(self, digest: bytes) -> tuple[int, int]:
        """The digest's tag and first bucket."""
        return int.from_bytes(digest[:2], "little") or 1, int.from_bytes(digest[2:10], "little") & self.mask

    def other(self, tag: int, bucket: int) -> int:
        """The tag's second bucket; of that one, the first."""
        return bucket ^ (tag * 0x5BD1E995 & self.mask)

    def __contains__(self, digest: bytes) -> bool:
        tag, bucket = self.place(digest)
        slots = self.slots
        for b in (bucket, self.other(tag, bucket)):
            if tag in slots[b * SLOTS : b * SLOTS + SLOTS]:
                return True
        return False

    def add(self, digest: bytes) -> bool:
        """False if some tag has lost its place; the filter is then to be filled anew."""
        tag, bucket = self.place(digest)
        slots = self.slots
        for b in (bucket, self.other(tag, bucket)):
            for i in range(b * SLOTS, b * SLOTS + SLOTS):
                if not slots[i]:
                    slots[i] = tag
                    return True
        for kick in range(MAX_KICKS):
            i = bucket * SLOTS + (kick + tag) % SLOTS
            slots[i], tag = tag, slots[i]
            bucket = self.other(tag, bucket)
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not slots[i]:
                    slots[i] = tag
                    return True
        return False

    def remove(self, digest: bytes) -> None:
        tag, bucket = self.place(digest)
        for b in (bucket, self.other(tag, bucket)):
            for i in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.slots[i] == tag:
                    self.slots[i] = 0
                    return


def better(one: tuple | None, two: tuple | None) -> tuple | None:
    """Of two rows (points, id, text_key): more code points, smaller id (null last), smaller text key."""
    if one is None or two is None:
        return one or two
    return min(one, two, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))


class Shard:
    """A filter and the content behind it; an entry is [digest, n_bytes, refs, best row]."""

    def __init__(self, entries: list[list] = (), slots: bytes | None = None):
        self.filter, self.content = CuckooFilter(FIRST_BUCKETS), {}
        if slots is not None:
            self.filter = CuckooFilter(len(slots) // (2 * SLOTS), slots)
            for entry in entries:
                self._store(entry)
        elif entries:
            self._fill(list(entries), FIRST_BUCKETS)

    def __len__(self) -> int:
        return sum(map(len, self.content.values()))

    def __iter__(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket

    def _store(self, entry: list) -> None:
        self.content.setdefault(self.filter.place(entry[0])[1], []).append(entry)

    def _fill(self, entries: list[list], buckets: int) -> None:
        while True:
            self.filter, self.content = CuckooFilter(buckets), {}
            if all(self.filter.add(e[0]) for e in entries):
                break
            buckets *= 2
        for entry in entries:
            self._store(entry)

    def find(self, digest: bytes, n_bytes: int) -> list | None:
        """The live entry of this content; the bucket is read only after a hit."""
        if digest not in self.filter:
            return None
        for entry in self.content.get(self.filter.place(digest)[1], ()):
            if entry[0] == digest and entry[1] == n_bytes:
                return entry
        return None

    def insert(self, digest: bytes, n_bytes: int, refs: int, best: tuple | None) -> bool:
        """Whether the content was new."""
        entry = self.find(digest, n_bytes)
        if entry is not None:
            entry[2] += refs
            entry[3] = better(entry[3], best)
            return False
        entry = [digest, n_bytes, refs, best]
        if self.filter.add(digest):
            self._store(entry)
        else:
            self._fill([*self, entry], 2 * (self.filter.mask + 1))
        return True

    def delete(self, digest: bytes, n_bytes: int, refs: int, best: tuple | None) -> None:
        """Drop rows of a content; without rows it is live no longer.

        ``best`` is the best of the dropped rows. If it was the one to stay, the
        entry has none until ``repair``.
        """
        entry = self.find(digest, n_bytes)
        if entry is None:
            return
        entry[2] -= refs
        if entry[2] <= 0:
            home = self.filter.place(digest)[1]
            self.content[home] = [e for e in self.content[home] if e is not entry]
            self.filter.remove(digest)
        elif best == entry[3]:
            entry[3] = None

    def repair(self, digest: bytes, n_bytes: int, refs: int, best: tuple | None) -> None:
        entry = self.find(digest, n_bytes)
        if entry is not None:
            entry[3] = better(entry[3], best)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, digest, n_bytes, points) of each row; blanks do not count, null is empty.

    ``text_key`` tells texts of one id apart, ``points`` are the code points of
    the text as it stands.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    read = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.length(text).cast("long").alias("points"),
        bare.alias("bare"),
    )
    return read.select(
        "id",
        "text_key",
        F.unhex(F.sha2(F.col("bare").cast("binary"), 256)).alias("digest"),
        F.octet_length("bare").cast("long").alias("n_bytes"),
        "points",
    )


def _rows(table: pa.Table | pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    return zip(*(table.column(c).to_pylist() for c in names))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


KEY = ["digest", "n_bytes"]
BEST = ["points", "id", "text_key"]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows by content, so that a hot digest leaves it once and not by the row."""
    shard, seen = Shard(), 0

    def out() -> pa.RecordBatch:
        return _batch([(d, n, refs, *best) for d, n, refs, best in shard], "digest binary, n_bytes long, refs long, points long, id long, text_key long")

    for batch in batches:
        for digest, n_bytes, *best in _rows(batch, KEY + BEST):
            seen += shard.insert(digest, n_bytes, 1, tuple(best))
            if seen >= TASK_KEYS:
                yield out()
                shard, seen = Shard(), 0
    if seen:
        yield out()


def _settle(step: str):
    """Shards after the claims; ``step`` is what a claim does to its shard."""

    def work(claims: pa.Table, state: pa.Table) -> pa.Table:
        number, entries, slots = None, [], None
        for number, digest, n_bytes, refs, *best, held in _rows(state, ["shard", *KEY, "refs", *BEST, "slots"]):
            if held is not None:
                slots = held
            else:
                entries.append([digest, n_bytes, refs, tuple(best) if best[0] is not None else None])
        shard = Shard(entries, slots)
        act = getattr(shard, step)
        for number, digest, n_bytes, refs, *best in _rows(claims, ["shard", *KEY, "refs", *BEST]):
            act(digest, n_bytes, refs, tuple(best))
        rows = [(number, d, n, refs, *(best or (None,) * 3), None) for d, n, refs, best in shard]
        rows.append((number, *[None] * 6, shard.filter.slots.tobytes()))
        return pa.Table.from_batches([_batch(rows, STATE)])

    return work


def _probe(claims: pa.Table, state: pa.Table) -> pa.Table:
    """Claims that the filter lets through, and whether the content behind it bears them out."""
    entries, slots = [], None
    for digest, n_bytes, refs, held in _rows(state, [*KEY, "refs", "slots"]):
        if held is not None:
            slots = held
        else:
            entries.append([digest, n_bytes, refs, None])
    shard, rows = Shard(entries, slots), []
    for digest, n_bytes in set(_rows(claims, KEY)):
        entry = shard.find(digest, n_bytes)
        rows.append((digest, n_bytes, digest in shard.filter, entry is not None, entry[2] if entry else 0))
    return pa.Table.from_batches([_batch(rows, PROBED)])


PROBED = "digest binary, n_bytes long, hit boolean, live boolean, refs long"


class Index:
    """Live digests of a table of texts, generation by generation.

    ``insert``, ``delete`` and ``repair`` return the next generation and leave
    this one as it is.
    """

    def __init__(self, spark: SparkSession, staged: Staged, shards: int, state: DataFrame):
        self.spark, self.staged, self.shards, self.state = spark, staged, shards, state

    @classmethod
    def empty(cls, spark: SparkSession, rows: int = 0, staged: Staged | None = None) -> Index:
        """An index meant for about so many rows; it grows beyond them by itself."""
        shards = max(LEAST_SHARDS, -(-rows // SHARD_KEYS))
        return cls(spark, staged or Staged(spark, "cuckoo"), shards, spark.createDataFrame([], STATE))

    def keys(self) -> DataFrame:
        """One row per live content: digest, n_bytes, refs and the row to stay (points, id, text_key)."""
        return self.state.where("digest IS NOT NULL").select(*KEY, "refs", *BEST)

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def _claims(self, rows: DataFrame) -> DataFrame:
        gathered = rows.select(*KEY, *BEST).mapInArrow(_gather, CLAIM.removeprefix("shard int, "))
        return gathered.select(self._shard(), *KEY, "refs", *BEST)

    def _next(self, rows: DataFrame, step: str) -> Index:
        grown = self._split()
        pairs = grown._claims(rows).groupBy("shard").cogroup(grown.state.groupBy("shard"))
        state = grown.staged.write(pairs.applyInArrow(_settle(step), STATE))
        return Index(grown.spark, grown.staged, grown.shards, state)

    def _split(self) -> Index:
        """More shards, once these hold four times what they are made for; their filters come from the stored keys."""
        if self.keys().count() <= 4 * SHARD_KEYS * self.shards:
            return self
        more = Index(self.spark, self.staged, 4 * self.shards, self.state)
        more.state = self.state.where("digest IS NOT NULL").withColumn("shard", more._shard())
        return more

    def insert(self, rows: DataFrame) -> Index:
        """Rows as ``digests`` gives them become live."""
        return self._next(rows, "insert")

    def delete(self, rows: DataFrame) -> Index:
        """Rows that were inserted are taken out; rows of other contents change nothing."""
        return self._next(rows, "delete")

    def repair(self, rows: DataFrame) -> Index:
        """Choose anew, among the rows that are left, where the one to stay was deleted."""
        return self._next(rows, "repair")

    def probe(self, rows: DataFrame) -> DataFrame:
        """Per distinct content of ``rows``: digest, n_bytes, hit (of the filter), live (verified), refs."""
        pairs = self._claims(rows).groupBy("shard").cogroup(self.state.groupBy("shard"))
        return pairs.applyInArrow(_probe, PROBED)


def groups(rows: DataFrame, index: Index) -> DataFrame:
    """``rows`` with group_size, keep_id, keep_key and kept from the index that holds them.

    Digests held by over a HOT_SHARE-th of all rows are fewer than HOT_SHARE and
    are broadcast; their rows stay where they are.
    """
    keys = index.keys().select(*KEY, F.col("refs").alias("group_size"), F.col("points").alias("most"), F.col("id").alias("keep_id"), F.col("text_key").alias("keep_key"))
    total = index.keys().agg(F.sum("refs")).first()[0] or 0
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = keys.where(is_hot)
    there = rows.join(F.broadcast(hot), KEY)
    rest = rows.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(keys.where(~is_hot), KEY)
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    return there.unionByName(rest).withColumn("kept", kept)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_key, digest, n_bytes, points, group_size, keep_id, keep_key, kept.

    Texts that agree without blanks form a group; the one with the most code
    points stays, then that of the smallest id, then of the smallest hash of its
    text. Null texts are empty and form a group with the empty and the blank
    ones; null ids come last. Rows repeated whole count each in group_size and
    share their verdict, see ``drop_copies``. Empty table: no rows. Other columns
    are not read.
    """
    spark = docs.sparkSession
    staged = Staged(spark, "cuckoo")
    rows = staged.write(digests(docs, id_col, text_col))
    return groups(rows, Index.empty(spark, rows.count(), staged).insert(rows))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left of each group, all columns as they are."""
    stay = copies(docs, id_col, text_col).where("kept").select("id", "text_key")
    return pick(docs, stay, id_col, F.xxhash64(F.col(text_col)), "left_semi", once=True)


def op11_cuckoo_dedup(spark, sf_dir: str) -> DataFrame:
    found = copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

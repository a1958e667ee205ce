"""Ranked lexical search over posting lists with range-maximum tables.

Documents are indexed in shards. In a shard, each term's posting list has a
sparse table of the greatest impact in any range of document blocks. A query
starts with the whole shard as one interval; its bound is the sum of the terms'
range maxima. Best first, an interval gives up the block of the document where
the term with the most to give has its greatest impact: that block is scored in
full, and the intervals on either side come back with their own bounds. The
search of a shard ends when no bound reaches the k-th best score so far, which a
task carries from shard to shard.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

TOP = 20
#: Documents of a block; a shard is closed at so many documents, bytes of text or postings.
BLOCK, SHARD_DOCS, SHARD_BYTES, SHARD_POSTINGS = 64, 8192, 32 << 20, 2_000_000
#: Items that are searched for together: so many, or so many bytes of text (one longer item goes alone).
ITEMS, ITEM_BYTES = 2000, 4 << 20

_BYTES = bytes(range(256))
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
TABLE = bytes.maketrans(_SEPARATORS + _BYTES[65:91], b" " * len(_SEPARATORS) + _BYTES[97:123])


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z become lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


POSTINGS = "shard long, term binary, docs array<int>, counts array<int>, ids array<long>"


class _Builder:
    """Postings of one shard; documents without a term are not counted."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.lengths, self.bytes, self.size = [], [], 0, 0
        self.of_doc, self.term, self.count = [], [], []

    def add(self, key: int | None, text: str | None) -> None:
        found = Counter(terms(text))
        if not found:
            return
        number = self.vocabulary
        self.term.append(np.array([number.setdefault(t, len(number)) for t in found], np.int32))
        self.count.append(np.fromiter(found.values(), np.int32, len(found)))
        self.ids.append(key)
        self.lengths.append(found.total())
        self.bytes += len(text)
        self.of_doc.append(len(found))
        self.size += len(found)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.bytes >= SHARD_BYTES or self.size >= SHARD_POSTINGS

    def out(self, shard: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """A row per term, and one without a term: ids and lengths of the documents."""
        term = np.concatenate(self.term)
        order = np.argsort(term, kind="stable")
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.of_doc)[order]
        counts = np.concatenate(self.count)[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.vocabulary)))]).astype(np.int32)
        n = len(self.vocabulary)
        meta = pa.RecordBatch.from_arrays(
            [
                pa.array([shard]), pa.array([None], pa.binary()), pa.array([None], pa.list_(pa.int32())),
                pa.array([self.lengths], pa.list_(pa.int32())), pa.array([self.ids], pa.list_(pa.int64())),
            ],
            NAMES,
        )
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, shard)), pa.array(list(self.vocabulary), pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(docs)), pa.ListArray.from_arrays(pa.array(ends), pa.array(counts)),
                pa.nulls(n, pa.list_(pa.int64())),
            ],
            NAMES,
        )
        return meta, rows


NAMES = ["shard", "term", "docs", "counts", "ids"]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    first, shards, shard = TaskContext.get().partitionId() << 32, 0, _Builder()
    for batch in worker.slices(batches):
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard.add(key, text)
            if shard.full():
                yield from shard.out(first + shards)
                shard, shards = _Builder(), shards + 1
    if shard.ids:
        yield from shard.out(first + shards)


def index(docs: DataFrame, staged: Staged, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Posting lists of all texts, as a Parquet table in the shared folder.

    One row per shard and term (docs: places in the shard, ascending; counts)
    and one per shard without a term (ids of its documents; counts: their
    lengths in terms). Shards are made where the documents are read; nothing is
    shuffled.
    """
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return staged.write(read.mapInArrow(_build, POSTINGS))


class ShardIndex:
    """A shard's posting lists with impacts, block pointers and range-maximum tables."""

    def __init__(self, ids: list, lengths: np.ndarray, lists: dict[bytes, tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int):
        self.ids = ids
        self.blocks = -(-len(ids) // BLOCK)
        m = 100 - 25 + (25 * lengths.astype(np.int64) * n_docs) // n_terms
        self.row = {t: i for i, t in enumerate(lists)}
        sizes = [len(d) for d, _ in lists.values()]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.docs = np.concatenate([d for d, _ in lists.values()]) if lists else np.zeros(0, np.int32)
        tf = np.concatenate([c for _, c in lists.values()]).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs])
        # Where each list enters each block, and its greatest impact there.
        place = np.repeat(np.arange(len(sizes)), sizes) * self.blocks + self.docs // BLOCK
        ends = np.cumsum(np.bincount(place, minlength=len(sizes) * self.blocks))
        self.begin = np.concatenate([[0], ends]).astype(np.int64)
        level = np.zeros(len(sizes) * self.blocks, np.int64)
        at = np.flatnonzero(np.diff(place, prepend=-1))
        if len(at):
            level[place[at]] = np.maximum.reduceat(self.impact, at)
        level = level.reshape(len(sizes), self.blocks)
        self.levels = [level]
        width = 1
        while 2 * width <= self.blocks:
            level = np.maximum(level[:, :-width], level[:, width:])
            self.levels.append(level)
            width *= 2

    def maxima(self, rows: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Greatest impact of each list among the blocks lo to hi - 1."""
        k = (hi - lo).bit_length() - 1
        level = self.levels[k]
        return np.maximum(level[rows, lo], level[rows, hi - (1 << k)])

    def scores(self, rows: np.ndarray, weights: np.ndarray, block: int) -> np.ndarray:
        """Exact scores of the documents of a block."""
        out = np.zeros(BLOCK, np.int64)
        places = rows * self.blocks + block
        begin, size = self.begin[places], self.begin[places + 1] - self.begin[places]
        total = int(size.sum())
        if total:
            skip = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            which = skip + np.arange(total)
            np.add.at(out, self.docs[which] - block * BLOCK, np.repeat(weights, size) * self.impact[which])
        return out


def search(shard: ShardIndex, rows: np.ndarray, weights: np.ndarray, best: list, top: int) -> int:
    """Bring ``best``, a heap of the (score, -id) so far, up to date with a shard; returns the blocks scored.

    ``rows`` and ``weights`` are the query's lists in the shard. An interval is
    left out only if its bound is below the k-th score: at an equal score, a
    smaller id would still count.
    """

    def bounded(lo: int, hi: int) -> tuple:
        given = weights * shard.maxima(rows, lo, hi)
        return -int(given.sum()), lo, hi, int(given.argmax())

    scored, queue = 0, [bounded(0, shard.blocks)]
    while queue:
        bound, lo, hi, lead = heapq.heappop(queue)
        if bound == 0 or len(best) == top and -bound < best[0][0]:
            break
        block = lo + int(shard.levels[0][rows[lead], lo:hi].argmax())
        found = shard.scores(rows, weights, block)
        scored += 1
        least = max(1, best[0][0]) if len(best) == top else 1
        for at in np.flatnonzero(found >= least).tolist():
            key = shard.ids[block * BLOCK + at]
            entry = (int(found[at]), -math.inf if key is None else -key)
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
        for part in ((lo, block), (block + 1, hi)):
            if part[0] < part[1]:
                heapq.heappush(queue, bounded(*part))
    return scored


def _search(queries: list[tuple[int, dict[bytes, int]]], n_docs: int, n_terms: int, top: int):
    """Tasks over shards; each passes on the best of each query among its shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: [] for number, _ in queries}
        current, ids, lengths, lists = None, None, None, {}

        def settle() -> None:
            if current is None or not lists:
                return
            shard = ShardIndex(ids, lengths, lists, n_docs, n_terms)
            for number, weights in queries:
                there = [(shard.row[t], w) for t, w in weights.items() if t in shard.row]
                if there:
                    rows, given = np.array(there, np.int64).T
                    search(shard, rows, given, best[number], top)

        for batch in batches:
            for row in range(batch.num_rows):
                key = batch.column(0)[row].as_py()
                if key != current:
                    settle()
                    current, ids, lengths, lists = key, None, None, {}
                term, counts = batch.column(1)[row].as_py(), batch.column(3)[row].values.to_numpy()
                if term is None:
                    ids, lengths = batch.column(4)[row].as_py(), counts.copy()
                else:
                    lists[term] = (batch.column(2)[row].values.to_numpy().copy(), counts.copy())
        settle()
        rows = [(n, None if i == -math.inf else -i, s) for n, heap in best.items() for s, i in heap]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return work


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items in blocks of bounded size, a row each."""
    block, size = [], 0

    def out() -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("text", pa.string())]))
        return pa.RecordBatch.from_arrays([pa.array([[{"item_id": i, "text": t} for i, t in block]], kind)], ["items"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if block and (len(block) >= ITEMS or size + len(text) > ITEM_BYTES):
                yield out()
                block, size = [], 0
            block.append((key, text))
            size += len(text)
    if block:
        yield out()


def item_blocks(items: DataFrame, staged: Staged, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(block, items): items with a text, at most ITEMS or ITEM_BYTES to a block, in the shared folder.

    Spark makes the blocks; the driver reads one of them at a time.
    """
    read = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    packed = read.mapInArrow(_blocks, "items array<struct<item_id long, text string>>")
    return staged.write(packed.select(F.monotonically_increasing_id().alias("block"), "items"))


def rank(
    docs: DataFrame, items: DataFrame, top: int = TOP,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item.

    Scores are integers and above 0; of equal ones the smaller doc_id comes
    first, a null id last. An item without a known term has no rows. Repeated
    rows of either table each count; null and empty texts have no terms. Without
    documents or items there are no rows. Other columns are not read.

    Items are taken in blocks, one search of the index each, so no task and not
    the driver ever holds all of them.
    """
    spark = docs.sparkSession
    staged = Staged(spark, "ranked")
    postings = index(docs, staged, id_col, text_col)
    blocks = item_blocks(items, staged, item_col, item_text_col)
    sums = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    n_docs, n_terms = postings.where("term IS NULL").agg(F.sum(F.size("ids")), F.sum(sums)).first()
    out = None
    for (number,) in blocks.select("block").collect() if n_docs else []:
        block = [(i.item_id, Counter(terms(i.text))) for i in blocks.where(F.col("block") == number).first().items]
        wanted = spark.createDataFrame([(t,) for t in set().union(*(c for _, c in block))], "term binary")
        # Bounded: the terms of a block of items.
        read = postings.join(F.broadcast(wanted), "term", "left_semi").select(*NAMES)
        df = {bytes(r.term): r.df for r in read.groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}
        weights = {t: weight(n_docs, n) for t, n in df.items()}
        queries = [(q, {t: c * weights[t] for t, c in found.items() if weights.get(t)}) for q, (_, found) in enumerate(block)]
        shards = read.unionByName(postings.where("term IS NULL")).repartition("shard").sortWithinPartitions("shard")
        found = shards.mapInArrow(_search(queries, n_docs, n_terms, top), "query long, doc_id long, score long")
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query long, item_id long")
        # Bounded: the items of a block.
        ranked = staged.write(ranked.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"))
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings CROSS JOIN total GROUP BY term, n_docs
),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
    FROM postings JOIN lengths USING (doc_id) JOIN weights USING (term) CROSS JOIN total
),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {TOP}
"""

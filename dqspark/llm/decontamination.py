"""Benchmark passages in documents: SimHash windows, Hamming index, exact check.

A window has as many words as the benchmark item it is held against. Windows
whose shingles are mostly in no item cannot be similar enough and are left out
before anything is computed for them. The others get a SimHash of their
weighted five-word shingles; blocks of its bits find all items of that size
whose fingerprint is within RADIUS bits; the similarity of the weighted
shingles themselves decides.

Items are dealt to blocks of bounded size in the shared folder and shipped to the
tasks block by block, so a benchmark of any size takes as many passes over the
documents as it has blocks and there is no shuffle of documents.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.rows import pick
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

WORDS, SIMILARITY = 5, 0.8
#: Bits that may differ. Texts of similarity 0.8 differ in 10 bits on average,
#: with a standard deviation of 3.
RADIUS, BLOCKS, BLOCK_BITS = 18, 8, 8
#: Items and characters that are shipped to a task at once.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
FILTER_BITS = 22

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def shingles(words: list[str], size: int = WORDS) -> list[str]:
    """Joined runs of words; fewer words than a run has make one."""
    if not words:
        return []
    n = max(1, len(words) - size + 1)
    return [" ".join(words[i : i + size]) for i in range(n)]


def weight(shingle: str) -> int:
    """Letters of a shingle: long words tell more than short ones."""
    return len(shingle) - shingle.count(" ")


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    both = sum(weight(s) * min(n, b[s]) for s, n in a.items() if s in b)
    either = sum(weight(s) * n for s, n in a.items()) + sum(weight(s) * n for s, n in b.items()) - both
    return both / either if either else 0.0


def simhash(found: list[str]) -> int:
    """Sign of the weighted sum of the shingles' hash bits."""
    hashes = np.array([xxhash.xxh64_intdigest(s) for s in found], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    weights = np.array([weight(s) for s in found])
    return int.from_bytes(np.packbits(2 * (weights @ bits) > weights.sum(), bitorder="little").tobytes(), "little")


def near_values(value: int, radius: int, width: int = BLOCK_BITS) -> list[int]:
    flips = (reduce(lambda x, bit: x ^ (1 << bit), c, 0) for r in range(radius + 1) for c in combinations(range(width), r))
    return [value ^ f for f in flips]


class HammingIndex:
    """All fingerprints within RADIUS bits of a query.

    At most RADIUS differing bits over BLOCKS blocks leave a block with at most
    RADIUS // BLOCKS of them, so looking up each block's near values misses none.
    """

    def __init__(self, prints: list[int]):
        self.prints = np.array(prints, np.uint64)
        self.tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(BLOCKS)]
        for i, p in enumerate(prints):
            for b in range(BLOCKS):
                self.tables[b][p >> (b * BLOCK_BITS) & 0xFF].append(i)

    def within(self, query: int) -> list[int]:
        found: set[int] = set()
        for b, table in enumerate(self.tables):
            for value in near_values(query >> (b * BLOCK_BITS) & 0xFF, RADIUS // BLOCKS):
                found.update(table.get(value, ()))
        some = np.fromiter(found, np.int64, len(found))
        some.sort()
        return some[np.bitwise_count(self.prints[some] ^ np.uint64(query)) <= RADIUS].tolist()


def run_hashes(words: list[str], size: int = WORDS) -> np.ndarray:
    """A number for each shingle; equal shingles have equal numbers in one process."""
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    if len(words) <= size:
        return np.array([hash(tuple(words))], np.int64).view(np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[k : len(words) - size + 1 + k]
    return out ^ (out >> np.uint64(31))


class Items:
    """Benchmark items of one block, ready to be found in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.bags, self.sizes = [], [], []
        owners, by_size = defaultdict(set), defaultdict(list)
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            found = shingles(words)
            number = len(self.ids)
            self.ids.append(key)
            self.bags.append(Counter(found))
            self.sizes.append(len(words))
            by_size[len(words)].append((number, simhash(found)))
            for h in run_hashes(words).tolist():
                owners[h].add(number)
            if len(words) == WORDS:  # one shingle, hashed as a whole text and as a run
                owners[self._as_run(words)].add(number)
        self.hashes = np.array(sorted(owners), np.uint64)
        self.owner_sizes = [sorted({self.sizes[i] for i in owners[h]}) for h in self.hashes.tolist()]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True
        self.by_size = {m: ([i for i, _ in x], HammingIndex([p for _, p in x])) for m, x in by_size.items()}
        self.short = sorted(m for m in by_size if m < WORDS)

    @staticmethod
    def _as_run(words: list[str]) -> int:
        return int(run_hashes([*words, ""])[0])

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which shingles occur in an item, and the sizes of those items."""
        hit = self.filter[self._slot(hashes)]
        at = np.flatnonzero(hit)
        if len(at):
            place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
            true = self.hashes[place] == hashes[at]
            hit[at[~true]] = False
            return hit, {m for p in np.unique(place[true]).tolist() for m in self.owner_sizes[p]}
        return hit, set()

    def find(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the passages in a text.

        Of overlapping windows for one item the most similar stays, the first
        one of equals.
        """
        words = words_of(text)
        if not words or not self.ids:
            return []
        hit, sizes = self.hits(run_hashes(words))
        best: dict[int, list[tuple[float, int, int]]] = defaultdict(list)
        if sizes:
            found = shingles(words)
            weights = np.array([weight(s) for s in found])
            mass = np.concatenate([[0], np.cumsum(weights)])
            good = np.concatenate([[0], np.cumsum(weights * hit)])
        for m in sorted(sizes):
            size = min(m, len(words))
            runs = max(1, size - WORDS + 1)
            total = mass[runs:] - mass[:-runs]
            starts = np.flatnonzero(good[runs:] - good[:-runs] >= SIMILARITY * total - 1e-9)
            self._check(found, starts[starts <= len(words) - size].tolist(), runs, m, size, best)
        for m in self.short:  # items shorter than a shingle: windows of their own size
            for start in self._short_starts(words, m):
                own = [" ".join(words[start : start + m])]
                self._check(own, [0], 1, m, m, best, start)
        out = []
        for item, windows in best.items():
            taken: list[tuple[int, int]] = []
            for score, start, size in sorted(windows, key=lambda w: (-w[0], w[1])):
                if all(start >= s + n or s >= start + size for s, n in taken):
                    taken.append((start, size))
                    out.append((self.ids[item], start, size, score))
        return sorted(out)

    def _short_starts(self, words: list[str], m: int) -> list[int]:
        known = {next(iter(self.bags[i])) for i in self.by_size[m][0]}
        return [s for s in range(len(words) - m + 1) if " ".join(words[s : s + m]) in known]

    def _check(self, found, starts, runs, m, size, best, shift=0) -> None:
        numbers, index = self.by_size[m]
        for start in starts:
            window = found[start : start + runs]
            near = index.within(simhash(window))
            bag = Counter(window) if near else None
            for k in near:
                score = similarity(self.bags[numbers[k]], bag)
                if score >= SIMILARITY - 1e-12:
                    best[numbers[k]].append((score, start + shift, size))


def blocks_of(items: DataFrame, item_col: str, staged: Staged) -> tuple[DataFrame, int]:
    """Items (block, i, t) in the shared folder, dealt to blocks at random, and how many blocks.

    A block has some BLOCK_ITEMS items and BLOCK_CHARS characters. Repeated
    items are dealt like others.
    """
    listed = items.select(F.col(item_col).cast("long").alias("i"), F.col("text").alias("t")).where("t IS NOT NULL")
    size = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")).first()
    count = -(-max(size.n * BLOCK_CHARS, size.chars * BLOCK_ITEMS) // (BLOCK_ITEMS * BLOCK_CHARS))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, count))).cast("int")
    return staged.write(listed.select(block.alias("block"), "i", "t")), count


SCHEMA = "id long, text_key long, item_id long, start long, n_words long, similarity double"


def find_passages(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """One row per benchmark passage in a row of ``docs``.

    id, text_key (tells texts of one id apart), item_id, start and n_words (of
    the window, in words), similarity (SIMILARITY at least). Words are runs of
    letters and digits, without regard to case. An item of fewer than five words
    is one shingle; a text with fewer words than an item is one window. Null
    and wordless texts and items match nothing; null ids are kept as such;
    repeated rows each give theirs. Without items or rows there are no rows.
    Other columns are not read.

    The items are staged in blocks; each block is a pass over ``docs`` whose
    findings are staged too, so the driver holds one block at a time.
    """
    key = F.xxhash64(F.col(text_col))
    read = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("text_key"), F.col(text_col).alias("text"))
    staged = Staged(docs.sparkSession, "decontamination")
    blocks, count = blocks_of(items, item_col, staged)
    found = []
    for number in range(count):
        block = [(r.i, r.t) for r in blocks.where(F.col("block") == number).select("i", "t").collect()]
        block.sort(key=lambda item: (item[0] is not None, item[0] or 0, item[1]))
        found.append(staged.write(read.mapInArrow(_search(block), SCHEMA)))
    return staged.union(found, SCHEMA)


def _search(block: list[tuple[int, str]]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(block)
        for batch in worker.slices(batches, 2048):
            rows = []
            for key, text_key, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(key, text_key, *found) for found in items.find(text)]
            kinds = [*[pa.int64()] * 5, pa.float64()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in SCHEMA.split(", ")]
            )

    return work


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns."""
    found = find_passages(docs, items, id_col, text_col).select("id", "text_key")
    return pick(docs, found, id_col, F.xxhash64(F.col(text_col)), "left_anti")


def op3_simhash_windows(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumnRenamed("id", "doc_id").drop("text_key")

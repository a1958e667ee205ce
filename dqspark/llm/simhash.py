"""Near-duplicate documents by SimHash and a table of distances to pivots.

Fingerprints within ``RADIUS`` bits are linked. Distances to many reference
fingerprints (pivots) are computed once per fingerprint. By the triangle
inequality no coordinate of two linked fingerprints differs by more than the
radius, and a coordinate whose pivots differ in one block only does not differ
at all where that block is untouched. Two flipped bits leave two of four blocks
untouched, so linked fingerprints agree in all coordinates of some two blocks:
those are the join keys. The greatest coordinate difference then discards pairs,
and the survivors' bits are counted.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm import worker
from dqspark.llm.components import components
from dqspark.llm.rows import pick
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

WORDS, SEED, RADIUS = 3, 42, 2
BLOCKS, BLOCK_BITS, PIVOTS_PER_BLOCK, WHOLE_PIVOTS = 4, 16, 8, 8
#: Cells of the pivot table with more fingerprints are linked by ``ball_links``.
CELL = 32


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """64 bits, each 1 if it is set in over half of the shingles' XXH64.

    A-Z count as lower case, words are runs without ASCII white space. Fewer
    words than a shingle has make one shingle; no word gives zero.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    size = min(words, len(found))
    starts = [0, *ends[: len(found) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], seed) for i, j in zip(starts, stops)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, fp) of each row; ``text_key`` tells texts of one id apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker.slices(batches):
            ids, keys, texts = batch.columns
            found = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(found)], ["id", "text_key", "fp"])

    key = F.xxhash64(F.col(text_col))
    read = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("text_key"), F.col(text_col).alias("text"))
    return read.mapInArrow(work, "id long, text_key long, fp long")


def _pivots() -> tuple[list[list[int]], list[int]]:
    """Reference patterns by block, and references over all 64 bits."""
    rng = random.Random(SEED)
    blocks = [[rng.getrandbits(BLOCK_BITS) for _ in range(PIVOTS_PER_BLOCK)] for _ in range(BLOCKS)]
    return blocks, [rng.getrandbits(64) for _ in range(WHOLE_PIVOTS)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def pivot_table(nodes: DataFrame) -> DataFrame:
    """Distances of ``fp``: ``block`` (packed coordinates by block) and ``whole``.

    The distance inside a block equals half the difference of the distances to
    two references that are complements of each other there and agree elsewhere,
    plus half the block's width.
    """
    by_block, whole = _pivots()
    fp = F.col("fp")

    def distance(mask: int, pivot: int) -> Column:
        return F.bit_count(fp.bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(pivot))))

    packed = []
    for b, pivots in enumerate(by_block):
        mask = ((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b)
        each = [distance(mask, p << (BLOCK_BITS * b)).cast("long") for p in pivots]
        packed.append(reduce(lambda key, d: key * (BLOCK_BITS + 1) + d, each))
    to_all = [distance((1 << 64) - 1, p).cast("int") for p in whole]
    return nodes.select("fp", F.array(*packed).alias("block"), F.array(*to_all).alias("whole"))


def links(nodes: DataFrame, staged: Staged) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp`` within RADIUS bits.

    Cells of up to CELL fingerprints are compared pair by pair. Fuller cells
    take a way without pairs, see ``ball_links``; the edges then connect the
    same components, though not every pair is listed.
    """
    pairs = list(combinations(range(BLOCKS), BLOCKS - RADIUS))
    keys = F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), *[F.col("block")[b].alias(f"k{i}") for i, b in enumerate(chosen)])
            for slot, chosen in enumerate(pairs)
        ]
    )
    names = ["slot", *[f"k{i}" for i in range(BLOCKS - RADIUS)]]
    cells = pivot_table(nodes).select("fp", "whole", F.explode(keys).alias("key")).select("fp", "whole", "key.*")
    sizes = cells.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1")
    members = staged.write(cells.join(sizes, names))
    cold = members.where(F.col("n") <= CELL)
    other = cold.select(*names, F.col("fp").alias("fp2"), F.col("whole").alias("whole2"))
    far = reduce(
        F.greatest, [F.abs(F.col("whole")[i] - F.col("whole2")[i]) for i in range(WHOLE_PIVOTS)]
    )
    matched = cold.alias("c").join(
        other.alias("o"),
        reduce(
            lambda x, y: x & y,
            [F.col(f"c.{n}") == F.col(f"o.{n}") for n in names]
            + [F.col("fp") < F.col("fp2"), far <= RADIUS, F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS],
        ),
    )
    hot = members.where(F.col("n") > CELL).select("fp").distinct()
    return matched.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).unionByName(ball_links(hot))


def ball_links(nodes: DataFrame) -> DataFrame:
    """Edges of a crowd of fingerprints without comparing pairs, for radius 2.

    Two fingerprints are within two bits exactly if some value is within one
    bit of both. Each is listed under the 65 values around it; a value has at
    most 65 fingerprints, all within two bits of each other, and a star among
    them connects them.
    """
    around = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(64)])
    listed = nodes.select("fp", F.explode(F.transform(around, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("z"))
    met = listed.groupBy("z").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_key, fp, component (smallest id reachable).

    Rows link at RADIUS or fewer differing bits; rows without a word all have
    fingerprint zero and link like any other. Repeated rows and ids each keep
    their row. Null ids never name a component: one in which all ids are null
    has a null component. Empty table: no rows. Other columns are not read.
    """
    staged = Staged(docs.sparkSession, "simhash")
    rows = staged.write(fingerprints(docs, id_col, text_col))
    nodes = staged.write(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes, staged), staged).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component"))
    of_fp = placed.join(named, "root").select("fp", "component")
    return rows.join(of_fp, "fp").select("id", "text_key", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row left of each group: that of the smallest id.

    Of rows with that id, the one with the smallest text key stays; null ids come
    last. All columns of ``docs`` are returned.
    """
    groups = near_groups(docs, id_col, text_col)
    # Null components: rows whose ids are all null are told apart by fingerprint.
    own = F.when(F.col("component").isNull(), F.col("fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    stay = groups.groupBy("component", own.alias("own")).agg(first.alias("first")).select("first.id", "first.text_key")
    return pick(docs, stay, id_col, F.xxhash64(F.col(text_col)), "left_semi", once=True)


def op7_simhash_pivots(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )

"""Near-duplicate paragraphs: MinHash banding, exact Jaccard, components.

A paragraph is a line of WORDS words or more. Equal paragraphs are one node. Nodes
that share a band of their MinHash signature are candidates; those of a similarity of
SIMILARITY or more in five-word shingles are linked; of each connected component
the paragraph first in the order of ids and lines stays.

Cells (paragraphs with one band in common) of up to CELL nodes are compared pair
by pair. In a fuller cell everything is first held against its most copied
paragraph, which usually is what the others were made from. Only nodes that this
leaves outside that paragraph's component are then compared with the whole cell,
block by block.

A passage inside a longer line is no line, so lines of over LONG words are also
cut into parts where their words say so: at the least hash of two neighbouring
words in any stretch of WINDOW. The cuts inside a passage are the same wherever
it stands, and any 2 * WINDOW words have two of them at least. Parts are compared
as wholes: those of LEAST_PART words or more that an earlier place has too go.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.llm import worker
from dqspark.llm.components import components
from dqspark.llm.rows import column, fresh
from dqspark.llm.staging import Staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

WORDS, SIMILARITY, ROWS, RECALL, SEED = 5, 0.8, 3, 0.99, 11
CELL, PROBES, MEMBERS = 32, 256, 1024
#: Words from which on a line is also cut, words between cuts at most, words of a part that counts.
LONG, WINDOW, LEAST_PART = 60, 24, 8
MEMO = 300_000

_words = re.compile(r"\w+").findall


def tuned_bands(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands after which a pair of just ``similarity`` has met with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = tuned_bands()
_rng = np.random.default_rng(SEED)
_TIMES = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < MEMO:
            self[word] = value
        return value


def lines_of(text: str | None) -> list[tuple[int, list[str]]]:
    """Number and words of each line of WORDS words or more, without regard to case."""
    found = ((i, _words(line)) for i, line in enumerate((text or "").lower().split("\n")))
    return [(i, w) for i, w in found if len(w) >= WORDS]


def node_of(words: list[str]) -> int:
    value = xxhash.xxh64_intdigest(" ".join(words), SEED)
    return value - (1 << 64) if value >> 63 else value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def part_cuts(words: list[str], known: WordHashes) -> np.ndarray:
    """First words of the parts of a line, and the number of its words."""
    each = np.fromiter((known[w] for w in words), np.uint64, len(words))
    pairs = _mixed(each[:-1] * _MIX + each[1:])
    views = np.lib.stride_tricks.sliding_window_view(pairs, WINDOW)
    return np.unique(np.concatenate([[0], np.arange(len(views)) + views.argmin(axis=1), [len(words)]]))


def run_hashes(paragraphs: list[list[str]], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of paragraphs of WORDS words or more, and where each starts."""
    sizes = np.array([len(p) for p in paragraphs])
    each = np.fromiter((known[w] for p in paragraphs for w in p), np.uint64, int(sizes.sum()))
    n = len(each) - WORDS + 1
    rolled = np.zeros(n, np.uint64)
    for k in range(WORDS):
        rolled = rolled * _MIX + each[k : n + k]
    runs = sizes - WORDS + 1
    starts = np.cumsum(runs) - runs
    at = np.arange(int(runs.sum())) + np.repeat(np.cumsum(sizes) - sizes - starts, runs)
    return _mixed(rolled[at]), starts


def band_keys(paragraphs: list[list[str]], known: WordHashes) -> np.ndarray:
    """A key for each paragraph and band; equal signatures of a band have equal keys."""
    hashes, starts = run_hashes(paragraphs, known)
    keys = np.empty((len(paragraphs), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(paragraphs), band + 1, np.uint64)
        for r in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat(hashes * _TIMES[r] + _PLUS[r], starts)
            key = _mixed(key * _MIX + least)
        keys[:, band] = key
    return keys.view(np.int64)


PARTS = "id long, text_key long, line int, start int, stop int, node long"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of all long lines; ``start`` and ``stop`` count words."""
    known = WordHashes()
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.int64()]
    names = [c.split()[0] for c in PARTS.split(", ")]
    for batch in worker.slices(batches, 128):
        rows = []
        for key, text_key, text in zip(*(c.to_pylist() for c in batch.columns)):
            for line, words in lines_of(text):
                if len(words) > LONG:
                    cuts = part_cuts(words, known).tolist()
                    both = zip(cuts, cuts[1:])
                    rows += [(key, text_key, line, i, j, node_of(words[i:j])) for i, j in both if j - i >= LEAST_PART]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], names)


def repeated_parts(read: DataFrame, staged: Staged) -> DataFrame:
    """(id, text_key, parts): the parts that stand in an earlier place too, with that place.

    ``read`` has id, text_key and text.
    """
    rows = staged.write(read.mapInArrow(_parts, PARTS))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "line", "start", "text_key")
    first = rows.groupBy("node").agg(F.count("*").alias("copies"), F.min(place).alias("first")).where("copies > 1").drop("copies")
    found = rows.join(first, "node").where(~place.eqNullSafe(F.col("first")))
    told = [F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "line", "start")]
    out = staged.write(
        found.groupBy("id", "text_key").agg(F.sort_array(F.collect_set(F.struct("line", "start", "stop", *told))).alias("parts"))
    )
    staged.drop(rows)
    staged.free()
    return out


PARAGRAPHS = "row long, id long, text_key long, line int, node long, bands array<long>"


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every paragraph of every row; a row without one gives a row with line -1."""
    known, number = WordHashes(), TaskContext.get().partitionId() << 33
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    for batch in worker.slices(batches, 128):
        rows, long, where = [], [], []
        for key, text_key, text in zip(*(c.to_pylist() for c in batch.columns)):
            lines = lines_of(text)
            for line, words in lines:
                where.append(len(rows))
                long.append(words)
                rows.append([number, key, text_key, line, node_of(words), None])
            if not lines:
                rows.append([number, key, text_key, -1, None, None])
            number += 1
        if long:
            for at, keys in zip(where, band_keys(long, known)):
                rows[at][5] = keys
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in PARAGRAPHS.split(", ")])


BODIES = "node long, body array<long>"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingle hashes of the wanted lines of each text."""
    known = WordHashes()
    for batch in worker.slices(batches, 128):
        nodes, bodies = [], []
        for text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            lines = dict(lines_of(text))
            for w in wanted:
                nodes.append(w["node"])
                bodies.append(np.unique(run_hashes([lines[w["line"]]], known)[0]).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(bodies, pa.list_(pa.int64()))], ["node", "body"])


def verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches SIMILARITY."""
    one = bodies.select(F.col("node").alias("a"), F.col("body").alias("body_a"))
    other = bodies.select(F.col("node").alias("b"), F.col("body").alias("body_b"))
    size_a, size_b = F.size("body_a"), F.size("body_b")
    sizes_fit = (F.least(size_a, size_b) >= SIMILARITY * F.greatest(size_a, size_b))
    common = F.size(F.array_intersect("body_a", "body_b"))
    met = pairs.join(one, "a").join(other, "b").where(sizes_fit).withColumn("common", common)
    return met.where(F.col("common") >= SIMILARITY * (size_a + size_b - F.col("common")) - 1e-9).select("a", "b")


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Links from the probes to the members of two blocks, one for each component of members."""
    probes, members = frame[frame["probe"]], frame[~frame["probe"]]
    where: dict[int, list[int]] = {}
    sizes = np.array([len(b) for b in members["body"]])
    groups = members["root"].to_numpy()
    nodes = members["node"].to_numpy()
    for i, body in enumerate(members["body"]):
        for h in body.tolist():
            where.setdefault(h, []).append(i)
    out = []
    for node, root, body in zip(probes["node"], probes["root"], probes["body"]):
        common = np.zeros(len(members), np.int64)
        for h in body.tolist():
            if h in where:
                common[where[h]] += 1
        near = (common >= SIMILARITY * (sizes + len(body) - common) - 1e-9) & (groups != root)
        for i in np.flatnonzero(near)[np.unique(groups[near], return_index=True)[1]]:
            out.append((node, nodes[i]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def links(nodes: DataFrame, docs: DataFrame, staged: Staged) -> DataFrame:
    """Edges (a, b) of ``nodes`` (node, copies, at, bands) that connect what is similar.

    ``at`` (id, text_key, line) is a place of the node in ``docs`` (id, text_key, text).
    """
    cells = nodes.where("bands IS NOT NULL").select("node", "copies", F.explode("bands").alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.struct("copies", "node")).alias("top")).where("n > 1")
    members = staged.write(cells.join(sizes, "cell").select("cell", "node", "n", F.col("top.node").alias("leader")))
    staged.free()
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    places = wanted.select("at.id", "at.text_key", F.struct("node", "at.line").alias("w"))
    by_text = places.groupBy("id", "text_key").agg(F.collect_list("w").alias("wanted"))
    by_text = by_text.withColumnsRenamed({"id": "_id", "text_key": "_key"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    texts = docs.join(by_text, same).select("text", "wanted")
    # Rows that are equal in all give a node twice.
    bodies = staged.write(texts.mapInArrow(_bodies, BODIES).dropDuplicates(["node"]))
    staged.free()
    cold = members.where(F.col("n") <= CELL).select("cell", "node")
    pairs = cold.select("cell", F.col("node").alias("a")).join(cold.select("cell", F.col("node").alias("b")), "cell").where("a < b")
    hot = members.where(F.col("n") > CELL)
    spokes = hot.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    candidates = pairs.select("a", "b").unionByName(spokes).distinct()
    found = staged.write(verified(candidates, bodies))
    staged.free()
    if hot.isEmpty():
        return found
    roots = staged.write(components(found, staged))
    place = lambda c: F.coalesce(F.col(c), F.col("node"))
    placed = hot.join(roots, "node", "left").select("cell", "node", "leader", place("root").alias("root"))
    led = roots.select(F.col("node").alias("leader"), F.col("root").alias("leader_root"))
    placed = staged.write(placed.join(led, "leader", "left").withColumn("leader_root", F.coalesce("leader_root", "leader")))
    outside = placed.where("root <> leader_root").select("cell", "node", "root")
    return found.unionByName(compared(outside, placed.select("cell", "node", "root"), bodies, staged))


def compared(probes: DataFrame, members: DataFrame, bodies: DataFrame, staged: Staged) -> DataFrame:
    """Links between ``probes`` and ``members`` of one cell that lie in different components.

    Probes and members of a cell are dealt into blocks of about PROBES and
    MEMBERS nodes, every block of the one meets every block of the other, and
    each meeting is a group of bounded size that yields few rows.
    """
    counts = probes.groupBy("cell").agg(F.count("*").alias("probes"))
    whole = members.join(counts, "cell").groupBy("cell", "probes").agg(F.count("*").alias("members"))
    blocks = staged.write(
        whole.select("cell", F.ceil(F.col("probes") / PROBES).cast("int").alias("p"), F.ceil(F.col("members") / MEMBERS).cast("int").alias("m"))
    )
    spread = F.xxhash64("node", "cell")
    dealt = lambda n: F.pmod(spread, n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = probes.join(blocks, "cell").select("cell", "node", "root", dealt(F.col("p")).alias("i"), every(F.col("m")).alias("j"), F.lit(True).alias("probe"))
    right = members.join(blocks, "cell").select("cell", "node", "root", every(F.col("p")).alias("i"), dealt(F.col("m")).alias("j"), F.lit(False).alias("probe"))
    rows = left.unionByName(right).join(bodies, "node")
    return rows.groupBy("cell", "i", "j").applyInPandas(_compare, "a long, b long")


def near_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text_key, n_paragraphs, removed, parts.

    ``removed`` lists line (from 0), first_id and first_line (the paragraph that
    stays for it), sorted by line. Paragraphs that share the place of the one
    that stays, as in rows of equal id, stay too. Null ids come last. Lines of
    fewer than five words are no paragraphs and stay. ``parts`` lists the
    repeated parts of the long lines that are not removed: line, start and stop
    (in words), first_id, first_line and first_start. Null and wordless texts
    have neither. No rows give no rows. Other columns are not read.
    """
    staged = Staged(docs.sparkSession, "paragraphs")
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    parts = repeated_parts(read, staged)
    found = staged.write(read.mapInArrow(_paragraphs, PARAGRAPHS))
    here = found.where("line >= 0")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "line", "text_key")
    nodes = staged.write(
        here.groupBy("node").agg(F.count("*").alias("copies"), F.min(order).alias("at"), F.first("bands", True).alias("bands"))
    )
    staged.free()
    roots = components(links(nodes, read, staged), staged)
    placed = nodes.where("copies > 1").select("node", "at").unionByName(
        nodes.where("copies = 1").join(roots.select("node"), "node", "left_semi").select("node", "at")
    )
    placed = staged.write(placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = placed.groupBy("root").agg(F.min("at").alias("first"))
    stays = placed.join(least, "root").select("node", "first")
    told = found.join(stays, "node", "left")
    own = F.struct(F.col("id").isNull().alias("no_id"), "id", "line")
    kept = F.struct("first.no_id", "first.id", "first.line")
    gone = F.when(
        F.col("first").isNotNull() & ~own.eqNullSafe(kept),
        F.struct("line", F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line")),
    )
    by_row = told.groupBy("row").agg(
        F.first("id").alias("id"),
        F.first("text_key").alias("text_key"),
        F.sum((F.col("line") >= 0).cast("long")).alias("n_paragraphs"),
        F.sort_array(F.collect_list(gone)).alias("removed"),
    )
    parts = parts.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "parts")
    joined = by_row.join(parts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    left = F.filter("parts", lambda p: ~F.array_contains(F.col("removed.line"), p["line"]))
    none = F.array().cast(joined.schema["parts"].dataType)
    return joined.select("id", "text_key", "n_paragraphs", "removed", F.coalesce(left, none).alias("parts"))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, lines: pd.Series, parts: pd.Series) -> pd.Series:
    """Texts without some lines, and without some stretches of words in the other lines."""

    def one(text: str | None, lines: list | None, parts: list | None) -> str | None:
        if text is None or lines is None:
            return text
        gone, out = set(lines), []
        for number, line in enumerate(text.split("\n")):
            if number in gone:
                continue
            cut = [p for p in parts if p["line"] == number]
            if cut:
                # Lower case may have other lengths, not other words.
                words = [m.span() for m in re.finditer(r"\w+", line)]
                at, kept = 0, []
                for p in cut:
                    kept.append(line[at : words[p["start"]][0]])
                    at = words[p["stop"]][0] if p["stop"] < len(words) else len(line)
                line = "".join([*kept, line[at:]])
            out.append(line)
        return "\n".join(out)

    return pd.Series([one(*row) for row in zip(texts, lines, parts)], dtype="object")


def drop_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that near-duplicate an earlier paragraph and without repeated parts; no row is dropped."""
    gone = near_paragraphs(docs, id_col, text_col).where((F.size("removed") > 0) | (F.size("parts") > 0))
    key, other_id, other_key, lines, parts = fresh(docs, "_key", "_other_id", "_other_key", "_lines", "_parts")
    gone = gone.select(
        column("id").alias(other_id), column("text_key").alias(other_key), F.col("removed.line").alias(lines), column("parts").alias(parts)
    )
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(column(text_col), F.lit(""))))
    same = column(id_col).eqNullSafe(column(other_id)) & (column(key) == column(other_key))
    joined = keyed.join(gone.dropDuplicates([other_id, other_key]), same, "left")
    text = _without(column(text_col), column(lines), column(parts))
    return joined.withColumn(text_col, text).select(*[column(c) for c in docs.columns])


def op8_paragraph_minhash(spark, sf_dir: str) -> DataFrame:
    found = near_paragraphs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_paragraphs",
        (F.size("removed") + F.size("parts")).cast("long").alias("n_removed"),
        F.col("removed.line").alias("removed_lines"),
        F.col("removed.first_id").alias("first_doc_ids"),
        F.col("removed.first_line").alias("first_lines"),
        F.col("parts.line").alias("part_lines"),
        F.col("parts.start").alias("part_starts"),
        F.col("parts.first_id").alias("part_first_doc_ids"),
    )

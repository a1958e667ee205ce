"""Pack tokenised examples into training sequences under several limits at once.

Vector bin packing: an example has a size in three dimensions (tokens, one
segment, loss-bearing tokens), a sequence has a limit in each. Sequences are
filled one after the other; each time the example that fits and has the largest
weighted dot product with the room left goes in next (Panigrahy, Talwar, Uyeda
and Wieder, 2011).

Each partition packs its own examples as they stream by, so there is no shuffle
and a task holds a bounded buffer. The last sequences of a partition are the
only ones that lack company.
"""

from __future__ import annotations

import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.llm import worker

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(worker)

EOS = 1
#: Pieces a task keeps to choose from, and at which number it closes sequences.
KEEP, FLUSH = 8192, 16384


class Encoder:
    """Ids of a byte-level BPE vocabulary given as a tokenizer file and as ranks.

    The ranks hold the same vocabulary and are read three times as fast. Texts
    with characters whose class could differ between the two readers (anything
    but Latin letters, digits, common signs and line breaks) take the tokenizer
    file, as the definition of the ids.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import base64
        import os
        import re

        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.n_bytes = np.zeros(max(table.values()) + 1, np.int64)
        for token, number in table.items():
            self.n_bytes[number] = len(token)
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.odd = re.compile("[^\x20-\x7e\n\t¡-ɏ]").search
        self.tokenizer, self.slow = tokenizer, None

    def ids(self, text: str) -> np.ndarray:
        if not self.odd(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.tokenizer)
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")

    def leading(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many of the ids begin within the first bytes of their text."""
        sizes = self.n_bytes[ids[:n_bytes]]
        return int(np.searchsorted(np.cumsum(sizes) - sizes, n_bytes))


def encoder(tokenizer: str, ranks: str, pattern: str) -> Encoder:
    return worker.kept(("encoder", tokenizer, ranks), lambda: Encoder(tokenizer, ranks, pattern))


@dataclass
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("each limit must be 1 or more")


#: Limits of the query: each of them closes sequences, at about 1 % of padding.
INSTRUCTIONS = Limits(2048, 10, 2016)


@dataclass
class Packer:
    """Pieces waiting for a sequence, grouped by their size (tokens, loss)."""

    limits: Limits
    waiting: dict[tuple[int, int], list] = field(default_factory=lambda: defaultdict(list))
    count: int = 0

    def add(self, tokens: int, loss: int, piece: object) -> None:
        self.waiting[tokens, loss].append(piece)
        self.count += 1

    def close(self, keep: int) -> Iterator[list]:
        """Sequences (lists of pieces) until at most ``keep`` pieces wait."""
        limits = self.limits
        kinds = sorted(self.waiting, reverse=True)
        left = np.array([len(self.waiting[k]) for k in kinds])
        tokens, loss = (np.array([k[i] for k in kinds], float) for i in (0, 1))
        while self.count > keep:
            if 2 * np.count_nonzero(left) < len(left):
                kept = np.flatnonzero(left)
                kinds, left, tokens, loss = [kinds[i] for i in kept], left[kept], tokens[kept], loss[kept]
            # What is still to be placed weighs each dimension.
            by_tokens = tokens * (left @ tokens) / limits.tokens**3
            by_loss = loss * (left @ loss) / limits.loss**3
            by_segment = left.sum() / limits.segments**3
            room_tokens, room_loss, chosen = limits.tokens, limits.loss, []
            while len(chosen) < limits.segments:
                first = int(np.searchsorted(-tokens, -room_tokens))  # the larger ones do not fit
                fits = (left[first:] > 0) & (loss[first:] <= room_loss)
                value = by_tokens[first:] * room_tokens + by_loss[first:] * room_loss
                value = np.where(fits, value + by_segment * (limits.segments - len(chosen)), -1.0)
                best = int(value.argmax()) if len(value) else 0
                if not len(value) or value[best] < 0:
                    break
                best += first
                chosen.append(self.waiting[kinds[best]].pop())
                left[best] -= 1
                room_tokens -= kinds[best][0]
                room_loss -= kinds[best][1]
            self.count -= len(chosen)
            yield chosen
        self.waiting = defaultdict(list, {k: v for k, v in self.waiting.items() if v})


def cuts(total: int, prompt: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
    """(start, length, loss-bearing tokens) of the pieces of one example."""
    start = 0
    while start < total:
        stop = min(total, start + limits.tokens, max(start, prompt) + limits.loss)
        yield start, stop - start, max(0, stop - max(start, prompt))
        start = stop


COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
    "sequence_id long, offset long"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    lead: Column | None = None,
    limits: Limits | None = None,
    eos: int = EOS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of an example, with its sequence and its place there.

    The ids of an example are those of its prompt (``prompt_col``; none by
    default), which bear no loss, of its text, and ``eos``. ``lead`` is the number
    of characters at the beginning of the text, null for none, that are an
    instruction too: ids that begin there bear no loss. An example beyond a
    limit is cut; each id is in exactly one piece. ``with_ids`` adds the ids.
    Null prompts and texts are empty (one id); null and repeated ids of rows are
    allowed, as rows are packed one by one. No rows give no rows. Other columns
    of ``docs`` are not read. Sequence ids are unique and stable when a lost
    partition is read again.
    """
    limits = limits or Limits()
    schema = COLUMNS + (", ids array<int>" if with_ids else "")
    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = encoder(tokenizer, ranks, pattern)
        packer, sequence = Packer(limits), TaskContext.get().partitionId() << 33

        def written(keep: int) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows = []
            for chosen in packer.close(keep):
                offset = 0
                for piece in chosen:
                    rows.append((*piece[:6], sequence, offset, *piece[6:]))
                    offset += piece[2]
                sequence += 1
                if len(rows) >= 4096:
                    yield as_batch(rows)
                    rows = []
            if rows:
                yield as_batch(rows)

        def as_batch(rows: list) -> pa.RecordBatch:
            values = list(zip(*rows))
            arrays = [pa.array(v, pa.int64()) for v in values[:8]]
            arrays += [pa.array(v, pa.list_(pa.int32())) for v in values[8:]]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

        for batch in worker.slices(batches):
            for key, head, text, n_lead in zip(*(c.to_pylist() for c in batch.columns)):
                parts = [read.ids(x) for x in (head or "", text or "")]
                free = len(parts[0])
                if n_lead and text:
                    free += read.leading(parts[1], len(text[:n_lead].encode("utf-8", "surrogatepass")))
                ids = np.concatenate([*parts, np.array([eos], "<u4")])
                for start, length, loss in cuts(len(ids), free, limits):
                    piece = ids[start : start + length]
                    row = (key, start, length, zlib.crc32(piece.tobytes()), len(ids), loss)
                    packer.add(length, loss, (*row, piece.astype(np.int32)) if with_ids else row)
            if packer.count >= FLUSH:
                yield from written(KEEP)
        yield from written(0)

    read = docs.select(
        F.col(id_col).cast("long").alias("id"),
        prompt.alias("prompt"),
        F.col(text_col).alias("text"),
        (F.lit(None) if lead is None else lead).cast("int").alias("lead"),
    )
    return read.mapInArrow(work, schema)


def public_encoding() -> tuple[str, str, str]:
    """Paths of the installed byte-level vocabulary and its splitting pattern."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def first_line(text_col: str = "text") -> Column:
    """Characters of the first line and its end, for texts of several lines; else none."""
    text = F.col(text_col)
    return F.when(F.contains(text, F.lit("\n")), F.length(F.substring_index(text, "\n", 1)) + 1).otherwise(0)


def op1_vector_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, *public_encoding(), lead=first_line(), limits=INSTRUCTIONS)

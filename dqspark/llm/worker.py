"""Things a Python worker keeps between tasks, and slices of Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE = 256


def kept(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, once per worker process and key.

    The operators' modules reach the workers by value and start afresh in each
    task, so the store is a module of its own.
    """
    store = sys.modules.setdefault("_dqspark_worker", types.ModuleType("_dqspark_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``size`` rows, to bound copies of texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)

"""Vectorised text helpers for code that runs inside ``mapInArrow`` tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Texts of a slice lie one after the other in one byte array; null counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text handled at once. One longer text forms a slice of its own.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every other."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def joined(parts: Sequence[np.ndarray]) -> np.ndarray:
    """One hash for each row of several hash columns; their order counts."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mix(out * np.uint64(3) + p)
    return out


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        bases = np.full(n, _BASE)
        unbases = np.full(n, _UNBASE)
        bases[0] = unbases[0] = 1
        _powers = np.cumprod(bases), np.cumprod(unbases)
    return _powers


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each text in them."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes stay."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes that are not ``breaks``."""
    inside = ~breaks[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[filled] |= inside[filled]
    last = filled[1:] - 1
    ends[last] |= inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every line, empty ones too; a text of n line feeds has n + 1."""
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    of = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    of = np.sort(of, kind="stable")
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    if len(start):
        final = np.flatnonzero(np.diff(of, append=len(offsets)) > 0)
        end[final] = offsets[of[final] + 1]
    return start, end, of


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever the span lies."""
    power, unpower = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * unpower[start] + (end - start).astype(np.uint64))


def per_text(of: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of ``values``, by text number."""
    return np.bincount(of, values, n).astype(np.int64) if values is not None else np.bincount(of, minlength=n)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all spans one after the other."""
    total = int(length.sum())
    shift = np.repeat(start - np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64), length)
    return np.arange(total) + shift


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``most`` bytes of ``column``, or one row."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def map_text(
    df: DataFrame, text: str, fields: list[T.StructField], work: Callable[[pa.RecordBatch], list[pa.Array]],
    keep: Sequence[str] | None = None, most: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` with the columns ``fields`` that ``work`` makes from slices of rows.

    ``keep`` names the input columns that stay (all by default); an input column with the name of a
    new one is replaced. Rows neither move nor change in number.
    """
    new = {f.name for f in fields}
    stay = [n for n in (df.columns if keep is None else keep) if n not in new]
    schema = T.StructType([df.schema[n] for n in stay] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, most):
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in stay] + work(part), names=stay + [f.name for f in fields]
                )

    return df.mapInArrow(run, schema)

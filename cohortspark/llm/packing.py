"""Best-fit packing of token sequences, certified by lower bounds.

Texts become token ids with an end mark; texts longer than a sequence are cut into full pieces, the first of which
may be shorter. Full pieces fill a sequence each. All others are dealt out evenly over partitions, and each
partition packs its pieces by best-fit decreasing. Dual feasible functions give a lower bound on the number of
sequences that any packing of a partition needs. Where a partition is above its bound by any fraction, it hands the
pieces of its emptiest sequences on; what was handed on is dealt out anew and packed again, until one partition
holds all of it or the bound over all pieces is met. What is handed on shrinks to a third in every round.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .words import flat, ranges, slices

CAPACITY = 1024
#: Pieces that one task packs.
PACK_ROWS = 50_000
#: A partition above its bound hands on one in so many of its sequences, the emptiest ones.
HANDED = 3
#: Largest k of the dual feasible functions of steps.
STEPS = 20
#: Distinct chunks of text whose ids a task remembers before it starts anew.
CACHE_CHUNKS = 300_000
ENCODE_BYTES = 3 << 20

#: Fixed value: the pattern by which byte-level tokenizers of this kind part a text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of printable ASCII, line feeds and letters with accents.
_PLAIN = bytes([10, *range(0x20, 0x7F), 0xC3, *range(0x80, 0xC0)])
#: Bytes beside which a lone blank surely ends a token: printable ASCII, and letters with accents (bytes C3 80 to C3 BF).
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True


@dataclass(frozen=True)
class Settings:
    """``end``: the id put after every text, or None."""

    tokenizer: str = ""
    end: int | None = 2
    capacity: int = CAPACITY


class Encoder:
    """Token ids by the tokenizers library, each distinct chunk of text once.

    Text is cut before a lone space or line feed between solid characters. A byte-level tokenizer's pattern never
    takes a token across such a place, so the ids of the chunks are those of the whole. Chunks of plain letters go
    through tiktoken with the ranks of the same file, which gives the same ids in a quarter of the time; all others,
    and any that may hold a special token, go through tokenizers.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = self.tokenizer.pre_tokenizer.__class__.__name__
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if kind != "ByteLevel" or self.tokenizer.normalizer is not None or any(re.search(r"\s", s) for s in special):
            raise ValueError("a byte-level tokenizer without normalizer or special tokens with blanks is needed")
        self.special = [s.encode() for s in special]
        self.quick = self._by_ranks(special)
        self.forget()

    def _by_ranks(self, special: list[str]):
        """The same vocabulary for tiktoken, or None where merges and ids are not in one order."""
        model = json.loads(self.tokenizer.to_str())["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [model["vocab"].get(a + b) for a, b in pairs]
        if model["type"] != "BPE" or None in made or made != sorted(made):
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, chunks: list[bytes]) -> list[list[int]]:
        plain = [self.quick is not None and not c.translate(None, _PLAIN) and not any(s in c for s in self.special) for c in chunks]
        slow = [c.decode() for c, p in zip(chunks, plain, strict=True) if not p]
        slow = iter([e.ids for e in self.tokenizer.encode_batch(slow, add_special_tokens=False)] if slow else [])
        return [self.quick.encode_ordinary(c.decode()) if p else next(slow) for c, p in zip(chunks, plain, strict=True)]

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        found = self._ids(chunks)
        length = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.uint32, int(length.sum()))
        base = len(self.known)
        self.known.update((c, base + k) for k, c in enumerate(chunks))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pool = np.concatenate([self.pool, ids])

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where chunks begin: at every text that is not empty and at every safe place."""
        before = _SOLID[data]
        after = before | (data == 0xC3)
        before[1:] |= (data[1:] >= 0x80) & (data[:-1] == 0xC3)
        out = np.zeros(len(data) + 1, bool)
        out[1:-2] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & before[:-2] & after[2:]
        texts = offsets[:-1][offsets[1:] > offsets[:-1]]
        for edge in (texts, texts - 1):  # a blank at either end of a text has no neighbour there
            out[edge[edge >= 0]] = False
        out[texts] = True
        return np.flatnonzero(out[:-1])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and how many each text has."""
        data, offsets = flat(texts)
        start = self.cuts(data, offsets) if len(data) else np.zeros(0, np.int64)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        bounds = np.append(start, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHE_CHUNKS:
            self.forget()
        missing = [c for c in distinct if c not in self.known]
        if missing:
            self._learn(missing)
        of = np.array([self.known[c] for c in distinct], np.int64)[coded.indices.to_numpy()]
        length = self.length[of]
        total = np.concatenate([[0], np.cumsum(length)])
        return self.pool[ranges(self.start[of], length)], np.diff(total[np.searchsorted(start, offsets)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, settings: Settings, text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each piece of each text: the other columns of ``docs``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A null text is an empty one, a single end mark (and no piece at all where there is no end mark).
    """
    made = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    stay = [c for c in docs.columns if c not in made and c != text]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType())]
    schema = T.StructType([docs.schema[c] for c in stay] + [T.StructField(n, k) for n, k in zip(made, kinds, strict=False)])
    end, most = settings.end, settings.capacity

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = encoder(settings.tokenizer).encode(part.column(text))
        if end is not None:
            ids = np.insert(ids, np.cumsum(lengths), end)
            lengths = lengths + 1
        count = -(-lengths // most)
        of = np.repeat(np.arange(len(lengths)), count)
        piece = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        first = lengths - (count - 1) * most  # the length of the first piece
        start = np.where(piece == 0, 0, first[of] + (piece - 1) * most)
        length = np.where(piece == 0, first[of], most)
        raw = np.ascontiguousarray(ids, "<u4")
        bounds = np.concatenate([[0], np.cumsum(length)])
        view = memoryview(raw).cast("B")
        crc = [zlib.crc32(view[4 * a: 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        out = [part.column(c).take(pa.array(of)) for c in stay]
        out += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        if with_ids:
            out.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))))
        return pa.RecordBatch.from_arrays(out, names=stay + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, ENCODE_BYTES):
                yield cut(part)

    return docs.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item, its offset there, and what is left of each bin.

    Bins are kept by the room they have left; one bit per room says where there are any.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets, room = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = open_ >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                open_ ^= 1 << left
        else:
            b, left = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        left -= size
        room[b] = left
        if left:
            by_room[left].append(b)
            open_ |= 1 << left
    return bins, offsets, np.array(room, np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> float:
    """The most that a dual feasible function says of items given as counts by length (0 to capacity).

    A dual feasible function maps lengths so that no bin's lengths map to more than 1 in all; the sum over all
    items is then at least needed. Two families are tried: one rounds to k-ths; the other takes lengths over
    capacity - e as whole bins and drops those under e.
    """
    x = np.arange(capacity + 1)
    best = float((counts * x).sum()) / capacity
    for k in range(1, STEPS + 1):
        up = (k + 1) * x
        value = np.where(up % capacity == 0, x / capacity, (up // capacity) / k)
        best = max(best, float((counts * value).sum()))
    mass = np.cumsum(counts * x)
    number = np.cumsum(counts)
    e = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - e]
    between = mass[capacity - e] - mass[e - 1]
    return max(best, float((whole + between / capacity).max()))


def needed(bound: float) -> int:
    """The least whole number of sequences that a bound allows."""
    return int(np.ceil(bound - 1e-6))


def _packed(items: DataFrame, capacity: int, turn: int, partitions: int) -> DataFrame:
    """Items of each partition with their sequence and offset; ``again`` marks those handed on."""
    schema = T.StructType([f for f in items.schema if f.name not in ("sequence_id", "offset", "again")] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("again", T.BooleanType())])
    stay = [f.name for f in schema][:-3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        lengths = rows.column("length").to_numpy()
        bins, offsets, room = best_fit(lengths, capacity)
        gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        handed = np.zeros(len(room), bool)
        if gap > 1e-6 and partitions > 1:
            handed[np.argsort(-room, kind="stable")[: max(2 + 2 * needed(gap), len(room) // HANDED)]] = True
            handed &= room > 0
        part = TaskContext.get().partitionId()
        out = rows.select(stay).append_column("sequence_id", pa.array((turn << 55) + (part << 27) + bins))
        out = out.append_column("offset", pa.array(offsets)).append_column("again", pa.array(handed[bins]))
        yield from out.to_batches()

    return items.select(*stay).repartition(partitions).mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int = CAPACITY, pack_rows: int = PACK_ROWS) -> DataFrame:
    """``items`` (a column ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``: gapless from 0 in each sequence.

    Rows may repeat, and their other columns may hold anything. An empty table gives no rows; input columns with the
    names above or ``again`` are replaced. A length outside the range is an error.
    """
    items = items.drop("sequence_id", "offset", "again")
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths from 1 to {capacity} are needed")
    whole = counts.pop(capacity, 0)
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    bound = needed(lower_bound(histogram, capacity))
    full = items.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id() - F.lit(1 << 62), "offset": F.lit(0).cast("long")})
    done, rest, n, turn = [full] if whole else [], items.filter(F.col("length") < capacity), int(histogram.sum()), 0
    while n:
        turn += 1
        partitions = -(-n // pack_rows)
        tried = written(_packed(rest, capacity, turn, partitions), "packed")
        told = tried.agg(F.count_if("again"), F.count_distinct("sequence_id")).first()
        if partitions == 1 or not told[0] or (not done[1:] and told[1] == bound):
            done.append(tried.drop("again"))
            break
        done.append(tried.filter("NOT again").drop("again"))
        rest, n = tried.filter("again").drop("sequence_id", "offset", "again"), told[0]
    if not done:
        return full
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, settings: Settings, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every text with their place in a sequence. See :func:`pieces` and :func:`pack`.

    A null text is an empty one; repeated rows are packed each; an empty table gives no rows.
    """
    return pack(written(pieces(docs, settings, text, with_ids), "pieces"), settings.capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of every sequence, from pieces packed with their ids; a sequence is bounded by its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))

"""SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

Normalised text is cut into words where a space follows something else; no piece of the model spans such a
place, so words are encoded one by one and each distinct word once. All words of a slice are merged at the
same time: symbols lie in one flat array; a round takes the best pair rank of every word, merges its
occurrences from the left, recomputes the ranks beside them and takes finished words out.

The library merges one pair at a time. A round that merges several equal pairs gives the same result unless a
merged symbol could at once join a neighbour at a better rank; words where that happens merge only the
leftmost pair in that round.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import flat, map_text, ranges

#: The character that stands for a space in pieces.
MARK = "▁"
NEVER = np.int64(1) << 40
#: Distinct words that a task remembers before it starts anew.
CACHE_WORDS = 300_000
#: Bytes of text encoded at once: the more, the more words are repeats.
ENCODE_BYTES = 3 << 20


def _fields(message: bytes) -> dict[int, list]:
    """The fields of a serialized message by number: ints and byte strings."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            value = varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            value, at = message[at:at + size], at + size
        out.setdefault(key >> 3, []).append(value)
    return out


class Model:
    """The tables of a model file: symbols, pair ranks, bytes of each piece."""

    def __init__(self, path: str) -> None:
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = size = lib.vocab_size()
        parts = _fields(lib.serialized_model_proto())
        trainer, normal = _fields(parts[2][0]), _fields(parts[3][0])
        if trainer.get(3, [1])[0] != 2 or normal.get(2, [b""])[0] or normal.get(4, [1])[0] or not trainer.get(35, [0])[0]:
            raise ValueError("a BPE model with byte fallback, no character map and all white space kept is needed")
        if not normal.get(3, [1])[0] or not normal.get(5, [1])[0]:
            raise ValueError("a model with a leading space and escaped spaces is needed")

        names = [lib.id_to_piece(i) for i in range(size)]
        plain = [not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)) for i in range(size)]
        if any(MARK in n.lstrip(MARK) for n, p in zip(names, plain, strict=True) if p):
            raise ValueError("pieces that span words are not supported")
        ids = {n: i for i, (n, p) in enumerate(zip(names, plain, strict=True)) if p}
        self.byte_id = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)

        # A character outside the vocabulary is the symbol size + its code point.
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + size
        for n, i in ids.items():
            if len(n) == 1:
                self.symbol_of[ord(n)] = i
        self.symbol_of[32] = ids[MARK]
        symbol = lambda s: ids.get(s, size + ord(s) if len(s) == 1 else None)

        scores = np.array([lib.get_score(i) for i in range(size)])
        order = np.unique(-scores, return_inverse=True)[1]
        left, right, made = [], [], []
        for n, i in ids.items():
            for cut in range(1, len(n)):
                a, b = symbol(n[:cut]), symbol(n[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        left, right, made = (np.array(x, np.int64) for x in (left, right, made))
        keys = (left << 21) | right
        by_key = np.argsort(keys)
        self.keys, self.made, self.rank = keys[by_key], made[by_key], order[made[by_key]]
        self._hash_pairs()
        # Symbols that may join a neighbour at a rank no worse than their own.
        self.risky = np.zeros(size, bool)
        for side in (left, right):
            inside = side < size
            self.risky[side[inside][order[made[inside]] <= order[side[inside]]]] = True
        repeated = np.bincount(order) > 1
        self.risky |= repeated[order]

        text = [n.replace(MARK, " ").encode() if p else b"" for n, p in zip(names, plain, strict=True)]
        for b, i in enumerate(self.byte_id):
            text[i] = bytes([b])
        text[lib.unk_id()] = " ⁇ ".encode()
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.text_length = np.array([len(t) for t in text], np.int64)
        self.text_start = np.concatenate([[0], np.cumsum(self.text_length)[:-1]])
        self.forget()

    def _hash_pairs(self) -> None:
        """An open-addressed table over the pair keys; a lookup costs a probe or two."""
        bits = max(4, int(len(self.keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot = np.full((1 << bits) + 64, -1, np.int32)
        home = self._home(self.keys)
        left = np.arange(len(self.keys))
        step = 0
        while len(left):
            at = home[left] + step
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]
            left = left[self.slot[at] != left]
            step += 1
            if step >= 64:
                raise ValueError("too many pairs meet")
        self.probes = step

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.pool_start = np.zeros(0, np.int64)
        self.pool_length = np.zeros(0, np.int64)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; the rank is NEVER where no piece is made."""
        keys = (a << 21) | b
        home = self._home(keys)
        entry = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for step in range(self.probes):
            got = self.slot[home[open_] + step]
            some = got >= 0
            open_, got = open_[some], got[some]
            hit = self.keys[got] == keys[open_]
            entry[open_[hit]] = got[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        found = entry >= 0
        return np.where(found, self.rank[entry], NEVER), np.where(found, self.made[entry], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols of words given as flat symbols, and their numbers. No word is empty."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), NEVER)
        made = np.full(len(symbols), -1, np.int64)

        def look(at: np.ndarray) -> None:
            """Ranks of the pairs that begin at the given places."""
            ok = at + 1 < len(symbols)
            ok[ok] = word[at[ok]] == word[at[ok] + 1]
            rank[at[~ok]] = NEVER
            at = at[ok]
            rank[at], made[at] = self.pairs(symbols[at], symbols[at + 1])

        look(np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            new = np.ones(len(word), bool)
            new[1:] = word[1:] != word[:-1]
            begin = np.flatnonzero(new)
            best = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(word)))
            live = best < NEVER
            if not live.all():  # finished words leave
                stay = np.repeat(live, size)
                done.append((word[~stay], symbols[~stay]))
                word, symbols, rank, made = word[stay], symbols[stay], rank[stay], made[stay]
                best, size = best[live], size[live]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = self._from_left(at)
            at = self._one_at_a_time(at, symbols, word, rank, made)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            word, symbols, rank, made = word[keep], symbols[keep], rank[keep], made[keep]
            at = place[at]
            near = np.zeros(len(symbols) + 1, bool)
            near[at] = near[at - 1] = True  # place -1 is the spare one at the end
            look(np.flatnonzero(near[:-1]))
        word = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else symbols
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(lengths))

    @staticmethod
    def _from_left(at: np.ndarray) -> np.ndarray:
        """Of places that overlap their successors (place and place + 1 both listed), every other one from the left."""
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1] + 1
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        return at[(np.arange(len(at)) - run) % 2 == 0]

    def _one_at_a_time(self, at, symbols, word, rank, made) -> np.ndarray:
        """Only the leftmost place of words in which a merged symbol would join a neighbour first."""
        check = at[self.risky[made[at]]]
        if not len(check):
            return at
        chosen = np.zeros(len(symbols) + 3, bool)
        chosen[at] = True
        m, r = made[check], rank[check]
        bad = np.zeros(len(check), bool)
        before, after = check - 1, check + 2
        has = (before >= 0) & (word[np.maximum(before, 0)] == word[check])
        bad[has] |= self.pairs(symbols[before[has]], m[has])[0] <= r[has]
        has &= check >= 2
        has[has] = chosen[check[has] - 2]
        bad[has] |= self.pairs(made[check[has] - 2], m[has])[0] <= r[has]
        has = after < len(symbols)
        has[has] = word[after[has]] == word[check[has]]
        bad[has] |= self.pairs(m[has], symbols[after[has]])[0] <= r[has]
        has[has] = chosen[after[has]]
        bad[has] |= self.pairs(m[has], made[after[has]])[0] <= r[has]
        slow = np.unique(word[check[bad]])
        if not len(slow):
            return at
        first = np.ones(len(at), bool)
        first[1:] = word[at[1:]] != word[at[:-1]]
        return at[first | ~np.isin(word[at], slow)]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not known yet and keep their ids."""
        text = b"".join(words).decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        heads = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words], np.int64)
        chars = np.add.reduceat((heads & 0xC0) != 0x80, np.concatenate([[0], np.cumsum(size)[:-1]]))
        symbols, lengths = self.merge(self.symbol_of[points], chars.astype(np.int64))
        if len(symbols) and symbols.max() >= self.size:  # unknown characters become their bytes
            strange = symbols >= self.size
            of = np.repeat(np.arange(len(lengths)), lengths)
            spelled = [self.byte_id[list(chr(s - self.size).encode())] for s in symbols[strange]]
            times = np.ones(len(symbols), np.int64)
            times[strange] = [len(s) for s in spelled]
            lengths = np.bincount(of, times, len(lengths)).astype(np.int64)
            out = np.repeat(symbols, times)
            out[np.repeat(strange, times)] = np.concatenate(spelled)
            symbols = out
        start = len(self.pool) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
        base = len(self.known)
        self.known.update((w, base + k) for k, w in enumerate(words))
        self.pool = np.concatenate([self.pool, symbols.astype(np.int32)])
        self.pool_start = np.concatenate([self.pool_start, start.astype(np.int64)])
        self.pool_length = np.concatenate([self.pool_length, lengths])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and how many each text has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        filled = pc.not_equal(texts, "")
        texts = pc.if_else(filled, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())), texts)
        data, offsets = flat(texts)
        if MARK.encode() in data.tobytes():
            data, offsets = flat(pc.replace_substring(texts, MARK, " "))
        blank = data == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        start = np.flatnonzero(start)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        bounds = np.append(start, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHE_WORDS:
            self.forget()
        missing = [w for w in distinct if w not in self.known]
        if missing:
            self._learn(missing)
        of = np.array([self.known[w] for w in distinct], np.int64)[coded.indices.to_numpy()]
        length = self.pool_length[of]
        ids = self.pool[ranges(self.pool_start[of], length)]
        total = np.concatenate([[0], np.cumsum(length)])
        cut = np.searchsorted(start, offsets)
        return ids, np.diff(total[cut])

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """The text of each list of ids: the space that encoding puts in front is taken off again."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id outside the vocabulary")
        size = self.text_length[ids]
        data = self.text[ranges(self.text_start[ids], size)]
        total = np.concatenate([[0], np.cumsum(size)])
        offsets = total[np.concatenate([[0], np.cumsum(lengths)])]
        lead = np.zeros(len(data), bool)
        some = offsets[:-1][offsets[1:] > offsets[:-1]]
        lead[some] = data[some] == 32
        gone = np.concatenate([[0], np.cumsum(lead)])
        offsets, data = offsets - gone[offsets], data[~lead]
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:  # ids that no text has: every byte that is not part of a character is replaced
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            return pa.array([_lenient(t) for t in texts], pa.large_string())
        return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _lenient(raw: bytes) -> str:
    out = []
    while raw:
        try:
            return "".join(out) + raw.decode()
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One copy of the tables in each Python process."""
    return Model(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of each whole text (array of int).

    The ids are those of the sentencepiece library without begin or end ids. A null or empty text has none; an
    empty table gives no rows; repeated rows are encoded each; an input column named ``ids`` is replaced.
    """

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        flat_ids, lengths = model(path).encode(part.column(text))
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat_ids, pa.int32()))]

    return map_text(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], work, most=ENCODE_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids. A null list is an empty text; null within a list is left out."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column(ids)
                values = pc.list_flatten(lists)
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                if values.null_count:
                    of = np.repeat(np.arange(len(lengths)), lengths)[values.is_valid().to_numpy(zero_copy_only=False)]
                    lengths, values = np.bincount(of, minlength=len(lengths)), values.drop_null()
                out = model(path).decode(values.to_numpy(), lengths)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in stay] + [out.cast(pa.string())], names=[*stay, text])

    stay = [n for n in df.columns if n != text]
    schema = T.StructType([df.schema[n] for n in stay] + [T.StructField(text, T.StringType())])
    return df.mapInArrow(run, schema)

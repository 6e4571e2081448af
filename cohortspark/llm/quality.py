"""Quality rules: how far a text's characters and common words stray from its language.

Two histograms are taken of each text: its characters by class, and its words by a list of common
words. Both are compared, by Jensen-Shannon distance, with the same histograms over all texts of
its language. Short texts make noisy histograms, so each comparison has a least length. Most words of any text
are none of the common ones, so even a text without a single common word is only so far from its language
(its reach): the limit for words is a share of that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import SPACE, flat, hashes, joined, lines, lowered, map_text, per_text, slices, spans

# Common words by language.
COMMON_WORDS = {
    "en": "the of and to in is that it for was as with be by on not he are this an at have from or a",
    "fr": "le la les de des du un une et est en que qui dans pour par au aux il elle sur ne pas ce on",
    "de": "der die das und zu in den von ist mit des dem nicht ein eine im auf für sich als auch es an werden",
    "es": "el la los las de del un una y es en que por con para se no al lo su como más o este a",
}

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Classes of bytes: white space, a-z, A-Z, digits, plain punctuation, other ASCII, letters beyond ASCII (their first bytes), later bytes of these (not counted).
N_CLASSES = 7
CLASSES = np.full(256, 5)
CLASSES[SPACE] = 0
CLASSES[97:123] = 1
CLASSES[65:91] = 2
CLASSES[48:58] = 3
CLASSES[list(b".,;:!?'\"()-")] = 4
CLASSES[128:192] = N_CLASSES
CLASSES[192:] = 6

OTHER = "*"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Greatest distances (0 to 1), and the least lengths from which they count.

    ``word_share``: the greatest distance of words as a share of the language's reach. A reference with hardly any common
    words (its reach below ``least_reach``) can't tell texts without them apart; ``word_distance`` holds there.
    """

    char_distance: float = 0.28
    word_share: float = 0.95
    least_reach: float = 0.2
    word_distance: float = 0.5
    least_chars: int = 200
    least_words: int = 50


def _vocabulary() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all common words, and the histogram bin of each."""
    words = sorted({w for s in COMMON_WORDS.values() for w in s.split()})
    data, offsets = flat(pa.array(words))
    found = hashes(data, offsets[:-1], offsets[1:])
    order = np.argsort(found)
    return found[order], order


VOCABULARY, BINS = _vocabulary()
N_BINS = len(BINS) + 1


def histograms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters by class and words by common word (the last bin: all others), a row for each text."""
    n = len(offsets) - 1
    kinds = CLASSES[data]
    of = np.repeat(np.arange(n), np.diff(offsets))
    chars = np.bincount(of * (N_CLASSES + 1) + kinds, minlength=n * (N_CLASSES + 1)).reshape(n, -1)[:, :N_CLASSES]
    low = lowered(data)
    start, end, doc = spans(low, offsets, CLASSES_NOT_LETTERS)
    found = hashes(low, start, end)
    at = np.minimum(np.searchsorted(VOCABULARY, found), len(VOCABULARY) - 1)
    bins = np.where(VOCABULARY[at] == found, BINS[at], N_BINS - 1)
    return chars, np.bincount(doc * N_BINS + bins, minlength=n * N_BINS).reshape(n, -1)


#: For common words only, punctuation parts words too.
CLASSES_NOT_LETTERS = ~np.isin(CLASSES, [1, 2, 6, N_CLASSES])


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) between rows of counts; 0 where either side is empty."""
    p, q = np.asarray(p, float), np.asarray(q, float)
    total = p.sum(1), q.sum(1)
    p, q = (x / np.maximum(t, 1)[:, None] for x, t in zip((p, q), total, strict=True))
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = [np.where(x > 0, x * np.log2(x / m), 0).sum(1) for x in (p, q)]
    out = np.sqrt(np.clip((part[0] + part[1]) / 2, 0, 1))
    return np.where((total[0] > 0) & (total[1] > 0), out, 0.0)


def word_limits(words_of: np.ndarray, limits: Limits) -> np.ndarray:
    """The greatest distance of words for each reference, by how far a text without common words is from it."""
    without = np.zeros_like(words_of)
    without[:, -1] = 1
    reach = distance(without, words_of)
    return np.where(reach >= limits.least_reach, limits.word_share * reach, limits.word_distance)


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, repeated lines and words in repeated five-word windows of each text."""
    n = len(offsets) - 1
    start, end, doc = spans(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    out = {"n_words": per_text(doc, n), "word_chars": per_text(doc, n, points[end] - points[start])}
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    begin, stop, of = lines(data, offsets)
    has = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, stop, of = begin[has], stop[has], of[has]
    out["n_dup_lines"] = per_text(of, n) - per_text(_distinct(of, hashes(data, begin, stop)), n)

    each = hashes(data, start, end)
    first = np.flatnonzero(doc[4:] == doc[:-4]) if len(doc) > 4 else np.zeros(0, int)
    window = joined([each[first + k] for k in range(5)]) if len(first) else np.zeros(0, np.uint64)
    order = np.lexsort((window, doc[first]))
    same = (window[order][1:] == window[order][:-1]) & (doc[first][order][1:] == doc[first][order][:-1])
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(doc) + 5, np.int64)
    np.add.at(covered, first[twice], 1)
    np.add.at(covered, first[twice] + 5, -1)
    out["n_repeat_words"] = per_text(doc, n, (np.cumsum(covered)[: len(doc)] > 0).astype(float))
    return out


def _distinct(of: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The text numbers of the distinct pairs of text number and value."""
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (values[1:] != values[:-1])
    return of[new]


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[list[int], list[int]]]:
    """Histograms over all texts of each language that has a word list; all other texts share one (``*``).

    Counts are added up in each task and then across tasks: at most a few hundred numbers per task
    move, and as many reach the driver, whatever the size of the corpus.
    """
    names = [*COMMON_WORDS, OTHER]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), N_CLASSES + N_BINS), np.int64)
        for batch in batches:
            for part in slices(batch, text):
                of = _language(part.column(lang), names)
                np.add.at(total, of, np.hstack(histograms(*flat(part.column(text)))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(names)), total.shape[1])), pa.array(np.tile(np.arange(total.shape[1]), len(names))),
             pa.array(total.ravel())], names=["lang", "bin", "n"],
        )

    rows = docs.select(F.col(text), F.col(lang).cast("string").alias(lang)).mapInArrow(run, "lang long, bin long, n long")
    total = np.zeros((len(names), N_CLASSES + N_BINS), np.int64)
    for r in rows.groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect():
        total[r["lang"], r["bin"]] = r["n"]
    return {name: (row[:N_CLASSES].tolist(), row[N_CLASSES:].tolist()) for name, row in zip(names, total, strict=True)}


def _language(column: pa.Array, names: list[str]) -> np.ndarray:
    known = {n: i for i, n in enumerate(names)}
    return np.array([known.get(x, len(names) - 1) for x in column.to_pylist()], np.int64)


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits(),
    reference: dict[str, tuple[list[int], list[int]]] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``char_distance``, ``word_distance`` and ``kept``.

    ``kept`` is false where the base rules fail (fewer than 10 words, or over a fifth of the words in
    five-word windows that occur twice) or where a distance is above its limit (for words, nearly that of a text without
    common words). A null text is an empty
    one and fails; a null or unlisted language is compared with all other such texts; an empty table
    gives no rows; repeated rows are judged each; input columns with the names above are replaced.
    """
    reference = references(docs, text, lang) if reference is None else reference
    names = [*COMMON_WORDS, OTHER]
    chars_of, words_of = (np.array([reference[n][k] for n in names]) for k in (0, 1))
    most = word_limits(words_of, limits)

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = flat(part.column(text))
        of = _language(part.column(lang), names)
        m = measures(data, offsets)
        chars, words = histograms(data, offsets)
        far = distance(chars, chars_of[of]), distance(words, words_of[of])
        failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        strange = (chars.sum(1) >= limits.least_chars) & (far[0] > limits.char_distance)
        strange |= (m["n_words"] >= limits.least_words) & (far[1] > most[of])
        return [*(pa.array(m[k], pa.int64()) for k in MEASURES), pa.array(failed), *map(pa.array, far), pa.array(~failed & ~strange)]

    fields = [T.StructField(n, T.LongType()) for n in MEASURES]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("char_distance", T.DoubleType())]
    fields += [T.StructField("word_distance", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return map_text(docs, text, fields, work)

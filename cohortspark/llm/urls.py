"""URL filter: allow and block rules by host and path, then a weighted vocabulary of terms.

One Aho-Corasick pass over a URL finds all terms. A hit counts only where letters and digits end on
both sides of it. One strict term, or enough distinct soft ones, blocks the URL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import map_text

# The rules of the query, longest match wins.
RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}

STRICT = ("casino", "porn", "xxx", "adult", "viagra", "escort", "warez", "phishing", "malware")
SOFT = (
    "spam", "farm", "ads", "track", "tracker", "cheap", "pills", "free", "bets", "bet", "win", "poker", "loan", "loans", "hot", "sexy",
    "click", "promo", "replica", "crack", "torrent", "proxy", "popunder", "jackpot",
)
SOFT_HITS = 2

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Vocabulary:
    """Terms that block alone, terms that block together, and how many distinct ones it takes."""

    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    soft_hits: int = SOFT_HITS
    rules: dict[str, str] = field(default_factory=lambda: dict(RULES))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[cut:]
    stop = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return rest[:cut].translate(_LOWER), path[:stop]


def _rules_by_host(rules: dict[str, str]) -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for rule in rules:
        host, slash, path = rule.partition("/")
        out.setdefault(host, []).append((slash + path, rule))
    return out


def matching_rule(by_host: dict[str, list[tuple[str, str]]], host: str, path: str) -> str | None:
    """The longest rule whose host is the URL's or a parent of it, and whose path begins the URL's."""
    found, at = [], 0
    while True:
        found += [rule for start, rule in by_host.get(host[at:], ()) if path.startswith(start)]
        at = host.find(".", at) + 1
        if not at:
            return max(found, key=len, default=None)


def automaton(words: Vocabulary) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term in words.soft:
        out.add_word(term, (term, False))
    for term in words.strict:
        out.add_word(term, (term, True))
    out.make_automaton()
    return out


def hits(terms: ahocorasick.Automaton, url: str | None) -> tuple[int, int]:
    """Distinct strict and distinct soft terms of a URL (after ``://`` if there is one)."""
    low = (url or "").translate(_LOWER)
    low = low.partition("://")[2] if "://" in low else low
    strict, soft = set(), set()
    for end, (term, hard) in terms.iter(low):
        start = end - len(term) + 1
        if (start and low[start - 1] in _ALNUM) or (end + 1 < len(low) and low[end + 1] in _ALNUM):
            continue
        (strict if hard else soft).add(term)
    return len(strict), len(soft)


def url_filter(pages: DataFrame, url: str = "url", words: Vocabulary = Vocabulary()) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``strict_hits``, ``soft_hits`` and ``verdict`` (allow or block).

    A null URL or one without ``://`` has empty host and path and no rule; its terms still count. Repeated
    rows are judged each; an empty table gives no rows; input columns with the names above are replaced.
    """

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        by_host, terms, out = _rules_by_host(words.rules), automaton(words), []
        for u in part.column(url).to_pylist():
            host, path = split_url(u)
            rule = matching_rule(by_host, host, path)
            strict, soft = hits(terms, u)
            verdict = words.rules[rule] if rule else "block" if strict or soft >= words.soft_hits else "allow"
            out.append((host, path, rule, strict, soft, verdict))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()]
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    kinds = {"host": T.StringType(), "path": T.StringType(), "rule": T.StringType(), "strict_hits": T.LongType(), "soft_hits": T.LongType(),
             "verdict": T.StringType()}
    return map_text(pages, url, [T.StructField(n, k) for n, k in kinds.items()], work)

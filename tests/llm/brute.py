"""Plain versions of the operators, written from their definitions."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import pairwise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def quality_base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in found]


def shingles(text, n):
    words = WORD.findall(lower(text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def groups(nodes, edges):
    """The least node that can be reached from each."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(texts, n, percent=80):
    """{id: (size of the set, least id reachable)}."""
    sets, holders, edges = {i: shingles(t, n) for i, t in texts.items()}, {}, []
    for i, s in sets.items():
        shared = Counter(j for g in s for j in holders.get(g, ()))
        edges += [(i, j) for j, k in shared.items() if 100 * k >= percent * (len(s) + len(sets[j]) - k)]
        for g in s:
            holders.setdefault(g, []).append(i)
    return {i: (len(sets[i]), r) for i, r in groups(sets, edges).items()}


def line_dedup(texts, least=50):
    """{id: (lines with a word, removed, text)} in the order of ids, from all windows of all texts."""
    seen, out = set(), {}
    count = lambda t: sum(WORD.search(x) is not None for x in t.split("\n"))
    for i in sorted(texts):
        text = texts[i] or ""
        parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)
        words = [WORD.search(p)[0] for p in parts]
        breaks = [k for k, p in enumerate(parts) if "\n" in p or k == 0] + [len(parts)]
        windows = set()
        for a in breaks:
            windows.add(("lines", a, next((b for b in breaks if b - a >= least), None)))
            windows.add(("lines", next((b for b in reversed(breaks) if a - b >= least), None), a))
        for a in range(len(words) - least + 1):
            if sum(a < b < a + least for b in breaks) >= 2:
                windows.add(("words", a, a + least))
        gone = set()
        for kind, a, b in sorted((w for w in windows if None not in w), key=lambda w: w[1:]):
            key = (kind, *((words[k], k > a and k in breaks) for k in range(a, b)))
            if key in seen:
                gone.update(range(a, b))
            seen.add(key)
        left = ""
        for k, p in enumerate(parts):
            if k not in gone:
                after = k - 1 in gone
                left += words[k] if after and not left else "\n" + words[k] if after and "\n" not in p else p
        if len(parts) - 1 not in gone:
            left += text[len("".join(parts)):]
        out[i] = (count(text), count(text) - count(left), left)
    return out


def pieces(ids, capacity=1024):
    """(start, length, crc32) of each piece."""
    first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    crc = lambda part: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    return [(a, b - a, crc(ids[a:b])) for a, b in pairwise(cuts)]

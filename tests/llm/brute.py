"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(words), len(covered)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def fingerprint(text, size=4):
    words = WORD.findall(low(text))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(fps, bits=4):
    """fps: list of (id, fingerprint); the smallest id reachable of each row."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(fps):
        for j, (_, b) in enumerate(fps[:i]):
            if (a ^ b).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(fps):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(fps))]


ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(text, items, window=10):
    """n_words, n_hit, sorted ids of the items found."""
    words, hit, found = ITEM_WORD.findall(low(text)), set(), set()
    for item_id, item in items:
        own = ITEM_WORD.findall(low(item))
        if item_id is None or not own:
            continue
        size = min(window, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_boilerplate(rows, ratio=0.05, least=2):
    """rows: (source, text); the texts without lines on many of the source's pages."""
    pages, totals = Counter(), Counter(s for s, _ in rows)
    for source, text in rows:
        pages.update((source, x) for x in set((text or "").split("\n")) if WORD.search(x))
    bad = {k for k, n in pages.items() if k[0] is not None and n >= least and n > ratio * totals[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (s, x) not in bad) for s, t in rows]

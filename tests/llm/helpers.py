"""Brute-force forms of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import re

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(docs, width=4, percent=80):
    """{row number: (n, component)} by comparing all pairs of different sets."""
    sets = []
    for _, text in docs:
        words = NOT_SPACE.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set())
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j, (b, _) in enumerate(docs[:i]):
            if a is not None and b is not None and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return [(d, len(s), None if d is None else root(d)) for (d, _), s in zip(docs, sets, strict=True)]


def cut_repeats(docs, width=20):
    """(id, words, removed, kept) of each row."""
    first = {}
    rows = [(d, NOT_SPACE.findall(t or "")) for d, t in docs]
    order = lambda d, i: (d is None, d or 0, i)
    for d, words in rows:
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            first[key] = min(first.get(key, order(d, i)), order(d, i))
    out = []
    for d, words in rows:
        gone = set()
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < order(d, i):
                gone |= set(range(i, i + width))
        out.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def contaminated(docs, items, width=10):
    """(id, words, hit places, items) of each row."""
    windows = []
    for item, text in items:
        words = LETTERS.findall((text or "").translate(LOWER))
        m = min(width, len(words))
        windows += [(item, words[i : i + m]) for i in range(len(words) - m + 1) if m]
    out = []
    for d, text in docs:
        words = LETTERS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found |= {str(item)} if item is not None else set()
        out.append((d, len(words), sorted(hit), sorted(found)))
    return out

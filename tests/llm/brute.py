"""Plain versions of the operators, row by row, for small fixtures."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*(w[k:] for k in range(size)), strict=False))


def components(docs: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, int]:
    """Smallest reachable id by comparing documents that share a shingle."""
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict[tuple, list[int]] = {}
    tried = set()
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders.setdefault(s, []):
                if (j, i) not in tried:
                    tried.add((j, i))
                    shared = len(sets[i] & sets[j])
                    if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                        a, b = sorted((root(i), root(j)))
                        parent[b] = a
            holders[s].append(i)
    return {i: root(i) for i in sets}


def removed(docs: list[tuple[int, bytes]], length: int) -> dict[int, list[bool]]:
    """For every byte, whether a string of that length covers it that also starts in a smaller id."""
    first: dict[bytes, int] = {}
    for i, data in sorted(docs):
        for k in range(len(data) - length + 1):
            first.setdefault(data[k : k + length], i)
    out = {}
    for i, data in docs:
        marks = [False] * len(data)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < i:
                marks[k : k + length] = [True] * length
        out[i] = marks
    return out

"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, smallest id in reach)."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets}

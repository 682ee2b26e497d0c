"""Brute-force helpers."""

from __future__ import annotations


def reachable(n: int, links) -> list[int]:
    """A representative per item under the links (brute force)."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def smallest_ids(ids, links) -> list:
    """The smallest id reachable from each item; a null id only if there is no other."""
    roots = reachable(len(ids), links)
    best: dict = {}
    for i, r in zip(ids, roots):
        if i is not None:
            best[r] = min(best.get(r, i), i)
    return [best.get(r, i) for i, r in zip(ids, roots)]

"""Plain versions of the operators, for comparison on small tables."""

import re

SPACES = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, width):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_components(rows, width, percent):
    """rows: (doc_id, text) with distinct ids. Returns {doc_id: (n_shingles, component_id)}."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, set()).add(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen = set()
    for i, s in sets.items():
        counts = {}
        for x in s:
            for j in by_shingle[x]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        for j, common in counts.items():
            if (i, j) not in seen and 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}

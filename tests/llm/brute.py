"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re


def components_of(ids, links):
    """Least reachable id of each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", ascii_lower(text or "")) if w]
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def near_duplicates(rows):
    """``{doc_id: (n_shingles, component_id)}`` of ``[(doc_id, text)]`` with distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    places = {}
    for i, s in sets.items():
        for x in s:
            places.setdefault(x, []).append(i)
    both = {}
    for ids in places.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                both[a, b] = both.get((a, b), 0) + 1
    links = [
        (a, b)
        for (a, b), n in both.items()
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)
    ]
    found = components_of(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}

"""Brute-force models that several tests share."""

import re

_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x20\t-\r]+", (text or "").translate(_LOWER))


def brute_components(texts, k, percent):
    found = {}
    for i, t in texts.items():
        w = words(t)
        found[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if found[i] and 100 * len(found[i] & found[j]) >= percent * len(found[i] | found[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in texts}


def brute_covered(texts, least):
    seen, out = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        hit = [False] * len(w)
        for k in range(len(w) - least + 1):
            run = tuple(w[k : k + least])
            if run in seen:
                hit[k : k + least] = [True] * least
            seen.add(run)
        out[i] = hit
    return out

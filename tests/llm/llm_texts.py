"""Texts and plain-Python rules that the tests of this folder share."""

import re

LONG = " ".join(f"word{i % 997} ébène{i % 13}" for i in range(30_000))
SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size):
    found = words(lowered(text))
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def near_components(texts, size, percent=80):
    """{id: smallest id reachable} by comparing all pairs of shingle sets."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    low = {i: i for i in texts}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                p, q = root(a), root(b)
                low[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}

"""Plain Python versions of the joins on shingles."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text):
    words = word_list(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def groups(rows):
    """doc_id to (number of shingles, smallest doc_id of its component)."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[:k])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def runs_of(text):
    """Shingles, and all runs of fewer than five words."""
    words = word_list(text)
    return {tuple(words[k:k + n]) for n in range(1, 6) for k in range(len(words) - n + 1)}


def item_hits(docs, items):
    sets = [(i, runs_of(t)) for i, t in docs]
    found = set()
    for item, text in items:
        wanted = shingle_set(text)
        for i, s in sets:
            if wanted and 100 * len(wanted & s) >= 80 * len(wanted):
                found.add((i, item, len(wanted), len(wanted & s)))
    return found

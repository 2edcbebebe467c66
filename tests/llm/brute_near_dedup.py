"""Near duplicates by holding every text against every other."""

import re


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(rows, similar=85):
    """For ``(doc_id, text)`` rows: size of the set and smallest doc_id reachable, in order."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(a, b) for held in by_shingle.values() for k, a in enumerate(held) for b in held[:k]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min((d for d in (least.get(find(i)), doc) if d is not None), default=None)
    return [(len(s), least[find(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]

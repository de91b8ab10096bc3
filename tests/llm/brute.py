"""Plain Python versions of what the corpus operators compute."""

import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def least_known(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def equal_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub(" ", text or "")].append(doc_id)
    return sorted(((i, least_known(g), len(g), i == least_known(g)) for g in groups.values() for i in g), key=repr)


def fingerprint(text):
    words = split(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(rows):
    fps = [fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = components(len(rows), links)
    members = defaultdict(list)
    for i, r in enumerate(roots):
        members[r].append(rows[i][0])
    return sorted(((rows[i][0], fps[i], least_known(members[roots[i]])) for i in range(len(rows))), key=repr)


def without_repeats(rows, window=50):
    last = float("inf")
    first = {}
    for doc_id, text in rows:
        words = split(text)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            order = last if doc_id is None else doc_id
            first[key] = min(first.get(key, last), order)
    out = []
    for doc_id, text in rows:
        words = split(text)
        order, gone = last if doc_id is None else doc_id, set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < order:
                gone.update(range(s, s + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def word_counts(texts):
    seen = Counter()
    for t in texts:
        seen.update([*split(lower(t)), None])
    return seen

"""Spelling variants against plain versions that compare all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from assetlake.llm import spelling as sp


def edit_apart(a, b):
    """True if one of the plain single edits of ``a`` gives ``b``."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(counts, ratio=10):
    near = {w: [o for o in counts if edit_apart(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], form[w], root, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def document_counts(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def vocabulary(seed=4):
    """Chains of variants, many arrangements of the same letters, accents, long words and one hub."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 10))) for _ in range(250)}
    words |= {"".join(rng.sample("abbacda", 7)) for _ in range(150)}
    hub = "extraordinary"
    words |= {hub[:i] + c + hub[i:] for i in range(len(hub) + 1) for c in "aqÿ×"} | {hub}
    words |= {hub[:i] + hub[i + 1 :] for i in range(len(hub))}
    long = "ab" * 60
    words |= {long, long + "a", "b" + long, long[:50] + long[51:], "x" * 3000, "x" * 3001, "x" * 47, "x" * 48, "x" * 49, "x" * 50}
    words |= {"x" * 48 + "y", "y" + "x" * 48}
    counts = {w: rng.choice([2, 3, 20, 35, 400, 5000]) for w in sorted(words)}
    return counts | {hub: 10**6, "mountain": 5000, "mountains": 300, "mountainsy": 20, "mountainsyq": 2}


@pytest.mark.parametrize("node, twig, visitors, pairs", [(20_000, 24, 200_000, 100_000), (20, 2, 64, 50)])
def test_variants(spark, monkeypatch, node, twig, visitors, pairs):
    for name, value in (("NODE", node), ("TWIG", twig), ("VISITORS", visitors), ("PAIRS", pairs)):
        monkeypatch.setattr(sp, name, value)
    counts = vocabulary()
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = sorted((r.word, r.n, r.form, r.root, r.n_near, r.form_n) for r in sp.spelling_variants(df).collect())
    want = variants(counts)
    assert got == want
    assert any(len({w, f, r}) == 3 for w, _, f, r, _, _ in want) and max(w[4] for w in want) > 40


def test_vector_search_is_the_budget():
    rng = np.random.default_rng(6)
    vectors = np.unique(rng.integers(0, 3, (300, 5)), axis=0)
    held, asked, state = sp.near_vectors(vectors, vectors, np.zeros(len(vectors), np.int64))
    got = sorted(zip(held.tolist(), asked.tolist(), state.tolist()))
    want = []
    for i, v in enumerate(vectors):
        for j, u in enumerate(vectors):
            change = (v - u)[v != u].tolist()
            if change in ([], [1], [1, -1]):
                want.append((i, j, len(change)))
    assert got == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_verification(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    words += [w[:i] + w[i + 1 :] for w in words for i in (0, len(w) // 2, len(w) - 1)]
    data = sp.Words(words)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    want = [edit_apart(words[a], words[b]) for a, b in zip(i, j)]
    assert sp.verified(data, i, data, j).tolist() == want and sum(want) > 200
    assert [sp.one_edit(words[a], words[b]) for a, b in zip(i, j)] == want


def test_documents(spark, docs, rows):
    plain = [(r[0], r[1]) for r in rows]
    odd = [(7, "Ünited ÀÉÎ×÷ÿabc don't-Stopping STOPPING stopping stópping"), (None, "STOPPING stopping"), (8, None), (9, "")]
    tail = " ".join(f"banana{chr(97 + i % 26)}tree bananatree" for i in range(300))
    odd += [(i, tail) for i in range(100, 130)] + [(200, "z" * 40_000 + " " + "z" * 40_000)]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    counts = document_counts(plain + odd)
    table = docs.select("doc_id", "text").unionByName(more).selectExpr("*", "text as word", "1 as n", "'x' as run", "map('a', 1) as vec")
    got = sorted((r.word, r.n, r.form, r.root, r.n_near, r.form_n) for r in sp.document_variants(table).collect())
    assert got == variants(counts) and any(r[2] for r in got)


def test_nothing(spark, nothing, odd):
    assert sp.document_variants(nothing).count() == 0
    assert sp.document_variants(odd).count() == 0

import hashlib

import numpy as np
import pytest
from brute import components, fingerprint, least_known, simhash, without_repeats

from assetlake.llm import components as cc
from assetlake.llm import embedding_dedup, simhash as sh, substring_dedup
from assetlake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_fingerprints(rows):
    for r in rows:
        assert sh.fingerprint(r[1]) == fingerprint(r[1])


def test_simhash(docs, rows):
    got = sh.simhash_components(docs).collect()
    assert sorted(((r[0], r[1] % 2**64, r[2]) for r in got), key=repr) == simhash([r[:2] for r in rows])


def test_simhash_dedup(docs, rows):
    groups = {}
    for k, _, c in simhash([(k, r[1]) for k, r in enumerate(rows)]):
        groups.setdefault(c, []).append(rows[k])
    kept = sh.simhash_dedup(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(groups)
    for members in groups.values():
        own = [r for r in got if r in members]
        assert len(own) == 1 and own[0][0] == least_known([r[0] for r in members])


def test_simhash_of_nothing(nothing, odd):
    assert sh.simhash_components(nothing).isEmpty() and sh.simhash_dedup(nothing).isEmpty()
    assert {tuple(r) for r in sh.simhash_components(odd).collect()} == {(1, 0, 1), (2, 0, 1), (4, 0, 1), (None, 0, 1)}


@pytest.mark.parametrize("budget", [1, 3, 4])
def test_trie_join_loses_no_link(spark, budget):
    rng = np.random.default_rng(budget)
    values = set()
    for base in rng.integers(0, 2**63, 60).tolist():
        base = base * 2 + 1
        values.add(base)
        for _ in range(12):
            x = base
            for bit in rng.integers(0, 64, rng.integers(0, budget + 3)):
                x ^= 1 << int(bit)
            values.add(x)
    values = sorted(values)
    links = [(i, j) for i, x in enumerate(values) for j in range(i) if (x ^ values[j]).bit_count() <= budget]
    want = components(len(values), links)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in values], "fp long")
    found = sh.trie_join(df, budget).collect()
    place = {(x - 2**64 if x >> 63 else x): i for i, x in enumerate(values)}
    assert components(len(values), [(place[r["u"]], place[r["v"]]) for r in found]) == want
    # Links span components instead of listing pairs.
    assert len(found) <= (budget + 1) * len(values)


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 400)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    ring = [(5000 + i, 5000 + (i + 7) % 31) for i in range(31)]
    links = path + star + ring + [(9, 9)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in cc.component_roots(df).collect()}
    want = {i: 0 for i in range(1, 401)} | {1000 + i: 1000 for i in range(1, 300)} | {5000 + i: 5000 for i in range(1, 31)}
    assert got == want
    assert cc.component_roots(df.limit(0)).isEmpty()


def vectors(seed=2, width=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(500, width))
    near = base[:100] + rng.normal(size=(100, width)) * 0.15
    dense = base[100] + rng.normal(size=(200, width)) * 0.1
    rows = [list(map(float, v)) for v in np.concatenate([base, near, dense])]
    rows += [rows[0]] * 40 + [[2 * x for x in rows[1]]]
    rows += [None, [0.0] * width, [None] + [1.0] * (width - 1), [float("nan")] + [1.0] * (width - 1), [float("inf")] + [1.0] * (width - 1), [], [1.0, 2.0], [2.0, 4.0]]
    return [(i * 2, v, i % 3, "x") for i, v in enumerate(rows)] + [(None, rows[2], 0, "x"), (4, rows[2], 0, "y")]


def by_brute_force(rows):
    good = [v if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else None for _, v, _, _ in rows]
    links = []
    for width in {len(v) for v in good if v}:
        at = [i for i, v in enumerate(good) if v and len(v) == width]
        x = np.array([good[i] for i in at])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links += [(at[i], at[j]) for i, j in zip(*np.nonzero(x @ x.T >= 0.95)) if i != j]
    roots, counts = components(len(rows), links), np.bincount([i for i, _ in links], minlength=len(rows))
    members = {}
    for i, r in enumerate(roots):
        members.setdefault(r, []).append(rows[i][0])
    return links, [(rows[i][0], int(counts[i]), least_known(members[roots[i]]), rows[i][0] == least_known(members[roots[i]])) for i in range(len(rows))]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 60, "block": 25, "margin": 2.1}])
def test_embeddings(spark, options):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links string").repartition(4)
    got = embedding_dedup.embedding_components(df, **options).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(by_brute_force(rows)[1], key=repr)
    kept = embedding_dedup.embedding_dedup(df, **options)
    assert kept.columns == df.columns and kept.filter("vec_id = 2").count() == 1


@pytest.mark.parametrize("width, seed", [(24, 5), (64, 6)])
def test_recall_of_many_cells(spark, width, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(3000, width))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    twins = base + rng.normal(size=base.shape) * (0.28 / np.sqrt(width))
    rows = [(i, [float(x) for x in v], 0, "") for i, v in enumerate(np.concatenate([base, twins]))]
    links, want = by_brute_force(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n string").repartition(4)
    got = embedding_dedup.embedding_components(df, cell_rows=100).collect()
    assert {r["vec_id"]: r["n_links"] for r in got}.keys() == {w[0] for w in want}
    exact = {w[0]: w[1] for w in want}
    assert all(r["n_links"] <= exact[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.95 * len(links) > 4000


def test_embeddings_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.embedding_components(spark.createDataFrame([], schema)).isEmpty()
    got = embedding_dedup.embedding_components(spark.createDataFrame([(1, None), (None, [0.0])], schema)).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, 0, 1, True), (None, 0, None, True)]


def test_embedding_query(spark):
    got = QUERIES["op7_embedding_dedup"](spark, SMALL).collect()
    rows = [(r["vec_id"], r["embedding"], 0, "") for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(by_brute_force(rows)[1])


@pytest.mark.parametrize("group", [substring_dedup.GROUP, 3, 0])
def test_substrings(docs, rows, group):
    got = substring_dedup.substring_dedup(docs, group=group).collect()
    assert sorted(map(tuple, got), key=repr) == without_repeats([r[:2] for r in rows])


@pytest.mark.parametrize("window, gram", [(8, 3), (5, 5), (50, 49)])
def test_other_windows(spark, window, gram):
    rng = np.random.default_rng(window)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 120))) for _ in range(60)] + ["a " * 300, "a b " * 80, None]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring_dedup.substring_dedup(df, window=window, gram=gram).collect()
    assert sorted(map(tuple, got), key=repr) == without_repeats(rows, window)


def test_substrings_of_nothing(nothing, odd):
    assert substring_dedup.substring_dedup(nothing).isEmpty()
    assert {tuple(r)[1:] for r in substring_dedup.substring_dedup(odd).collect()} == {(0, 0, "")}


def test_simhash_and_substring_queries(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = {(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op4_simhash_dedup"](spark, SMALL).collect()}
    assert got == set(simhash(rows))
    want = sorted((i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in without_repeats(rows))
    assert sorted(map(tuple, QUERIES["op5_substring_dedup"](spark, SMALL).collect())) == want
    assert any(gone for _, _, gone, _ in want)


def near_copies():
    """Groups of near copies with repeated and null ids, and a document alone under an id that has a near copy too."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"t{k}w{x}" for x in rng.integers(0, 10**6, 60)) for k in range(6)]
    near = [t.upper() for t in texts]
    rows = [(1, texts[0]), (7, near[0]), (7, texts[1])]  # 7 is gone as a copy of 1 and stays alone
    rows += [(3, texts[2]), (None, near[2]), (None, texts[2])]  # a null id is the largest
    rows += [(None, texts[3]), (None, near[3]), (None, texts[3])]  # only null ids
    rows += [(5, texts[4]), (5, near[4]), (5, texts[4])]  # the least id several times
    return [(i, t, "x") for i, t in rows + [(9, texts[5])]]


@pytest.mark.parametrize("table", ["near", "odd cases"])
def test_simhash_dedup_decides_by_row(spark, rows, table):
    rows = near_copies() if table == "near" else [(r[0], r[1], r[2]) for r in rows]
    groups = {}
    for k, _, c in simhash([(k, r[1]) for k, r in enumerate(rows)]):
        groups.setdefault(c, []).append(rows[k])
    df = spark.createDataFrame(rows, "doc_id long, text string, n string").repartition(3)
    kept = sh.simhash_dedup(df)
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == df.columns and len(got) == len(groups)
    for members in groups.values():
        own = [r for r in got if r in members]
        assert len(own) == 1 and own[0][0] == least_known([r[0] for r in members])
    if table == "near":
        assert sorted((r[0] for r in got), key=repr) == [1, 3, 5, 7, 9, None] and (7, rows[2][1], "x") in got


def test_embedding_dedup_decides_by_row(spark):
    unit = np.eye(8).tolist()
    rows = [(1, unit[0]), (7, unit[0]), (7, unit[1]), (3, unit[2]), (None, unit[2]), (None, unit[3]), (None, unit[3]), (5, unit[4]), (5, unit[4])]
    rows += [(1, None), (1, None), (None, [0.0] * 8), (None, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in embedding_dedup.embedding_dedup(df).collect()]
    want = [rows[0], rows[2], rows[3], rows[5], rows[7], *rows[9:]]
    assert sorted(got, key=repr) == sorted(want, key=repr)

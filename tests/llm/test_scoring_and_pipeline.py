import json
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import SPACE, lower, simhash, split, word_counts

import __spark_entry__ as entry
import corpus_pipeline
from assetlake.llm import lm_scoring as lm
from assetlake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def learns(doc_id, folds=10):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds != 0


def unigram(rows):
    seen = word_counts(t for i, t in rows if learns(i))
    total, distinct = sum(seen.values()), len(seen)
    out = []
    for i, t in rows:
        tokens = [*split(lower(t)), None]
        score = sum(math.log10((seen[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        out.append((i, not learns(i), len(tokens), sum(seen[w] > 0 for w in tokens), total, round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("direct", [lm.DIRECT, 50, 1])
def test_unigram_part(docs, rows, direct):
    got = lm.score(docs, direct=direct, rounds=1).collect()
    assert sorted(((*r[:5], round(r[5], 6)) for r in got), key=repr) == unigram([r[:2] for r in rows])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_the_model_is_normalised():
    rng = np.random.default_rng(0)
    q = rng.random(40) + 0.01
    model = lm.LogBilinear([*lm.LogBilinear.start(q / q.sum())])
    model.r += rng.normal(size=model.r.shape)
    before, log10 = rng.integers(0, 40, 6), model.scorer()
    total = 0.0
    for w in range(40):
        ids = np.append(before, w)
        total += 10 ** (log10(ids) - log10(before))
    assert abs(total - 1) < 1e-4


def test_gradients_are_those_of_the_objective():
    rng = np.random.default_rng(1)
    q = np.full(12, 1 / 12)
    model = lm.LogBilinear(lm.LogBilinear.start(q))
    context, target, noise = rng.integers(0, 12, (5, lm.CONTEXT)), rng.integers(0, 12, 5), rng.integers(0, 12, lm.NOISE)
    log_noise = np.log(lm.NOISE * q)

    def objective():
        predicted = model.predicted(context)
        data = (predicted * model.v[target]).sum(axis=1) + model.b[target] - log_noise[target]
        false = predicted @ model.v[noise].T + model.b[noise] - log_noise[noise]
        return (-np.log1p(np.exp(-data)).sum() - np.log1p(np.exp(false)).sum()) / len(target)

    grads = model.gradients(context, target, noise, log_noise)
    for p, g in zip((model.r, model.c, model.v, model.b), grads):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(8)]:
            p[at] += 1e-5
            up = objective()
            p[at] -= 2e-5
            down = objective()
            p[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_the_model_beats_the_unigram_on_held_out_documents(spark):
    got = QUERIES["op1_lm_scoring"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert len(got) == 1000 and len(held) > 50
    assert sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens + 0.05


def plain_score(text, seen, params, words):
    """The score of a text, token by token with plain loops; ``seen`` has the counts of the learning texts."""
    r, c, v, b = params
    tail = lambda w: zlib.crc32(w.encode()[-2:]) % lm.CLASSES
    output = lambda w: 0 if w is None else words.index(w) + 1 if w in words else len(words) + 1 + tail(w)
    tokens, log = [*split(lower(text or "")), None], 0.0
    for t, word in enumerate(tokens):
        before = [output(tokens[t - 1 - i]) if t - 1 - i >= 0 else 0 for i in range(lm.CONTEXT)]
        q = [sum(c[i][d] * r[before[i]][d] for i in range(lm.CONTEXT)) for d in range(lm.WIDTH)]
        scores = [sum(x * y for x, y in zip(q, v[k])) + b[k] for k in range(len(b))]
        top = max(scores)
        log += (scores[output(word)] - top - math.log(sum(math.exp(s - top) for s in scores))) / math.log(10)
        if output(word) > len(words):
            others = [w for w in seen if w is not None and w not in words and tail(w) == tail(word)]
            mass = lm.SMOOTH + sum(seen[w] + lm.SMOOTH for w in others)
            log += math.log10((seen.get(word, 0) + lm.SMOOTH) / mass)
    return log


def test_scores_token_by_token(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(x)}" for x in rng.integers(0, 12, n)) for n in (1, 5, 9, 14, 30)] * 4 + ["", None, "New wörd w1", "É" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = []

    def some(encoded, size, q, rounds):
        params = lm.LogBilinear.start(q)
        made[:] = [p + rng.normal(0, 0.5, p.shape) for p in params]
        return made

    monkeypatch.setattr(lm, "train", some)
    seen = Counter(w for i, t in enumerate(texts) if learns(i) for w in split(lower(t or "")))
    # With ``direct`` at 30 some words are joined, and the outputs are the words over a thirtieth of the tokens.
    for direct in (lm.DIRECT, 30):
        got = {r["doc_id"]: r["score"] for r in lm.score(docs, direct=direct).collect()}
        total = sum(seen.values()) + sum(map(learns, range(len(texts))))
        words = sorted((w for w in seen if seen[w] > total / direct), key=lambda w: (-seen[w], w))[: lm.WORDS]
        assert len(got) == len(texts)
        for i, text in enumerate(texts):
            assert abs(got[i] - plain_score(text, seen, made, words)) < 1e-3 * (1 + len(text or ""))


def levelled(rng, words=4, members=30, heads=3):
    vocabulary = lm.Vocabulary([b"t%d" % i for i in range(words)], [b"m%d" % i for i in range(members)], heads)
    often = {w: int(rng.integers(5, 50)) for w in vocabulary.own}
    held, q = vocabulary.weights(often, rng.random(lm.CLASSES * heads) + 0.1)
    return vocabulary, held, q


@pytest.mark.parametrize("heads", [1, 3])
def test_outputs_in_two_levels(heads):
    rng = np.random.default_rng(5)
    vocabulary, held, q = levelled(rng, heads=heads)
    levels = vocabulary.levels
    ids = vocabulary.ids([b"", b"t0", b"t3", *(b"m%d" % i for i in range(30)), *(b"x%d" % i for i in range(1000))])
    assert len(set(ids[:33])) == 33 and list(vocabulary.is_rare(ids)) == [False] * 33 + [True] * 1000
    assert not set(ids[:33]) & set(ids[33:]) and len(set(ids[33:])) <= lm.CLASSES * heads
    assert abs(q[: levels.first].sum() - 1) < 1e-9
    for a, b in zip(levels.starts, levels.starts[1:]):
        assert a == b or abs(q[a:b].sum() - 1) < 1e-9
    # All outputs that words have share one, after any context.
    model = lm.LogBilinear([p + rng.normal(0, 0.5, p.shape) for p in lm.LogBilinear.start(q)], levels)
    reached = [*np.flatnonzero(held)]
    before, log10 = np.array(reached)[rng.integers(0, len(reached), 6)], model.scorer()
    assert abs(sum(10 ** (log10(np.append(before, w)) - log10(before)) for w in reached) - 1) < 1e-4
    texts = [np.array(reached)[rng.integers(0, len(reached), n)] for n in (1, 7, 3000)]
    together = model.texts_scorer()(np.concatenate(texts), np.array([1, 7, 3000]))
    assert np.allclose(together, [log10(t) for t in texts], rtol=1e-4)


@pytest.mark.parametrize("heads", [1, 3])
def test_outputs_of_words_of_any_length(heads):
    vocabulary = lm.Vocabulary([b"t"], [b"member", b"m2"], heads)
    words = [b"", b"a", b"t", "é".encode(), b"ab", b"member", b"abc", b"m2", b"x" * 99, bytes([0, 255]), b"\xff"]
    part = lambda w: zlib.crc32(w[-2:]) % lm.CLASSES * heads + zlib.crc32(w[:2]) % heads
    want = [vocabulary.own[w] if w in vocabulary.own else vocabulary.rare + part(w) for w in words]
    kept = pa.array([b"before", *words], pa.binary()).slice(1)
    assert list(vocabulary.ids(words)) == list(vocabulary.ids(kept)) == want and len(vocabulary.ids([])) == 0


def test_a_noise_word_drawn_often_is_one_column(monkeypatch):
    # Of three outputs all draws meet at most three, so no step may take more than three columns of noise through exp.
    rng = np.random.default_rng(3)
    model = lm.LogBilinear(lm.LogBilinear.start(np.full(3, 1 / 3)))
    context, target, noise = rng.integers(0, 3, (7, lm.CONTEXT)), rng.integers(0, 3, 7), rng.integers(0, 3, lm.NOISE)
    made, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **kw: made.append(x.size) or exp(x, **kw))
    model.gradients(context, target, noise, np.zeros(3))
    assert max(made) <= 7 * 3


def test_rare_words_are_joined_by_sorting_where_a_table_is_too_large(docs, monkeypatch):
    plan = lambda: lm.score(docs, direct=50, rounds=1)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan()
    monkeypatch.setattr(lm, "TABLE", 1)
    assert "ShuffledHashJoin" not in plan()


def test_outputs_grow_with_the_vocabulary():
    sizes = []
    for n in (0, 1_000, 16_000):
        levels = lm.Vocabulary([], [b"%d" % i for i in range(n)], 1).levels
        assert levels.size >= n and levels.first <= lm.CLASSES + 2 + 1.1 * n**0.5
        assert max(np.diff(levels.starts), default=0) <= max(1, n**0.5)
        sizes.append(levels.size)
    assert sizes == sorted(set(sizes))


def test_words_below_the_limit_share_parts_of_classes(spark, monkeypatch):
    rng = np.random.default_rng(6)
    frequent = [f"f{i}é" for i in range(40)]
    texts = [" ".join([*(f"{chr(97 + k % 26)}{k:x}" for k in range(100 * i, 100 * i + 100)), *rng.choice(frequent, 60)]) for i in range(800)]
    texts += ["a", "é b new-word F1É f1é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    made = []

    def some(encoded, levels, q, rounds):
        made[:] = [p + rng.normal(0, 0.5, p.shape) for p in lm.LogBilinear.start(q)], q
        return made[0]

    monkeypatch.setattr(lm, "train", some)
    monkeypatch.setattr(lm, "WORDS", 10)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, direct=2_000).collect()}
    seen = Counter(w.encode() for i, t in enumerate(texts) if learns(i) for w in split(lower(t)))
    learnt = sum(map(learns, range(len(texts))))
    total = sum(seen.values()) + learnt
    ranked = sorted((w for w in seen if seen[w] > total / 2_000), key=lambda w: (-seen[w], w))
    heads = math.isqrt(len(seen) + 1) // lm.CLASSES
    vocabulary = lm.Vocabulary(ranked[:10], sorted(ranked[10:], key=lambda w: w[::-1]), heads)
    assert heads == 2 and len(ranked) == 40
    mass = np.full(vocabulary.levels.size, lm.SMOOTH)
    words = list(seen)
    ids = vocabulary.ids(words)
    for w, k in zip(words, ids):
        mass[k] += seen[w] + lm.SMOOTH
    params, q = made
    model = lm.LogBilinear(params, vocabulary.levels).scorer()
    for i in (0, 7, 311, 799, 800, 801):
        own = [*(w.encode() for w in split(lower(texts[i]))), b""]
        outputs = vocabulary.ids(own)
        rare = [(w, k) for w, k in zip(own, outputs) if w not in vocabulary.own]
        want = model(outputs) + sum(math.log10((seen[w] + lm.SMOOTH) / mass[k]) for w, k in rare)
        assert abs(got[i] - want) < 1e-4 * len(own) + 1e-3


def test_context_tells_words_of_one_class_apart(spark):
    """Each word is followed by its own partner; all end alike, so they were one class with their plain shares in it."""
    rng = np.random.default_rng(7)
    n = 300
    texts = []
    for _ in range(1_500):
        picked = rng.integers(0, n, 40)
        texts.append(" ".join(f"a{k % 6}{k}st b{k % 6}{k}st" for k in picked))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = lm.score(docs).where("held_out").collect()
    tokens = sum(r["n_tokens"] for r in got)
    gain = (sum(r["score"] for r in got) - sum(r["base_score"] for r in got)) / tokens
    assert len(got) > 80 and gain > 0.3 + 0.2, gain


def test_words_and_texts_split_up_as_by_bytes():
    import pyarrow as pa

    texts = [None, "", " ", "A\x1cB\x0bc\x0c D\u2003É\x85ß \u3000", "\t x\r\ny ", "a" * 70]
    flat, n = lm.split_up(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert flat.to_pylist() == sum(want, []) and list(n) == list(map(len, want))


def test_scores_beyond_single_precision():
    q = np.full(8, 1 / 8)
    r, c, v, b = lm.LogBilinear.start(q)
    model = lm.LogBilinear([r, c, v, b + np.array([0, 300.0, 0, 0, 0, 0, 0, -300])])
    assert abs(model.scorer()(np.array([1, 1, 1]))) < 1e-5 and -265 < model.scorer()(np.array([1, 7])) < -255
    low = lm.LogBilinear([r, c, v, b - 200])
    assert abs(low.scorer()(np.array([3])) - math.log10(1 / 8)) < 0.3


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(4)
    q = np.full(20, 1 / 20)
    ids = (np.cumsum(rng.integers(1, 3, 60_000)) % 20).astype(np.uint8)  # the next is one or two further
    model = lm.LogBilinear(lm.LogBilinear.start(q))
    assert model.train(iter([ids]), q, 1) == len(ids)
    assert model.scorer()(ids[:2000]) / 2000 > math.log10(1 / 20) + 0.7


def test_scoring_of_nothing(spark, nothing, odd):
    assert lm.score(nothing).isEmpty()
    got = lm.score(odd.where("doc_id is null")).collect()
    assert [(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(True, 1, 0, 0)]
    assert abs(got[0]["base_score"]) < 1e-12 and all(r["n_tokens"] == 1 for r in lm.score(odd).collect())


def test_pipeline_stages(spark, docs, rows):
    """Each stage against its brute-force version on its own input."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "best_fit_packing"]
    stage = dict(corpus_pipeline.STAGES)
    told = stage["language_id"](spark, docs, SMALL)
    assert told.columns == docs.columns
    kept = [tuple(r) for r in told.collect()]
    assert all(any(c.isalpha() for c in r[1]) for r in kept) and set(kept) <= set(rows)
    plain = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert len(kept) >= 0.7 * len(plain)
    exact = stage["exact_dedup"](spark, docs, SMALL)
    assert exact.count() == len({SPACE.sub(" ", r[1] or "") for r in rows})  # a row of each text, also where an id has two
    near = stage["simhash_dedup"](spark, exact, SMALL)
    one = [tuple(r)[:2] for r in exact.collect()]
    assert {r["doc_id"] for r in near.collect() if r["doc_id"] is not None} == {c for _, _, c in simhash(one) if c is not None}
    mixed = stage["mixing"](spark, near, SMALL)
    assert mixed.columns == docs.columns
    times = Counter(tuple(r) for r in mixed.collect())
    assert max(times.values()) <= 6 and set(times) <= {tuple(r) for r in near.collect()}
    packed = stage["best_fit_packing"](spark, mixed, SMALL).collect()
    fill = defaultdict(int)
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len([r for r in packed if r["piece"] == 0]) == sum(times.values())


def test_pipeline_runs_on_anything(spark, nothing, odd):
    for table in (nothing, odd):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, SMALL)
        assert table.isEmpty()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.count() >= 0.98 * docs.count()


def test_pipeline_query(spark):
    got = entry.queries()["pipeline"](spark, SMALL)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns) and got.count() > 100


def test_entry_has_every_operator():
    names = entry.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert json.dumps(sorted(entry.oracle_sql())) and "pipeline" in names

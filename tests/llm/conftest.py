import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size long, position string, hash int, n string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def corpus(seed=5):
    """Documents with copies, near copies, shared passages, a hot source and group, and every odd case."""
    rng = random.Random(seed)
    passage = words(rng, 70, 10**6)
    texts = [words(rng, rng.randrange(1, 150)) for _ in range(120)]
    texts += [texts[0]] * 60 + [texts[0].replace(" ", "\n\t "), texts[1] + " ", texts[1] + "  ", " " + texts[1]]
    texts += [words(rng, rng.randrange(0, 90)) + " " + passage + " " + words(rng, rng.randrange(0, 40)) for _ in range(25)]
    long = words(rng, 30_000, 10**5)
    near = long.split(" ")
    near[50] = "changed"
    texts += [long, " ".join(near), "Zß ÉA B\x1cC D", "a", "A", "", " ", "\n", None, None, "x " * 400, "don't  stopé!! 12 34", "<|endoftext|> hi"]
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else ("hot" if i % 3 else f"s{i % 4}")
        lang = None if i % 13 == 0 else ("en" if i % 2 else "xx")
        rows.append((i * 3 - 4, text, lang, source, len(text or ""), "k", 7, "p", 1, None))
    rng.shuffle(rows)
    # A row twice, an id with two texts, and null ids.
    rows += [rows[0], (rows[1][0], "another text of the same id", *rows[1][2:])]
    rows += [(None, texts[3], "en", None, 1, "k", 7, "p", 1, None), (None, "no id", None, "hot", 5, "k", 7, "p", 1, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Only rows without anything to read."""
    return spark.createDataFrame([(1, None), (2, ""), (None, None), (4, " \n")], "doc_id long, text string").selectExpr(
        "doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "0L n_chars"
    )

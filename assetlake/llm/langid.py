"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import held_out, in_process, learns

FOLDS = 5
BITS = 15
ORDERS = 3
#: Expected number of labelled rows per language that the weights are fitted on; document frequencies use all rows.
SAMPLE_PER_LANGUAGE = 1_000
#: Texts whose counts a task holds at once.
VECTORS = 200
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"


def letters() -> np.ndarray:
    """For each code point the letter itself (0: not a letter)."""
    points = np.arange(0x110000, dtype=np.uint32)
    is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(is_letter, points, 0).astype(np.uint32)


class Grams:
    """Counts of hashed character n-grams of orders 1 to ``ORDERS``; runs of other characters act as one border."""

    def __init__(self):
        self.table = letters()

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        points = self.table[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        if not points.any():
            return None
        inner = (points != 0) | np.append(True, points[:-1] != 0)
        points = np.concatenate(([0], points[inner], [0])).astype(np.uint32)
        total = np.zeros(1 << BITS, np.int64)
        code = np.zeros(len(points), np.uint32)
        for order in range(1, ORDERS + 1):
            n = len(points) - order + 1
            if n < 1:
                break
            code = code[:n] * np.uint32(0x01000193) + points[order - 1 : order - 1 + n] + np.uint32(1)
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)
            total += np.bincount(mixed >> np.uint32(32 - BITS), minlength=1 << BITS)
        at = np.flatnonzero(total)
        return at, total[at]


@dataclass
class Model:
    """Weights (class by feature), inverse document frequencies and the temperature."""

    labels: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, at: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        p = softmax(logits(self.weights, *weighted(at, counts, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length, with a damped term frequency."""
    value = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, value / norm if norm > 0 else value


def logits(weights: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    return weights[:, at] @ value


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, features: int) -> np.ndarray:
    """Follow-the-regularised-leader with per-coordinate rates and elastic-net penalties."""
    z, n = np.zeros((classes, features)), np.zeros((classes, features))

    def weights(at):
        zz, nn = z[:, at], n[:, at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            w = weights(at)
            slip = softmax(w @ value)
            slip[labels[i]] -= 1
            g = slip[:, None] * value
            squares = n[:, at]
            step = (np.sqrt(squares + g * g) - np.sqrt(squares)) / ALPHA
            z[:, at] += g - step * w
            n[:, at] = squares + g * g
    return weights(np.arange(features))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross-entropy on rows kept from the fit.

    As in Platt scaling the true class counts (n + 1) / (n + 2), the others share the rest, so that rows without an
    error don't drive the temperature to zero.
    """
    n = len(labels)
    if not n or scores.shape[1] < 2:
        return 1.0
    target = np.full(scores.shape, 1 / (n + 2) / (scores.shape[1] - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t):
        x = scores / t
        x = x - x.max(axis=1, keepdims=True)
        return (np.log(np.exp(x).sum(axis=1)) - (target * x).sum(axis=1)).mean()

    return float(min(np.exp(np.linspace(np.log(0.01), np.log(20), 200)), key=loss))


def train(labelled: DataFrame, id_col: str, text_col: str, label_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on ``labelled``, rows whose label is not null; None if no text there has a letter.

    Document frequencies are counted over all rows in one pass; only the weights and the temperature use a sample,
    of ``per_language`` expected rows for each label, chosen by a hash of the id.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    rows = rows.where("text is not null and label is not null")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    even = (F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit("langid")), 11)) / F.lit(float(1 << 53))
    # One row per label: a model has a row of weights for each of them.
    chosen = rows.join(F.broadcast(counts), "label").where(even * F.col("n") < per_language)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, found, n = in_process("grams", Grams), np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                if (c := grams.counts(text.as_py())) is not None:
                    found[c[0]] += 1
                    n += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], n), pa.int64())], ["at", "n"]
        )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = in_process("grams", Grams)
        for batch in (b.slice(at, VECTORS) for b in batches for at in range(0, b.num_rows, VECTORS)):
            made = [grams.counts(t) for t in batch.column(1).to_pylist()]
            keep = [i for i, m in enumerate(made) if m is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array([made[i][0] for i in keep], pa.list_(pa.int32())),
                    pa.array([made[i][1] for i in keep], pa.list_(pa.int32())),
                    batch.column(2).take(pa.array(keep, pa.int64())),
                ],
                ["label", "at", "counts", "part"],
            )

    found = rows.select("text").mapInArrow(frequencies, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    df = {r["at"]: r["n"] for r in found.collect()}  # at most 2 ** BITS rows, and the number of texts
    total = df.pop(-1, 0)
    if not total:
        return None
    idf = np.zeros(1 << BITS)
    at = np.fromiter(df, np.int64, len(df))
    idf[at] = np.log((1 + total) / (1 + np.fromiter(df.values(), np.float64, len(df)))) + 1
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("calibrate")), F.lit(5)).cast("int")
    sample = chosen.select("label", "text", part.alias("part")).mapInArrow(
        vectors, "label string, at array<int>, counts array<int>, part int"
    )
    got = sorted((r["label"], r["part"], r["at"], r["counts"]) for r in sample.toLocalIterator())
    labels = sorted({g[0] for g in got})
    if not labels:
        return None
    xs = [weighted(np.array(a, np.int64), np.array(c, np.float64), idf) for _, _, a, c in got]
    ys = np.array([labels.index(g[0]) for g in got])
    fits = np.array([g[1] != 0 for g in got])
    if not fits.any():
        fits[:] = True
    weights = fit_ftrl([x for x, f in zip(xs, fits) if f], ys[fits], len(labels), 1 << BITS)
    rest = [logits(weights, *x) for x, f in zip(xs, fits) if not f]
    return Model(labels, weights, idf, fit_temperature(np.array(rest).reshape(len(rest), len(labels)), ys[~fits]))


def predictions(texts: pa.Array, grams: Grams, model: Model | None) -> Iterator[tuple[str, float]]:
    """The label and score of each text; only one text's counts are held at a time."""
    for text in texts:
        made = grams.counts(t) if model is not None and (t := text.as_py()) else None
        yield (UNKNOWN, 0.0) if made is None else model.predict(*made)


def predict(docs: DataFrame, model: Model | None, id_col: str, text_col: str, carry: list[str | Column]) -> DataFrame:
    """``carry`` columns with ``lang_pred`` and ``score``; only the text is looked at."""
    rows = docs.select(*carry, F.col(text_col).alias("_li_text"))
    kept = rows.drop("_li_text")
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else vars(model))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, model = in_process("grams", Grams), None if shared.value is None else Model(**shared.value)
        for batch in batches:
            out = list(predictions(batch.column(batch.num_columns - 1), grams, model))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return rows.mapInArrow(classify, f"{fields}, lang_pred string, score double")


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", folds: int = FOLDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Predict the language of each whole text after learning from the rows whose fold is not 0.

    Adds ``held_out``, ``lang_pred`` and ``score``, the calibrated probability of the prediction. Only texts and
    non-null labels of the learning rows are learnt from; a prediction sees nothing but the text. Null texts and
    texts without a letter give ``und`` with score 0, as do all texts when there is nothing to learn from. Rows
    with null ids are held out. Repeated rows get equal results; columns called like the added ones are replaced.
    """
    added = {"held_out", "lang_pred", "score"}
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in added]
    model = train(docs.where(learns(id_col, folds)), id_col, text_col, label_col)
    carried = [F.col(f"`{c}`") for c in names] + [held_out(id_col, folds).alias("held_out")]
    return predict(docs, model, id_col, text_col, carried)

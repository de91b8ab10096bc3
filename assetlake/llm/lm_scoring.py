"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation on all learning texts."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import held_out, learns
from assetlake.session import cut_lineage

FOLDS = 10
SMOOTH = 0.1
#: Words with over 1 / DIRECT of all tokens, so fewer than DIRECT words, are looked up inside the tasks and are outputs of
#: their own; the others share outputs.
DIRECT = 131_072
#: Outputs told apart at once: the end, the most frequent words, groups of the other words over the limit, and classes of
#: the words below it by their last two bytes. Groups and the parts of classes grow with the vocabulary.
WORDS, CLASSES = 128, 127
WIDTH, CONTEXT = 16, 4
ROUNDS = 2
NOISE, BATCH, RATE, FLOOR = 64, 2_048, 0.15, 1e-6
#: Scores of one matrix product, tokens whose inner outputs are scored together, tokens of
#: one shuffled run of training, and the range in which exponentials of single precision need no shift.
BLOCK, SPAN, RUN, LARGEST, SMALLEST = 1 << 19, 1 << 17, 1 << 20, 80.0, 1e-30
#: Bytes of text split up at once, and numbers of a model in one row of the average.
CHUNK, PIECE = 1 << 23, 1 << 12
#: Bytes of counted words in a partition, with PLACE for each, up to which they are joined by a hash table, not by sorting.
TABLE, PLACE = 1 << 26, 100
END = b""


def split_up(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, A-Z in lower case, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat, parents = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(flat), 0)  # leading and trailing white space give empty pieces
    n = np.bincount(parents.filter(some).to_numpy(zero_copy_only=False), minlength=len(texts))
    return flat.filter(some).cast(pa.binary()), n


def chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about CHUNK bytes of the texts in ``column``, at least a row each."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; the empty word is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = 0
        for batch in chunks(batches, 0):
            seen = pc.value_counts(split_up(batch.column(0))[0])
            ends += batch.num_rows
            yield pa.RecordBatch.from_arrays([seen.field("values"), seen.field("counts")], ["word", "n"])
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], ["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@cache
def crc_table() -> np.ndarray:
    """The crc32 of all texts of two bytes (at 256 times the first plus the second), then of those of one byte."""
    two, one = (zlib.crc32(i.to_bytes(2)) for i in range(1 << 16)), (zlib.crc32(i.to_bytes(1)) for i in range(1 << 8))
    return np.array([*two, *one], np.int64)


def end_crcs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The crc32 of the first two and of the last two bytes of words of at least one byte."""
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data, start, stop = np.frombuffer(words.buffers()[2], np.uint8), bounds[:-1], bounds[1:]

    def crc(at: np.ndarray) -> np.ndarray:
        one, two = data[at].astype(np.intp), data[np.minimum(at + 1, stop - 1)]
        return crc_table()[np.where(stop - start == 1, (1 << 16) + one, (one << 8) + two)]

    return crc(start), crc(np.maximum(stop - 2, start))


class Space:
    """Arrays by name that are used again: to get a new one from the system costs more than the work done in it."""

    def __init__(self):
        self.kept = {}

    def __call__(self, name: str, shape: tuple[int, ...], dtype: type) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or len(self.kept[name]) < size:
            self.kept[name] = np.empty(size, dtype)
        return self.kept[name][:size].reshape(shape)


class Levels:
    """Outputs in two levels: the first ``first`` are told apart at once; the others lie in groups, one after the other,
    each group below one of the first, its parent."""

    def __init__(self, first: int, parents: np.ndarray, sizes: np.ndarray):
        self.first = first
        self.starts = first + np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        groups = np.arange(len(sizes), dtype=np.uint16 if len(sizes) <= 1 << 16 else np.uint32)
        self.group = np.repeat(groups, sizes)  # 16 bits are sorted by counting
        self.parent = np.concatenate((np.arange(first), np.repeat(parents, sizes))).astype(np.int64)

    @property
    def size(self) -> int:
        return len(self.parent)

    @property
    def dtype(self) -> type:
        return np.uint8 if self.size <= 1 << 8 else np.uint16 if self.size <= 1 << 16 else np.uint32

    def inner(self, ids: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Per group of at least two outputs that is met: its bounds and the places of its outputs, as in ``order``."""
        order = order[ids[order] >= self.first]
        if len(order):
            group = self.group[ids[order] - self.first]
            order = order[np.argsort(group, kind="stable")]
            ends = np.cumsum(np.bincount(group, minlength=len(self.starts) - 1))
            for k, (a, b) in enumerate(zip(np.concatenate(([0], ends)), ends)):
                if a < b and self.starts[k + 1] - self.starts[k] > 1:
                    yield int(self.starts[k]), int(self.starts[k + 1]), order[a:b]


class Vocabulary:
    """Outputs of words: 0 is the end, then come the most frequent ``words``, groups of ``members``, and classes.

    ``members`` are cut into as many groups as a group has words, by their order from the last byte on; each is an output
    below its group. The ``heads`` parts of a class, by a word's first two bytes, are outputs below the class.
    """

    def __init__(self, words: list[bytes], members: list[bytes], heads: int):
        per = max(1, math.isqrt(len(members)))
        groups = -(-len(members) // per)
        parts = heads if heads > 1 else 0  # a class of one part is an output itself
        first = 1 + len(words) + groups + CLASSES
        sizes = [*(min(per, len(members) - at) for at in range(0, len(members), per)), *([parts] * CLASSES)]
        self.levels = Levels(first, np.arange(1 + len(words), first), np.array(sizes))
        #: The first output of words that are not known one by one; those of groups lie between, but no word has them.
        self.rare = first + len(members) if parts else first - CLASSES
        self.own = {END: 0} | {w: i + 1 for i, w in enumerate(words)} | {w: first + i for i, w in enumerate(members)}
        self.heads, self.listed = heads, pa.array(list(self.own), pa.binary())

    def is_rare(self, ids: np.ndarray) -> np.ndarray:
        return (ids >= self.rare) & ((ids < self.levels.first) | (self.rare >= self.levels.first))

    def ids(self, words: list[bytes] | pa.Array) -> np.ndarray:
        words = pa.array(words, pa.binary())
        at = pc.index_in(words, value_set=self.listed).fill_null(-1).to_numpy(zero_copy_only=False)
        ids, other = np.fromiter(self.own.values(), np.int64, len(self.own))[at], at < 0
        if other.any():
            first, last = end_crcs(words.filter(pa.array(other)))
            ids[other] = self.rare + last % CLASSES * self.heads + first % self.heads
        return ids.astype(self.levels.dtype)

    def weights(self, often: dict[bytes, int], mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per output its smoothed count, and its share: among the first ones, or of its group."""
        held, levels = np.zeros(self.levels.size), self.levels
        for w, i in self.own.items():
            held[i] = often[w] + SMOOTH
        held[self.rare : self.rare + len(mass)] = mass
        inner = np.bincount(levels.parent[levels.first :], held[levels.first :], levels.first)
        first = held[: levels.first] + inner
        return held, np.concatenate((first / first.sum(), held[levels.first :] / first[levels.parent[levels.first :]]))


class LogBilinear:
    """Context vectors R, position weights C, target vectors V and biases b; a context predicts q = sum of C_i * R[w_i]."""

    def __init__(self, params: list[np.ndarray], levels: Levels | None = None):
        self.r, self.c, self.v, self.b = (p.copy() for p in params)
        self.levels = levels or Levels(len(self.b), np.zeros(0, int), np.zeros(0, int))

    @staticmethod
    def start(q: np.ndarray) -> list[np.ndarray]:
        rng = np.random.default_rng(3)
        size = (len(q), WIDTH)
        return [rng.normal(0, 0.1, size), np.full((CONTEXT, WIDTH), 0.5), rng.normal(0, 0.1, size), np.log(q)]

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return sum(self.c[i] * self.r.take(context[:, i], axis=0) for i in range(CONTEXT))

    def scorer(self):
        """A function that gives the log10 probability of a text's outputs; see :meth:`texts_scorer`."""
        each = self.texts_scorer()
        return lambda ids: float(each(ids, np.array([len(ids)]))[0])

    def texts_scorer(self):
        """A function of the outputs of texts one after the other and the texts' lengths, each at least 1, that gives
        their log10 probabilities, normalised over the first outputs and within each group."""
        size, levels, space = len(self.b), self.levels, Space()
        # The bias is one more coordinate, so a block's scores are one matrix product.
        around = [np.hstack((c * self.r, np.full((size, 1), i == 0))).astype(np.float32) for i, c in enumerate(self.c)]
        v = np.vstack((self.v.T, self.b)).astype(np.float32)
        longest, highest = math.sqrt(float(np.square(self.v, dtype=np.float64).sum(axis=1).max())), float(self.b.max())
        ones = np.ones(size, np.float32)

        def logs(hidden: np.ndarray, target: np.ndarray, start: int, stop: int, small: bool) -> np.ndarray:
            """Natural logarithms of the probabilities of ``target`` among the outputs from ``start`` to ``stop``."""
            scores = np.matmul(hidden, v[:, start:stop], out=space("scores", (len(target), stop - start), np.float32))
            reached = scores[np.arange(len(target)), target - start]
            if small or scores.max() < LARGEST:
                if (sums := np.exp(scores, out=scores) @ ones[: stop - start]).min() > SMALLEST:
                    return reached - np.log(sums)
                scores = hidden @ v[:, start:stop]
            top = scores.max(axis=1)  # beyond single precision: each row from its largest score
            return reached - np.log(np.exp(scores - top[:, None]).sum(axis=1)) - top

        def log10(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
            place = np.arange(len(ids)) + CONTEXT * np.repeat(np.arange(1, len(lengths) + 1), lengths)
            padded = np.zeros(len(ids) + CONTEXT * len(lengths), np.intp)
            padded[place] = ids
            total = np.empty(len(ids))
            for at in range(0, len(ids), SPAN):
                here = ids[at : at + SPAN].astype(np.intp)
                before, out = place[at : at + SPAN] - 1, total[at : at + SPAN]
                hidden, more = (space(name, (len(here), WIDTH + 1), np.float32) for name in ("hidden", "more"))
                around[0].take(padded[before], axis=0, out=hidden, mode="clip")
                for i in range(1, CONTEXT):
                    np.add(hidden, around[i].take(padded[before - i], axis=0, out=more, mode="clip"), out=hidden)
                # No score is beyond the product of the longest vectors and the highest bias.
                small = math.sqrt(float(np.einsum("ij,ij->i", hidden, hidden).max())) * longest + highest < LARGEST
                top, step = levels.parent[here], max(1, BLOCK // levels.first)
                for k in range(0, len(here), step):
                    out[k : k + step] = logs(hidden[k : k + step], top[k : k + step], 0, levels.first, small)
                for start, stop, rows in levels.inner(here, np.arange(len(here))):
                    step = max(1, BLOCK // (stop - start))
                    for k in range(0, len(rows), step):
                        some = rows[k : k + step]
                        out[some] += logs(hidden.take(some, axis=0), here[some], start, stop, small)
            return np.add.reduceat(total, np.cumsum(lengths) - lengths) / math.log(10)

        return log10

    def train(self, batches: Iterator[np.ndarray], q: np.ndarray, seed: int) -> int:
        """One pass of noise-contrastive estimation with shared noise words and adaptive rates; returns the tokens.

        The pass is in single precision; each array of ``batches`` is trained in random order. A step tells apart the
        first outputs, or those of one group, and touches the context vectors that it meets.
        """
        rng, n, levels = np.random.default_rng(seed), 0, self.levels
        self.r, self.c, self.v, self.b = params = [p.astype(np.float32) for p in (self.r, self.c, self.v, self.b)]
        squares = [np.full(p.shape, FLOOR, np.float32) for p in params]
        log_noise = np.log(NOISE * q).astype(np.float32)
        met, local = np.zeros(len(self.r), bool), np.zeros(len(self.r), np.intp)
        space = Space()
        for ids in batches:
            padded, n = np.concatenate((np.zeros(CONTEXT, ids.dtype), ids)), n + len(ids)
            # The words before each token, nearest first, as one item that is fetched at once.
            before = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[: len(ids), ::-1])
            before = before.view(np.dtype((np.void, CONTEXT * ids.itemsize))).ravel()
            order, top = rng.permutation(len(ids)), levels.parent[ids]
            parts = [(0, levels.first, order), *levels.inner(ids, order)]
            steps = [(start, stop, places[at : at + BATCH]) for start, stop, places in parts for at in range(0, len(places), BATCH)]
            for k in rng.permutation(len(steps)):
                start, stop, take = steps[k]
                context = before.take(take).view(ids.dtype).reshape(-1, CONTEXT)
                met[context] = True
                rows = np.flatnonzero(met)  # at most BATCH * CONTEXT
                met[rows] = False
                local[rows] = np.arange(len(rows))
                cumulative = np.cumsum(q[start:stop])
                noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE) * cumulative[-1]), stop - start - 1)
                target = (ids if start else top)[take].astype(np.intp) - start
                part = LogBilinear([self.r.take(rows, axis=0), self.c, self.v[start:stop], self.b[start:stop]], levels)
                grads = part.gradients(local[context], target, noise, log_noise[start:stop], space)
                for p, s, w, old, g in zip(params, squares, (rows, ..., slice(start, stop), slice(start, stop)), part.params(), grads):
                    g *= np.float32(len(take) / BATCH)  # a step of few tokens moves the model less
                    square = s.take(rows, axis=0) if w is rows else s[w]
                    square += g * g
                    if w is rows:
                        s[w] = square
                    g *= np.float32(RATE)
                    g /= np.sqrt(square)
                    old += g
                    p[w] = old
        return n

    def params(self) -> list[np.ndarray]:
        return [self.r, self.c, self.v, self.b]

    def gradients(self, context, target, noise, log_noise, space=None):
        """The objective's mean gradients by ``params``, for contexts (a row of CONTEXT words each) and their targets."""
        space, (size, width), n, dtype = space or Space(), self.r.shape, len(target), self.r.dtype
        near = self.r.take(context, axis=0, out=space("near", (n, CONTEXT, width), dtype), mode="clip")
        flat = near.reshape(n, CONTEXT * width)
        predicted = np.matmul(flat, np.vstack([np.diag(c) for c in self.c]), out=space("predicted", (n, width), dtype))
        noise, times = np.unique(noise, return_counts=True)  # a noise word drawn several times is one column
        times = times.astype(dtype)[:, None]
        vt, vn, shift = self.v.take(target, axis=0, out=space("vt", (n, width), dtype), mode="clip"), self.v[noise], self.b - log_noise
        data = 1 / (1 + np.exp(np.einsum("ij,ij->i", predicted, vt) + shift[target]))
        false = np.matmul(predicted, -vn.T, out=space("false", (n, len(noise)), dtype))
        false -= shift[noise]
        np.exp(false, out=false)
        false += 1
        np.divide(-1, false, out=false)
        to_predicted = np.matmul(false, times * vn, out=space("to_predicted", (n, width), dtype))
        vt *= data[:, None]
        to_predicted += vt

        def by_output(rows, lines, size):
            """The sum of the values of each of ``size`` outputs, from a line of values per coordinate."""
            out = np.empty((size, width), dtype)
            for k, line in enumerate(lines):
                out[:, k] = np.bincount(rows, line, size)
            return out

        each = space("each", (width, n), float)
        dv = by_output(target, np.multiply(predicted.T, data, out=each), len(self.b))
        db = np.bincount(target, data, len(self.b)).astype(dtype)
        dv[noise] += times * (false.T @ predicted)
        db[noise] += times[:, 0] * (np.ones(n, dtype) @ false)
        each[:] = to_predicted.T
        spread = space("spread", (CONTEXT, n), float)
        dr = by_output(context.T.ravel(), (np.multiply(c[:, None], line, out=spread).ravel() for c, line in zip(self.c.T, each)), size)
        dc = np.stack([np.einsum("ij,ij->j", near[:, i], to_predicted) for i in range(CONTEXT)])
        for g in (dr, dc, dv, db):
            g /= n
        return [dr, dc, dv, db]


def stored_ids(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of the texts of a binary column, one after the other, and the texts' lengths."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    data = column.buffers()[2] if len(column) else pa.py_buffer(b"")
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data, dtype, int(lengths.sum()) // size, int(first)), lengths // size


def train(encoded: DataFrame, levels: Levels, q: np.ndarray, rounds: int) -> list[np.ndarray]:
    """Parameters after ``rounds`` passes, each over its share of the texts' outputs (columns ``ids`` and ``part``).

    In a pass every task trains its own copy on its texts; the copies are averaged by their tokens in a shuffle, so
    only one model's worth of numbers comes back.
    """
    spark, params = encoded.sparkSession, LogBilinear.start(q)
    params[2][levels.first :] = 0  # at first a word has its share of its group
    shapes = [p.shape for p in params]
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(([p.astype(np.float32) for p in params], q, levels))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start, q, levels = shared.value
            model = LogBilinear(start, levels)

            def joined():
                some, n = [], 0
                for batch in batches:
                    ids, _ = stored_ids(batch.column(0), levels.dtype)
                    for at in range(0, len(ids), RUN):
                        some.append(ids[at : at + RUN])
                        n += len(some[-1])
                        if n >= RUN:
                            yield np.concatenate(some)
                            some, n = [], 0
                if n:
                    yield np.concatenate(some)

            n = model.train(joined(), q, seed=17)
            flat = np.concatenate([p.ravel() for p in model.params()])
            if n:
                pieces = [flat[at : at + PIECE].tobytes() for at in range(0, len(flat), PIECE)]
                columns = [pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary()), pa.array([n] * len(pieces), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["i", "x", "n"])

        def average(copies: pa.Table) -> pa.Table:
            x, n = 0, 0
            for one, times in zip(copies["x"], copies["n"]):
                x, n = x + np.frombuffer(one.as_buffer(), np.float32).astype(np.float64) * times.as_py(), n + times.as_py()
            return pa.table({"i": copies["i"][:1], "x": pa.array([(x / n).astype(np.float32).tobytes()], pa.binary())})

        made = encoded.where(F.col("part") == k).select("ids").mapInArrow(run, "i int, x binary, n long")
        got = made.groupBy("i").applyInArrow(average, "i int, x binary").collect()
        if got:
            flat = np.concatenate([np.frombuffer(r["x"], np.float32) for r in sorted(got, key=lambda r: r["i"])])
            cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
            params = [p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)]
    return params


def encode(rows: DataFrame, vocabulary: tuple, often: dict[bytes, int], held: np.ndarray) -> DataFrame:
    """What training and scoring need of each row (id, text, held_out, part), stored: a text is split up here only.

    ``ids`` are the text's outputs. ``known`` and ``logs`` count and sum over the tokens of the words in ``often``;
    the other words are listed with their ``times``. ``inside`` is what the outputs' own probabilities already hold of
    their words' counts.
    """
    spark, id_type = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((vocabulary, bool(often[END]), held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ends_known, held = shared.value
        vocabulary = Vocabulary(*made)
        logs = np.log10(np.maximum(held, SMOOTH))
        row = TaskContext.get().partitionId() << 33
        names = ["id", "held_out", "part", "row", "n_tokens", "known", "logs", "inside", "ids", "words", "times"]
        for batch in chunks(batches, 1):
            flat, n = split_up(batch.column(1))
            coded = flat.dictionary_encode()
            words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            outputs = vocabulary.ids(words)
            # Each text's words and its end, output 0.
            lengths = n + 1
            stops = np.cumsum(lengths)
            starts = stops - lengths
            ids, is_word = np.zeros(stops[-1], outputs.dtype), np.ones(stops[-1], bool)
            is_word[stops - 1] = False
            ids[is_word] = outputs[code]
            each, rare = logs[ids], vocabulary.is_rare(ids)
            known = np.add.reduceat(~rare, starts, dtype=np.int64) - (not ends_known)
            # The distinct other words of each text.
            text = np.repeat(np.arange(len(n)), n)[rare[is_word]]
            pairs, times = np.unique(text * len(words) + code[rare[is_word]], return_counts=True)
            of_text = np.bincount(pairs // max(1, len(words)), minlength=len(n))
            cuts = pa.array(np.concatenate(([0], np.cumsum(of_text))), pa.int32())
            others = words.take(pa.array(pairs % max(1, len(words))))
            size = ids.dtype.itemsize
            bounds = np.concatenate(([0], stops * size)).astype(np.int32)
            columns = [
                pa.array(np.arange(row, row + len(n))),
                pa.array(lengths, pa.int64()),
                pa.array(known),
                pa.array(np.add.reduceat(np.where(rare, 0.0, each), starts)),
                pa.array(np.add.reduceat(each, starts)),
                pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(cuts, others),
                pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
            ]
            row += len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *columns], names)

    schema = (
        f"id {id_type}, held_out boolean, part int, row long, n_tokens long, known long, logs double, inside double,"
        " ids binary, words array<binary>, times array<int>"
    )
    return cut_lineage(rows.select("id", "text", "held_out", "part").mapInArrow(run, schema), "lm-rows")


def network_scores(encoded: DataFrame, params: list[np.ndarray], levels: Levels) -> DataFrame:
    """``encoded`` without the lists, with ``network``: the log10 probability of a text's outputs."""
    shared = encoded.sparkSession.sparkContext.broadcast((params, levels))
    kept = ["id", "held_out", "row", "n_tokens", "known", "logs", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, levels = shared.value
        log10 = LogBilinear(params, levels).texts_scorer()
        for batch in batches:
            ids, lengths = stored_ids(batch.column(len(kept)), levels.dtype)
            stops, at, scores = np.cumsum(lengths), 0, []
            while at < len(lengths):  # texts of about SPAN tokens together
                first = stops[at] - lengths[at]
                stop = max(at + 1, int(np.searchsorted(stops, first + SPAN, "right")))
                scores.append(log10(ids[first : stops[stop - 1]], lengths[at:stop]))
                at = stop
            made = pa.array(np.concatenate([np.zeros(0), *scores]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], made], [*kept, "network"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.select(*kept).schema)
    return encoded.select(*kept, "ids").mapInArrow(run, f"{fields}, network double")


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, direct: int = DIRECT, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows whose fold is not 0, all of their texts. Tokens are the words, A-Z in lower case, and an end.
    ``base_score`` is the smoothed unigram log10 probability. ``score`` is the model's: the log-bilinear network gives
    every output's probability from the four tokens before, normalised over all outputs; a word outside the most
    frequent ones has its class's probability times its smoothed share of the class, in which one place is left for
    all unseen words. Null texts count as empty: an end alone. Rows with null ids are held out; repeated rows come
    back one for one; with nothing to learn from all counts are 0; an empty table gives no rows. Other columns are
    not read.
    """
    part = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("round")), F.lit(rounds)).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(id_col, folds).alias("held_out"), part.alias("part"))
    counts = cut_lineage(count_words(docs.where(learns(id_col, folds)).select(F.col(text_col).alias("text"))), "lm-counts")
    total, distinct, held_bytes = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.length("word") + PLACE)).first()
    total = total or 0
    often = {bytes(r["word"]): r["n"] for r in counts.where(F.col("n") > total / direct).collect()}  # fewer than ``direct``
    ends = counts.where(F.length("word") == 0).first()
    often[END] = ends["n"] if ends else 0
    ranked = sorted((w for w in often if w != END), key=lambda w: (-often[w], w))
    words, members = ranked[:WORDS], sorted(ranked[WORDS:], key=lambda w: w[::-1])
    heads = max(1, math.isqrt(distinct) // CLASSES)
    others = counts.where((F.col("n") <= total / direct) & (F.length("word") > 0))
    kind = F.crc32(F.substring("word", -2, 2)) % CLASSES * heads + F.crc32(F.substring("word", 1, 2)) % heads
    mass = np.full(CLASSES * heads, SMOOTH)
    for r in others.groupBy(kind.alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["k"]] += r["n"] + SMOOTH * r["v"]  # at most CLASSES + sqrt(distinct) rows
    vocabulary = Vocabulary(words, members, heads)
    held, q = vocabulary.weights(often, mass)
    stored = encode(rows, (words, members, heads), often, held)
    params = train(stored.where("not held_out"), vocabulary.levels, q, rounds)
    log_base = math.log10(total + SMOOTH * (distinct + 1))
    rare = stored.select("row", F.explode(F.arrays_zip("words", "times")).alias("t")).select("row", F.col("t.words").alias("word"), F.col("t.times").alias("m"))
    if (held_bytes or 0) <= TABLE * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        others = others.hint("shuffle_hash")
    met = rare.join(others, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    added = met.groupBy("row").agg(
        F.sum(F.col("m") * F.log10(F.col("n") + SMOOTH)).alias("rare_logs"), F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("more")
    )
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return network_scores(stored, params, vocabulary.levels).join(added, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * log_base).alias("base_score"),
        (logs + F.col("network") - F.col("inside")).alias("score"),
    )

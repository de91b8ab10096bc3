"""Packing of token sequences by a configuration linear program over the length histogram."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.common import Recent, in_process
from assetlake.session import cut_lineage

CAPACITY = 4096
END = 1
#: Rounds of the schedule, knapsack tables per round, the step of the weights, and the least fills of configurations.
ROUNDS, PRICINGS, ETA, FILLS = 4, 40, 1.0, (0.998, 0.95, 0.85, 0.7)
#: A packing this close to the least number of sequences that the volume allows is not tried again.
GOOD = 1.001
ROWS_PER_BLOCK = 4_000
#: Bytes of a generation of kept words (a worker has two, for all its tasks), and of text that is split into words at once.
KEPT_BYTES, BLOCK = 24 << 20, 4 << 20
#: The white space between words.
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Letters whose lower case is their normal form, and marks without those of special strings and contractions: in words
#: of such letters and then such marks both are pieces of their own.
LETTERS, MARKS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF", "!\"#$%&()*+,-./:;=>?@[\\]^_`{}~"
PLAIN = f"^[{LETTERS}]*[{re.escape(MARKS)}]*$"
PIECE = re.compile(f"[{LETTERS}]+|[{re.escape(MARKS)}]+")


def byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(shown)))}


def ranges(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range, one range after the other."""
    at = np.repeat((first - (np.cumsum(times) - times)).astype(np.int32), times)
    at += np.arange(len(at), dtype=np.int32)
    return at


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The vocabulary drops white space and never joins what it separates, so the ids of a text are those of its words
    in turn. The words of many texts are told apart first, and the library is asked once per word that is not kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.words = Recent(self.ids, KEPT_BYTES)

    def ids(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():  # one piece, which the library's model needs no search for
            found = [t.id for t in self.model.tokenize(text)]
        elif PIECE.fullmatch(text):
            found = [t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(self.letters))]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", found).tobytes()

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, one after the other, and their numbers."""
        plain, lower = pc.match_substring_regex(words, PLAIN), pc.utf8_lower(words)
        stems = pc.if_else(plain, pc.ascii_rtrim(lower, characters=MARKS), words)
        marks = pc.if_else(plain, pc.replace_substring_regex(lower, f"^[{LETTERS}]+", ""), "")
        coded = pa.concat_arrays([stems, marks]).dictionary_encode()
        found = [self.words[w] if w else b"" for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        part = coded.indices.to_numpy().reshape(2, -1).T.ravel()  # stem, marks, stem, marks ...
        times = sizes[part]
        ids = np.frombuffer(b"".join(found), "<u4")
        return ids[ranges((np.cumsum(sizes) - sizes)[part], times)], times.reshape(-1, 2).sum(axis=1)

    def text(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.string())))

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; a null text has none."""
        some, size = [], 0
        for text in texts:
            some.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
            size += len(some[-1])
            if size >= BLOCK:
                yield from self.block(some)
                some, size = [], 0
        yield from self.block(some)

    def block(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of some texts; one beyond ``BLOCK`` is taken in parts that end at white space."""
        few: list = []
        for text in texts:
            if len(text) <= BLOCK:
                few.append(text)
                continue
            yield from self.together(few)
            few, out, at = [], [], 0
            while at < len(text):
                space = SPACE.search(text, at + BLOCK)
                end = space.start() if space else len(text)
                out.extend(self.together([text[at:end]]))
                at = end
            yield b"".join(out)
        yield from self.together(few)

    def together(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of texts whose words are told apart once for all of them."""
        if not texts:
            return
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.values.dictionary_encode()
        ids, sizes = self.of_words(coded.dictionary)
        word = coded.indices.to_numpy()
        times = sizes[word]
        out = ids[ranges((np.cumsum(sizes) - sizes)[word], times)]
        ends = np.concatenate(([0], np.cumsum(times)))[split.offsets.to_numpy()].tolist()
        for low, high in zip(ends, ends[1:]):
            yield out[low:high].tobytes()


def pieces(
    docs: DataFrame, vocabulary: str, id_col: str, text_col: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, row and, if asked for, ids): the documents' ids and the end, cut at ``capacity``.

    ``row`` numbers the pieces, so that pieces that are equal in all else can be told apart once the result is stored.
    """
    spark, end = docs.sparkSession, np.array([END], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = in_process(f"encoder {vocabulary}", lambda: Encoder(vocabulary))
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            take, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, whole in enumerate(encoder.texts(batch.column(1))):
                whole += end
                for k, at in enumerate(range(0, len(whole), capacity * 4)):
                    part = whole[at : at + capacity * 4]
                    take.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4"))
            columns = [
                batch.column(0).take(pa.array(take, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(range(first, first + len(take)), pa.int64()),
            ]
            first += len(take)
            names = ["id", "piece", "start", "length", "ids_crc32", "row"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long, row long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, schema)


def price_configurations(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: the dearest filling of every capacity and the item it takes last (-1: none).

    ``lengths`` descend, so that of equally dear fillings the one of longer items is taken.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    first = np.searchsorted(-lengths, -np.arange(capacity + 1))
    for room in range(1, capacity + 1):
        k = first[room]
        if k < len(lengths):
            values = best[room - lengths[k:]] + prices[k:]
            j = int(values.argmax())
            if values[j] > best[room - 1] + 1e-12:
                best[room], last[room] = values[j], k + j
                continue
        best[room] = best[room - 1]
    return best, last


def solve(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, least_fill: float = FILLS[0], rounds: int = ROUNDS
) -> dict[tuple, float]:
    """Fractional configurations, as tuples of (item, copies), within the demand; ``lengths`` descend.

    Multiplicative weights: a length's price starts at its size and falls by a factor for each demand-share it is
    covered ahead of the round's schedule; one without any left is free. Every length that is behind, longest first,
    buys the dearest configuration that contains it, read from a knapsack table, as much as the scarcest length in it
    has left. When a configuration would be less full than ``least_fill`` the prices are set anew, up to ``PRICINGS`` times a round;
    what still finds no such configuration waits for the next round, and after the last for the rounding.
    """
    covered, x, sizes = np.zeros(len(lengths)), defaultdict(float), lengths.tolist()
    noise = np.random.default_rng(5)
    for t in range(1, rounds + 1):
        left = (demand * (t / rounds) - covered).tolist()
        below, taken, tables, fresh = [], [], 0, False
        for i, size in enumerate(sizes):
            while left[i] > 1e-9:
                if not below:
                    ahead = np.clip(covered / demand * rounds - (t - 1), 0, None)
                    prices = lengths / capacity * np.exp(-ETA * ahead) * (1 + 1e-3 * noise.random(len(lengths)))
                    some = np.flatnonzero(np.array(left) > 1e-9)
                    _, last = price_configurations(lengths[some], prices[some], capacity)
                    below = np.zeros(capacity + 1, np.int64)  # the largest room, this or smaller, at which an item is taken
                    below[last >= 0] = np.flatnonzero(last >= 0)
                    below, taken = np.maximum.accumulate(below).tolist(), some[last].tolist()
                    tables, fresh = tables + 1, True
                items, room = {i: 1}, capacity - size
                while room > 0 and (at := below[room]):
                    j = taken[at]
                    if left[j] <= 1e-9 or items.get(j, 0) + 1 > demand[j]:
                        room = at - 1  # none of it left: the next smaller filling
                        continue
                    items[j] = items.get(j, 0) + 1
                    room = at - sizes[j]
                if sum(sizes[j] * k for j, k in items.items()) < least_fill * capacity:
                    if fresh or tables >= PRICINGS:
                        break
                    below = []
                    continue
                times, fresh = min(left[j] / k for j, k in items.items()), False
                x[tuple(sorted(items.items()))] += times
                for j, k in items.items():
                    left[j] -= k * times
                    covered[j] += k * times
    return x


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing, as (copies by item, number of such sequences); ``lengths`` descend.

    The next piece goes into the fullest sequence that still has room, which then is the fullest one for the piece
    after it as well. So a sequence takes all copies of a length that fit, and of equal sequences all do, at once: work and rows follow
    the number of lengths, not of pieces.
    """
    rooms, mask, done = defaultdict(list), 0, []

    def put(room: int, items: dict[int, int], times: int) -> None:
        nonlocal mask
        if room:
            rooms[room].append((items, times))
            mask |= 1 << room
        else:
            done.append((items, times))

    for i, (size, n) in enumerate(zip(lengths.tolist(), left.tolist())):
        n = int(n)
        while n:
            if fitting := mask >> size:
                room = (fitting & -fitting).bit_length() - 1 + size
                items, times = rooms[room].pop()
                if not rooms[room]:
                    mask &= ~(1 << room)
            else:  # as many new sequences as it takes
                room, items, times = capacity, {}, -(-n // (capacity // size))
            copies = min(room // size, n)
            some = min(times, n // copies)
            n -= copies * some
            put(room - copies * size, items | {i: copies}, some)
            if times > some and items:
                put(room, items, times - some)
    return done + [sequence for same in rooms.values() for sequence in same]


def rounded(lengths: np.ndarray, demand: np.ndarray, capacity: int, least_fill: float) -> tuple[int, list[tuple]]:
    """A packing as (number of sequences, rows as :func:`layout` gives them).

    Rounding leaves less than a sequence of each configuration bought, but pieces that find none as full as
    ``least_fill`` are not bought at all, and there may be any number of them: best fit places equal sequences at once.
    """
    left = demand.copy()
    rows, sequence, used = [], 0, np.zeros(len(lengths), np.int64)

    def place(items: dict[int, int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for i, copies in items.items():
            rows.append((lengths[i], used[i], sequence, copies, offset))
            used[i] += copies * times
            offset += copies * int(lengths[i])
        sequence += times

    for items, share in sorted(solve(lengths, left.astype(float), capacity, least_fill).items()):
        times = min(int(share + 1e-9), *(int(left[i]) // k for i, k in items))
        if times > 0:
            for i, k in items:
                left[i] -= k * times
            place(dict(items), times)
    for items, times in best_fit(lengths, left, capacity):
        place(items, times)
    return sequence, rows


def layout(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go: rows (length, first rank, first sequence, copies in one sequence, offset).

    The fractional solution is rounded down, never beyond the demand; the rest, less than a sequence for each
    configuration bought and what fits in none, is placed by best fit, equal sequences at once: rows and time are
    bounded by the lengths, whatever the corpus. Where lengths do not fill sequences well, the program is solved with
    lesser fills too and the packing of fewest sequences taken. Rows are in order of (length, first rank).
    """
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    demand = np.array([histogram[k] for k in lengths.tolist()], np.int64)
    least, best = -(-int((lengths * demand).sum()) // capacity), None
    for fill in FILLS:
        found = rounded(lengths, demand, capacity, fill)
        best = found if best is None or found[0] < best[0] else best
        if best[0] <= max(least + 1, least * GOOD):
            break
    table = np.array(best[1], np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    rows_per_block: int = ROWS_PER_BLOCK,
    with_ids: bool = False,
) -> DataFrame:
    """Pack the documents' tokens into sequences of at most ``capacity`` tokens.

    A document is its ids, without special tokens, and the id 1; longer ones are cut into pieces of ``capacity``.
    Returns one row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, with ``with_ids``, the ``ids``. Only the histogram of lengths, at most ``capacity`` rows, comes to the
    driver. A piece's place follows from its rank among the pieces of its length; ranks are counted in blocks that
    rows are dealt to by their numbers, so a length, or one and the same piece, that most rows share is spread over tasks.
    Null texts count as empty (one token); null and
    repeated ids are ordinary rows; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    cut = cut_lineage(pieces(docs, vocabulary, id_col, text_col, capacity, with_ids), "pack-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = layout(counts, capacity) if counts else np.zeros((0, 5), np.int64)
    shared = spark.sparkContext.broadcast(table)
    blocks = max(1, -(-sum(counts.values()) // rows_per_block))
    blocked = cut.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    onward = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocked.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("length", "block", F.coalesce(F.sum("n").over(onward), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "block").orderBy("row")
    columns = [c for c in cut.columns if c != "row"]
    ranked = (
        blocked.withColumn("nth", F.row_number().over(inside) - 1)
        .join(cut_lineage(starts, "pack-starts").hint("merge"), ["length", "block"])  # grows with the input: no broadcast
        .withColumn("rank", F.col("first") + F.col("nth"))
        .select(*columns, "rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        order = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            found = rows[np.searchsorted(order, length << 44 | rank, side="right") - 1]
            nth, copies = rank - found[:, 1], found[:, 3]
            columns = [
                pa.array(found[:, 2] + nth // copies, pa.int64()),
                pa.array(found[:, 4] + nth % copies * length, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*columns).schema)
    placed = ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)

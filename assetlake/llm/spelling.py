"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's vector counts its letters by groups of letters. One edit changes the vector by a surplus of at most one and a
deficit of at most one, so a depth-first search of the trie of vectors that may spend one of each meets every word one
edit apart; the words at the leaves are verified letter by letter. The first levels of the trie deal its subtrees to
tasks: each word lives in its own subtree and visits those that a prefix of its vector can reach within the budget.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.session import cut_lineage

#: Runs of these are words; lower-casing is of A to Z only.
LETTERS = r"[A-Za-zÀ-ÿ]+"
GROUPS = 12
#: Words that a subtree holds at most, visitors searched at once, and vectors below which a node is not descended.
NODE = 20_000
VISITORS = 200_000
TWIG = 24
#: Word pairs verified at once, and the longest word that is verified as a row of a matrix.
PAIRS = 100_000
WIDE = 48

MET = "word string, n_near long, best struct<less long, word string>"


def lower_ascii(word: Column) -> Column:
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame, id_col: str, text_col: str, least: int = 1) -> DataFrame:
    """(id, run): every maximal run of letters of at least ``least`` code points, lower-cased, as often as it occurs."""
    found = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"({LETTERS})"), F.lit(1))
    each = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(found).alias("run"))
    return each.where(F.length("run") >= least).select("id", lower_ascii(F.col("run")).alias("run"))


def worn(runs_of: DataFrame, every: int = 31) -> DataFrame:
    """(word): each run, without one code point where the crc32 of ``<id>:<run>`` is divisible by ``every``.

    The code point at crc32 modulo the run's length is the one that goes. A null id counts as an empty text.
    """
    name = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs_of.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n): distinct words of at least ``shortest`` code points with at least ``least`` occurrences."""
    counts = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least)


def letter_groups(vocab: DataFrame, groups: int = GROUPS) -> list[str]:
    """Letters dealt to ``groups`` groups of similar frequency among the words, most frequent letters first."""
    letters = vocab.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    rows = sorted(((-n, letter) for letter, n in letters.collect() if letter))  # at most 90 letters
    load, dealt = [0] * groups, [""] * groups
    for less, letter in rows:
        least = min(range(groups), key=lambda g: (load[g], g))
        load[least] -= less
        dealt[least] += letter
    return [g for g in dealt if g]


def counted(letters: str) -> Column:
    """How many of the word's code points are among ``letters``."""
    return F.length("word") - F.length(F.translate("word", letters, ""))


def subtree_moves(depth: int) -> list[list[int]]:
    """Changes of a prefix of ``depth`` counts that spend the budget, the surplus before the deficit."""
    still = [0] * depth
    moves = [still]
    for i in range(depth):
        more = [*still]
        more[i] = 1
        moves.append(more)
        for j in range(i + 1, depth):
            moves.append([*more[:j], -1, *more[j + 1 :]])
    return moves


def near_vectors(held: np.ndarray, asked: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in ``held``, position in ``asked``, spent) of vectors within what is left of the budget.

    ``held`` holds distinct vectors in lexicographic order: a trie whose nodes are ranges. ``spent`` is 0 at the start,
    1 once a surplus and 2 once a surplus and then a deficit is spent, so of two words only one finds the other.
    """
    out: list[tuple] = []
    levels = held.shape[1]
    stack = [(0, 0, len(held), np.arange(len(asked)), spent)]
    while stack:
        level, lo, hi, who, state = stack.pop()
        if not len(who) or lo == hi:
            continue
        if level == levels:
            out.append((np.full(len(who), lo), who, state))
            continue
        if hi - lo <= TWIG or len(who) <= 2:
            for at in range(0, len(who), VISITORS // max(1, hi - lo) + 1):
                out.append(_twig(held, asked, level, lo, hi, who[at:], state[at:], VISITORS // max(1, hi - lo) + 1))
            continue
        column = held[lo:hi, level]
        values, starts = np.unique(column, return_index=True)
        ends = [*starts[1:], hi - lo]
        wanted = asked[who, level]
        for value, a, b in zip(values, starts, ends):
            change = value - wanted
            goes = (change == 0) | ((change == 1) & (state == 0)) | ((change == -1) & (state == 1))
            if goes.any():
                stack.append((level + 1, lo + a, lo + b, who[goes], (state + (change != 0))[goes]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate([part[i] for part in out]) for i in range(3))


def _twig(held, asked, level, lo, hi, who, state, room):
    """The rest of a small node's search, all its vectors at once."""
    who, state = who[:room], state[:room]
    change = held[None, lo:hi, level:] - asked[who][:, None, level:]
    more, less = (change == 1).sum(2), (change == -1).sum(2)
    inside = (np.abs(change).sum(2) == more + less) & (more + (state[:, None] > 0) <= 1) & (less + (state[:, None] > 1) <= 1)
    # A deficit may only follow a surplus.
    first = np.where((change == 1).any(2), (change == 1).argmax(2), change.shape[2])
    second = np.where((change == -1).any(2), (change == -1).argmax(2), change.shape[2] + 1)
    inside &= (less == 0) | (state[:, None] == 1) | ((state[:, None] == 0) & (first < second))
    q, r = np.nonzero(inside)
    return r + lo, who[q], state[q] + more[q, r] + less[q, r]


class Words:
    """Words as rows of letter codes; every letter is below U+0100, so a code is one byte."""

    def __init__(self, words: list[str]):
        self.text = np.array(words, object)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(self.sizes <= WIDE)
        self.codes = np.zeros((len(words), WIDE + 1), np.uint8)
        flat = np.frombuffer("".join(self.text[short]).encode("latin-1"), np.uint8)
        inside = np.arange(WIDE + 1) < np.where(self.sizes <= WIDE, self.sizes, 0)[:, None]
        self.codes[inside] = flat


def one_edit(a: str, b: str) -> bool:
    """True if exactly one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)
    while lo < hi:  # the common prefix by halving
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return a[lo + (len(a) == len(b)) :] == b[lo + 1 :]


def verified(left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> np.ndarray:
    """For each pair of positions whether the words are one edit apart."""
    swap = left.sizes[i] > right.sizes[j]
    a, b = left.codes[i], right.codes[j]
    a[swap], b[swap] = b[swap].copy(), a[swap].copy()
    short, long = np.minimum(left.sizes[i], right.sizes[j]), np.maximum(left.sizes[i], right.sizes[j])
    inside = np.arange(WIDE + 1) < short[:, None]
    differs = (a != b) & inside
    moved = np.zeros_like(differs)
    moved[:, :-1] = (a[:, :-1] != b[:, 1:]) & inside[:, :-1]
    # With one letter more in the long word, it is in or before the first difference and nothing after differs.
    first = np.where(differs.any(1), differs.argmax(1), short)
    last = np.where(moved.any(1), WIDE - moved[:, ::-1].argmax(1), -1)
    near = np.where(short == long, differs.sum(1) == 1, (long - short == 1) & (last < first))
    for p in np.flatnonzero(long > WIDE):
        near[p] = one_edit(left.text[i[p]], right.text[j[p]])
    return near


class Subtree:
    """The words of one subtree, by vector."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors = _vectors(table["vec"].combine_chunks())
        words = np.array(table["word"].to_pylist(), object)
        order = np.lexsort(vectors.T[::-1])
        vectors, words = vectors[order], words[order]
        self.n = table["n"].to_numpy()[order]
        fresh = np.append(True, (vectors[1:] != vectors[:-1]).any(1))
        self.held = vectors[fresh]
        self.starts = np.append(np.flatnonzero(fresh), len(vectors))
        self.words = Words(list(words))

    def search(self, batches: list[pa.RecordBatch]) -> Iterator[tuple]:
        """(visiting word, its n, word, its n) arrays of the words one edit apart."""
        table = pa.Table.from_batches(batches).combine_chunks()
        vectors, spent = _vectors(table["vec"].combine_chunks()), table["spent"].to_numpy()
        visitors, n = Words(table["word"].to_pylist()), table["n"].to_numpy()
        order = np.lexsort((spent, *vectors.T[::-1]))
        keys = np.column_stack([vectors, spent])[order]
        fresh = np.append(True, (keys[1:] != keys[:-1]).any(1))
        begins = np.append(np.flatnonzero(fresh), len(keys))
        leaf, asked, state = near_vectors(self.held, keys[fresh][:, :-1], keys[fresh][:, -1])
        size = (self.starts[leaf + 1] - self.starts[leaf]) * (begins[asked + 1] - begins[asked])
        for lo, hi in _runs_of(size, PAIRS):
            for i, j, same in _expanded(begins, asked[lo:hi], self.starts, leaf[lo:hi], state[lo:hi] == 0, PAIRS):
                i = order[i]
                # Words of one vector meet twice; the smaller one asks.
                once = ~same | (visitors.text[i] < self.words.text[j])
                i, j = i[once], j[once]
                near = verified(visitors, i, self.words, j)
                i, j = i[near], j[near]
                yield visitors.text[i], n[i], self.words.text[j], self.n[j]


def _vectors(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _runs_of(sizes: np.ndarray, room: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive entries whose sizes add up to about ``room``."""
    if len(sizes):
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // room)) + 1
        yield from zip([0, *cuts], [*cuts, len(sizes)])


def _expanded(begins, asked, starts, leaf, same, room) -> Iterator[tuple]:
    """All (visitor, word) positions of pairs of vectors, at most about ``room`` at once."""
    wide = starts[leaf + 1] - starts[leaf]
    size = wide * (begins[asked + 1] - begins[asked])
    total = int(size.sum())
    ends = np.cumsum(size)
    for at in range(0, total, room):
        place = np.arange(at, min(at + room, total))
        pair = np.searchsorted(ends, place, "right")
        rest = place - (ends[pair] - size[pair])
        yield begins[asked[pair]] + rest // wide[pair], starts[leaf[pair]] + rest % wide[pair], same[pair]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch of visitors, for each word met: how many, and the most frequent of them (then the smallest)."""
    number, waiting, asking, size, subtree = None, [], [], 0, None

    def answers():
        best: dict = {}
        for a, m, b, n in subtree.search(asking):
            for word, other, count in zip([*a, *b], [*b, *a], [*(-n).tolist(), *(-m).tolist()]):
                seen = best.get(word)
                best[word] = (1, count, other) if seen is None else (seen[0] + 1, *min(seen[1:], (count, other)))
        if best:
            counts, less, others = zip(*best.values())
            struct = pa.StructArray.from_arrays([pa.array(less, pa.int64()), pa.array(others, pa.string())], ["less", "word"])
            yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.string()), pa.array(counts, pa.int64()), struct], ["word", "n_near", "best"])

    for whole in batches:
        place = whole.column("place").to_pylist()
        kind = whole.column("kind").to_numpy()
        cuts = [i for i in range(1, len(place)) if place[i] != place[i - 1] or kind[i] != kind[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(place)]):
            if place[a] != number:
                if asking:
                    yield from answers()
                number, waiting, asking, size, subtree = place[a], [], [], 0, None
            batch = whole.slice(a, b - a)
            if kind[a] == 0:
                waiting.append(batch)
            elif waiting:
                subtree = subtree or Subtree(waiting)
                asking.append(batch)
                size += len(batch)
                if size >= VISITORS:
                    yield from answers()
                    asking, size = [], 0
    if asking:
        yield from answers()


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): for each word that has near words their number and the first by (n falling, word).

    A subtree of the trie goes to one task. Levels are added to the dealing prefix until no subtree holds over ``NODE``
    words; where all levels are not enough (many arrangements of the same letters) a subtree's words are dealt over
    blocks and its visitors go to each of them. Visitors stream past the words a task holds, so its memory does not
    follow their number. Each pair is met once, and tasks emit counts instead of pairs.
    """
    groups = letter_groups(vocab)
    if not groups:
        return vocab.selectExpr("word", "0L as n_near", "word as form", "n as form_n").limit(0)
    vectors = vocab.select("word", "n", F.array(*[counted(g) for g in groups]).alias("vec"))
    vectors = cut_lineage(vectors, "spelling-vectors")
    for depth in range(1, len(groups) + 1):
        prefix = F.concat_ws(",", F.slice("vec", 1, depth))
        sizes = vectors.groupBy(prefix.alias("node")).agg(F.count(F.lit(1)).alias("words"))
        if (sizes.agg(F.max("words")).first()[0] or 0) <= NODE:
            break
    # At most words / NODE rows.
    large = F.broadcast(sizes.where(F.col("words") > NODE).select("node", F.ceil(F.col("words") / NODE).cast("int").alias("blocks")))
    moves = F.lit(subtree_moves(depth))
    homes = vectors.select("*", prefix.alias("node"), F.lit(0).alias("kind"), F.lit(0).alias("spent"))
    # A visitor comes with its prefix as moved, so that the search below spends what is left.
    moved = F.zip_with(F.slice("vec", 1, depth), "move", lambda a, b: a + b)
    visits = vectors.select("*", F.explode(moves).alias("move")).select("*", moved.alias("moved"))
    visits = visits.where(F.array_min("moved") >= 0)
    spent = F.aggregate("move", F.lit(0), lambda s, x: s + F.abs(x))
    vec = F.concat("moved", F.slice("vec", depth + 1, len(groups)))
    visits = visits.select("word", "n", vec.alias("vec"), F.concat_ws(",", "moved").alias("node"), F.lit(1).alias("kind"), spent.alias("spent"))
    blocks = F.coalesce("blocks", F.lit(1))
    homes = homes.join(large, "node", "left").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    visits = visits.join(large, "node", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = homes.unionByName(visits).withColumn("place", F.concat_ws("/", "node", "block"))
    met = met.select("place", "kind", "word", "n", "vec", "spent").repartition("place").sortWithinPartitions("place", "kind")
    found = met.mapInArrow(_met, MET).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on the way from form to form; chains halve in every round.

    Each step of a chain multiplies the count, so chains are short; a word's near words, and so the words with one
    form, are bounded by its length times the number of letters.
    """
    ways = cut_lineage(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = ways.join(ahead, "root", "left")
        ways = cut_lineage(stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(vocab: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for every row of ``vocab`` (distinct words and their counts).

    Words are near if exactly one inserted, deleted or replaced code point parts them. A word's form is its near word
    of largest count (ties: the smallest in code-point order) if that is at least ``ratio`` times its own, else null; its
    root is the end of the way along forms, the word itself without a form. An empty vocabulary gives no rows. Words must
    consist of letters below U+0100.
    """
    vocab = cut_lineage(vocab.select("word", "n"), "spelling-words")
    near = cut_lineage(near_words(vocab), "spelling-near")
    joined = vocab.join(near, "word", "left")
    taken = F.col("form_n") >= ratio * F.col("n")
    told = joined.select(
        "word", "n", F.when(taken, F.col("form")).alias("form"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("form_n")).alias("form_n"),
    )
    told = cut_lineage(told, "spelling-told")
    ends = roots(told.where("form is not null"))
    out = told.join(ends, "word", "left")
    return out.select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def document_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, least: int = 2) -> DataFrame:
    """Spelling variants of all words of all documents, worn by :func:`worn`; a null text has no words.

    Only the two columns are read, so others may have any name. Repeated rows count as often as they occur.
    """
    words = worn(runs(docs, id_col, text_col, shortest))
    return spelling_variants(vocabulary(words, shortest, least))

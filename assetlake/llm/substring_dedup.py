"""Removal of repeated passages: prefix-partitioned suffix trees over sampled suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import Kept, attach, bit_filter, filter_words, free_name, in_process, in_words, maybe_in
from assetlake.session import cut_lineage

WINDOW = 50
#: Words of the shortest prefix by which suffixes are dealt out.
GRAM = 16
#: Distinct segments of one prefix that a subtree is built of at most; above, prefixes are as long as the window.
GROUP = 20_000
CHUNK = 20_000
LAST = (1 << 63) - 1
ALL = -1
KEPT_WORDS = 300_000


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Suffixes:
    """The sampled suffixes of texts.

    Of the grams in each window the one with the least hash is sampled, so equal windows sample the same place, and a
    window's place is at most ``window - gram`` words after its start. A sampled place stands for all windows around
    it: its segment reaches from ``window - gram`` words before to ``window`` words after it, within the document.
    """

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram
        self.before = window - gram
        self.hash = Kept(lambda w: xxhash.xxh64_intdigest(w), KEPT_WORDS)

    def spans(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each place, from hashes of powers of two that may overlap."""
        size, block = 1, hashes
        while size * 2 <= length:
            block, size = mix(block[:-size], block[size:]), size * 2
        rest = length - size
        return mix(block[:-rest], block[rest:]) if rest else block

    def places(self, words: list[bytes]) -> tuple[np.ndarray, ...] | None:
        """(prefix hash, segment hash, first word, end, place) of each sampled suffix."""
        n = len(words)
        if n < self.window:
            return None
        hashes = np.fromiter(map(self.hash.__getitem__, words), np.uint64, n)
        grams = self.spans(hashes, self.gram)
        found = []
        for at in range(0, n - self.window + 1, 1 << 23):
            part = grams[at : at + (1 << 23) + self.before]
            low = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64)
            size, least = 1, low
            while size * 2 <= self.before + 1:
                least, size = np.minimum(least[:-size], least[size:]), size * 2
            rest = self.before + 1 - size
            least = np.minimum(least[:-rest], least[rest:]) if rest else least
            found.append((least & np.uint64((1 << 24) - 1)).astype(np.int64) + at)
        place = np.unique(np.concatenate(found))
        first, end = np.maximum(place - self.before, 0), np.minimum(place + self.window, n)
        length = end - first
        # Every segment has a window at least; two overlapping hashes of that length cover it.
        whole = self.spans(hashes, self.window)
        segment = mix(mix(whole[first], whole[end - self.window]), (length * 1024 + place - first).astype(np.uint64))
        return grams[place], segment, first, end, place


def sampled(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(prefix, segment, order, rid, first, end, place) of the sampled suffixes of ``docs`` (order, rid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = in_process(f"suffixes {window} {gram}", lambda: Suffixes(window, gram))
        for batch in batches:
            rows = [(i, p) for i, t in enumerate(batch.column(2).to_pylist()) if t and (p := suffixes.places(t.encode().split()))]
            if rows:
                prefix, segment, first, end, place = (np.concatenate(x) for x in zip(*(p for _, p in rows)))
                take = pa.array(np.repeat([i for i, _ in rows], [len(p[0]) for _, p in rows]))
                order, rid = batch.column(0).take(take), batch.column(1).take(take)
                ints = [pa.array(x, pa.int32()) for x in (first, end, place)]
                yield pa.RecordBatch.from_arrays(
                    [signed(prefix), signed(segment), order, rid, *ints],
                    ["prefix", "segment", "ord", "rid", "first", "end", "place"],
                )

    return docs.mapInArrow(run, "prefix long, segment long, ord long, rid long, first int, end int, place int")


def segment_key(segment, order):
    return segment.bitwiseXOR(order).bitwiseXOR(F.shiftleft(order, 24))


def segment_texts(docs: DataFrame, wanted: np.ndarray, window: int, gram: int) -> DataFrame:
    """(prefix, segment, ord, off, words) of the sampled suffixes whose key the filter may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = in_process(f"suffixes {window} {gram}", lambda: Suffixes(window, gram))
        for batch in batches:
            out: list = []
            for order, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split() if text else []
                if (found := suffixes.places(words)) is None:
                    continue
                segment = found[1].view(np.int64)
                keys = segment ^ np.int64(order) ^ np.left_shift(np.int64(order), np.int64(24))
                for i in np.flatnonzero(in_words(shared.value, keys)):
                    first, end, place = (int(x[i]) for x in found[2:])
                    out.append((int(found[0].view(np.int64)[i]), int(segment[i]), order, place - first, b" ".join(words[first:end])))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["prefix", "segment", "ord", "off", "words"]
                )

    return docs.mapInArrow(run, "prefix long, segment long, ord long, off int, words binary")


def subtree(texts: list[bytes], offsets: np.ndarray, least: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each segment the set of its windows (bit per start before the sampled place) that a lesser document has.

    The suffixes that start at every word of the segments are put in classes by their first 1, 2, 4, ... words, each
    class from two of the round before; the last round gives the nodes of the suffix tree at the window's depth.
    A node that several documents reach is an internal node of at least that depth, hence a repeat.
    """
    before, width = window - gram, 2 * window - gram
    number: dict[bytes, int] = {}
    table = np.zeros((len(texts), width), np.int64)
    for i, (text, off) in enumerate(zip(texts, offsets)):
        ids = [number.setdefault(w, len(number) + 1) for w in text.split(b" ")]
        table[i, before - off : before - off + len(ids)] = ids
    sound = table != 0

    def joined(a, b, shift):
        left, right = a[:, :-shift], b[:, shift:]
        pairs = left * (right.max(initial=0) + 1) + right
        return np.unique(pairs, return_inverse=True)[1].reshape(pairs.shape)

    size, rank = 1, table
    while size * 2 <= window:
        rank, size = joined(rank, rank, size), size * 2
    node = joined(rank, rank, window - size) if window > size else rank
    node = node[:, : before + 1]
    starts = sound[:, : before + 1] & sound[:, window - 1 : window + before]
    lowest = np.full(int(node.max(initial=0)) + 1, LAST)
    rows, cols = np.nonzero(starts)
    np.minimum.at(lowest, node[rows, cols], least[rows])
    repeat = lowest[node[rows, cols]] < least[rows]
    mask = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(mask, rows[repeat], np.left_shift(np.int64(1), cols[repeat]))
    return mask


def subtrees(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(prefix, segment, mask) for ``rows`` (prefix, segment, ord, off, words), whole prefixes at a time."""
    dealt = rows.repartition("prefix").sortWithinPartitions("prefix", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held):
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            segment = table.column(1).to_numpy()
            once = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            table = table.take(pa.array(once))
            mask = subtree(table.column(4).to_pylist(), table.column(3).to_numpy(), table.column(2).to_numpy(), window, gram)
            yield pa.RecordBatch.from_arrays([table.column(0), table.column(1), pa.array(mask)], ["prefix", "segment", "mask"])

        held, n = [], 0
        for batch in batches:
            if n + len(batch) >= CHUNK:
                # What belongs to the last prefix waits for the next batch.
                prefix = batch.column(0).to_numpy()
                cut = int((prefix == prefix[-1]).argmax())
                if cut:
                    yield from solve([*held, batch.slice(0, cut)])
                    held, n, batch = [], 0, batch.slice(cut)
                elif held and held[-1].column(0)[-1].as_py() != prefix[0]:
                    yield from solve(held)
                    held, n = [], 0
            held.append(batch)
            n += len(batch)
        yield from solve(held)

    return dealt.mapInArrow(run, "prefix long, segment long, mask long")


def long_prefixes(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(prefix, segment, mask) as :func:`subtrees` gives, for prefixes too frequent for one subtree.

    Their suffixes are dealt by prefixes of the window's length, each of which is one deep node; the least document
    of a node is a partial aggregate, so no task meets all of a frequent node's suffixes.
    """
    before = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = in_process(f"suffixes {window} {gram}", lambda: Suffixes(window, gram))
        for batch in batches:
            for i, (off, text) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                words = text.split(b" ")
                hashes = np.fromiter(map(suffixes.hash.__getitem__, words), np.uint64, len(words))
                node = suffixes.spans(hashes, window)[: off + 1]
                same = [batch.column(k).slice(i, 1).take(pa.array(np.zeros(len(node), np.int64))) for k in range(3)]
                start = np.left_shift(np.int64(1), np.arange(len(node)) + before - off)
                yield pa.RecordBatch.from_arrays([*same, signed(node), pa.array(start)], ["prefix", "segment", "ord", "node", "start"])

    deep = cut_lineage(rows.mapInArrow(run, "prefix long, segment long, ord long, node long, start long"), "sub-deep")
    nodes = deep.groupBy("prefix", "node").agg(F.min("ord").alias("least"), F.count(F.lit(1)).alias("n"))
    met = attach(deep, cut_lineage(nodes, "sub-nodes"), ["prefix", "node"], "n", "inner").where("least < ord")
    return met.groupBy("prefix", "segment").agg(F.bit_or("start").alias("mask"))


def repeated_spans(docs: DataFrame, window: int, gram: int, group: int) -> DataFrame:
    """(rid, spans): the parts of each document that a document of lesser order has too; see :func:`keep_words`."""
    found = cut_lineage(sampled(docs, window, gram), "sub-suffixes")
    segments = cut_lineage(
        found.groupBy("prefix", "segment").agg(
            F.min("ord").alias("least"), F.max("ord").alias("most"), F.count(F.lit(1)).alias("n")
        ),
        "sub-segments",
    )
    prefixes = segments.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("k"), F.min("least").alias("lo"), F.max("most").alias("hi")
    )
    several = cut_lineage(prefixes.where("lo < hi").select("prefix", "k"), "sub-prefixes")
    shared = cut_lineage(attach(segments, several, ["prefix"], "k", "inner"), "sub-shared")
    branching = shared.where("k > 1")
    wanted = bit_filter(branching.select(segment_key(F.col("segment"), F.col("least")).alias("key")), "key")
    texts = segment_texts(docs, filter_words(wanted), window, gram)
    chosen = branching.select("prefix", "segment", F.col("least").alias("ord"), "k")
    texts = cut_lineage(texts.join(chosen, ["prefix", "segment", "ord"]), "sub-texts")
    order = ["prefix", "segment", "ord", "off", "words"]
    masks = subtrees(texts.where(F.col("k") <= group).select(order), window, gram).unionByName(
        long_prefixes(texts.where(F.col("k") > group).dropDuplicates(["prefix", "segment"]).select(order), window, gram)
    )
    masks = cut_lineage(masks.where("mask <> 0"), "sub-masks")
    known = shared.join(masks, ["prefix", "segment"], "left").select("prefix", "segment", "least", "n", F.coalesce("mask", F.lit(0)).alias("mask"))
    # A segment with its first document alone and nothing covered there says nothing.
    telling = known.where("mask <> 0 or n > 1")
    met = attach(found, cut_lineage(telling, "sub-telling"), ["prefix", "segment"], "n", "inner")
    bits = F.when(F.col("ord") > F.col("least"), F.lit(ALL)).otherwise(F.col("mask"))
    span = F.struct("first", "end", "place", F.col("bits"))
    return met.withColumn("bits", bits).where("bits <> 0").groupBy("rid").agg(F.collect_set(span).alias("spans"))


def keep_words(words: list[bytes], spans, window: int, gram: int) -> list[bytes]:
    """The words outside the spans; a span is whole (bits ``ALL``) or names its covered windows by bits."""
    change = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        if s["bits"] == ALL:
            change[s["first"]] += 1
            change[s["end"]] -= 1
        else:
            start = s["place"] - (window - gram) + np.flatnonzero((s["bits"] >> np.arange(window - gram + 1)) & 1)
            np.add.at(change, start, 1)
            np.add.at(change, start + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return [w for w, c in zip(words, covered.tolist()) if not c]


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, group: int = GROUP
) -> DataFrame:
    """One row per document: ``id_col`` (an integer), ``n_words``, ``n_removed`` and ``kept_text``.

    A word goes if a run of ``window`` words around it also occurs in a document with a smaller id, judged on the
    input. ``kept_text`` has the other words joined by one space. Null, empty and short texts lose nothing. A null id
    is larger than all others; rows that repeat an id and text get equal results and never remove from each other. An
    empty table gives no rows; other columns are not read.

    Suffixes are sampled, about two per ``window - gram`` words, and dealt by the hash of their first ``gram`` words.
    Only prefixes that several documents have go on; equal segments are joined to one with its least id before any
    text is moved, and only segments that branch, at edges of repeats, are read again and built into subtrees.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rid = F.xxhash64(order, F.col(text_col))
    lean = docs.select(order.alias("ord"), rid.alias("rid"), F.col(text_col).alias("text"))
    spans = cut_lineage(repeated_spans(lean, window, gram, group), "sub-spans")
    touched = cut_lineage(bit_filter(spans, "rid"), "sub-touched")
    rows = docs.select(F.col(id_col).alias("id"), rid.alias("rid"), F.col(text_col).alias("text"))
    flagged = maybe_in(rows, F.col("rid"), touched, flag := free_name(rows, "maybe"))
    kind = spans.schema["spans"].dataType.simpleString()
    plain = flagged.where(~F.col(flag)).select("id", "text", F.lit(None).cast(kind).alias("spans"))
    cut = flagged.where(flag).join(spans, "rid", "left").select("id", "text", "spans")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, texts = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode().split()
                kept = keep_words(words, spans, window, gram) if spans else words
                sizes.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                ["id", "n_words", "n_removed", "kept_text"],
            )

    out = plain.unionByName(cut).mapInArrow(run, f"id {id_type}, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)

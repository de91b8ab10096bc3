"""SimHash near-duplicates: 64-bit fingerprints and a binary trie self-join with a Hamming error budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import attach, keep_first, ordered_id, row_key
from assetlake.llm.components import component_roots
from assetlake.session import cut_lineage

SHINGLE = 3
BUDGET = 3
SEED = 42
#: Node pairs that the traversal holds at once, and fingerprints that a task joins at once (whole subtrees).
FRONTIER = 400_000
CHUNK = 250_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; a text without words gives 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest, n, ones = xxhash.xxh64_intdigest, len(words) - shingle + 1, np.zeros(64, np.int64)
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, n)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, fp long")


def trie_links(values: np.ndarray, groups: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """For each value the position of the least value it is linked with, directly or through others of its group.

    ``values`` (sorted, distinct within a group) are tries that share a node of ``depth`` bits per group. Node pairs
    go down together, bit by bit; a pair whose paths differ in more than ``budget`` bits is dropped with all that is
    below it. A node is a range of the sorted values.
    """
    root = np.arange(len(values))

    def union(a, b):
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, low = a[open_], b[open_], np.minimum(x[open_], y[open_])
            np.minimum.at(root, x[open_], low)
            np.minimum.at(root, y[open_], low)
            while (root[root] != root).any():
                root[:] = root[root]

    lo = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    hi = np.append(lo[1:], len(values))
    many = hi - lo > 1
    start = (lo[many], hi[many], lo[many], hi[many], np.zeros(many.sum(), np.int64))
    below = [np.concatenate(([0], np.cumsum((values >> np.uint64(63 - level)) & np.uint64(1)))).astype(np.int64) for level in range(depth, 64)]
    stack = [(depth, *(x[i : i + FRONTIER] for x in start)) for i in range(0, len(start[0]), FRONTIER)]
    while stack:
        level, alo, ahi, blo, bhi, d = stack.pop()
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            close = np.bitwise_count(values[i] ^ values[j]) <= budget
            union(i[close], j[close])
            alo, ahi, blo, bhi, d = (x[~single] for x in (alo, ahi, blo, bhi, d))
        if not len(alo) or level == 64:
            continue
        ones = below[level - depth]
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        cross = alo != blo
        parts = [
            (alo, amid, blo, bmid, d),
            (amid, ahi, bmid, bhi, d),
            (alo, amid, bmid, bhi, d + 1),
            (amid[cross], ahi[cross], blo[cross], bmid[cross], d[cross] + 1),
        ]
        made = [np.concatenate(x) for x in zip(*parts)]
        alo, ahi, blo, bhi, d = made
        lone = (alo == blo) & (ahi - alo == 1)
        keep = (ahi > alo) & (bhi > blo) & (d <= budget) & ~lone
        made = [x[keep] for x in made]
        stack += [(level + 1, *(x[i : i + FRONTIER] for x in made)) for i in range(0, len(made[0]), FRONTIER)]
    return root


def trie_join(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (u, v) of distinct fingerprints (column ``fp``) that connect all pairs within ``budget`` differing bits.

    Split into ``budget + 1`` blocks of bits, two such fingerprints agree on one block at least. So each is put into
    ``budget + 1`` tries, rotated to begin with another block each, and only node pairs that agree on that first block
    are followed. The subtrees below a first block are dealt to the tasks; each gives links that span its components,
    fewer than it has fingerprints.
    """
    blocks = budget + 1
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]

    def value(k):
        at, turned = cuts[k], F.col("fp")
        return turned if at == 0 else F.shiftleft(turned, at).bitwiseOR(F.shiftrightunsigned(turned, 64 - at))

    turned = F.array(*[F.struct(F.lit(k).alias("turn"), value(k).alias("value")) for k in range(blocks)])
    rows = distinct.select(F.explode(turned).alias("t")).select("t.turn", "t.value")
    width = [cuts[k + 1] - cuts[k] for k in range(blocks)]
    head = F.element_at(F.array(*[F.shiftrightunsigned("value", 64 - w) for w in width]), F.col("turn") + 1)
    dealt = rows.withColumn("head", head).repartition("turn", "head").sortWithinPartitions("turn", "head", "value")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(turn, head, values):
            if len(values) < 2:
                return
            values = values.view(np.uint64)
            for k in np.unique(turn):
                own = turn == k
                # Signed order within a group equals unsigned order, as a group's values share their first bit.
                v = values[own]
                root = trie_links(v, head[own], width[k], budget)
                linked = np.flatnonzero(root != np.arange(len(root)))
                back = [(x >> np.uint64(cuts[k])) | (x << np.uint64(64 - cuts[k])) if cuts[k] else x for x in (v[linked], v[root[linked]])]
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in back], ["u", "v"])

        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (batch.column(0), batch.column(2), batch.column(1))]
            held = [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) >= CHUNK:
                # The last group may go on in the next batch.
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                cut = int(last.argmax())
                yield from solve(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        yield from solve(*held)

    return dealt.mapInArrow(join, "u long, v long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """(``id_col``, fp, component_id) per document: its fingerprint and the least id reachable by links.

    Words are what white space separates, with A-Z in lower case; fingerprints link at ``budget`` or fewer differing
    bits. Null, empty and blank texts have fingerprint 0, which links like any other. Copies share a fingerprint and
    are joined as one; rows with null ids come back with their component's least id (null if all its ids are null).
    An empty table gives no rows; other columns are not read.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = component_roots(cut_lineage(trie_join(distinct.select("fp"), budget), "simhash-links"))
    known = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    known = cut_lineage(known.withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    named = attach(known, cut_lineage(least, "simhash-least"), ["root"], "fps", "inner").select("fp", "n", "component_id")
    out = attach(fps, cut_lineage(named, "simhash-named"), ["fp"], "n", "inner")
    return out.select(F.col("id").alias(id_col), "fp", "component_id")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """One document of each component, with all its columns; see :func:`simhash_components`.

    It is the one with the least id, a null id being larger than every id; rows that repeat an id are told apart by
    their texts. Keys of rows to drop are tested by a bit filter first, so that only rows it may hold are shuffled
    with their texts.
    """
    key = row_key(id_col, F.col(text_col))
    rows = docs.select(ordered_id(id_col, key).alias("id"), F.col(text_col).alias("text"))
    parts = simhash_components(rows, "id", "text", shingle, budget)
    parts = parts.select(F.col("id.key").alias("key"), F.col("component_id.key").alias("first"))
    return keep_first(docs, key, parts, "simhash")

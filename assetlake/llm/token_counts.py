"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import Kept, in_process

LIMIT = 512
KEPT_PIECES, KEPT_UNITS = 800_000, 300_000
PLACE = (1 << 40) - 1
#: The split pattern of byte-level BPE and what it treats as white space.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNIT = re.compile(r"[^\S\x1C-\x1F]*[\S\x1C-\x1F]+|[^\S\x1C-\x1F]+")
#: A space before other white space or at the end: then units do not begin at every space.
MIXED_SPACE = re.compile(r" (?=\s)| \Z")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, mapped back to the byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_merges(path: str) -> tuple[dict[int, tuple[int, int]], list[str]]:
    """The merges, and the special strings, of a ``tokenizers`` file.

    Symbols are numbered: bytes 0 to 255, then merge results in order of rank. A merge is keyed by
    ``left << 20 | right`` and gives (rank, result).
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    number: dict[str, int] = byte_symbols()
    merges = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        result = number.setdefault(left + right, len(number))
        merges[number[left] << 20 | number[right]] = (rank, result)
    return merges, [t["content"] for t in spec["added_tokens"]]


def merged_count(piece: bytes, merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left of one piece: its bytes minus the merges made.

    A heap holds the adjacent pairs that can merge as (rank, place), lowest rank and then leftmost first; a linked
    list holds the symbols. ``due`` has the rank of the pair that now starts at a place, so an entry whose symbols
    have changed since it was pushed is passed over.
    """
    n = len(piece)
    symbol, get = list(piece), merges.get
    after, ahead, due, heap = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n, []
    for i in range(n - 1):
        if found := get(symbol[i] << 20 | symbol[i + 1]):
            due[i] = found[0]
            heap.append(found[0] << 40 | i)
    if not heap:
        return n
    heapq.heapify(heap)
    count = n
    while heap:
        entry = heapq.heappop(heap)
        i = entry & PLACE
        if due[i] != entry >> 40:
            continue
        j = after[i]
        new = symbol[i] = get(symbol[i] << 20 | symbol[j])[1]
        due[j] = due[i] = -1
        k = after[i] = after[j]
        count -= 1
        if k < n:
            ahead[k] = i
            if found := get(new << 20 | symbol[k]):
                due[i] = found[0]
                heapq.heappush(heap, found[0] << 40 | i)
        h = ahead[i]
        if h >= 0:
            if found := get(symbol[h] << 20 | new):
                due[h] = found[0]
                heapq.heappush(heap, found[0] << 40 | h)
            else:
                due[h] = -1
    return count


class Counter:
    """Counts the tokens of texts. A unit is a run of white space with the word after it; units are independent."""

    def __init__(self, merges, specials):
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        pieces = Kept(lambda piece: merged_count(piece.encode(), merges), KEPT_PIECES)
        self.units = Kept(lambda unit: sum(map(pieces.__getitem__, SPLIT.findall(unit))), KEPT_UNITS)
        self.spaced = Kept(lambda word: sum(map(pieces.__getitem__, SPLIT.findall(" " + word))), KEPT_UNITS)

    def plain(self, text: str) -> int:
        if MIXED_SPACE.search(text):
            return sum(map(self.units.__getitem__, UNIT.findall(text)))
        first, *others = text.split(" ")
        return self.units[first] + sum(map(self.spaced.__getitem__, others))

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special is not None else [text]
        return len(parts) - 1 + sum(map(self.plain, parts))


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Per document: ``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE file of the ``tokenizers`` library, read by the driver; the merge
    ranks, whose number the file fixes, go to the tasks. A special string inside a text counts as one token, as that
    library does by default; nothing is added or cut. Null texts count as empty. Rows with null or repeated ids come
    back one for one, an empty table gives no rows, and other columns are not read. There is no shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_merges(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = in_process(f"counter {vocabulary}", lambda: Counter(*shared.value))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [counter.count(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"])

    id_type = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), size.alias("n_bytes"))
    counted = rows.mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

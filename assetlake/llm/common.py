"""Helpers shared by the corpus operators: words, row keys, bit filters and joins that survive hot keys."""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.session import cut_lineage

#: Words are the maximal runs of characters other than these (Python's ``bytes.split()`` uses the same set).
SPACE = r"[\x20\x09-\x0D]+"
FILTER_BITS = 24
HOT_SHARE = 1 / 2000


def whole(text: str) -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: str) -> Column:
    """Number of words of a text; a null text has none."""
    one_each = F.regexp_replace(whole(text), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "w")
    return F.when(whole(text).rlike(r"[^\x20\x09-\x0D]"), F.length(one_each)).otherwise(0).cast("long")


def crc32_utf8(text: str) -> Column:
    return F.crc32(F.encode(whole(text), "UTF-8"))


def learns(doc_id: str, folds: int) -> Column:
    """True for rows that a model may learn from: crc32 of the id as text is not 0 modulo ``folds``."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % folds != 0, F.lit(False))


def held_out(doc_id: str, folds: int) -> Column:
    return ~learns(doc_id, folds)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


class Kept(dict):
    """A function of short strings whose results are kept while there is room."""

    def __init__(self, function, room: int):
        super().__init__()
        self.function, self.room = function, room

    def __missing__(self, key: str) -> int:
        n = self.function(key)
        if len(key) <= 64:
            if len(self) >= self.room:
                self.clear()
            self[key] = n
        return n


class Recent(dict):
    """A function of short strings whose latest results are kept, in two generations of at most ``room`` bytes each.

    A full generation takes the place of the older one; what is asked for again moves up, so frequent strings stay.
    """

    #: Bytes of a place in a dictionary, as measured.
    PLACE = 50

    def __init__(self, function, room: int):
        super().__init__()
        self.function, self.room, self.used, self.older = function, room, 0, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.function(key)
        if len(key) <= 64:
            self.used += self.PLACE + sys.getsizeof(key) + sys.getsizeof(value)
            if self.used > self.room:
                self.older, self.used = {}, 0
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def in_process(key: str, make):
    """What ``make`` gives, made once per Python worker: a worker that runs several tasks keeps its cache."""
    kept = vars(sys).setdefault("_assetlake_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def bit_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Rows (word, mask) of a bit set that holds every ``key`` (a long) modulo ``2 ** bits``.

    It has at most ``2 ** (bits - 6)`` rows whatever the number of keys, so it may be broadcast.
    A test against it can say yes for an absent key and never says no for a present one, so it only
    spares work: exact joins follow it.
    """
    slot = F.pmod(F.col(key), F.lit(1 << bits))
    one = F.lit(1).cast("long")
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{key}`, 64L) as int))")
    return (
        keys.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit"), one.alias("n"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
    )


def maybe_in(df: DataFrame, key: Column, bits_table: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with a boolean column ``flag``: whether ``key`` may be in the filter."""
    words = F.broadcast(bits_table.select(F.col("word").alias("_bf_word"), F.col("mask").alias("_bf_mask")))
    slot = F.pmod(key, F.lit(1 << bits))
    joined = df.withColumn("_bf_slot", slot).join(words, F.shiftright(F.col("_bf_slot"), 6) == F.col("_bf_word"), "left")
    hit = F.coalesce(F.expr("getbit(_bf_mask, cast(pmod(_bf_slot, 64L) as int)) = 1"), F.lit(False))
    return joined.withColumn(flag, hit).drop("_bf_slot", "_bf_word", "_bf_mask")


def filter_words(bits_table: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit set as an array of ``2 ** (bits - 6)`` words for use inside Python tasks."""
    out = np.zeros(1 << (bits - 6), np.uint64)
    rows = bits_table.collect()  # at most 2 ** (bits - 6) rows
    if rows:
        out[[r["word"] for r in rows]] = np.array([r["mask"] for r in rows], np.int64).view(np.uint64)
    return out


def in_words(words: np.ndarray, keys: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """Test of an array of long keys against :func:`filter_words`."""
    slot = keys.astype(np.int64).view(np.uint64) & np.uint64((1 << bits) - 1)
    return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``groups`` (one row per key, with the number of rows of the key in ``weight``).

    Keys with over ``HOT_SHARE`` of all rows, of which there are fewer than ``1 / HOT_SHARE``, are joined by
    broadcast and never shuffled; the others go through an ordinary join. Both tables should be stored ones.
    """
    total = groups.agg(F.sum(weight)).first()[0] or 0
    least = max(1, math.floor(total * HOT_SHARE))
    hot = F.broadcast(groups.where(F.col(weight) > least))
    cold = groups.where(F.col(weight) <= least)
    rest = rows.join(F.broadcast(groups.where(F.col(weight) > least).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys, "inner").unionByName(rest.join(cold, keys, how))


def row_key(id_col: str, content: Column) -> Column:
    """A digest of a row's id and content (neither may be told apart by anything else); never null."""
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    mark = F.when(F.col(id_col).isNull(), "n").otherwise(F.concat(F.lit("i"), F.length(id_text).cast("string")))
    return F.md5(F.encode(F.concat(mark, F.lit(":"), id_text, F.coalesce(content, F.lit(""))), "UTF-8"))


def ordered_id(id_col: str, key: Column) -> Column:
    """The id as a struct that orders by (id is null, id, key), for components that are decided row by row."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), key.alias("key"))


def keep_first(rows: DataFrame, key: Column, parts: DataFrame, purpose: str) -> DataFrame:
    """``rows`` without those that are not the first of their component; of rows with the first's key one stays.

    ``parts`` has, for each row that is to be decided, its ``key`` and the key ``first`` of its component's first row;
    rows whose key is not there stay. Keys to drop are tested by a bit filter first, so that only rows it may hold
    are shuffled.
    """
    counts = parts.groupBy("key", "first").agg(F.count(F.lit(1)).alias("_kf_n"))
    decided = counts.where("key <> first or _kf_n > 1").withColumn("_kf_gone", F.expr("key <> first"))
    decided = decided.select(F.col("key").alias("_kf_key"), "_kf_n", "_kf_gone")
    decided = cut_lineage(decided, f"{purpose}-decided")
    filtered = cut_lineage(bit_filter(decided.select(F.xxhash64("_kf_key").alias("key")), "key"), f"{purpose}-filter")
    flagged = maybe_in(rows.withColumn("_kf_key", key), F.xxhash64("_kf_key"), filtered, "_kf_maybe")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    checked = attach(flagged.where("_kf_maybe"), decided, ["_kf_key"], "_kf_n")
    out = flagged.where("not _kf_maybe").select(*columns).unionByName(checked.where("_kf_gone is null").select(*columns))
    if decided.where("not _kf_gone").isEmpty():
        return out
    copies = checked.where("not _kf_gone").select("_kf_key", F.struct(*columns).alias("_kf_row"))
    return out.unionByName(copies.groupBy("_kf_key").agg(F.any_value("_kf_row").alias("_kf_row")).select("_kf_row.*"))

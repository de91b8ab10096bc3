"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import FILTER_BITS, SPACE, attach, bit_filter, free_name, maybe_in, whole
from assetlake.session import cut_lineage

PREFIX_CHARS = 256


def normalised(text: str) -> Column:
    """The text with every run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(whole(text), SPACE, " ")


def full_hash(text: str) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def refine(
    docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = (), bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with ``_ed_maybe``: whether another row may have its length and prefix; ids and full hashes of those).

    The first pass counts the rows of each length and prefix hash. Lengths that occur once are settled; of the others,
    prefixes that occur once are settled. Only the remaining rows are read again in full and hashed
    with SHA-256. The surviving (length, prefix) keys reach that second scan as a bit filter of bounded size.
    """
    norm = normalised(text_col)
    key = F.xxhash64(F.octet_length(norm), F.substring(norm, 1, PREFIX_CHARS))
    first = docs.select(F.octet_length(norm).alias("len"), key.alias("prefix"))
    # Rows are counted by length and prefix first, so that a group of copies is one row from here on.
    pairs = cut_lineage(first.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")), "exact-pairs")
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("rows")).where("rows > 1")
    shared_prefix = pairs.join(lengths, "len", "left_semi").where("n > 1")
    surviving = cut_lineage(bit_filter(shared_prefix, "prefix", bits), "exact-filter")
    flagged = maybe_in(docs, key, surviving, "_ed_maybe", bits)
    hashed = cut_lineage(
        flagged.where("_ed_maybe").select(F.col(id_col).alias("id"), full_hash(text_col).alias("hash"), *carry),
        "exact-hash",
    )
    return flagged, hashed


def equal_groups(hashed: DataFrame) -> DataFrame:
    """(hash, keep_id, group_size): the smallest non-null id of each text stays, null only if there is no other."""
    return hashed.groupBy("hash").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per document: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and the columns ``carry``.

    Texts are equal when they are identical after white space runs became single spaces. Of equal texts the row
    with the smallest id stays. Null texts equal the empty text. Rows that repeat an id have equal results; a row
    with a null id is kept only if its text has no other row. An empty table gives an empty result. Other columns
    are not looked at.
    """
    flagged, hashed = refine(docs.select(id_col, text_col, *carry), id_col, text_col, carry)
    groups = cut_lineage(equal_groups(hashed), "exact-groups")
    copies = attach(hashed, groups, ["hash"], "group_size").select("id", "keep_id", "group_size", *carry)
    alone = flagged.where("not _ed_maybe").select(
        F.col(id_col).alias("id"), F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *carry
    )
    return alone.unionByName(copies).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), *carry
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; see :func:`exact_groups` for the rule.

    Texts are never shuffled except those of rows whose group has several members; of fully equal rows (same id
    and text) one stays.
    """
    flagged, hashed = refine(docs, id_col, text_col)
    groups = cut_lineage(equal_groups(hashed), "exact-groups")
    several = groups.where("group_size > 1").select(F.col("hash").alias("_ed_hash"))
    copied = F.broadcast(bit_filter(several.select(F.xxhash64("_ed_hash").alias("key")), "key"))
    alone = flagged.where("not _ed_maybe").drop("_ed_maybe")
    rest = flagged.where("_ed_maybe").drop("_ed_maybe").withColumn("_ed_hash", full_hash(text_col))
    rest = maybe_in(rest, F.xxhash64("_ed_hash"), copied, "_ed_copy")
    order = F.struct(F.col(id_col).isNull(), F.col(id_col))  # null ids last
    cols = free_name(docs, "_ed_row")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(cols)
    first = (
        rest.where("_ed_copy")
        .select("_ed_hash", order.alias("_ed_order"), row)
        .groupBy("_ed_hash")
        .agg(F.min_by(cols, "_ed_order").alias(cols))
        .select(f"{cols}.*")
    )
    return alone.unionByName(rest.where("not _ed_copy").drop("_ed_hash", "_ed_copy")).unionByName(first)

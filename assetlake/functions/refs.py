"""Asset references such as ``account/project/datasets/name:version.build#selector``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reference syntax (fixed pattern).
REF_PATTERN = (
    r"^(([a-zA-Z0-9_-]+)\/)?(([a-zA-Z0-9_-]+)\/)?(datasets|models)\/([a-zA-Z0-9_-]+)"
    r"(:([a-z0-9_]*)(\.([0-9]*))?)?(#([a-zA-Z0-9_-]+))?$"
)
PARTS = ["account", "project", "type", "name", "version", "build", "selector"]


# Groups kept from a match: account or project, project, type, name, version with and without
# its colon, build, selector.
GROUPS = (2, 4, 5, 6, 7, 8, 10, 12)


def _groups(ref: Column, expected_type: str | None) -> Column:
    """All groups of the reference by one regular expression; a text that does not match comes back whole."""
    if expected_type:
        ref = F.when(F.contains(ref, F.lit("/")), ref).otherwise(F.concat(F.lit(f"{expected_type}/"), ref))
    return F.split(F.regexp_replace(ref, REF_PATTERN, "\x01".join(f"${g}" for g in GROUPS)), "\x01")


def parse_refs(
    df: DataFrame,
    column: str,
    into: str,
    expected_type: str | None = None,
    account: str | None = None,
    project: str | None = None,
) -> DataFrame:
    """Add the struct ``into``: ``status`` (``ok`` or what is wrong) and the parts of a reference.

    A bare name gets ``expected_type``. With a default account or project, missing ones are
    filled in, and a reference that still lacks one is a ``relative reference``.
    """
    groups = F.col("_groups")
    first, second, kind, name, colon, version, number, selector = (
        F.nullif(F.get(groups, F.lit(i)), F.lit("")) for i in range(len(GROUPS))
    )
    who = F.coalesce(F.when(second.isNotNull(), first), F.lit(account))
    what = F.coalesce(second, first, F.lit(project))
    status = F.when(F.col(column).isNull(), "missing reference")
    if expected_type is None:
        status = status.when(~F.contains(column, F.lit("/")), "full path or type needed")
    status = status.when(F.size(groups) < len(GROUPS), "pattern mismatch")
    if expected_type is not None:
        status = status.when(kind != expected_type, "type mismatch")
    if account is not None or project is not None:
        status = status.when(who.isNull() | what.isNull(), "relative reference")
    status = status.otherwise("ok")
    values = {
        "account": who,
        "project": what,
        "type": kind,
        "name": name,
        "version": F.when(colon.isNotNull(), F.coalesce(version, F.lit(""))),
        "build": number.try_cast("long"),
        "selector": selector,
    }
    ok = status == "ok"
    parsed = F.struct(status.alias("status"), *[F.when(ok, values[p]).alias(p) for p in PARTS])
    listed = df.withColumn("_groups", _groups(F.col(column), expected_type))
    return listed.withColumn(into, parsed).drop("_groups")


def _qualifier(ref: Column, tag: Column | None) -> Column:
    version = F.concat(ref["version"], F.coalesce(F.concat(F.lit("."), ref["build"].cast("string")), F.lit("")))
    return F.coalesce(tag, version) if tag is not None else version


def render_path(ref: Column, tag: Column | None = None, selector: bool = True) -> Column:
    """``account/project/type/name:tag#selector``; a tag wins over version and build.

    The path of a reference that was not understood is null.
    """
    joined = F.concat_ws("/", ref["account"], ref["project"], ref["type"], ref["name"])
    base = F.when(ref["name"].isNotNull(), joined)
    path = F.concat(base, F.coalesce(F.concat(F.lit(":"), _qualifier(ref, tag)), F.lit("")))
    if selector:
        path = F.concat(path, F.coalesce(F.concat(F.lit("#"), ref["selector"]), F.lit("")))
    return path


def render_url(ref: Column, host: str, tag: Column | None = None) -> Column:
    """URL of the asset; null without account and project."""
    base = F.concat_ws("/", F.lit(host), ref["account"], ref["project"], ref["type"], ref["name"])
    query = F.coalesce(F.concat(F.lit("?v="), _qualifier(ref, tag)), F.lit(""))
    fragment = F.coalesce(F.concat(F.lit("#"), F.nullif(ref["selector"], F.lit(""))), F.lit(""))
    complete = ref["account"].isNotNull() & ref["project"].isNotNull()
    return F.when(complete, F.concat(base, query, fragment))

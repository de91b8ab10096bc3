"""Logged values as a long table: typing, expansion, decoding, series and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.operators.skew import lookup

# Types of logged values (fixed names).
TEXT, TABLE, NUMBER, BOOLEAN = "TEXT", "TABLE", "NUMBER", "BOOLEAN"
IMAGE, VIDEO, MARKDOWN, FILE = "IMAGE", "VIDEO", "MARKDOWN", "FILE"
# Suffixes of media files (fixed lists).
VIDEO_SUFFIXES = [".mp4", ".webm", ".ogg"]
IMAGE_SUFFIXES = [".gif", ".png", ".jpg", ".jpeg"]
# Most rows of one logged table (fixed value).
TABLE_ROW_LIMIT = 1_000


def suffix(path: Column) -> Column:
    """Lower-cased last suffix of a path, empty if its name has none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def path_type(path: Column) -> Column:
    ending = suffix(path)
    return F.when(ending.isin(VIDEO_SUFFIXES), VIDEO).when(ending.isin(IMAGE_SUFFIXES), IMAGE).otherwise(FILE)


def _kind(value: Column) -> Column:
    """Kind of a variant, from its type name; null (no valid JSON) is ``invalid``."""
    kinds = {"STR": "string", "ARR": "list", "OBJ": "object", "BOO": "boolean", "VOI": "null", "?": "invalid"}
    table = F.create_map(*[F.lit(v) for pair in kinds.items() for v in pair])
    name = F.substring(F.schema_of_variant(value), 1, 3)
    return F.coalesce(table[F.coalesce(name, F.lit("?"))], F.lit("number"))


# A string of a JSON text, or a number outside of strings (the grammar of JSON).
LITERAL = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(-?(?:0|[1-9]\d*+)(?:\.\d++)?+(?:[eE][+-]?\d++)?+(?![\w.+-]))'
#: Begins a string value that stands for a number; a text can hold it only as written out in escapes.
NUMBER_MARK = "\u0001\u0002"
_ESCAPED_MARK = r"\u0001\u0002"


def _numbers_as_text(json: Column) -> Column:
    """A JSON text with each number as a marked string, so that it survives parsing as it was written.

    Numbers that JSON does not allow are left, or cut so that the text stays invalid. Raw control characters, which JSON
    does not allow either, delimit the tokens on the way.
    """
    split = F.regexp_replace(json, LITERAL, "$1\x02$2\x03")
    opened = F.replace(F.replace(split, F.lit("\x02\x03"), F.lit("")), F.lit("\x02"), F.lit('"' + _ESCAPED_MARK))
    return F.when(json.rlike("[\x02\x03]"), json).otherwise(F.replace(opened, F.lit("\x03"), F.lit('"')))


def _depth(json: Column) -> Column:
    """How deep the objects of a JSON text are nested, from its braces outside of strings."""
    braces = F.regexp_replace(F.regexp_replace(json, r'"(\\.|[^"\\])*"', ""), "[^{}]", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, brace: Column) -> Column:
        now = state["now"] + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.split(braces, ""), zero, step)["most"]


def walk_objects(df: DataFrame, keep: Sequence[str], column: str, delimiter: str = "/") -> DataFrame:
    """All non-object values inside JSON objects of any depth.

    Returns ``keep``, the key path, the enclosing key (null at the top), the key, the kind and
    the plain text of the value; numbers are as they were written. Arrays stay whole. A text that is no valid JSON, or has a key
    twice, gives one row of kind ``invalid`` without a path. One pass finds how deep the objects
    go; then a single plan parses each text once and opens all objects level by level.
    """
    texts = df.select(*keep, F.trim(F.col(column)).alias("json")).filter("json IS NOT NULL")
    depth = texts.filter(F.startswith("json", F.lit("{"))).agg(F.max(_depth(F.col("json")))).first()[0] or 0
    none = F.lit(None).cast("string")
    rows = texts.select(
        *keep, none.alias("path"), none.alias("parent"), none.alias("key"),
        F.try_parse_json(_numbers_as_text(F.col("json"))).alias("v"),
    ).filter("v IS NULL OR startswith(schema_of_variant(v), 'OBJ')")
    # What is no object passes a level as an entry without a key.
    entry = "array<struct<key:string,value:variant>>"
    opened = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")).cast(entry)
    same = F.array(F.struct(none.alias("key"), F.col("v").alias("value")))
    inner = F.col("_e.key").isNotNull()
    for _ in range(depth):
        rows = rows.withColumn("_e", F.explode(F.when(_kind(F.col("v")) == "object", opened).otherwise(same))).select(
            *keep,
            F.when(inner, F.concat_ws(delimiter, "path", "_e.key")).otherwise(F.col("path")).alias("path"),
            F.when(inner, F.col("key")).otherwise(F.col("parent")).alias("parent"),
            F.coalesce("_e.key", "key").alias("key"),
            F.col("_e.value").alias("v"),
        )
    kind, text = _kind(F.col("v")), F.col("v").cast("string")
    number = (kind == "string") & F.startswith(text, F.lit(NUMBER_MARK))
    inside = F.regexp_replace(text, r'"\\u0001\\u0002([^"]*)"', "$1")
    text = F.when(number, F.substring(text, F.lit(3), F.length(text))).when(kind == "list", inside).otherwise(text)
    kind = F.when(number, "number").otherwise(kind)
    return rows.select(*keep, "path", "parent", "key", kind.alias("kind"), text.alias("text")).withColumn(
        "text", F.when(F.col("kind") == "boolean", F.initcap("text")).otherwise(F.col("text"))
    )


def flatten_params(df: DataFrame, keep: Sequence[str], column: str, delimiter: str = "/") -> DataFrame:
    """``(keep, path, value)`` for every leaf of nested JSON objects; null becomes ``None``.

    A text that cannot be parsed gives a row without path and value.
    """
    value = F.when(F.col("kind") == "null", "None").otherwise(F.col("text"))
    return walk_objects(df, keep, column, delimiter).select(*keep, "path", value.alias("value"))


def type_log_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Typed long rows of logged values.

    ``df`` has ``tag``, ``kind`` (``json``, ``markdown`` or ``path``), ``raw``, ``x``, ``x_type``,
    ``category`` and ``group_tag``. An object gives one row per item, grouped under its key and
    without the step. Only numbers, images and videos keep the step. A bad step or a value of
    no known type gives a row with ``error`` set.
    """
    keep = list(keep)
    step = F.col("x").try_cast("bigint") if isinstance(df.schema["x"].dataType, T.StringType) else F.col("x").cast("bigint")
    bad_step = F.col("x").isNotNull() & (step.isNull() | (step < 0))
    rows = df.select(
        *keep, "tag", F.col("kind").alias("source"), F.trim("raw").alias("json"), step.alias("x"), "x_type",
        "category", "group_tag", bad_step.alias("bad_step"),
    )
    is_json = F.col("source") == "json"
    rows = rows.withColumn("v", F.when(is_json, F.try_parse_json("json")))
    kind = F.when(is_json, _kind(F.col("v"))).otherwise("plain")
    stored = (
        F.when(F.col("kind") == "string", F.col("v").cast("string"))
        .when(F.col("kind") == "boolean", F.initcap("json"))
        .otherwise(F.col("json"))
    )
    rows = rows.withColumn("kind", kind).withColumn("text", stored).drop("v")
    to_open = is_json & F.startswith("json", F.lit("{")) & (F.col("kind") == "object") & ~F.col("bad_step")
    inner = walk_objects(rows.filter(to_open), [*keep, "tag", "category"], "json")
    items = inner.select(
        *keep,
        F.col("key").alias("tag"),
        F.lit("json").alias("source"),
        "text",
        F.lit(None).cast("bigint").alias("x"),
        F.lit(None).cast("string").alias("x_type"),
        "category",
        F.coalesce("parent", "tag").alias("group_tag"),
        F.lit(False).alias("bad_step"),
        "kind",
    )
    every = rows.filter(~F.coalesce(to_open, F.lit(False))).drop("json").unionByName(items)
    kind = F.col("kind")
    kind_type = (
        F.when(F.col("source") == "markdown", MARKDOWN)
        .when(F.col("source") == "path", path_type(F.col("text")))
        .when(kind.isin("string", "list"), TEXT)
        .when(kind == "boolean", BOOLEAN)
        .when(kind == "number", NUMBER)
    )
    error = F.when(F.col("bad_step"), "step must be a non-negative integer").when(
        F.col("type").isNull(), "unsupported value type"
    )
    stepped = F.col("type").isin(NUMBER, IMAGE, VIDEO) & F.col("x").isNotNull()
    good = F.col("error").isNull()
    return (
        every.withColumn("type", kind_type)
        .withColumn("error", error)
        .select(
            *keep,
            "tag",
            F.when(good, F.col("type")).alias("type"),
            F.when(good, F.col("text")).alias("value"),
            F.when(good & stepped, F.col("x")).otherwise(F.lit(-1)).cast("bigint").alias("x"),
            F.when(good & stepped, F.coalesce("x_type", F.lit("STEP"))).alias("x_type"),
            "category",
            "group_tag",
            "error",
        )
    )


def decode_log_rows(df: DataFrame) -> DataFrame:
    """Add ``number``, ``text``, ``flag`` and ``decode_error`` according to ``type``."""
    kind, value = F.col("type"), F.col("value")
    known = kind.isin(NUMBER, TEXT, MARKDOWN, BOOLEAN, TABLE)
    return df.select(
        "*",
        F.when(kind == NUMBER, value.try_cast("double")).alias("number"),
        F.when(kind.isin(TEXT, MARKDOWN, TABLE), value).alias("text"),
        F.when(kind == BOOLEAN, value == "True").alias("flag"),
        F.when(~F.coalesce(known, F.lit(False)), "not a plain value")
        .when((kind == NUMBER) & value.try_cast("double").isNull(), "not a number")
        .alias("decode_error"),
    )


def metric_series(df: DataFrame, entity: Sequence[str], seq: str) -> DataFrame:
    """``(entity, tag, x, value, latest)``: the last value per step, and per tag the last of all."""
    points = df.groupBy(*entity, "tag", "x").agg(
        F.max_by("value", seq).alias("value"), F.max(seq).alias("_seq")
    )
    latest = points.groupBy(*entity, "tag").agg(
        F.max_by("value", "_seq").alias("latest"), F.count(F.lit(1)).alias("_n")
    )
    return lookup(points, latest, [*entity, "tag"], weight="_n").drop("_seq", "_n")


def entity_labels(df: DataFrame, run: str, train: str, build: str, label: str) -> DataFrame:
    """Distinct labels per run, train or build; each input row must name exactly one of them."""
    named = sum(F.col(c).isNotNull().cast("int") for c in (run, train, build))
    checked = df.filter(F.col(label).isNotNull()).withColumn(
        "_one", F.when(named != 1, F.raise_error("exactly one of run, train and build must be given")).otherwise(True)
    )
    kind = F.when(F.col(run).isNotNull(), "run").when(F.col(train).isNotNull(), "train").otherwise("build")
    return (
        checked.filter("_one")
        .select(
            kind.alias("kind"),
            F.coalesce(*[F.col(c).cast("string") for c in (run, train, build)]).alias("entity"),
            F.col(label).alias("label"),
        )
        .distinct()
    )


def tables_to_json(df: DataFrame, entity: Sequence[str], order: Sequence[str], limit: int = TABLE_ROW_LIMIT) -> DataFrame:
    """One JSON table per entity, with its schema; an entity with more than ``limit`` rows gets an error.

    Row counts are settled first, so at most ``limit`` rows of an entity are ever collected.
    """
    fields = [c for c in df.columns if c not in entity]
    counts = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("n_rows"))
    small = lookup(df, counts, entity, weight="n_rows").filter(F.col("n_rows") <= limit)
    schema_text = df.select(*fields).schema.simpleString()
    record = F.struct(*[c for c in order if c in fields], *[c for c in fields if c not in order])
    rows = F.array_sort(F.collect_list(record))
    value = F.to_json(F.struct(F.lit(schema_text).alias("schema"), rows.alias("data")))
    written = small.groupBy(*entity).agg(F.count(F.lit(1)).alias("n_rows"), value.alias("value"))
    errors = counts.filter(F.col("n_rows") > limit).select(
        *entity,
        "n_rows",
        F.concat(F.lit(f"a logged table cannot exceed {limit} rows, got "), "n_rows").alias("error"),
    )
    return written.unionByName(errors, allowMissingColumns=True)


def json_to_tables(df: DataFrame, entity: Sequence[str], schema: str) -> DataFrame:
    """Rows of the JSON tables; ``schema`` is the DDL of one row."""
    parsed = F.from_json("value", f"struct<schema:string,data:array<struct<{schema}>>>")
    return df.filter(F.col("value").isNotNull()).select(*entity, F.inline(parsed["data"]))

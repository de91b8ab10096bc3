import pytest
from pyspark.sql import functions as F

from assetlake.operators import metadata as m

CALL = "id long, tag string, kind string, raw string, x string, x_type string, category string, group_tag string"


def typed(spark, *calls):
    rows = [(i, tag, kind, raw, x, None, "c", None) for i, (tag, kind, raw, x) in enumerate(calls)]
    got = m.type_log_rows(spark.createDataFrame(rows, CALL), ["id"]).collect()
    return sorted((r["id"], r["tag"], r["type"], r["value"], r["x"], r["x_type"], r["group_tag"], r["error"]) for r in got)


def test_value_types(spark):
    got = typed(
        spark,
        ("t", "json", '"hi"', "3"),
        ("l", "json", "[1, 2]", "3"),
        ("b", "json", " true", "3"),
        ("n", "json", "1.5", "3"),
        ("i", "json", "7", None),
        ("m", "markdown", "# title", "3"),
        ("v", "path", "runs/a.MP4", "3"),
        ("p", "path", "runs/a.jpeg", "0"),
        ("f", "path", "runs/.png", "3"),
    )
    assert got == [
        (0, "t", "TEXT", "hi", -1, None, None, None),
        (1, "l", "TEXT", "[1, 2]", -1, None, None, None),
        (2, "b", "BOOLEAN", "True", -1, None, None, None),
        (3, "n", "NUMBER", "1.5", 3, "STEP", None, None),
        (4, "i", "NUMBER", "7", -1, None, None, None),
        (5, "m", "MARKDOWN", "# title", -1, None, None, None),
        (6, "v", "VIDEO", "runs/a.MP4", 3, "STEP", None, None),
        (7, "p", "IMAGE", "runs/a.jpeg", 0, "STEP", None, None),
        (8, "f", "FILE", "runs/.png", -1, None, None, None),
    ]


def test_bad_steps_and_values_give_error_rows(spark):
    got = typed(spark, ("a", "json", "1", "-1"), ("b", "json", "1", "xyz"), ("c", "json", "null", None), ("d", "json", "{bad", None))
    assert [r[2] for r in got] == [None] * 4
    assert [r[-1] for r in got] == ["step must be a non-negative integer"] * 2 + ["unsupported value type"] * 2


def test_objects_expand_and_lose_the_step(spark):
    got = typed(spark, ("outer", "json", '{"a": 1, "in": {"b": true, "none": {}}, "z": null}', "4"))
    assert sorted((r[1], r[2], r[3], r[4], r[6], r[7]) for r in got) == [
        ("a", "NUMBER", "1", -1, "outer", None),
        ("b", "BOOLEAN", "True", -1, "in", None),
        ("z", None, None, -1, "outer", "unsupported value type"),
    ]


def test_flatten_any_depth(spark):
    deep = '{"a": {"b": {"c": {"d": {"e": "x"}}}}, "n": null, "l": [{"k": 1}], "s": "{no}"}'
    texts = [(1, deep), (2, "[1]"), (3, None), (4, "not json"), (5, "{bad"), (6, '{"a": 1, "a": 2}'), (7, '{"e": {}, "}{": {"}": "{"}}')]
    df = spark.createDataFrame(texts, "id long, j string")
    got = sorted(((r["id"], r["path"], r["value"]) for r in m.flatten_params(df, ["id"], "j").collect()), key=repr)
    assert got == [
        (1, "a/b/c/d/e", "x"), (1, "l", '[{"k":1}]'), (1, "n", "None"), (1, "s", "{no}"),
        (4, None, None), (5, None, None), (6, None, None), (7, "}{/}", "{"),
    ]
    assert m.flatten_params(df.limit(0), ["id"], "j").isEmpty()


def test_numbers_keep_their_text(spark):
    good = ["1.0", "2.50", "1e-5", "-0", "1E+400", "12345678901234567890123", "0.10"]
    wrong = ["01", "1.", "1.2.3", "-", "+1", "1e", "0x1", "1 2", ".5"]
    quoted = ['"1.0"', '"a 1.0, 2"', '"q\\"7"', '"\\\\"']
    texts = good + wrong + quoted
    rows = [(i, f'{{"k1": {{"2.0": {t}}}, "l": [{t}, {{"x": {t}}}]}}') for i, t in enumerate(texts)]
    got = {}
    for r in m.flatten_params(spark.createDataFrame(rows, "id long, j string"), ["id"], "j").collect():
        got.setdefault(texts[r["id"]], {})[r["path"]] = r["value"]
    for t in good:
        assert got[t] == {"k1/2.0": t, "l": f'[{t},{{"x":{t}}}]'}
    for t in wrong:
        assert got[t] == {None: None}
    assert [got[t]["k1/2.0"] for t in quoted] == ["1.0", "a 1.0, 2", 'q"7', "\\"]
    assert [got[t]["l"] for t in quoted] == [f'[{t},{{"x":{t}}}]' for t in quoted]


def test_decoding(spark):
    rows = [("NUMBER", "2.5"), ("BOOLEAN", "False"), ("TEXT", "t"), ("MARKDOWN", "m"), ("IMAGE", "u"), ("NUMBER", "abc")]
    df = spark.createDataFrame(rows, "type string, value string")
    got = m.decode_log_rows(df).collect()
    assert [(r["number"], r["text"], r["flag"], r["decode_error"]) for r in got] == [
        (2.5, None, None, None), (None, None, False, None), (None, "t", None, None), (None, "m", None, None),
        (None, None, None, "not a plain value"), (None, None, None, "not a number"),
    ]


def test_series_keeps_the_last_value_per_step_and_isolates_entities(spark):
    rows = [("b1", "t", step, f"value {step}", seq) for seq, step in enumerate([1, 2, 3, 4])]
    rows += [("b1", "t", 2, "late", 9), ("b2", "t", 2, "other", 5)]
    df = spark.createDataFrame(rows, "build string, tag string, x long, value string, seq long")
    got = sorted((r["build"], r["x"], r["value"], r["latest"]) for r in m.metric_series(df, ["build"], "seq").collect())
    assert got == [
        ("b1", 1, "value 1", "late"), ("b1", 2, "late", "late"), ("b1", 3, "value 3", "late"), ("b1", 4, "value 4", "late"),
        ("b2", 2, "other", "other"),
    ]


def test_tables_above_the_limit_are_errors(spark):
    df = spark.range(2002).select(F.when(F.col("id") < 1001, "big").otherwise(F.concat(F.lit("e"), F.col("id") % 2)).alias("e"), "id")
    rows = {r["e"]: r for r in m.tables_to_json(df, ["e"], ["id"]).collect()}
    assert rows["big"]["value"] is None and "1001" in rows["big"]["error"]
    assert rows["e0"]["error"] is None
    back = m.json_to_tables(m.tables_to_json(df, ["e"], ["id"]), ["e"], "id:bigint")
    assert back.count() == 1001


def test_labels_need_exactly_one_owner(spark):
    schema = "run string, train string, build string, label string"
    good = spark.createDataFrame([("r", None, None, "x"), ("r", None, None, "x"), (None, "t", None, "y"), (None, None, "b", None)], schema)
    got = sorted(tuple(r) for r in m.entity_labels(good, "run", "train", "build", "label").collect())
    assert got == [("run", "r", "x"), ("train", "t", "y")]
    bad = spark.createDataFrame([("r", "t", None, "x")], schema)
    with pytest.raises(Exception, match="exactly one"):
        m.entity_labels(bad, "run", "train", "build", "label").collect()

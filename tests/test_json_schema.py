"""Each keyword of the schema compiler with a value that passes and one that fails."""

import json

import pytest

from tidemark.operators import json_schema, messages


def errors(spark, schema, *values):
    df = spark.createDataFrame([(json.dumps(v),) for v in values], "message string")
    return [r.errors for r in json_schema.validate(df, schema).collect()]


def obj(**properties):
    return {"type": "object", "properties": properties}


@pytest.mark.parametrize(
    "rule, good, bad, name",
    [
        ({"type": "string"}, "x", 1, "type:k"),
        ({"type": "integer"}, 7, "7", "type:k"),
        ({"type": "integer"}, 7, 7.5, "type:k"),
        ({"type": "number"}, 7.5, True, "type:k"),
        ({"type": "boolean"}, False, "false", "type:k"),
        ({"type": "null"}, None, 0, "type:k"),
        ({"type": ["string", "null"]}, None, 3, "type:k"),
        ({"type": "object"}, {"a": 1}, [1], "type:k"),
        ({"type": "array"}, [1, "a"], {"a": 1}, "type:k"),
        ({"type": "string", "enum": ["a", "b"]}, "b", "c", "enum:k"),
        ({"type": "string", "enum": ["a", "b"]}, "a", None, "enum:k"),
        ({"type": "string", "minLength": 3}, "abc", "ab", "short:k"),
        ({"type": "string", "minLength": 2}, "ñé", 1234, "short:k"),
        ({"type": "string", "maxLength": 3}, "abc", "abcd", "long:k"),
        ({"type": "string", "format": "date-time"}, "2024-02-29T00:00:00Z", "2023-02-29T00:00:00Z", "format:k"),
        ({"type": "string", "format": "date"}, "2024-02-29", "2024-2-29", "format:k"),
        ({"type": "array", "items": {"type": "string"}}, ["a", ""], ["a", 1], "type:k"),
        ({"type": "array", "items": {"type": "string"}}, [], ["a", None], "type:k"),
        ({"type": "array", "items": {"type": "string", "minLength": 1}}, ["a"], ["a", ""], "empty:k"),
        ({"type": "array", "items": {"type": "string", "maxLength": 1}}, ["a"], ["ab"], "long:k"),
        ({"type": "array", "items": {"type": "string", "enum": ["a"]}}, ["a"], ["b"], "enum:k"),
    ],
)
def test_keywords(spark, rule, good, bad, name):
    assert errors(spark, obj(k=rule), {"k": good}, {"k": bad}, {}) == [[], [name], []]


def test_required_and_additional_properties(spark):
    schema = obj(a={"type": "string"}) | {"required": ["a", "b"], "additionalProperties": False}
    assert errors(spark, schema, {"a": "x"}, {"a": "x", "b": 1}, {"b": None, "a": "x"}, {}) == [
        ["missing:b"], ["extra"], ["extra"], ["missing:a", "missing:b"],
    ]
    assert errors(spark, obj(a={"type": "string"}), {"z": 1}) == [[]]


def test_two_rules_of_one_string(spark):
    rule = {"type": "string", "minLength": 2, "maxLength": 3}
    assert errors(spark, obj(k=rule), {"k": "a"}, {"k": "abcd"}, {"k": 5}) == [["short:k"], ["long:k"], ["short:k"]]


def test_names_with_odd_letters(spark):
    assert errors(spark, obj(**{"a.b $'c": {"type": "string"}}), {"a.b $'c": 1}, {"a.b $'c": "x"}) == [["type:a.b $'c"], []]


@pytest.mark.parametrize(
    "schema",
    [
        {"type": "array"},
        obj(k={"type": "string", "pattern": "x"}),
        obj(k={"type": "object", "properties": {}}),
        obj(k={"type": "text"}),
        obj(k={"type": "string", "format": "uri"}),
        obj(k={"type": "array", "items": {"type": "integer"}}),
        obj() | {"minProperties": 1},
    ],
)
def test_what_is_not_compiled_is_refused(spark, schema):
    with pytest.raises(ValueError):
        json_schema.validate(spark.createDataFrame([("{}",)], "message string"), schema).collect()


def test_a_schema_comes_from_a_file(spark, tmp_path):
    path = tmp_path / "handoff.schema.json"
    schema = json.loads(json.dumps(messages.HANDOFF))
    schema["properties"]["status"]["enum"].append("paused")
    path.write_text(json.dumps(schema, indent=1))
    message = {
        "run_id": "nightly-1", "from": "platform", "to": "bi_viz", "intent": "science", "status": "paused", "artifacts": [],
        "contracts": {}, "preconditions_met": [], "metrics": {}, "next_agent": "ninguno", "ts": "2024-01-01T00:00:00Z",
    }
    df = spark.createDataFrame([(json.dumps(message),)], "message string")
    assert messages.validate_handoffs(df).first().errors == ["enum:status"]
    assert messages.validate_handoffs(df, schema=json_schema.load(spark, str(path))).first().valid


def test_types_are_asked_once(spark):
    df = spark.createDataFrame([("{}",)], "message string")
    plan = messages.validate_handoffs(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schema_of_variant") <= len(messages.HANDOFF["properties"]) + 1

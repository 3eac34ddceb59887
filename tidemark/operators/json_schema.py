"""JSON Schema compiled to one column expression that lists what a JSON message breaks.

A message is parsed once, its type asked once for each property, and every rule reads these. The schema is
that of an object with properties of plain types; a keyword that is not compiled is refused, so that
no rule of a contract goes unseen.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "examples", "default"}
TOP = {"type", "required", "properties", "additionalProperties"}
PROPERTY = {"type", "enum", "minLength", "maxLength", "format", "items", "additionalProperties"}
ITEM = {"type", "enum", "minLength", "maxLength"}
#: How a variant's type reads, by JSON type.
KINDS = {
    "string": "STRING",
    "integer": r"BIGINT|DECIMAL\(\d+,0\)",
    "number": r"BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT",
    "boolean": "BOOLEAN",
    "null": "VOID",
    "object": r"OBJECT<.*>",
    "array": r"ARRAY<.*>",
}
MOMENT = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
FIELDS, NOT_AN_OBJECT = "_fields", "not_an_object"


def load(spark: SparkSession, path: str) -> dict[str, Any]:
    """A schema from a file that Spark can read."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def _only(schema: dict, allowed: set[str], where: str) -> None:
    unknown = set(schema) - allowed - ANNOTATIONS
    if unknown:
        raise ValueError(f"keywords not compiled in {where}: {', '.join(sorted(unknown))}")


def _types(schema: dict, where: str) -> list[str]:
    named = schema.get("type", list(KINDS))
    named = [named] if isinstance(named, str) else list(named)
    if not set(named) <= set(KINDS):
        raise ValueError(f"unknown type in {where}: {named}")
    return named


def _text_rules(schema: dict, text: Column, where: str) -> list[tuple[str, Column]]:
    """(name, holds) of the rules on a string."""
    rules = []
    if "enum" in schema:
        if not all(isinstance(v, str) for v in schema["enum"]):
            raise ValueError(f"only strings are compiled in the enum of {where}")
        rules.append(("enum", text.isin(*schema["enum"])))
    if "format" in schema:
        formats = {
            "date-time": lambda: text.rlike(MOMENT) & F.try_to_timestamp(F.upper(text)).isNotNull(),
            "date": lambda: text.rlike(DAY) & F.try_to_date(text).isNotNull(),
        }
        if schema["format"] not in formats:
            raise ValueError(f"format not compiled in {where}: {schema['format']}")
        rules.append(("format", formats[schema["format"]]()))
    if "minLength" in schema:
        rules.append(("short", F.length(text) >= schema["minLength"]))
    if "maxLength" in schema:
        rules.append(("long", F.length(text) <= schema["maxLength"]))
    return rules


def _breaks(schema: dict, label: str, where: str):
    """Whether a string of a list breaks one rule; null is another rule's matter."""
    return lambda x: x.isNotNull() & ~dict(_text_rules(schema, x, where))[label]


class Compiled:
    """The compiled rules of an object schema."""

    def __init__(self, schema: dict[str, Any]):
        _only(schema, TOP, "the schema")
        if schema.get("type") != "object":
            raise ValueError("a message is an object")
        self.required, self.properties = list(schema.get("required", [])), schema.get("properties", {})
        self.closed = schema.get("additionalProperties", True) is False
        for name, rule in self.properties.items():
            _only(rule, PROPERTY, name)
            if rule.get("additionalProperties", True) is not True:
                raise ValueError(f"keywords not compiled in {name}: additionalProperties")
            if "items" in rule:
                _only(rule["items"], ITEM, f"the items of {name}")

    def typed(self, df: DataFrame, message: str) -> DataFrame:
        """`df` with the message's values, their types, and the strings among them, each computed once."""
        parsed = F.try_variant_get(F.try_parse_json(F.col(message)), "$", "map<string,variant>")
        df = df.withColumn(FIELDS, parsed)
        names = dict(enumerate([*self.properties, *[r for r in self.required if r not in self.properties]]))
        self.at = {name: i for i, name in names.items()}
        df = df.withColumns({f"_value{i}": F.col(FIELDS)[name] for i, name in names.items()})
        df = df.withColumns({f"_kind{i}": F.schema_of_variant(F.col(f"_value{i}")) for i in names})
        texts = {f"_text{i}": F.when(F.col(f"_kind{i}") == "STRING", F.try_variant_get(F.col(f"_value{i}"), "$", "string")) for i in names}
        items = {
            f"_items{i}": F.when(F.col(f"_kind{i}").rlike("^ARRAY<(STRING|VOID)>$"), F.try_variant_get(F.col(f"_value{i}"), "$", "array<string>"))
            for i, name in names.items() if "items" in self.properties.get(name, {})
        }
        return df.withColumns(texts | items)

    def _rules(self, name: str) -> list[tuple[str, Column]]:
        """(name, broken) of one property's rules; a value of the wrong type breaks the most specific one."""
        schema, i = self.properties[name], self.at[name]
        there, kind, text = F.col(f"_value{i}").isNotNull(), F.col(f"_kind{i}"), F.col(f"_text{i}")
        of_type = kind.rlike(f"^({'|'.join(KINDS[t] for t in _types(schema, name))})$")
        rules = _text_rules(schema, text, name)
        if not rules:
            good, more = of_type, []
            if "items" in schema:
                item, items = schema["items"], F.col(f"_items{i}")
                if _types(item, name) != ["string"]:
                    raise ValueError(f"only strings are compiled in the items of {name}")
                good = items.isNotNull()
                short = F.exists(items, lambda x: F.coalesce(F.length(x), F.lit(0)) < item.get("minLength", 0))
                if "minLength" in item:
                    more.append((f"empty:{name}", short))
                else:
                    good = good & ~F.exists(items, lambda x: x.isNull())
                more += [(f"{label}:{name}", F.exists(items, _breaks(item, label, name))) for label, _ in _text_rules(item, text, name) if label != "short"]
            return [(f"type:{name}", there & ~F.coalesce(good, F.lit(False))), *[(n, F.coalesce(b, F.lit(False))) for n, b in more]]
        first = rules[0]
        broken = [(f"{first[0]}:{name}", there & ~F.coalesce(of_type & first[1], F.lit(False)))]
        return broken + [(f"{n}:{name}", F.coalesce(~holds, F.lit(False))) for n, holds in rules[1:]]

    def errors(self) -> Column:
        """Array of the rules that a message breaks, over the columns of `typed`; empty for a valid one."""
        rules = [(f"missing:{k}", F.col(f"_value{self.at[k]}").isNull()) for k in self.required]
        for name in self.properties:
            rules += self._rules(name)
        if self.closed:
            known = F.array(*[F.lit(k) for k in self.properties]).cast("array<string>")
            rules.append(("extra", F.size(F.array_except(F.map_keys(FIELDS), known)) > 0))
        found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
        return F.when(F.col(FIELDS).isNull(), F.array(F.lit(NOT_AN_OBJECT))).otherwise(found)


def validate(messages: DataFrame, schema: dict[str, Any], column: str = "message") -> DataFrame:
    """Adds `errors` and `valid` to messages in JSON text."""
    rules = Compiled(schema)
    checked = rules.typed(messages, column).withColumn("errors", rules.errors())
    return checked.select(*messages.columns, "errors").withColumn("valid", F.size("errors") == 0)

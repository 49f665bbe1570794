"""A JSON schema compiled to one Column: the issues of a stored record, worked out in tasks.

``issues(value, schema)`` takes a VARIANT (``F.try_parse_json`` of a text) and gives an array of (path, message), with the messages
and in the order of ``rules.schema_issues``, which does the same for one Python object on the driver. The subset is const, enum, type,
required, additionalProperties, properties, items, minLength, maxLength, pattern and minimum. The schema is walked once, when the
plan is made; records of any number are checked by built-in functions.

Numbers are as JSON spells them: ``5`` is an integer, ``5.0`` is not; beyond 18 digits a number without a fraction is an integer. A
text that is no JSON is a missing value, told as one issue. Patterns are Java's, and match whole strings.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUES = "array<struct<path:string,message:string>>"
WHOLE = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\((19|[23]\d),0\))$"
NUMBER = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"
KINDS = {"object": r"^OBJECT<", "array": r"^ARRAY<", "string": r"^STRING$", "boolean": r"^BOOLEAN$", "null": r"^VOID$", "integer": WHOLE, "number": NUMBER}


def _none() -> Column:
    return F.array().cast(ISSUES)


def _issue(test: Column, path: Column, message: str) -> Column:
    """One issue where ``test`` holds, else none."""
    return F.when(test, F.array(F.struct(path.alias("path"), F.lit(message).alias("message")))).otherwise(_none())


def _all(parts: list[Column]) -> Column:
    return F.flatten(F.array(*parts)) if parts else _none()


def _equals(v: Column, shape: Column, want: object, strict: bool) -> Column:
    """``strict``: of the same kind too, as const wants it; else numbers, true and false are equal by value, as enum wants it."""
    if want is None:
        return F.is_variant_null(v)
    if isinstance(want, str):
        return (shape == "STRING") & (F.try_variant_get(v, "$", "string") == want)
    if isinstance(want, bool | int | float):
        kind = KINDS["boolean"] if isinstance(want, bool) else WHOLE if isinstance(want, int) else NUMBER
        exact = "decimal(38,9)" if isinstance(want, int) else "double"
        number = F.when(shape == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast(exact)).otherwise(F.try_variant_get(v, "$", exact))
        own = shape.rlike(kind) & ~(shape.rlike(WHOLE) if isinstance(want, float) else F.lit(False)) if strict else shape.rlike(f"{NUMBER}|^BOOLEAN$")
        return own & (number == F.lit(int(want) if isinstance(want, int) else want).cast(exact))
    return F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(want))))


def issues(v: Column, schema: dict, path: Column | None = None) -> Column:
    """The issues of ``v``, a VARIANT, against ``schema``."""
    path = F.lit("$") if path is None else path
    shape = F.schema_of_variant(v)
    known = lambda test: F.coalesce(test, F.lit(False))
    first = []
    if "const" in schema:
        first.append(_issue(~known(_equals(v, shape, schema["const"], strict=True)), path, f"must be {schema['const']!r}"))
    if "enum" in schema:
        within = reduce(lambda a, b: a | b, [known(_equals(v, shape, x, strict=False)) for x in schema["enum"]], F.lit(False))
        first.append(_issue(~within, path, f"must be one of {schema['enum']!r}"))
    rest = [*_of_object(v, shape, schema, path), *_of_array(v, shape, schema, path), *_of_string(v, shape, schema, path)]
    if "minimum" in schema:
        rest.append(_issue(known(shape.rlike(WHOLE) & (F.try_variant_get(v, "$", "decimal(38,9)") < F.lit(schema["minimum"]).cast("decimal(38,9)"))), path, f"must be {schema['minimum']} or more"))
    found = _all(rest)
    if "type" in schema:
        allowed = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        fits = known(shape.rlike("|".join(KINDS[k] for k in allowed)))
        found = F.when(fits, found).otherwise(_issue(~fits, path, f"must be of type {' or '.join(allowed)}"))  # a value of another type has no other rules
    return _all([*first, found])


def _of_object(v: Column, shape: Column, schema: dict, path: Column) -> list[Column]:
    properties, required = schema.get("properties", {}), schema.get("required", ())
    if not properties and not required and schema.get("additionalProperties") is not False:
        return []
    is_object = F.coalesce(shape.rlike(KINDS["object"]), F.lit(False))
    keys = F.when(is_object, F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))
    at = lambda name: F.concat(path, F.lit(f".{name}"))
    out = [_issue(is_object & ~F.array_contains(keys, k), at(k), "is required") for k in required]
    if schema.get("additionalProperties") is False:
        other = F.array_sort(F.filter(keys, lambda k: ~k.isin(*properties) if properties else F.lit(True)))
        out.append(F.coalesce(F.transform(other, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.lit("is not allowed").alias("message"))), _none()))
    for name, sub in properties.items():
        member = F.try_variant_get(v, f"$['{name}']", "variant")
        out.append(F.when(is_object & F.array_contains(keys, name), issues(member, sub, at(name))).otherwise(_none()))
    return out


def _of_array(v: Column, shape: Column, schema: dict, path: Column) -> list[Column]:
    if not schema.get("items"):
        return []
    items = F.when(shape.rlike(KINDS["array"]), F.try_variant_get(v, "$", "array<variant>"))
    each = F.transform(items, lambda x, i: issues(x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
    return [F.coalesce(F.flatten(each), _none())]


def _of_string(v: Column, shape: Column, schema: dict, path: Column) -> list[Column]:
    if not {"minLength", "maxLength", "pattern"} & set(schema):
        return []
    text, out = F.when(shape == "STRING", F.try_variant_get(v, "$", "string")), []
    told = lambda test, message: out.append(_issue(F.coalesce(test, F.lit(False)), path, message))
    if "minLength" in schema:
        told(F.char_length(text) < schema["minLength"], f"must have {schema['minLength']} characters or more")
    if "maxLength" in schema:
        told(F.char_length(text) > schema["maxLength"], f"must have {schema['maxLength']} characters or fewer")
    if "pattern" in schema:
        told(~text.rlike(rf"\A(?:{schema['pattern']})\z"), f"must match {schema['pattern']}")
    return out


def record_issues(records: DataFrame, schema: dict, json_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, ``path``, ``message``: a row for each issue of the JSON texts in ``json_col``."""
    v = F.try_parse_json(json_col)
    found = F.when(v.isNull(), F.array(F.struct(F.lit("$").alias("path"), F.lit("is not valid JSON").alias("message")))).otherwise(issues(v, schema))
    return records.select(*keep, F.inline(found))

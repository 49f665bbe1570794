"""JSON with one spelling for each value, built in SQL from a column's schema, and typed comparison of stored JSON.

``canonical_json`` sorts the keys of structs and maps at every depth (by code point), tells nulls, writes no blanks and
escapes only quotes, backslashes and control characters: what ``json.dumps(sort_keys=True, separators=(",", ":"),
ensure_ascii=False)`` writes. Floating-point numbers have Spark's digits in that layout (``1e-07``, ``1e+16``, ``5.0``).
Decimals are plain numbers; dates, times and binary (base 64) are strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DecimalType, FractionalType, IntegralType, MapType, NullType, StringType, StructType, VariantType

#: Escapes with a letter of their own; other control characters are spelled by number.
SHORT = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def json_string(c: Column) -> Column:
    out = c
    for raw, spelled in SHORT.items():
        out = F.replace(out, F.lit(raw), F.lit(spelled))
    rare = out
    for code in range(0x20):
        if chr(code) not in SHORT:
            rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    plain = F.when(c.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), rare).when(c.rlike(r'[\\"\x08-\x0d]'), out).otherwise(c)
    return F.concat(F.lit('"'), plain, F.lit('"'))


def json_float(c: Column) -> Column:
    """Digits of a double, laid out with an exponent only below 1e-4 and from 1e16 on."""
    text = F.lower(F.abs(c).cast("double").cast("string"))
    mantissa, exponent = F.split_part(text, F.lit("e"), F.lit(1)), F.coalesce(F.nullif(F.split_part(text, F.lit("e"), F.lit(2)), F.lit("")).cast("int"), F.lit(0))
    whole = F.split_part(mantissa, F.lit("."), F.lit(1))
    every = F.concat(whole, F.split_part(mantissa, F.lit("."), F.lit(2)))
    lead = F.length(every) - F.length(F.ltrim(every, F.lit("0")))
    digits = F.rtrim(F.ltrim(every, F.lit("0")), F.lit("0"))
    n, point = F.length(digits), F.length(whole) + exponent - lead  # the value is 0.digits times ten to the point
    moved = (
        F.when(digits == "", "0.0").when((point <= -4) | (point > 16), F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""), F.format_string("e%s%02d", F.when(point > 0, "+").otherwise("-"), F.abs(point - 1))))
        .when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0"))).otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
    )
    negative = F.startswith(c.cast("double").cast("string"), F.lit("-"))
    return F.when(F.isnan(c), "NaN").when(F.abs(c) == float("inf"), F.when(c > 0, "Infinity").otherwise("-Infinity")).otherwise(F.concat(F.when(negative, "-").otherwise(""), moved))


def canonical_json(c: Column, kind: DataType) -> Column:
    """``c`` of type ``kind`` as canonical JSON text; a null is ``null``."""
    null = F.lit("null")
    if isinstance(kind, StructType):
        members = [F.concat(json_string(F.lit(f.name)), F.lit(":"), canonical_json(c[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNull(), null).otherwise(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")))
    if isinstance(kind, ArrayType):
        return F.when(c.isNull(), null).otherwise(F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]")))
    if isinstance(kind, MapType):
        if not isinstance(kind.keyType, StringType):
            raise TypeError(f"keys of JSON are strings, not {kind.keyType.simpleString()}")
        pairs = F.transform(F.array_sort(F.map_keys(c)), lambda k: F.concat(json_string(k), F.lit(":"), canonical_json(F.element_at(c, k), kind.valueType)))
        return F.when(c.isNull(), null).otherwise(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
    if isinstance(kind, NullType):
        return null
    if isinstance(kind, BooleanType | IntegralType | DecimalType):
        text = c.cast("string")
    elif isinstance(kind, FractionalType):
        text = json_float(c)
    elif isinstance(kind, VariantType):
        raise TypeError("a VARIANT has no schema to sort keys by; give it one first")
    else:
        text = json_string(F.base64(c) if isinstance(kind, BinaryType) else c.cast("string"))
    return F.coalesce(text, null)


def stored_field(record: Column, name: str) -> Column:
    """A field of a stored JSON record as VARIANT, its type kept: the top level wherever it has the key, even as null, else
    ``attributes``. ``record`` is a VARIANT (``F.try_parse_json`` of the text)."""
    return F.coalesce(F.try_variant_get(record, f"$.{name}", "variant"), F.try_variant_get(record, f"$.attributes.{name}", "variant"))


def same_typed(stored: Column, wanted: Column, kind: DataType) -> Column:
    """Whether a stored VARIANT is the wanted value by type and value: ``5`` is not ``"5"``. Numbers compare by value, with true as 1
    and false as 0; a missing value, a JSON null and a null are the same."""
    absent = stored.isNull() | F.is_variant_null(stored)
    shape = F.schema_of_variant(stored)
    if isinstance(kind, StringType):
        same = (shape == "STRING") & (F.try_variant_get(stored, "$", "string") == wanted)
    elif isinstance(kind, BooleanType | IntegralType | FractionalType | DecimalType):
        exact = "decimal(38,9)" if isinstance(kind, IntegralType | DecimalType | BooleanType) else "double"
        number = F.when(shape == "BOOLEAN", F.try_variant_get(stored, "$", "boolean").cast("int").cast(exact)).when(shape.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), F.try_variant_get(stored, "$", exact))
        same = number == (wanted.cast("int").cast(exact) if isinstance(kind, BooleanType) else wanted.cast(exact))
    else:
        raise TypeError(f"stored JSON is compared with plain values, not with {kind.simpleString()}")
    return F.when(absent | wanted.isNull(), absent & wanted.isNull()).otherwise(F.coalesce(same, F.lit(False)))


def stored_relation(record: Column, name: str) -> Column:
    """A relation's document id from a stored VARIANT: a plain string, an object with documentId, or one under ``data``."""
    v = stored_field(record, name)
    return F.coalesce(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")), *[F.try_variant_get(v, p, "string") for p in ("$.documentId", "$.data.documentId", "$.data.attributes.documentId")])

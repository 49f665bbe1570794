"""Validation of tabular sources: rules give issue rows (severity, row_number, column, message)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import remove_whitespace, strip
from ..schemas import CATEGORY_HEADER, GLOSSARY_HEADER, SUBJECT_HEADER

#: A rule gives a message or null for the stripped values of a row.
Rule = tuple[str, Callable[[Column], Column]]


def _value(column: str) -> Column:
    return F.coalesce(strip(F.col(f"`{column}`")), F.lit(""))


def when_given(test: Callable[[Column], Column], message: str) -> Callable[[Column], Column]:
    """``message`` where a value is there and fails ``test``."""
    return lambda v: F.when((v != "") & ~test(v), F.lit(message))


def matches(pattern: str) -> Callable[[Column], Column]:
    return lambda v: v.rlike(rf"\A(?:{pattern})\z")


#: What int() reads: a sign, digits, single underscores between them.
INTEGER = r"[+-]?[0-9]+(?:_[0-9]+)*"

# fixed values: what the sources' codes, states and dates look like, and the messages that tell so
required: Callable[[Column], Column] = lambda v: F.when(v == "", F.lit("Required value is missing."))
is_boolean = when_given(lambda v: F.lower(v).isin("true", "false"), "Expected boolean value true or false.")
is_integer = when_given(matches(INTEGER), "Expected an integer value.")
is_optional_integer = when_given(matches(INTEGER), "Expected an integer value when present.")
is_date = when_given(matches("[0-9]{4}-[0-9]{2}-[0-9]{2}"), "Expected date format YYYY-MM-DD when present.")
is_status = when_given(lambda v: v.isin("draft", "published"), "Expected desired_status to be draft or published.")
is_category = when_given(matches("CAT[0-9]{3}"), "Expected format CATnnn, for example CAT001.")
is_subject = when_given(matches("SUB[0-9]{3}"), "Expected format SUBnnn, for example SUB001.")
is_term = when_given(matches("T[0-9]{5}"), "Expected format Tnnnnn, for example T00001.")


def term_in_range(v: Column) -> Column:
    number = F.when(matches("T[0-9]{5}")(v), F.substring(v, 2, 5).cast("int"))
    return F.when(~number.between(1, 50000), F.lit("Term Code must be in range T00001 through T50000."))


# end of fixed values


def one_of(values: list[str], message: str) -> Callable[[Column], Column]:
    """A value of a list, as a sheet's drop-down has it."""
    return when_given(lambda v: v.isin(values), message)


def stripped(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` without white space at their ends, as a sheet leaves them after an edit; nulls stay."""
    return rows.withColumns({c: strip(F.col(f"`{c}`")) for c in columns})


def shared_values(rows: DataFrame, column: str) -> DataFrame:
    """Adds ``is_shared``: whether another row has the same value, not blank (what a sheet marks as a duplicate)."""
    v = _value(column)
    again = rows.select(v.alias("_v")).where("_v <> ''").groupBy("_v").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_v")
    return rows.join(again, v == F.col("_v"), "left").withColumn("is_shared", F.col("_v").isNotNull()).drop("_v")


# fixed value: the message of at_most
def at_most(n: int) -> Callable[[Column], Column]:
    return lambda v: F.when(F.char_length(v) > n, F.lit(f"Value must be {n} characters or fewer."))


@dataclass(frozen=True)
class RuleSet:
    header: tuple[str, ...]
    rules: tuple[Rule, ...]
    unique: tuple[str, ...] = ()
    unique_without_spaces: str | None = None
    no_edge_space: tuple[str, ...] = ()
    extra: tuple = field(default=())


_LENGTHS = tuple((c, at_most(255)) for c in ("legacy_code", "name_en", "name_hi-IN"))
GLOSSARY = RuleSet(GLOSSARY_HEADER, (*((c, required) for c in GLOSSARY_HEADER), ("Term Code", is_term), ("Term Code", term_in_range)), unique_without_spaces="Term", no_edge_space=("Term",))
CATEGORY = RuleSet(
    CATEGORY_HEADER,
    (*((c, required) for c in ("code", "is_active", "sort_order", "desired_status", "name_en", "name_hi-IN")), ("code", is_category), ("is_active", is_boolean), ("sort_order", is_integer), ("desired_status", is_status), *_LENGTHS),
    unique=("code", "legacy_code", "sort_order"),
)
SUBJECT = RuleSet(
    SUBJECT_HEADER,
    (
        *((c, required) for c in ("code", "is_active", "sort_order", "category_code", "desired_status", "name_en", "name_hi-IN")),
        ("code", is_subject), ("category_code", is_category), ("is_active", is_boolean), ("sort_order", is_integer), ("desired_status", is_status),
        *_LENGTHS, ("from_date", is_date), ("to_date", is_date), ("prabodhan_count", is_optional_integer),
    ),
    unique=("code", "legacy_code", "sort_order"),
)

# fixed values: the rules of the editing sheet that the file check does not enforce, and their messages
SHEET_RULES: tuple[tuple[str, Callable[[], Column]], ...] = (
    ("from_date", lambda: F.when(_value("from_date") == "", F.lit("Required value is missing."))),
    ("to_date", lambda: F.when(_value("to_date") == "", F.lit("Required value is missing."))),
    ("to_date", lambda: F.when((_value("from_date") != "") & (_value("to_date") != "") & (_value("to_date") < _value("from_date")), F.lit("to_date must be on or after from_date."))),
    ("prabodhan_count", lambda: F.when((_value("prabodhan_count") != "") & ~F.coalesce(F.try_to_number(_value("prabodhan_count"), F.lit("999999999")).between(1, 999), F.lit(False)), F.lit("Expected a count from 1 to 999."))),
)


def _issues(rows: DataFrame, found: list[Column]) -> DataFrame:
    listed = F.filter(F.array(*found), lambda x: x["message"].isNotNull())
    return rows.select("row_number", F.explode(listed).alias("_i")).select(F.lit("error").alias("severity"), "row_number", F.col("_i.column").alias("column"), F.col("_i.message").alias("message"))


def _issue(column: str, message: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), message.alias("message"))


def row_issues(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """``rows``: row_number and the columns of the header. Rules look at stripped values."""
    edge = [_issue(c, F.when(F.col(f"`{c}`") != strip(F.col(f"`{c}`")), F.concat(F.lit(f"{c} has leading or trailing whitespace. Cell value: '"), F.col(f"`{c}`"), F.lit("'.")))) for c in rules.no_edge_space]
    return _issues(rows, edge + [_issue(c, rule(_value(c))) for c, rule in rules.rules])


def sheet_issues(rows: DataFrame) -> DataFrame:
    return _issues(rows, [_issue(c, rule()) for c, rule in SHEET_RULES])


# fixed values: the messages of duplicate_issues
def duplicate_issues(rows: DataFrame, column: str, spaceless: bool = False) -> DataFrame:
    """One issue for each row that shares its value of ``column``, telling all such rows. Values are counted with
    partial sums first, so only those that repeat are gathered."""
    v = _value(column)
    keyed = rows.select("row_number", v.alias("_v"), (remove_whitespace(v) if spaceless else v).alias("_k")).where(v != "")
    again = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k")
    shared = keyed.join(again, "_k", "left_semi")
    lists = shared.groupBy("_k").agg(F.array_join(F.transform(F.array_sort(F.collect_list("row_number")), lambda r: r.cast("string")), ", ").alias("_rows"))
    if spaceless:
        message = F.concat(F.lit(f"Duplicate {column.lower()} within source after removing whitespace; normalized value '"), F.col("_k"), F.lit("' appears on rows: "), F.col("_rows"), F.lit(". Row value: '"), F.col("_v"), F.lit("'."))
    else:
        message = F.concat(F.lit(f"Duplicate non-empty {column} value '"), F.col("_v"), F.lit("'; appears on rows: "), F.col("_rows"), F.lit("."))
    return shared.join(lists, "_k").select(F.lit("error").alias("severity"), "row_number", F.lit(column).alias("column"), message.alias("message"))


# fixed values: the messages of reference_issues
def reference_issues(rows: DataFrame, column: str, known: DataFrame, known_col: str) -> DataFrame:
    """Values of ``column`` that no row of ``known`` has."""
    v = rows.select("row_number", _value(column).alias("_v")).where(F.col("_v") != "")
    have = known.select(_value(known_col).alias("_v")).where(F.col("_v") != "").distinct()
    missing = v.join(have, "_v", "left_anti")
    return missing.select(F.lit("error").alias("severity"), "row_number", F.lit(column).alias("column"), F.concat(F.lit(f"Unresolved {column}; no matching category code found: "), F.col("_v"), F.lit(".")).alias("message"))


# fixed value: the message of a source whose references cannot be looked up
GATE_MESSAGE = "Category source validation failed; cannot validate subject references."
# end of fixed value


def gated_reference_issues(rows: DataFrame, column: str, known: DataFrame, known_col: str, known_issues: DataFrame) -> DataFrame:
    """``reference_issues``, unless the source of what is known has errors itself (``known_issues``, as ``validate`` gives them): then one
    issue of row 0 instead."""
    spark = rows.sparkSession
    broken = lambda: known_issues.where("severity = 'error'").agg(F.count(F.lit(1)) > 0).scalar()
    one = spark.range(1).where(broken()).select(F.lit("error").alias("severity"), F.lit(0).cast(rows.schema["row_number"].dataType).alias("row_number"), F.lit(column).alias("column"), F.lit(GATE_MESSAGE).alias("message"))
    return reference_issues(rows, column, known, known_col).where(~broken()).unionByName(one)


# fixed values: the messages of shape_issues
def shape_issues(records: DataFrame, width: int) -> DataFrame:
    """``records``: row_number and ``values`` (array). Blank rows, and rows of another width, have one issue each."""
    blank = F.forall("values", lambda v: F.coalesce(strip(v), F.lit("")) == "")
    message = F.when(blank, F.lit("Blank rows are not allowed.")).when(F.size("values") != width, F.concat(F.lit(f"Expected {width} columns, found "), F.size("values").cast("string"), F.lit(".")))
    return records.select(F.lit("error").alias("severity"), "row_number", F.lit("Row").alias("column"), message.alias("message")).where(F.col("message").isNotNull())


def well_formed(records: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """Rows that have the header's width and are not blank, as columns."""
    blank = F.forall("values", lambda v: F.coalesce(strip(v), F.lit("")) == "")
    return records.where(~blank & (F.size("values") == len(header))).select("row_number", *[F.get("values", F.lit(i)).alias(c) for i, c in enumerate(header)])


def validate(records: DataFrame, rules: RuleSet, references: tuple[str, DataFrame, str] | None = None, reference_source_issues: DataFrame | None = None) -> DataFrame:
    """All issues of a source, to be shown in the order of row and column. ``references``: (column, what is known, its column);
    ``reference_source_issues``: the issues of what is known itself, where that was validated too."""
    rows = well_formed(records, rules.header)
    found = shape_issues(records, len(rules.header)).unionByName(row_issues(rows, rules))
    for c in rules.unique:
        found = found.unionByName(duplicate_issues(rows, c))
    if rules.unique_without_spaces:
        found = found.unionByName(duplicate_issues(rows, rules.unique_without_spaces, spaceless=True))
    if references:
        column, known, known_col = references
        checked = reference_issues(rows, column, known, known_col) if reference_source_issues is None else gated_reference_issues(rows, column, known, known_col, reference_source_issues)
        found = found.unionByName(checked)
    return found


def ordered(issues: DataFrame) -> DataFrame:
    return issues.orderBy("row_number", "column", "message")


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(F.count(F.lit(1)).alias("issues"))


def header_issue(found: list[str] | None, header: tuple[str, ...]) -> str | None:
    """Message for a missing, empty or other header; the check of a file stops there."""
    if found is None:
        return "Source file is missing."
    if not found:
        return "Source file is empty."
    return None if tuple(found) == header else f"Expected header {', '.join(header)}; found {', '.join(found)}."


def add_missing_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Append only the columns that are not there."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def schema_issues(value: object, schema: dict, path: str = "$") -> list[tuple[str, str]]:
    """Driver-side check of an envelope against the subset const, enum, type, required, additionalProperties, properties,
    items, minLength, maxLength, pattern and minimum: (path, message)."""
    import re

    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}

    def is_kind(v: object, k: str) -> bool:
        if k in ("integer", "number"):
            return isinstance(v, int | float if k == "number" else int) and not isinstance(v, bool)
        return isinstance(v, kinds[k])

    out = []
    if "const" in schema and (value != schema["const"] or type(value) is not type(schema["const"])):
        out.append((path, f"must be {schema['const']!r}"))
    if "enum" in schema and value not in schema["enum"]:
        out.append((path, f"must be one of {schema['enum']!r}"))
    if "type" in schema:
        allowed = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if not any(is_kind(value, k) for k in allowed):
            return [*out, (path, f"must be of type {' or '.join(allowed)}")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [(f"{path}.{k}", "is required") for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [(f"{path}.{k}", "is not allowed") for k in sorted(set(value) - set(known))]
        for k, sub in known.items():
            if k in value:
                out += schema_issues(value[k], sub, f"{path}.{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            out += schema_issues(v, schema.get("items", {}), f"{path}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append((path, f"must have {schema['minLength']} characters or more"))
        if len(value) > schema.get("maxLength", len(value)):
            out.append((path, f"must have {schema['maxLength']} characters or fewer"))
        if "pattern" in schema and not re.fullmatch(schema["pattern"], value):
            out.append((path, f"must match {schema['pattern']}"))
    elif isinstance(value, int) and not isinstance(value, bool) and value < schema.get("minimum", value):
        out.append((path, f"must be {schema['minimum']} or more"))
    return out

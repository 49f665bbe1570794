import pytest

from corpusprep.operators import records, rules
from corpusprep.schemas import CATEGORY_HEADER, GLOSSARY_HEADER, SUBJECT_HEADER
from corpusprep.sources import files


def source(spark, tmp_path, header, rows, name="s.csv"):
    text = "﻿" + ",".join(header) + "\r\n" + "\r\n".join(",".join(r) for r in rows) + "\r\n"
    (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    return files.split_header(files.csv_records(spark, str(tmp_path / name)))


def found(issues):
    return [(r.row_number, r.column, r.message) for r in rules.ordered(issues).collect()]


def test_glossary(spark, tmp_path):
    rows = [["1", "T00001", "राम", "x"], ["2", "T60000", " edge ", "x"], ["3", "X1", "रा म", "x"], ["", " ", "", ""], ["5", "T00002", "y"], ["6", "", "q", "x"]]
    header, records_ = source(spark, tmp_path, GLOSSARY_HEADER, rows)
    assert rules.header_issue(header, GLOSSARY_HEADER) is None
    got = found(rules.validate(records_, rules.GLOSSARY))
    assert (3, "Term Code", "Term Code must be in range T00001 through T50000.") in got
    assert (3, "Term", "Term has leading or trailing whitespace. Cell value: ' edge '.") in got
    assert (4, "Term Code", "Expected format Tnnnnn, for example T00001.") in got
    assert (5, "Row", "Blank rows are not allowed.") in got and (6, "Row", "Expected 4 columns, found 3.") in got
    assert (7, "Term Code", "Required value is missing.") in got
    assert [x[0] for x in got if x[2].startswith("Duplicate term")] == [2, 4]
    assert len(got) == 8


def test_category_and_references(spark, tmp_path):
    good = ["CAT001", "L1", "TRUE", "1", "draft", "n", "", "ना", ""]
    bad = ["CAT1", "L1", "yes", "1_0", "Draft", "n" * 256, "", "", ""]
    _, rows = source(spark, tmp_path, CATEGORY_HEADER, [good, bad])
    got = found(rules.validate(rows, rules.CATEGORY))
    assert {(c, m.split(";")[0]) for _, c, m in got} == {
        ("code", "Expected format CATnnn, for example CAT001."), ("is_active", "Expected boolean value true or false."), ("desired_status", "Expected desired_status to be draft or published."),
        ("name_en", "Value must be 255 characters or fewer."), ("name_hi-IN", "Required value is missing."), ("legacy_code", "Duplicate non-empty legacy_code value 'L1'"),
    }
    subject = ["SUB001", "", "true", "3", "CAT009", "draft", "n", "", "ना", "", "2006-99-99", "06-1-1", "x"]
    _, s = source(spark, tmp_path, SUBJECT_HEADER, [subject], "t.csv")
    known = rules.well_formed(rows, CATEGORY_HEADER)
    got = found(rules.validate(s, rules.SUBJECT, ("category_code", known, "code")))
    assert got == [
        (2, "category_code", "Unresolved category_code; no matching category code found: CAT009."), (2, "prabodhan_count", "Expected an integer value when present."), (2, "to_date", "Expected date format YYYY-MM-DD when present."),
    ]
    with pytest.raises(ValueError, match="Unresolved"):
        records.require_valid(rules.validate(s, rules.SUBJECT, ("category_code", known, "code")))
    r = records.category_records(known.where("row_number = 2")).first()
    assert (r.category_code, r.is_active, r.sort_order, r.description_en) == ("CAT001", True, 1, None)


def test_quoted_newlines_count_as_one_record(spark, tmp_path):
    _, rows = source(spark, tmp_path, GLOSSARY_HEADER, [["1", "T00001", '"a\nb"', "x"], ["2", "T00001", "c", '"say ""hi"""']])
    assert [(r.row_number, r["values"][2]) for r in rows.orderBy("row_number").collect()] == [(2, "a\nb"), (3, "c")]


def test_empty_table(spark, tmp_path):
    _, rows = source(spark, tmp_path, GLOSSARY_HEADER, [])
    assert found(rules.validate(rows.where("size(values) > 0"), rules.GLOSSARY)) == []


def test_header_messages():
    assert rules.header_issue(None, GLOSSARY_HEADER) and rules.header_issue([], GLOSSARY_HEADER) and rules.header_issue(["Term"], GLOSSARY_HEADER)


def test_sheet_rules(spark):
    df = spark.createDataFrame([(2, "2006-02-01", "2006-01-01", "0"), (3, "", "2006-01-01", "50")], "row_number long, from_date string, to_date string, prabodhan_count string")
    assert found(rules.sheet_issues(df)) == [(2, "prabodhan_count", "Expected a count from 1 to 999."), (2, "to_date", "to_date must be on or after from_date."), (3, "from_date", "Required value is missing.")]
    assert rules.add_missing_columns(df, {"extra": 50, "to_date": "x"}).columns[-1] == "extra"


def test_schema_subset():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"], "pattern": "x+", "maxLength": 2}, "c": {"type": "array", "items": {"enum": [1]}}}}
    assert rules.schema_issues({"a": 1, "b": "xx", "c": [1]}, schema) == []
    assert [p for p, _ in rules.schema_issues({"a": -1, "b": "xxx", "c": [2], "d": 0}, schema)] == ["$.d", "$.a", "$.b", "$.c[0]"]
    assert [p for p, _ in rules.schema_issues({"a": True, "b": None}, schema)] == ["$.a"]


def test_lists_and_sheet_marks(spark):
    df = spark.createDataFrame([(2, " a ", "x"), (3, "b", None), (4, "a", ""), (5, "c", "x")], "row_number int, k string, v string")
    made = rules.RuleSet(("k", "v"), (("k", rules.one_of(["a", "b"], "Expected a or b.")),))
    assert [(r.row_number, r.message) for r in rules.row_issues(df, made).collect()] == [(5, "Expected a or b.")]
    assert [r.k for r in rules.stripped(df, ["k", "v"]).orderBy("row_number").collect()] == ["a", "b", "a", "c"]
    assert {r.row_number: r.is_shared for r in rules.shared_values(df, "k").collect()} == {2: True, 3: False, 4: True, 5: False}
    assert {r.row_number: r.is_shared for r in rules.shared_values(df, "v").collect()} == {2: True, 3: False, 4: False, 5: True}


def test_an_invalid_source_of_references_is_one_issue(spark):
    rows = spark.createDataFrame([(2, "CAT001"), (3, "CAT009"), (4, "")], "row_number long, category_code string")
    known = spark.createDataFrame([("CAT001",)], "code string")
    none = spark.createDataFrame([], "severity string, row_number long, column string, message string")
    got = lambda issues: [(r.row_number, r.message) for r in rules.gated_reference_issues(rows, "category_code", known, "code", issues).collect()]
    assert got(none) == [(3, "Unresolved category_code; no matching category code found: CAT009.")]
    warning, error = (spark.createDataFrame([(s, 5, "code", "x")], none.schema) for s in ("warning", "error"))
    assert got(warning) == got(none) and got(error) == [(0, "Category source validation failed; cannot validate subject references.")]
    empty = spark.createDataFrame([], "row_number long, values array<string>")
    assert [r.row_number for r in rules.validate(empty, rules.SUBJECT, ("category_code", known, "code"), error).collect()] == [0]

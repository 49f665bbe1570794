"""Plans written to a store and read back; stored JSON compared by type; canonical JSON."""

import hashlib
import json
import math
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import canonical, identity
from corpusprep.operators import reconcile
from corpusprep.operators.reconcile import CATEGORY
from corpusprep.sources import cms

DESIRED = "position long, category_code string, legacy_code string, is_active boolean, sort_order long, name_en string, description_en string, name_hi_IN string, description_hi_IN string"


@pytest.fixture(scope="module")
def store(spark):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "file_store.py"))
    spark.dataSource.register(cms.ContentStore)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return lambda folder, **more: {"transport": "file_store:FileStore", "folder": folder, "collection": "categories", "apply": "true"} | more


def existing(spark, options):
    parts = [spark.read.format("content_store").options(**options, locale=loc).load().withColumn("locale", F.lit(loc)) for loc in ("en", "hi-IN")]
    return reconcile.existing_of(parts[0].unionByName(parts[1]), CATEGORY)


def desired(spark, n=12):
    return spark.createDataFrame([(i, f"C{i}", None, i % 2 == 0, 10 + i, f"n{i}", None, f"h{i}", "d") for i in range(n)], DESIRED)


def stored(folder):
    return sorted((r["attributes"]["code"], r["attributes"]["locale"], r["attributes"]["name"]) for r in map(json.loads, (open(f"{folder}/categories/{f}").read() for f in os.listdir(f"{folder}/categories"))))


WANT = sorted(x for i in range(12) for x in ((f"C{i}", "en", f"n{i}"), (f"C{i}", "hi-IN", f"h{i}")))


def test_plan_actions_and_writer_end_to_end(spark, store, tmp_path):
    options, d = store(str(tmp_path)), desired(spark)
    (tmp_path / "categories").mkdir()
    for i in (3, 4):  # one as desired in its default locale, one with another name and a number spelled as a string
        record = {"documentId": f"old{i}", "attributes": {"locale": "en", "code": f"C{i}", "legacy_code": None, "is_active": i % 2 == 0, "sort_order": 10 + i if i == 3 else "14", "name": "n3" if i == 3 else "n4", "description": None}}
        (tmp_path / "categories" / f"old{i}-en").write_text(json.dumps(record))
    plan = reconcile.plan(d, existing(spark, options), CATEGORY)
    got = {r.code: (r.action, r.update_default, r.create_localized) for r in plan.collect()}
    assert got["C3"] == ("update", False, True) and got["C4"] == ("update", True, True) and got["C0"] == ("create", False, True), "a stored \"14\" is not 14"
    writes = spark.createDataFrame(reconcile.writes(plan, d, CATEGORY).collect(), "code string, step int, verb string, locale string, document_id string, payload string")
    assert {(r.code, r.step, r.verb) for r in writes.where("code in ('C3', 'C4', 'C5')").collect()} == {("C3", 1, "publish"), ("C3", 2, "localize"), ("C4", 1, "update"), ("C4", 2, "localize"), ("C5", 1, "create"), ("C5", 2, "localize")}
    cms.send(writes, options)
    assert stored(tmp_path) == WANT
    names = os.listdir(tmp_path / "categories")
    assert len(names) == 24 and len({n.partition("-en")[0].partition("-hi")[0] for n in names}) == 12, "both locales of a code are one document"
    assert {r.action for r in reconcile.plan(d, existing(spark, options), CATEGORY).collect()} == {"matching"}
    cms.send(writes, options)
    assert stored(tmp_path) == WANT, "sent once more, nothing doubles"


@pytest.mark.parametrize("verb", ["create", "localize"])
def test_a_task_that_dies_is_sent_again(spark, store, tmp_path, verb):
    d = desired(spark)
    options = store(str(tmp_path), fail_on=f"{verb} C5")
    plan = reconcile.plan(d, existing(spark, store(str(tmp_path))), CATEGORY)
    writes = spark.createDataFrame(reconcile.writes(plan, d, CATEGORY).collect(), "code string, step int, verb string, locale string, document_id string, payload string")
    with pytest.raises(Exception, match="the store went away"):
        cms.send(writes, options, parallel=3)
    assert len(stored(tmp_path)) < 24
    cms.send(writes, options, parallel=3)
    assert stored(tmp_path) == WANT


def test_writer_refuses_what_it_cannot_place(tmp_path):
    import sys

    sys.path.insert(0, os.path.dirname(__file__))
    options = {"transport": "file_store:FileStore", "folder": str(tmp_path), "collection": "categories", "apply": "true"}
    row = {"code": "A", "step": 1, "verb": "localize", "locale": "hi-IN", "document_id": None, "payload": "{}"}
    with pytest.raises(ValueError, match="no document"):
        cms._Writer(options).write(iter([row]))
    with pytest.raises(ValueError, match="out of order"):
        cms._Writer(options).write(iter([row | {"step": 2, "document_id": "d"}, row | {"document_id": "d"}]))


# glossaries


def test_glossary_plan(spark):
    records = [
        ({"documentId": "d1", "attributes": {"code": "T1", "term": "a", "definition": "x"}}, 1), ({"documentId": "d1", "attributes": {"code": "T1", "term": "a", "definition": "newer"}}, 2),
        ({"id": 7, "code": "T2", "term": "b", "definition": "x"}, 1), ({"documentId": "d3", "code": "T3", "term": "", "definition": None}, 1),
        ({"documentId": "d4", "code": "T4", "term": "d", "definition": "x"}, 1), ({"documentId": "d5", "code": "T4", "term": "d", "definition": "x"}, 1), ({"documentId": "d6", "code": "T6", "term": 6, "definition": "x"}, 1),
    ]
    have = reconcile.glossary_existing(spark.createDataFrame([(json.dumps(r), k, i) for i, (r, k) in enumerate(records)], "record string, status_rank int, position int"))
    want = [("T1", "a", "newer"), ("T2", "b", "x"), ("T3", "c", "x"), ("T4", "d", "x"), ("T6", "6", "x"), ("T7", "g", "x"), ("T7", "g", "x"), (None, "h", "")]
    d = spark.createDataFrame([(i, *w) for i, w in enumerate(want)], "position int, term_code string, term string, definition string")
    plan = reconcile.glossary_plan(d, have, "Sanatan Glossary")
    got = {r.position: (r.code, r.action, r.document_id, r.messages) for r in plan.collect()}
    assert got == {
        0: ("T1", "matching", "d1", []), 1: ("T2", "conflict", None, ["Existing glossary record is missing documentId."]),
        2: ("T3", "conflict", None, [f"Existing glossary record is missing required Strapi field: {c}." for c in ("term", "definition")]),
        3: ("T4", "conflict", None, ["Duplicate existing Sanatan Glossary records with code T4."]), 4: ("T6", "update", "d6", []), 5: ("T7", "create", None, []),
        6: ("T7", "conflict", None, ["Duplicate artifact term_code: T7."]), 7: ("<missing-code>", "conflict", None, ["Missing required artifact value: term_code.", "Missing required artifact value: definition."]),
    }
    assert {(r.code, r.verb, r.document_id, r.payload) for r in reconcile.glossary_writes(plan, d).collect()} == {("T6", "update", "d6", '{"code":"T6","term":"6","definition":"x"}'), ("T7", "create", None, '{"code":"T7","term":"g","definition":"x"}')}


# stored JSON by type


@pytest.mark.parametrize(("stored_json", "kind", "value", "same"), [
    ("5", "int", 5, True), ('"5"', "int", 5, False), ("5", "string", "5", False), ('"5"', "string", "5", True), ("5.0", "long", 5, True), ("5.5", "double", 5.5, True), ("5.5", "int", 5, False),
    ("true", "boolean", True, True), ("1", "boolean", True, True), ("true", "int", 1, True), ('"true"', "boolean", True, False), ("null", "string", None, True), ("null", "string", "", False), ('""', "string", None, False), ("{}", "string", "{}", False), ("[5]", "int", 5, False),
])
def test_typed_comparison(spark, stored_json, kind, value, same):
    df = spark.createDataFrame([(f'{{"attributes": {{"f": {stored_json}}}}}', value), ('{"f": null, "attributes": {"f": 1}}', value), ("not json", value)], f"r string, w {kind}")
    got = [r[0] for r in df.select(canonical.same_typed(canonical.stored_field(F.try_parse_json("r"), "f"), F.col("w"), df.schema["w"].dataType)).collect()]
    assert got == [same, value is None, value is None]


def test_relations_by_type(spark):
    forms = ['{"r": "d"}', '{"r": {"documentId": "d"}}', '{"attributes": {"r": {"data": {"documentId": "d"}}}}', '{"r": {"data": {"attributes": {"documentId": "d"}}}}', '{"r": 5}', "{}", "x"]
    got = spark.createDataFrame([(f,) for f in forms], "r string").select(canonical.stored_relation(F.try_parse_json("r"), "r")).collect()
    assert [g[0] for g in got] == ["d"] * 4 + [None] * 3


# canonical JSON


def test_canonical_json_is_that_of_the_driver(spark):
    texts = ["", 'q"\\', "é\u0000\u001f\u000b\n\t\r\f\b/\u007f ", "𝔘", None]
    floats = [0.0, -0.0, 1.0, 0.1, 1e-4, 1e-5, 123456789.125, 1e15, 1e16, 1.5e300, 9007199254740993.0, None]
    schema = "z string, a struct<y: int, x: array<struct<q: string, p: double>>>, m map<string, struct<b: boolean, a: bigint>>, Y double, e array<string>"
    rows = []
    for k in range(12):
        t, f = texts[k % 5], floats[k]
        rows.append((t, None if k == 7 else (k, None if k == 8 else [(t, f), None]), {"é": (True, 2**60), "b": None, "B": (None, k)} if k % 3 else {}, f, [t, "x"]))
    df = spark.createDataFrame(rows, schema)

    def plain(v):
        return {k: plain(x) for k, x in v.asDict().items()} if hasattr(v, "asDict") else [plain(x) for x in v] if isinstance(v, list) else {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else v

    record, kind = F.struct(*df.columns), df.schema
    for r in df.select("*", canonical.canonical_json(record, kind).alias("_j"), identity.record_fingerprint(record, kind).alias("_f")).collect():
        value = {k: v for k, v in plain(r).items() if k not in ("_j", "_f")}
        assert r["_j"] == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r["_f"] == identity.config_fingerprint(value)


def test_canonical_json_of_other_kinds(spark):
    df = spark.createDataFrame([(date(2024, 1, 2), Decimal("1.50"), b"ab", math.nan, -math.inf)], "d date, n decimal(5,2), b binary, x double, y double")
    assert df.select(canonical.canonical_json(F.struct(*df.columns), df.schema)).first()[0] == '{"b":"YWI=","d":"2024-01-02","n":1.50,"x":NaN,"y":-Infinity}'
    with pytest.raises(TypeError):
        canonical.canonical_json(F.col("m"), spark.createDataFrame([], "m map<int, int>").schema["m"].dataType)


def test_fingerprint_is_of_sorted_keys(spark):
    df = spark.createDataFrame([("x", None)], "b string, a int")
    assert df.select(identity.record_fingerprint(F.struct("b", "a"), df.schema)).first()[0] == hashlib.sha256(b'{"a":null,"b":"x"}').hexdigest()


def test_locales(spark):
    class Locales:
        def __init__(self, options):
            pass

        def locales(self):
            return [{"code": "en", "name": "English", "isDefault": True}, {"code": "hi-IN", "name": "Hindi"}]

    import sys

    sys.modules["locales_of_test"] = type(sys)("locales_of_test")
    sys.modules["locales_of_test"].Locales = Locales
    known = cms.locales(spark, {"transport": "locales_of_test:Locales"})
    assert sorted(map(tuple, known.collect())) == [("en", "English", True), ("hi-IN", "Hindi", False)]
    cms.require_locales(known, ["en", "hi-IN"])
    with pytest.raises(ValueError, match="mr-IN"):
        cms.require_locales(known, ["en", "mr-IN"])

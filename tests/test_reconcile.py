import json

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import reconcile
from corpusprep.operators.reconcile import CATEGORY, SUBJECT

DESIRED = "position long, category_code string, legacy_code string, is_active boolean, sort_order long, name_en string, description_en string, name_hi_IN string, description_hi_IN string"
EXISTING = "document_id string, locale string, code string, position long, legacy_code string, is_active boolean, sort_order long, name string, description string"


def want(spark, *rows):
    return spark.createDataFrame([(i, c, None, True, so, f"n{c}", None, f"h{c}", None) for i, (c, so) in enumerate(rows)], DESIRED)


def have(spark, *rows):
    return spark.createDataFrame([(d, loc, c, i, None, True, so, name, None) for i, (d, loc, c, so, name) in enumerate(rows)], EXISTING)


def planned(spark, desired, existing):
    return {r.position: r for r in reconcile.plan(want(spark, *desired), have(spark, *existing), CATEGORY).collect()}


def test_actions(spark):
    got = planned(
        spark, [("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5)],
        [("d1", "en", "B", 2, "nB"), ("d1", "hi-IN", "B", 2, "hB"), ("d2", "en", "C", 3, "old"), ("d2", "hi-IN", "C", 3, "hC"), ("d3", "hi-IN", "D", 4, "hD"), ("d4", "en", "E", 5, "nE")],
    )
    assert [got[i].action for i in range(5)] == ["create", "matching", "update", "update", "update"]
    assert got[0].create_localized and got[0].document_id is None
    assert (got[2].update_default, got[2].update_localized, got[2].create_localized) == (True, False, False)
    assert (got[3].document_id, got[3].update_default, got[3].create_localized) == ("d3", True, False)  # a lone localized record lends its id
    assert (got[4].update_default, got[4].create_localized) == (False, True)


def test_conflicts(spark):
    got = planned(
        spark, [("A", 1), ("A", 2), ("B", 2), (None, 7), ("D", 9)],
        [("d1", "en", "D", 9, "x"), ("d2", "en", "D", 9, "y"), (None, "en", "A", 1, "nA"), ("d5", "en", "Z", 7, "z"), ("d5", "hi-IN", "Z", 7, "z")],
    )
    assert got[0].messages == ["Existing Category is missing documentId."]
    assert "Duplicate artifact category_code: A." in got[1].messages
    assert "Duplicate artifact sort_order 2 also used by A." in got[2].messages
    assert got[3].messages.count("Missing required artifact value: category_code.") == 2
    assert "sort_order 7 is already used by existing Category code(s): Z, Z." in got[3].messages
    assert got[4].messages == ["Duplicate existing Category records with code D in default locale."]
    assert {r.action for r in got.values()} == {"conflict"}


def test_blocked_outranks_conflict(spark):
    d = spark.createDataFrame([(0, "S1", None, True, 1, "C1", "n", None, "", None, None, None, None), (1, "S2", None, True, 2, "C2", "n", None, "h", None, None, None, None), (2, "S3", None, True, 3, "C3", "n", None, "h", None, None, None, None)], "position long, subject_code string, legacy_code string, is_active boolean, sort_order long, category_code string, name_en string, description_en string, name_hi_IN string, description_hi_IN string, from_date string, to_date string, prabodhan_count long")
    e = spark.createDataFrame([("s3", loc, "S3", 0, None, True, 3, n, None, None, None, None, p) for loc, n, p in (("en", "n", "c3"), ("hi-IN", "h", "other"))], EXISTING + ", from_date string, to_date string, prabodhan_count long, parent_document_id string")
    parents = spark.createDataFrame([("C2", "c2a"), ("C2", "c2b"), ("C3", "c3"), ("C3", "c3")], "code string, document_id string")
    got = {r.position: r for r in reconcile.plan(d, e, SUBJECT, parents).collect()}
    assert (got[0].action, got[0].messages) == ("blocked", ["Referenced Category code C1 was not found."])
    assert got[1].messages == ["Referenced Category code C2 is ambiguous across documentIds: c2a, c2b."]
    assert (got[2].action, got[2].update_default, got[2].update_localized) == ("update", False, True)


def test_apply_then_replan_is_empty(spark):
    d = want(spark, ("A", 1), ("B", 2))
    e = have(spark, ("d1", "en", "B", 2, "old"), ("d9", "en", "K", 8, "kept"))
    p = reconcile.plan(d, e, CATEGORY)
    assert [(r.code, r.step, r.verb, r.locale) for r in reconcile.actions(p, CATEGORY).orderBy("code", "step").collect()] == [("A", 1, "create", "en"), ("A", 2, "localize", "hi-IN"), ("B", 1, "update", "en"), ("B", 2, "localize", "hi-IN")]
    after = reconcile.apply_plan(d, e, p, CATEGORY)
    assert {r.action for r in reconcile.plan(d, after, CATEGORY).collect()} == {"matching"}
    assert after.where("code = 'K'").count() == 1
    counters = reconcile.plan_counters(p).first()
    assert (counters.create_count, counters.update_count, counters.publish_actions) == (1, 1, 4)


def test_gate(spark):
    p = reconcile.plan(want(spark, ("A", 1), ("A", 2)), have(spark), CATEGORY)
    with pytest.raises(PermissionError):
        reconcile.require_applicable(p, False)
    with pytest.raises(RuntimeError):
        reconcile.require_applicable(p, True)


def test_empty_plan(spark):
    assert reconcile.plan_counters(reconcile.plan(spark.createDataFrame([], DESIRED), have(spark, ("d", "en", "A", 1, "x")), CATEGORY)).first().records == 0


def test_last_fetch_wins(spark):
    df = spark.createDataFrame([("d", None, 1, 0, "draft"), ("d", None, 2, 0, "published"), ("d", None, 2, 1, "later"), ("e", "x", 1, 5, "only")], "id string, code string, status_rank int, pos int, v string")
    assert sorted(r.v for r in reconcile.latest(df, ["id", "code"], "status_rank", "pos").collect()) == ["later", "only"]


def test_fields_and_relations(spark):
    rows = [json.dumps(x) for x in ({"code": None, "attributes": {"code": "x"}}, {"attributes": {"code": "y"}}, {"category": "c1"}, {"category": {"documentId": "c2"}}, {"category": {"data": {"documentId": "c3"}}})]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string")
    got = df.orderBy("i").select(reconcile.field(F.col("r"), "code"), reconcile.relation_id(F.col("r"), "category")).collect()
    assert [g[0] for g in got[:2]] == [None, "y"] and [g[1] for g in got[2:]] == ["c1", "c2", "c3"]

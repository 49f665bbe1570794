"""Reconciliation: desired records against the present state, as a plan, its actions and its check.

A plan is one row per desired record, in any number; nothing is looked up on the driver. Present state is
grouped by code and locale first, with the count that tells ambiguity, so joins are one to one. Field names,
actions and messages are fixed values, as those who read plans know them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, VariantType

from ..functions.canonical import same_typed, stored_field, stored_relation


@dataclass(frozen=True)
class Spec:
    """What is reconciled. ``shared`` and ``localized`` map stored fields to record columns; of ``localized`` there is one for each locale."""

    label: str
    code: str
    shared: dict[str, str]
    default_names: dict[str, str]
    localized_names: dict[str, str]
    required: tuple[str, ...]
    default_locale: str = "en"
    localized_locale: str = "hi-IN"
    parent: str | None = None  # record column that names a parent by code


_COMMON = {"legacy_code": "legacy_code", "is_active": "is_active", "sort_order": "sort_order"}
_NAMES = ({"name": "name_en", "description": "description_en"}, {"name": "name_hi_IN", "description": "description_hi_IN"})
CATEGORY = Spec("Category", "category_code", _COMMON, *_NAMES, ("category_code", "is_active", "sort_order", "name_en", "category_code", "is_active", "sort_order", "name_hi_IN"))
SUBJECT = Spec(
    "Subject", "subject_code", _COMMON | {"from_date": "from_date", "to_date": "to_date", "prabodhan_count": "prabodhan_count"}, *_NAMES,
    ("subject_code", "is_active", "sort_order", "category_code", "name_en", "subject_code", "is_active", "sort_order", "category_code", "name_hi_IN"), parent="category_code",
)


def latest(fetched: DataFrame, keys: list[str], rank: str, position: str) -> DataFrame:
    """Of rows that share ``keys`` the one fetched last wins; keys may be null."""
    w = Window.partitionBy(*keys).orderBy(F.desc(rank), F.desc(position))
    return fetched.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def field(record: Column, name: str) -> Column:
    """A field of a JSON record: the top level wherever it has the key, even as null, else ``attributes``."""
    top = F.array_contains(F.json_object_keys(record), name)
    return F.when(top, F.get_json_object(record, f"$.{name}")).otherwise(F.get_json_object(record, f"$.attributes.{name}"))


def relation_id(record: Column, name: str) -> Column:
    """A relation's document id: a plain string, an object, or an object under ``data``."""
    v = field(record, name)
    inner = F.coalesce(F.get_json_object(v, "$.documentId"), F.get_json_object(v, "$.data.documentId"), F.get_json_object(v, "$.data.attributes.documentId"))
    return F.when(v.startswith("{"), inner).otherwise(v)


def existing_of(records: DataFrame, spec: Spec, parent_field: str = "category") -> DataFrame:
    """``existing`` for ``plan`` from what a store gave: records (document_id, locale, position, record as JSON text). Stored fields are
    VARIANT, so that a plan compares them by type and value. A record of text that is no JSON has no code and no fields."""
    v = F.try_parse_json("record")
    parsed = records.select("document_id", "locale", "position", v.alias("_v"))
    names = sorted({*spec.shared, *spec.default_names})
    parent = [stored_relation(F.col("_v"), parent_field).alias("parent_document_id")] if spec.parent else []
    return parsed.select("document_id", "locale", "position", F.try_variant_get(stored_field(F.col("_v"), "code"), "$", "string").alias("code"), *[stored_field(F.col("_v"), n).alias(n) for n in names], *parent)


def differs_from(stored: Column, stored_kind: DataType, wanted: Column, kind: DataType) -> Column:
    """By type and value where stored values keep their JSON types, else by value; nulls are equal to each other."""
    return ~(same_typed(stored, wanted, kind) if isinstance(stored_kind, VariantType) else stored.eqNullSafe(wanted))


def cardinality(parents: DataFrame, key: str, document: str) -> DataFrame:
    """Distinct document ids per code, sorted, and how many."""
    ids = parents.where(F.col(document).isNotNull()).groupBy(F.col(key).alias("code")).agg(F.array_sort(F.collect_set(document)).alias("document_ids"))
    return ids.withColumn("n", F.size("document_ids"))


def first_users(rows: DataFrame, order_col: str, code: Column, position: str) -> DataFrame:
    """Of each order that is given: ``first_code`` and ``first_position`` of the record that comes first, and ``n`` records."""
    return rows.where(F.col(order_col).isNotNull()).groupBy(F.col(order_col).alias("_order")).agg(F.min_by(code, F.col(position)).alias("first_code"), F.min(position).alias("first_position"), F.count(F.lit(1)).alias("n"))


def lookup_with_fallback(rows: DataFrame, first: tuple[Column, DataFrame, str, str], second: tuple[Column, DataFrame, str, str]) -> DataFrame:
    """Adds ``resolved``: what the first of (key, dimension, key column, value column) gives, else the second, else "";
    and ``differs``, where both give something else. Of rows of a dimension that share a key the smallest value counts."""
    for tag, (key, dimension, key_col, value_col) in (("_a", first), ("_b", second)):
        found = dimension.groupBy(F.col(key_col).alias(f"{tag}_key")).agg(F.min(value_col).alias(tag))
        rows = rows.join(found, key == F.col(f"{tag}_key"), "left").drop(f"{tag}_key")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return rows.withColumn("resolved", F.coalesce("_a", "_b", F.lit(""))).withColumn("differs", both & (F.col("_a") != F.col("_b"))).drop("_a", "_b")


def plan(desired: DataFrame, existing: DataFrame, spec: Spec, parents: DataFrame | None = None, position: str = "position") -> DataFrame:
    """One row per desired record: code, action (blocked, conflict, create, update, matching), document_id,
    update_default, update_localized, create_localized, messages.

    ``existing``: document_id, locale, code, position, the stored fields (VARIANT as ``existing_of`` gives them, or columns of
    the records' own types), and parent_document_id for specs with a parent.
    ``parents``: code and document_id."""
    kinds, wanted_kinds = ({f.name: f.dataType for f in df.schema} for df in (existing, desired))
    names = sorted({*spec.shared, *spec.default_names})
    stored = [*names, *(["parent_document_id"] if spec.parent else [])]
    per = existing.groupBy("code", "locale").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct(F.col("document_id"), *stored), F.col(position)).alias("r"))
    of = lambda locale, tag: per.where(F.col("locale") == locale).select(F.col("code").alias(f"_{tag}_code"), F.col("n").alias(f"_{tag}_n"), F.when(F.col("n") == 1, F.col("r")).alias(f"_{tag}"))
    code = F.coalesce(F.nullif(F.col(spec.code), F.lit("")), F.lit("<missing-code>"))
    d = desired.withColumn("_code", code).withColumn("_pos", F.col(position))
    again = d.groupBy(F.col("_code").alias("_acode")).agg(F.min("_pos").alias("_apos"))
    d = d.join(again, F.col("_code") == F.col("_acode")).withColumn("_again", F.col("_pos") != F.col("_apos")).drop("_acode", "_apos")
    if "sort_order" in d.columns:
        d = d.join(first_users(d, "sort_order", F.col("_code"), "_pos"), F.col("sort_order") == F.col("_order"), "left")
        d = d.withColumn("_first_user", F.when(F.col("_pos") != F.col("first_position"), F.col("first_code"))).drop("_order", "first_code", "first_position", "n")
        order = F.try_variant_get("sort_order", "$", "long") if isinstance(kinds["sort_order"], VariantType) else F.col("sort_order")
        orders = existing.where(F.col("locale").isin(spec.default_locale, spec.localized_locale)).select(order.alias("_so"), F.coalesce("code", F.lit("<missing-code>")).alias("_ecode"), (F.col("locale") != spec.default_locale).cast("int").alias("_l"), F.col(position).alias("_p"))
        users = orders.where(F.col("_so").isNotNull()).groupBy("_so").agg(F.array_sort(F.collect_list(F.struct("_l", "_p", "_ecode"))).alias("_users"))
        d = d.join(users, F.col("sort_order") == F.col("_so"), "left")
        others = F.transform(F.filter("_users", lambda u: u["_ecode"] != F.col("_code")), lambda u: u["_ecode"])
        d = d.withColumn("_clash", F.when(F.size(others) > 0, F.array_join(others, ", "))).drop("_so", "_users")
    else:
        d = d.withColumn("_first_user", F.lit(None).cast("string")).withColumn("_clash", F.lit(None).cast("string"))
    d = d.join(of(spec.default_locale, "d"), F.col("_code") == F.col("_d_code"), "left").join(of(spec.localized_locale, "l"), F.col("_code") == F.col("_l_code"), "left")
    blocked = [F.lit(None).cast("string")]
    parent = F.lit(None).cast("string")
    if spec.parent and parents is not None:
        known = cardinality(parents, "code", "document_id").select(F.col("code").alias("_pcode"), "document_ids", F.col("n").alias("_pn"))
        d = d.join(known, F.col(spec.parent) == F.col("_pcode"), "left")
        blocked = [
            F.when(F.col("_pn").isNull(), F.concat(F.lit("Referenced Category code "), F.coalesce(F.nullif(F.col(spec.parent), F.lit("")), F.lit("<missing-category-code>")), F.lit(" was not found."))),
            F.when(F.col("_pn") > 1, F.concat(F.lit("Referenced Category code "), F.col(spec.parent), F.lit(" is ambiguous across documentIds: "), F.array_join("document_ids", ", "), F.lit("."))),
        ]
        parent = F.when(F.col("_pn") == 1, F.get("document_ids", F.lit(0)))
    ambiguous = lambda tag, scope: F.when(F.col(f"_{tag}_n") > 1, F.concat(F.lit(f"Duplicate existing {spec.label} records with code "), F.col("_code"), F.lit(f" in {scope}.")))
    document = F.when(F.col("_d").isNotNull(), F.col("_d.document_id")).otherwise(F.col("_l.document_id"))
    conflicts = [
        *[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"Missing required artifact value: {c}.")) for c in spec.required],
        F.when(F.col("_again"), F.concat(F.lit(f"Duplicate artifact {spec.code}: "), F.col("_code"), F.lit("."))),
        F.when(F.col("_first_user").isNotNull(), F.concat(F.lit("Duplicate artifact sort_order "), F.col("sort_order").cast("string") if "sort_order" in desired.columns else F.lit(""), F.lit(" also used by "), F.col("_first_user"), F.lit("."))),
        ambiguous("d", "default locale"), ambiguous("l", "localized locale"),
        F.when((F.col("_d").isNotNull() | F.col("_l").isNotNull()) & (F.coalesce(document, F.lit("")) == ""), F.lit(f"Existing {spec.label} is missing documentId.")),
        F.when(F.col("_clash").isNotNull(), F.concat(F.lit("sort_order "), F.col("sort_order").cast("string") if "sort_order" in desired.columns else F.lit(""), F.lit(f" is already used by existing {spec.label} code(s): "), F.col("_clash"), F.lit("."))),
    ]

    def differs(tag: str, fields: dict[str, str]) -> Column:
        out = F.lit(False)
        for stored_name, column in fields.items():
            out = out | differs_from(F.col(f"_{tag}.{stored_name}"), kinds[stored_name], F.col(column), wanted_kinds[column])
        return out | ~F.col(f"_{tag}.parent_document_id").eqNullSafe(F.col("_parent")) if spec.parent else out

    d = d.withColumn("_parent", parent).withColumn("_document", document)
    d = d.withColumn("_blocked", F.array_compact(F.array(*blocked))).withColumn("_conflicts", F.array_compact(F.array(*conflicts)))
    changed_d = F.when(F.col("_d").isNull(), True).otherwise(differs("d", spec.shared | spec.default_names))
    changed_l = F.when(F.col("_l").isNull(), True).otherwise(differs("l", spec.shared | spec.localized_names))
    d = d.withColumn("_cd", changed_d).withColumn("_cl", changed_l)
    action = (
        F.when(F.size("_blocked") > 0, "blocked").when(F.size("_conflicts") > 0, "conflict").when(F.col("_d").isNull() & F.col("_l").isNull(), "create")
        .when(F.col("_cd") | F.col("_cl"), "update").otherwise("matching")
    )
    d = d.withColumn("action", action)
    update = F.col("action") == "update"
    known = F.col("action").isin("update", "matching")
    return d.select(
        F.col("_pos").alias(position), F.col("_code").alias("code"), "action", F.when(known, F.col("_document")).alias("document_id"), (update & F.col("_cd")).alias("update_default"),
        (update & F.col("_l").isNotNull() & F.col("_cl")).alias("update_localized"), ((F.col("action") == "create") | (update & F.col("_l").isNull())).alias("create_localized"),
        F.when(F.col("action") == "blocked", F.col("_blocked")).when(F.col("action") == "conflict", F.col("_conflicts")).otherwise(F.array().cast("array<string>")).alias("messages"), F.col("_parent").alias("parent_document_id"),
    )


def plan_counters(planned: DataFrame) -> DataFrame:
    """How many records of each action, and the publish actions they ask for (two where a localized write comes along)."""
    writes = F.col("action").isin("create", "update")
    localized = F.col("create_localized") | F.col("update_localized")
    count = lambda a: F.count_if(F.col("action") == a).alias(f"{a}_count")
    return planned.agg(F.count(F.lit(1)).alias("records"), *[count(a) for a in ("create", "update", "matching", "conflict", "blocked")], F.coalesce(F.sum(F.when(writes, F.when(localized, 2).otherwise(1))), F.lit(0)).cast("long").alias("publish_actions"))


def require_applicable(planned: DataFrame, apply_mode: bool) -> None:
    """The gate before any write: apply mode, and neither conflict nor block."""
    if not apply_mode:
        raise PermissionError("writing needs apply mode")
    bad = planned.where(F.col("action").isin("conflict", "blocked")).limit(1).collect()
    if bad:
        raise RuntimeError(f"the plan has conflicts or blocked records ({bad[0]['code']}) and cannot be applied")


def actions(planned: DataFrame, spec: Spec) -> DataFrame:
    """Ordered writes of a plan: code, step (from 1), verb, locale, document_id. Everything written is published;
    the desired status of a record is not looked at."""
    act = lambda test, verb, locale: F.when(test, F.struct(F.lit(verb).alias("verb"), F.lit(locale).alias("locale")))
    create, update = F.col("action") == "create", F.col("action") == "update"
    listed = F.array_compact(F.array(
        act(create, "create", spec.default_locale), act(update & F.col("update_default"), "update", spec.default_locale), act(update & ~F.col("update_default"), "publish", spec.default_locale),
        act(F.col("create_localized"), "localize", spec.localized_locale), act(F.col("update_localized"), "update", spec.localized_locale),
    ))
    rows = planned.where(create | update).select("code", "document_id", F.posexplode(listed).alias("_p", "a"))
    return rows.select("code", (F.col("_p") + 1).alias("step"), F.col("a.verb").alias("verb"), F.col("a.locale").alias("locale"), "document_id")


def writes(planned: DataFrame, desired: DataFrame, spec: Spec, position: str = "position", parent_field: str = "category") -> DataFrame:
    """The actions of a plan with what they send: code, step, verb, locale, document_id, payload (JSON text; ``{}`` to publish alone)."""

    def payload(names: dict[str, str]) -> Column:
        parent = [F.col("p.parent_document_id").alias(parent_field)] if spec.parent else []
        return F.to_json(F.struct(F.col("p.code").alias("code"), *[F.col(f"d.{c}").alias(f) for f, c in (spec.shared | names).items()], *parent), {"ignoreNullFields": "false"})

    both = planned.alias("p").join(desired.alias("d"), F.col(f"p.{position}") == F.col(f"d.{position}")).where(F.col("p.action").isin("create", "update"))
    payloads = both.select(F.col("p.code").alias("_code"), payload(spec.default_names).alias("_default"), payload(spec.localized_names).alias("_localized"))
    sent = F.when(F.col("verb") == "publish", "{}").when(F.col("locale") == spec.default_locale, F.col("_default")).otherwise(F.col("_localized"))
    return actions(planned, spec).join(payloads, F.col("code") == F.col("_code")).select("code", "step", "verb", "locale", "document_id", sent.alias("payload"))


# fixed values: fields of glossaries that must be there, desired and stored
GLOSSARY_DESIRED = ("term_code", "term", "definition")
GLOSSARY_STORED = ("code", "term", "definition")
# end of fixed values


def glossary_existing(records: DataFrame) -> DataFrame:
    """Stored terms from (record as JSON text, status_rank, position): of those that share document and code the one fetched last
    counts; the document is ``documentId``, or ``id`` where that is missing. document_id (of ``documentId`` alone), code, term,
    definition as VARIANT, position."""
    v = records.select(F.try_parse_json("record").alias("_v"), "status_rank", "position")
    text = lambda name: F.nullif(F.try_variant_get(stored_field(F.col("_v"), name), "$", "string"), F.lit(""))
    keyed = v.select("_v", "status_rank", "position", text("documentId").alias("document_id"), F.coalesce(text("documentId"), text("id")).alias("_document"), F.try_variant_get(stored_field(F.col("_v"), "code"), "$", "string").alias("code"))
    return latest(keyed, ["_document", "code"], "status_rank", "position").select("document_id", "code", stored_field(F.col("_v"), "term").alias("term"), stored_field(F.col("_v"), "definition").alias("definition"), "position")


def glossary_plan(desired: DataFrame, existing: DataFrame, label: str, position: str = "position") -> DataFrame:
    """Terms have one locale and no order: one row per desired term (term_code, term, definition) with ``position``, code, action
    (conflict, create, update, matching), document_id, messages. ``existing`` as ``glossary_existing`` gives it: a stored term
    without one of its required fields is a conflict, whatever the desired term says."""
    per = existing.groupBy(F.col("code").alias("_ecode")).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("document_id", "term", "definition"), F.col("position")).alias("_r"))
    code = F.coalesce(F.nullif(F.col("term_code"), F.lit("")), F.lit("<missing-code>"))
    d = desired.select(F.col(position).alias("_pos"), code.alias("_code"), *GLOSSARY_DESIRED)
    first = d.groupBy(F.col("_code").alias("_acode")).agg(F.min("_pos").alias("_apos"))
    d = d.join(first, F.col("_code") == F.col("_acode")).join(per, F.col("_code") == F.col("_ecode"), "left")
    one = F.col("_n") == 1
    blank = lambda v: v.isNull() | F.is_variant_null(v) | ((F.schema_of_variant(v) == "STRING") & (F.try_variant_get(v, "$", "string") == ""))
    lacks = {"code": F.coalesce(F.col("_ecode"), F.lit("")) == "", "term": blank(F.col("_r.term")), "definition": blank(F.col("_r.definition"))}
    messages = F.array_compact(F.array(
        *[F.when(F.col(c).isNull() | (F.col(c) == ""), f"Missing required artifact value: {c}.") for c in GLOSSARY_DESIRED],
        F.when(F.col("_pos") != F.col("_apos"), F.concat(F.lit("Duplicate artifact term_code: "), F.col("_code"), F.lit("."))),
        F.when(F.col("_n") > 1, F.concat(F.lit(f"Duplicate existing {label} records with code "), F.col("_code"), F.lit("."))),
        F.when(one & F.col("_r.document_id").isNull(), "Existing glossary record is missing documentId."),
        *[F.when(one & lacks[c], f"Existing glossary record is missing required Strapi field: {c}.") for c in GLOSSARY_STORED],
    ))
    text = desired.schema["term"].dataType
    changed = ~same_typed(F.col("_r.term"), F.col("term"), text) | ~same_typed(F.col("_r.definition"), F.col("definition"), text)
    action = F.when(F.size("_m") > 0, "conflict").when(F.col("_n").isNull(), "create").when(changed, "update").otherwise("matching")
    told = d.withColumn("_m", messages).withColumn("action", action)
    return told.select(F.col("_pos").alias(position), F.col("_code").alias("code"), "action", F.when(F.col("action").isin("update", "matching"), F.col("_r.document_id")).alias("document_id"), F.col("_m").alias("messages"))


def glossary_writes(planned: DataFrame, desired: DataFrame, position: str = "position") -> DataFrame:
    """One write for each term to create or update, as ``writes`` gives them; terms have no locale."""
    both = planned.alias("p").join(desired.alias("d"), F.col(f"p.{position}") == F.col(f"d.{position}")).where(F.col("p.action").isin("create", "update"))
    payload = F.to_json(F.struct(F.col("d.term_code").alias("code"), "d.term", "d.definition"), {"ignoreNullFields": "false"})
    return both.select("p.code", F.lit(1).alias("step"), F.col("p.action").alias("verb"), F.lit(None).cast("string").alias("locale"), "p.document_id", payload.alias("payload"))


def apply_plan(desired: DataFrame, existing: DataFrame, planned: DataFrame, spec: Spec, position: str = "position") -> DataFrame:
    """The state after a plan: written records in place of those they replace. New documents get ids from their codes."""
    joined = planned.where(F.col("action").isin("create", "update")).alias("p").join(desired.alias("d"), F.col(f"p.{position}") == F.col(f"d.{position}"))
    document = F.coalesce("p.document_id", F.concat(F.lit("new-"), F.col("p.code")))

    def written(locale: str, names: dict[str, str], test: Column) -> DataFrame:
        extra = [F.col("p.parent_document_id").alias("parent_document_id")] if spec.parent else []
        return joined.where(test).select(document.alias("document_id"), F.lit(locale).alias("locale"), F.col("p.code").alias("code"), F.col(f"p.{position}").alias(position), *[F.col(f"d.{c}").alias(f) for f, c in (spec.shared | names).items()], *extra)

    new = written(spec.default_locale, spec.default_names, (F.col("p.action") == "create") | F.col("p.update_default")).unionByName(
        written(spec.localized_locale, spec.localized_names, F.col("p.create_localized") | F.col("p.update_localized")))
    kept = existing.select(*new.columns).join(new.select("code", "locale"), ["code", "locale"], "left_anti").select(*new.columns)
    return kept.unionByName(new)

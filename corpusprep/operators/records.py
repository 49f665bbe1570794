"""Typed records from validated rows, and the artifacts that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip
from ..schemas import SEED_ARTIFACT_VERSION


def text(c: str) -> Column:
    return strip(F.col(f"`{c}`"))


def optional_text(c: str) -> Column:
    return blank_to_null(F.col(f"`{c}`"))


def boolean(c: str) -> Column:
    return F.lower(text(c)) == "true"


def integer(c: str) -> Column:
    """As int() reads it; null where blank."""
    return F.regexp_replace(F.nullif(text(c), F.lit("")), "_", "").cast("long")


def category_records(rows: DataFrame) -> DataFrame:
    return rows.select(
        text("code").alias("category_code"), optional_text("legacy_code").alias("legacy_code"), boolean("is_active").alias("is_active"), integer("sort_order").alias("sort_order"),
        text("desired_status").alias("desired_status"), text("name_en").alias("name_en"), optional_text("description_en").alias("description_en"),
        text("name_hi-IN").alias("name_hi_IN"), optional_text("description_hi-IN").alias("description_hi_IN"),
    )


def subject_records(rows: DataFrame) -> DataFrame:
    return rows.select(
        text("code").alias("subject_code"), optional_text("legacy_code").alias("legacy_code"), boolean("is_active").alias("is_active"), integer("sort_order").alias("sort_order"),
        text("category_code").alias("category_code"), text("desired_status").alias("desired_status"), text("name_en").alias("name_en"), optional_text("description_en").alias("description_en"),
        text("name_hi-IN").alias("name_hi_IN"), optional_text("description_hi-IN").alias("description_hi_IN"),
        optional_text("from_date").alias("from_date"), optional_text("to_date").alias("to_date"), integer("prabodhan_count").alias("prabodhan_count"),
    )


def glossary_records(rows: DataFrame) -> DataFrame:
    return rows.select(text("Term Code").alias("term_code"), text("Term").alias("term"), text("Definition").alias("definition"))


def envelope(workflow: str, key: str, label: str, collection: str, display: str) -> dict:
    """What stands around an artifact's records."""
    return {"schema_version": SEED_ARTIFACT_VERSION, "workflow": workflow, "source": {"key": key, "label": label}, "strapi": {"collection_type": collection, "display_name": display}}


def require_valid(issues: DataFrame) -> None:
    """The gate: nothing is written while there is an error."""
    bad = issues.where(F.col("severity") == "error").orderBy("row_number", "column").limit(10).collect()
    if bad:
        raise ValueError("; ".join(f"row {r['row_number']} {r['column']}: {r['message']}" for r in bad))

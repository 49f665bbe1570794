"""Seed artifacts: which target an artifact is for, and whether it says so itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SEED_ARTIFACT_VERSION


@dataclass(frozen=True)
class Target:
    workflow: str
    source_key: str
    collection: str
    display_name: str


# fixed values: the targets and what their artifacts are called
TARGETS = {
    "category": Target("category", "categories", "category", "Categories"),
    "subject": Target("subject", "subjects", "subject", "Subjects"),
    "sanatan-glossary": Target("glossary", "sanatan-glossary", "sanatan-glossary", "Sanatan Glossary"),
    "prabodhan-glossary": Target("glossary", "prabodhan-glossary", "prabodhan-glossary", "Prabodhan Glossary"),
}
# end of fixed values
ENVELOPE = "schema_version int, workflow string, source struct<key:string,label:string>, strapi struct<collection_type:string,display_name:string>"


def routed(rows: DataFrame, target_col: str = "target", targets: dict[str, Target] = TARGETS) -> DataFrame:
    """Adds ``route`` (the target's fields; null for one that is not known) and ``blocked``, the message for such a row."""
    names = F.create_map(*[x for k, t in targets.items() for x in (F.lit(k), F.struct(*[F.lit(v).alias(f) for f, v in vars(t).items()]))])
    out = rows.withColumn("route", F.get(F.filter(F.array(names[F.coalesce(target_col, F.lit(""))]), lambda r: r.isNotNull()), F.lit(0)))
    message = F.concat(F.lit("Unsupported ingest target: "), F.coalesce(target_col, F.lit("")), F.lit(f". Accepted values: {', '.join(targets)}."))
    return out.withColumn("blocked", F.when(F.col("route").isNull(), message))


def identity_problems(target: Target) -> Column:
    """Messages for each field of an artifact's envelope that is not as its target has it."""
    want = [("schema_version", F.lit(SEED_ARTIFACT_VERSION)), ("workflow", F.lit(target.workflow)), ("source.key", F.lit(target.source_key)), ("strapi.collection_type", F.lit(target.collection)), ("strapi.display_name", F.lit(target.display_name))]
    return F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(w), F.concat(F.lit(f"{f} is "), F.coalesce(F.col(f).cast("string"), F.lit("missing")), F.lit(", expected "), w.cast("string"), F.lit("."))) for f, w in want]))


def load(spark: SparkSession, path: str, target: str, record: str, targets: dict[str, Target] = TARGETS) -> tuple[DataFrame | None, list[str]]:
    """The records (``record``: their schema) of a target's artifact with ``position``, or None and what is wrong: an unknown target,
    no file, no JSON, or an identity of something else."""
    if target not in targets:
        return None, [f"Unsupported ingest target: {target}. Accepted values: {', '.join(targets)}."]
    try:
        files = spark.read.schema(f"{ENVELOPE}, records array<struct<{record}>>, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
        told = files.select("_corrupt", identity_problems(targets[target]).alias("p"), F.col("records").isNotNull().alias("has")).limit(1).collect()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return None, [f"{target} artifact not found: {path}"]
        raise
    if not told or told[0]["_corrupt"] is not None:
        return None, [f"{target} artifact is not valid JSON: {path}"]
    problems = [*told[0]["p"], *([] if told[0]["has"] else ["records is missing."])]
    if problems:
        return None, [f"{target} artifact: {p}" for p in problems]
    return files.select(F.posexplode("records").alias("position", "r")).select("position", "r.*"), []

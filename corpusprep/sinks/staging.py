"""Several tables made visible at once.

A run writes its tables under ``<folder>/runs/<run id>/``, where no reader looks. Readers go by a pointer file that names the
path of each current table; ``promote`` replaces it in one step, after all tables are whole. So a failure anywhere before leaves
readers on the old set, and a table that a run did not write stays as it was. A run may be staged and promoted again with the same
result. Promotion is checked against the pointer that the run began with: where another run was promoted meanwhile it fails
rather than undo that. Replaced runs stay for readers that are still at them, until ``vacuum``.

The pointer is written beside its place and renamed over it, which file systems do in one step; object stores have no
rename, but put one small object in one step, so there ``in_place=True`` writes it directly.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current.json"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, folder: str) -> dict:
    """The pointer: ``version`` (0 before the first promotion), ``run`` and ``tables`` (name to path below ``folder``)."""
    p, system = _path(spark, f"{folder}/{POINTER}")
    if not system.exists(p):
        return {"version": 0, "run": None, "tables": {}}
    stream = system.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def stage(tables: dict[str, DataFrame], folder: str, run_id: str, partition_by: str | None = None) -> int:
    """Write all tables of a run out of sight; what an earlier try of the run has left is replaced. Returns the version that ``promote``
    is to follow."""
    if not tables:
        raise ValueError("a run stages one table or more")
    spark = next(iter(tables.values())).sparkSession
    version = current(spark, folder)["version"]
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{folder}/runs/{run_id}/{name}")
    return version


def promote(spark: SparkSession, folder: str, run_id: str, names: list[str], after: int, in_place: bool = False) -> int:
    """Make the staged tables ``names`` of a run the current ones, all at once; others stay. Returns the new version. A run that is current
    already stays so."""
    now = current(spark, folder)
    if now["run"] == run_id:
        return now["version"]
    if now["version"] != after:
        raise RuntimeError(f"run {now['run']} was promoted while {run_id} was staged; stage it again on top")
    for name in names:  # a table is whole when its commit has left a mark
        mark, system = _path(spark, f"{folder}/runs/{run_id}/{name}/_SUCCESS")
        if not system.exists(mark):
            raise FileNotFoundError(f"{name} of run {run_id} is not staged")
    told = {"version": after + 1, "run": run_id, "tables": now["tables"] | {n: f"runs/{run_id}/{n}" for n in names}}
    target, system = _path(spark, f"{folder}/{POINTER}")
    written = target if in_place else _path(spark, f"{folder}/{POINTER}.{run_id}")[0]
    stream = system.create(written, True)
    try:
        stream.write(json.dumps(told).encode())
    finally:
        stream.close()
    if not in_place:
        jvm = spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        context.rename(written, target, options)
    return told["version"]


def publish_together(tables: dict[str, DataFrame], folder: str, run_id: str, partition_by: str | None = None) -> int:
    """Stage all tables, then promote them."""
    after = stage(tables, folder, run_id, partition_by)
    return promote(next(iter(tables.values())).sparkSession, folder, run_id, list(tables), after)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The current table of that name. A plan keeps to the run that was current when it was made."""
    tables = current(spark, folder)["tables"]
    if name not in tables:
        raise FileNotFoundError(f"{folder} has no current table {name}")
    return spark.read.parquet(f"{folder}/{tables[name]}")


def vacuum(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Delete runs that hold no current table and are not in ``keep`` (runs in the making); which they were."""
    used = {p.split("/")[1] for p in current(spark, folder)["tables"].values()} | set(keep)
    runs, system = _path(spark, f"{folder}/runs")
    gone = sorted(s.getPath().getName() for s in (system.listStatus(runs) if system.exists(runs) else []) if s.getPath().getName() not in used)
    for run in gone:
        system.delete(_path(spark, f"{folder}/runs/{run}")[0], True)
    return gone

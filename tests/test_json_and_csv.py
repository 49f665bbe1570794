"""Schemas as columns against the driver's walk; CSV by splits against the whole-file reader."""

import csv
import hashlib
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import json_schema, rules
from corpusprep.plans import catalog
from corpusprep.sources import csv_splits, files

SCHEMA = {
    "type": "object", "required": ["v", "items", "na me"], "additionalProperties": False,
    "properties": {
        "v": {"const": 1}, "k": {"enum": ["a", 2, None, True]}, "items": {"type": "array", "items": {"type": "object", "required": ["code"], "properties": {"code": {"type": "string", "minLength": 2, "maxLength": 4, "pattern": "[A-Z]+[0-9]*"}, "n": {"type": ["integer", "null"], "minimum": 3}}}},
        "x": {"type": "number"}, "b": {"type": "boolean", "const": True}, "f": {"const": 1.5}, "o": {"type": "object", "additionalProperties": False}, "s": {"minLength": 1}, "l": {"const": [1, {"a": "b"}]}, "na me": {"type": ["string", "null"]}, "z": {"const": None},
    },
}


def some(rng, depth=0):
    pick = rng.random()
    if depth < 3 and pick < 0.25:
        return {rng.choice(["v", "k", "items", "x", "b", "f", "o", "s", "l", "na me", "z", "code", "n", "é"]): some(rng, depth + 1) for _ in range(rng.randint(0, 5))}
    if depth < 3 and pick < 0.4:
        return [some(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, False, 0, 1, 2, 5, 2.0, 1.5, -7, 1e30, 12345678901234567890123, "", "a", "AB", "AB12", "ABCDE", "ab", "A\n", "é"])


def near(rng):
    """A sound record with some fields changed."""
    good = {"v": 1, "k": "a", "items": [{"code": "AB1", "n": 3}, {"code": "ZZ"}], "x": 1.25, "b": True, "f": 1.5, "o": {}, "s": "t", "l": [1, {"a": "b"}], "na me": None, "z": None}
    for k in rng.sample(sorted(good), rng.randint(0, 4)):
        good[k] = some(rng)
    for k in rng.sample(sorted(good), rng.randint(0, 2)):
        del good[k]
    for r in good.get("items") if isinstance(good.get("items"), list) else ():
        if isinstance(r, dict) and rng.random() < 0.5:
            r[rng.choice(["code", "n"])] = some(rng, 3)
    return good


def test_compiled_schema_is_the_drivers(spark):
    rng = random.Random(4)
    values = [near(rng) for _ in range(250)] + [some(rng) for _ in range(150)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string").repartition(4)
    got = {i: [] for i in range(len(values))}
    for r in df.select("i", json_schema.issues(F.try_parse_json("j"), SCHEMA).alias("x")).collect():
        got[r.i] = [(x.path, x.message) for x in r.x]
    want = {i: rules.schema_issues(v, SCHEMA) for i, v in enumerate(values)}
    assert got == want and sum(map(bool, want.values())) > 200 and not all(want.values())


def test_rows_of_issues(spark):
    df = spark.createDataFrame([(1, '{"a": "x"}'), (2, '{"a": 1}'), (3, "no json"), (4, None)], "id int, j string")
    got = sorted(map(tuple, json_schema.record_issues(df, {"properties": {"a": {"type": "string"}}}, "j", ("id",)).collect()))
    assert got == [(2, "$.a", "must be of type string"), (3, "$", "is not valid JSON"), (4, "$", "is not valid JSON")]


# CSV


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set(key, old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def records(df):
    return sorted((r.path.rpartition("/")[2], r.row_number, list(r["values"])) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_quoted_newlines_across_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    cell = lambda: rng.choice(["", "a", "b c", 'q"q', "x,y", "l1\nl2", "l1\r\nl2\n\n", '"', "é" * 30, "\n", "long " * 30, '",\n"'])
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\r")):
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=end).writerows([cell() for _ in range(rng.randint(1, 4))] for _ in range(120))
        (tmp_path / name).write_bytes(("\ufeff" if name == "a.csv" else "").encode() + out.getvalue().encode())
    odd = 'a,b"c,"d"e"f,\n\n "x",5" disk,"open ""quote\nstill"\n"tail"x,y\r1,2\r\n"never closed,\nto the end,"" of it\n'
    (tmp_path / "d.csv").write_text(odd, newline="")
    (tmp_path / "e.csv").write_text("")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = records(csv_splits.csv_records(spark, str(tmp_path)))
    assert got == records(files.csv_records(spark, str(tmp_path))) and len(got) > 360


def test_fields_of_any_length(spark, tmp_path):
    """Python's csv module takes 131,072 characters unless it is told otherwise."""
    rows = [["1", "x" * 131_073], ["2", 'a "b",\n' * 20_000], ["3", ""]]
    out = io.StringIO(newline="")
    csv.writer(out).writerows(rows)
    (tmp_path / "a.csv").write_text(out.getvalue(), newline="")
    for source in (csv_splits, files):
        assert [r[2] for r in records(source.csv_records(spark, str(tmp_path)))] == rows


def test_long_texts_as_csv(spark, tmp_path):
    texts = ["x" * 131_073, 'a "b",\n' * 20_000, None, "\ufeffa\n\ufeff\"b", "\r\n,\r"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "'s' AS source", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, catalog.csv_records(spark, str(tmp_path)).collect()))
    assert got == [(str(i), "s", hashlib.sha256((t or "").encode()).hexdigest()) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("was", "then"), (("64m", str(4 << 20)), ("67108864b", str(4 << 20)), ("1m", "1m")))
def test_whole_records_come_in_small_batches(spark, tmp_path, was, then):
    """A batch of as many records as a task is given at once by default took an executor beyond its memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    (tmp_path / "a.csv").write_text("a\n")
    try:
        spark.conf.set(key, was)
        assert records(csv_splits.csv_records(spark, str(tmp_path))) == [("a.csv", 1, ["a"])] and spark.conf.get(key) == then
    finally:
        spark.conf.set(key, old)


def test_marks_within_a_file(spark, tmp_path):
    """A byte order mark begins a file once; elsewhere it is a letter, and a quote after it is one too."""
    (tmp_path / "a.csv").write_bytes('\ufeff"a\n"\n\ufeff"b\nc"\n'.encode())
    (tmp_path / "b.csv").write_bytes('\ufeff\ufeff"a\n"\n\ufeffb'.encode())
    got = records(csv_splits.csv_records(spark, str(tmp_path)))
    assert got == records(files.csv_records(spark, str(tmp_path)))
    assert got == [("a.csv", 1, ["a\n"]), ("a.csv", 2, ['\ufeff"b']), ("a.csv", 3, ['c"']), ("b.csv", 1, ['\ufeff"a']), ("b.csv", 2, ["\n\ufeffb"])]


@pytest.mark.parametrize("rows", (1, 3))
def test_records_across_batches_and_splits(spark, tmp_path, rows):
    """Odd files, whose lines come in splits of some bytes and batches of some lines."""
    rng = random.Random(rows)
    for k in range(24):
        letters = rng.choice(['ab",\r\n', 'a"\n', 'a",\n', '"\r\n', "ab,\n"])
        (tmp_path / f"{k:02}.csv").write_text("".join(rng.choice(letters) for _ in range(rng.randint(0, 160))), newline="")
    want = records(files.csv_records(spark, str(tmp_path)))
    keys = {"spark.sql.files.maxPartitionBytes": "41", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = csv_splits.csv_records(spark, str(tmp_path))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert records(got) == want and len(want) > 100


def test_effects_of_lines(spark):
    """The four functions, against a reader that is told in which state it begins."""
    rng = random.Random(9)
    lines = ["".join(rng.choice('ab",,""\r ') for _ in range(rng.randint(0, 9))) for _ in range(1500)]

    def ends_inside(line, inside):
        state = "quoted" if inside else "start"
        for c in line:
            if state == "quoted":
                state = "quote" if c == '"' else "quoted"
            elif state == "quote" and c == '"':
                state = "quoted"
            elif c in ",\r":
                state = "start"
            else:
                state = "quoted" if state == "start" and c == '"' else "plain"
        return state == "quoted"

    outside, inside = csv_splits._effect(F.col("line"))
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", outside, inside).collect()
    assert [(r[1], r[2]) for r in got] == [(ends_inside(x, False), ends_inside(x, True)) for x in lines]

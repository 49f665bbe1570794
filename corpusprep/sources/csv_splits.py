"""CSV records of large files, read in splits: a quoted field may hold newlines, so whether a line begins a record depends on all
quotes before it.

Spark deals a file's lines in byte splits. What a line does to the state (inside a quoted field or not) is one of four functions: keep
it, swap it, or end inside or outside whatever it was. Each split is read once, under both states in which it may begin: lines that no
record begins between are put together, and written with what either state makes of them. Functions compose, so a split is summed up by
one and by the records and rows that it begins, and a prefix scan over splits, one small row each, tells each split how it begins. What
is a record by itself then stays where it is, already numbered; only records that cross splits, or the lines before both states
meet, come together by a shuffle. Results equal those of ``files.csv_records``, which reads a file in one task.

Where quotes count: a field is quoted if it begins with a quote; a quote elsewhere is a letter; two in a row inside are one. A record ends at
LF, CR or CRLF outside quotes. A quote that is never closed makes the rest of its file one record. One byte order mark at the start of a file
is none of its text (Spark's reader drops it). Fields may be of any length; a record is a value in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..operators.series import PART
from ..shared import settle, small_batches
from .files import csv_rows

# fields that are closed, and one that is open to the end of the line
INSIDE = r'(?:[^"]++|"")*+'
FIELDS = rf'(?:(?:"{INSIDE}"[^,\r]*+|[^",\r][^,\r]*+)?+[,\r])*+'
OPENS = rf'\A{FIELDS}"{INSIDE}\z'
STAYS = rf"\A{INSIDE}\z"
REOPENS = rf'\A{INSIDE}"[^,\r]*+[,\r]{FIELDS}"{INSIDE}\z'
QUOTED = rf'(?<![^,\r])"{INSIDE}(?:"|\z)'
#: What a state that a split may begin in makes of lines put together: whether they begin a record, whether they end inside quotes, the
#: records begun in the split so far, these included, and the rows begun before them and so far. A CR begins rows within a record's lines.
TOLD = {"starts": "boolean", "open": "boolean", "record": "long", "before": "long", "upto": "long"}
STATES = ("outside", "inside")
SPLIT = {"path": "string", PART: "long", "size": "long"}
UNIT = SPLIT | {"at": "long", "text": "string", "bytes": "long"} | {f"{k}_{s}": t for s in STATES for k, t in TOLD.items()}
ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def _parsed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(csv_rows)


def _effect(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it begins outside and if it begins inside."""
    plain = ~F.contains(line, F.lit('"'))
    return F.when(plain, False).otherwise(line.rlike(OPENS)), F.when(plain, True).otherwise(line.rlike(STAYS) | line.rlike(REOPENS))


def _rows_within(line: Column) -> tuple[Column, Column]:
    """The rows that CRs begin within a line, if it begins outside quotes and if it begins inside. A CR at its end is part of the end."""
    inner = F.regexp_replace(line, r"\r\z", "")
    count = lambda c: F.when(F.contains(inner, F.lit("\r")), F.regexp_count(F.regexp_replace(c, QUOTED, ""), F.lit("\r"))).otherwise(0)
    return count(inner), count(F.concat(F.lit('"'), inner))


def _ends(outside: np.ndarray, inside: np.ndarray, begins: bool) -> np.ndarray:
    """Whether quotes are open after each line, where they are before the first if ``begins``. A line that ends the same whatever
    came before forgets it: what counts is the last such line and the swaps since."""
    swaps = np.cumsum(outside & ~inside) % 2 == 1
    last = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    return np.where(last >= 0, outside[last] ^ swaps[last], begins) ^ swaps


def _told(lines: pa.Table, carried: dict[str, tuple[bool, int, int]]) -> tuple[pa.Table, np.ndarray, dict[str, tuple[bool, int, int]]]:
    """The lines of one split with what each state makes of them, those that begin a record under either, and what is carried on."""
    outside, inside, rows_outside, rows_inside = (lines[c].to_numpy() for c in ("ends_outside", "ends_inside", "rows_outside", "rows_inside"))
    out, any_starts, after = {"line": lines["line"]}, np.zeros(len(lines), bool), {}
    for s in STATES:
        begins, records, rows = carried[s]
        ends = _ends(outside, inside, begins)
        was_open = np.concatenate([[begins], ends[:-1]])
        upto = rows + np.cumsum(~was_open + np.where(was_open, rows_inside, rows_outside))
        record = records + np.cumsum(~was_open)
        told = {"starts": ~was_open, "open": ends, "record": record, "before": np.concatenate([[rows], upto[:-1]]), "upto": upto}
        out |= {f"{k}_{s}": pa.array(v, ARROW[TOLD[k]]) for k, v in told.items()}
        any_starts |= ~was_open
        after[s] = (bool(ends[-1]), int(record[-1]), int(upto[-1]))
    return pa.table(out), np.flatnonzero(any_starts), after


def _joined(split: tuple, at: int, told: list[pa.Table], begins: np.ndarray) -> pa.RecordBatch:
    """The lines from each of ``begins`` to the next put together, numbered from ``at``."""
    lines = pa.concat_tables(told).combine_chunks()
    column = lambda c: lines[c].combine_chunks()
    bounds = np.append(begins, len(lines))
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), column("line").cast(pa.string())), "\n")
    out = {c: pa.repeat(pa.scalar(v, ARROW[UNIT[c]]), len(begins)) for c, v in zip(SPLIT, split, strict=True)}
    out |= {"at": pa.array(np.arange(at, at + len(begins))), "text": text, "bytes": pc.add(pc.binary_length(text).cast(pa.int64()), 1)}
    out |= {f"{k}_{s}": column(f"{k}_{s}").take(pa.array(begins if k in ("starts", "before") else bounds[1:] - 1)) for s in STATES for k in TOLD}
    return pa.RecordBatch.from_arrays([out[c] for c in UNIT], list(UNIT))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split, put together where no record begins between them under either state. Lines of a split follow each other."""
    split, at, held, carried = None, 0, [], {}
    for b in filter(len, batches):
        other = [pc.not_equal(b[c][1:], b[c][:-1]).to_numpy(zero_copy_only=False) for c in ("path", PART)]
        edges = [0, *(np.flatnonzero(other[0] | other[1]) + 1), len(b)]
        for begin, end in zip(edges, edges[1:], strict=False):
            lines = pa.Table.from_batches([b]).slice(begin, end - begin)
            if (here := tuple(lines[c][0].as_py() for c in SPLIT)) != split:
                if held:
                    yield _joined(split, at, held, np.array([0]))
                split, at, held, carried = here, 0, [], {s: (s == "inside", 0, 0) for s in STATES}
            told, begins, carried = _told(lines, carried)
            if len(begins):  # what begins last may go on in lines to come, what is held ends here
                whole = np.append(np.zeros(min(len(held), 1), int), begins[:-1] + sum(map(len, held)))
                if len(whole):
                    yield _joined(split, at, [*held, told[: begins[-1]]], whole)
                at, held, told = at + len(whole), [], told[begins[-1] :]
            held.append(told)
    if held:
        yield _joined(split, at, held, np.array([0]))


def _states(w: Window) -> Column:
    """The function of all splits up to this one as ``fixed`` (the state it ends in whatever came before, null if that counts) and
    ``swaps`` (whether it swaps the state that came before)."""
    swaps = F.sum(F.col("swaps").cast("int")).over(w) % 2
    at_last = F.last(F.when(F.col("fixed").isNotNull(), F.struct(F.col("fixed").cast("int").alias("state"), swaps.alias("swaps"))), ignorenulls=True).over(w)
    return F.struct(((at_last["state"] + at_last["swaps"] + swaps) % 2 == 1).alias("fixed"), (swaps == 1).alias("swaps"))


def _begun(units: DataFrame) -> DataFrame:
    """Of each split: the state in which it begins, the records and rows begun before it, and the last record of its file if that has no
    end, as far as the bytes of its lines tell: a byte order mark is in the file's size alone."""
    ends = [f(f"{k}_{s}").alias(f"{k}_{s}") for s in STATES for k, f in (("open", lambda c: F.max_by(c, "at")), ("record", F.max), ("upto", F.max))]
    splits = settle(units.groupBy(*SPLIT).agg(*ends, F.sum("bytes").alias("bytes")))
    in_file = Window.partitionBy("path").orderBy(PART)
    fixed = F.when(F.col("open_outside") == F.col("open_inside"), F.col("open_outside"))
    through = splits.withColumn("fixed", fixed).withColumn("swaps", F.col("fixed").isNull() & F.col("open_outside"))
    through = through.withColumn("function", _states(in_file.rowsBetween(Window.unboundedPreceding, 0))).withColumn("function", F.lag("function").over(in_file))
    placed = through.withColumn("begins_inside", F.coalesce("function.fixed", "function.swaps", F.lit(False)))
    records, rows = (F.when(F.col("begins_inside"), F.col(f"{k}_inside")).otherwise(F.col(f"{k}_outside")) for k in ("record", "upto"))
    earlier, whole = in_file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("path")
    unended = (F.sum("bytes").over(whole) - F.col("size")).isin(1, -2)
    return placed.select("path", PART, "begins_inside", F.coalesce(F.sum(records).over(earlier), F.lit(0)).alias("records_before"), F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias("rows_before"), F.when(unended, F.sum(records).over(whole)).alias("unended"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of each CSV file: path, row_number (the header is 1; by record, not by line), values (array). What it returns does not
    read the files again."""
    small_batches(spark)
    read, line = spark.read.option("lineSep", "\n").text(path), F.col("value")
    told = [c.alias(f"{k}_{s}") for k, of in (("ends", _effect), ("rows", _rows_within)) for s, c in zip(STATES, of(line), strict=True)]
    lines = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias(PART), F.col("_metadata.file_size").alias("size"), line.alias("line"), *told)
    # small splits share a task, in order, as each task writes a file; a shuffle would have as many tasks
    lines = lines.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))
    units = settle(lines.mapInArrow(_units, ", ".join(f"{k} {t}" for k, t in UNIT.items())))  # how lines are dealt stays as it is
    here = units.join(F.broadcast(_begun(units)), ["path", PART])
    starts, is_open, record, before, _ = (F.when(F.col("begins_inside"), F.col(f"{k}_inside")).otherwise(F.col(f"{k}_outside")) for k in TOLD)
    placed = here.select("path", (F.col("records_before") + record).alias("record"), (F.col("rows_before") + before).alias("before"), (starts & ~is_open).alias("whole"), PART, "at", "text", "unended")
    whole = placed.where("whole").select("path", "record", "before", "text", "unended")
    in_order = F.array_sort(F.collect_list(F.struct(PART, "at", "text")))
    parts = placed.where("NOT whole").groupBy("path", "record").agg(F.min("before").alias("before"), F.array_join(F.transform(in_order, lambda x: x["text"]), "\n").alias("text"), F.max("unended").alias("unended"))
    ended = F.concat("text", F.when(F.col("record") == F.col("unended"), "").otherwise("\n"))
    each = whole.unionByName(parts).select("path", "before", F.posexplode(_parsed(ended)).alias("_p", "values"))
    return each.select("path", (F.col("before") + F.col("_p") + 1).cast("long").alias("row_number"), "values")

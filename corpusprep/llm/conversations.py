"""Conversation structure repair: weighted CYK interval parsing over the turns of each conversation.

The roles of a sound conversation spell ``(s?(ua)+)?``. The repair grammar is in Chomsky normal form: a nonterminal (p, q)
stands for the turns that lead from state p to state q (begin, after the system, after the user, after the assistant), a
binary rule for (p, r) -> (p, q) (q, r), a terminal rule for keeping, re-roling or deleting one row, closed under insertions
on both sides. A cell of the chart holds for each nonterminal the least (cost, audit) over a span, and spans are combined
bottom-up by their length: 1, 2, 4 and so on. As the grammar is regular, each way to split a span gives the same cell, so
one split is enough and the chart is linear in the rows instead of cubic. The least audits of two neighbouring spans,
joined, are the least of both: of two audits of one span at the same cost none begins the other, for what follows would be
insertions, which cost.

Rows are dealt by range of (conversation, turn, role, text) and numbered in that order, so one conversation with a third of all rows is many tasks':
each makes the cells of its blocks of BLOCK rows. Only cells meet by conversation, then edits go back to the rows. Texts
do not go through the chart. What is one value per conversation (the audit) is put together in one
task, and the digest of a repaired conversation is streamed over its sorted rows.

Rows of a conversation go by turn, null turns first, then by role and text, so rows equal in all are adjacent; these count each and
are held once with their number. Null roles and texts are one space (a role that fits nowhere, a blank text); a null
conversation id is an id like any other. A role that begins with none of s, u, a (also the empty one) can only be
re-roled or deleted. A blank row or a repeat of an earlier one is always deleted. An empty table gives an empty table. A very
long text costs time by its length. Columns are read by name, so extra columns with any names do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import ASCII_SPACE, materialize, partitions, small_batches

#: Rows of one conversation whose cells one row of the chart holds.
BLOCK_BITS = 8
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (BEGIN, ASSISTANT)
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: Where a turn of a role leads. I and R stand for insertions and changes to the user, J and S to the assistant: within a state
#: just one of them can follow, so audits in these letters are in the order of audits in I and R.
ARCS = {"s": [(BEGIN, SYSTEM)], "u": [(BEGIN, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
NONTERMINALS = [(p, q) for p in range(4) for q in range(4) if p == q or q in (USER, ASSISTANT) or (p, q) == (BEGIN, SYSTEM)]
BINARY = [(i, NONTERMINALS.index((p, q)), NONTERMINALS.index((q, r))) for i, (p, r) in enumerate(NONTERMINALS) for q in range(4) if (p, q) in NONTERMINALS and (q, r) in NONTERMINALS]

#: For each nonterminal the least cost and audit, or None where it can't be.
Cell = list[tuple[int, str] | None]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out: Cell = [None] * len(NONTERMINALS)
    for i, a, b in BINARY:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            new, old = (x[0] + y[0], x[1] + y[1]), out[i]
            if old is None or new < old:
                out[i] = new
    return out


def _closure() -> Cell:
    """Insertions alone: the cell of the empty span."""
    now: Cell = [(0, "") if p == q else None for p, q in NONTERMINALS]
    once = list(now)
    for role, letter in (("u", "I"), ("a", "J")):
        for arc in ARCS[role]:
            once[NONTERMINALS.index(arc)] = (INSERT, letter)
    while (more := joined(now, once)) != now:
        now = more
    return now


EMPTY = _closure()


def _terminal(kind: str) -> Cell:
    """One row. ``kind``: x for one that must go, else its role's initial or o, upper-case if it is truncated."""
    out: Cell = [(DELETE, "D") if p == q else None for p, q in NONTERMINALS]
    if kind != "x":
        late = TRUNCATED * kind.isupper()
        for cost, role, letter in ((0, kind.lower(), "K"), (REROLE, "u", "R"), (REROLE, "a", "S")):
            for arc in ARCS.get(role, ()):
                i = NONTERMINALS.index(arc)
                out[i] = min(filter(None, (out[i], (cost + late, letter))))
    return joined(joined(EMPTY, out), EMPTY)


TERMINAL = {kind: _terminal(kind) for kind in "xsuaoSUAO"}


def chart(spans: list[Cell]) -> Cell:
    """The cell of all spans in a row, combined by growing length."""
    while len(spans) > 1:
        spans = [joined(spans[i], spans[i + 1]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0] if spans else EMPTY


def row_cell(kind: str, copies: int) -> Cell:
    """A row and the rows equal to it that follow it, which all go."""
    if copies == 1:
        return TERMINAL[kind]
    gone: Cell = [(DELETE * (copies - 1), "D" * (copies - 1)) if p == q else None for p, q in NONTERMINALS]
    return joined(TERMINAL[kind], joined(joined(EMPTY, gone), EMPTY))


# types as objects: workers import this module and have no session to read type names with
CELL = ArrayType(StructType([StructField("cost", LongType()), StructField("audit", StringType())]))
BEST = StructType([StructField("cost", LongType()), StructField("audit", StringType()), StructField("tokens", ArrayType(ArrayType(StringType())))])


@F.pandas_udf(CELL)
def _block_cells(kinds: pd.Series, copies: pd.Series) -> pd.Series:
    cells = (chart([row_cell(k, int(m)) for k, m in zip(ks, ms, strict=True)]) for ks, ms in zip(kinds, copies, strict=True))
    return pd.Series([[None if c is None else {"cost": c[0], "audit": c[1]} for c in cell] for cell in cells], dtype=object)


@F.pandas_udf(BEST)
def _best(blocks: pd.Series, copies: pd.Series) -> pd.DataFrame:
    """The least repair of a conversation from its blocks' cells, and each row's part of it: insertions before it, its own
    edit, the deletions of its copies; insertions at the end go with the last row."""
    costs, audits, tokens = [], [], []
    for cells, counts in zip(blocks, copies, strict=True):
        whole = chart([[None if c is None else (c["cost"], c["audit"]) for c in cell] for cell in cells])
        cost, audit = min(filter(None, (whole[NONTERMINALS.index((BEGIN, q))] for q in FINAL)))
        at, own = 0, []
        for ms in counts:
            own.append([])
            for m in ms:
                begun = at
                while audit[at] in "IJ":
                    at += 1
                at += int(m)
                own[-1].append(audit[begun:at])
        own[-1][-1] += audit[at:]
        costs.append(cost)
        audits.append(audit)
        tokens.append(own)
    return pd.DataFrame({"cost": costs, "audit": audits, "tokens": tokens})


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``rows`` (conversation, turn, role, text, nulls of the last two as one space) with the faults of a test set: by
    crc32 of ``conversation:turn`` (nulls as one space) modulo 20, 0 is dropped, 1 loses its text, 2 its sentence ends, 3 comes
    twice, 4 has the user's role."""
    blank = F.lit(" ")
    role, text = F.coalesce(F.col(role_col).cast("string"), blank), F.coalesce(F.col(text_col), blank)
    fault = F.crc32(F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))) % 20
    made = rows.where(fault != 0).select(
        conv_col, turn_col, F.when(fault == 4, "user").otherwise(role).alias(role_col),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col), F.when(fault == 3, 2).otherwise(1).alias("_times"),
    )
    return made.select(conv_col, turn_col, role_col, text_col, F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("col")


def _same(*names: str) -> Column:
    out = F.lit(True)
    for c in names:
        out &= F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return out


def parse(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables. Conversations: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``. Edits:
    ``conv``, ``at`` (a row's number, in order), ``token`` (its edits, I J K R S D). Rows: ``at``, ``turn``, ``role``, ``text``."""
    blank, order = F.lit(" "), ("conv", "turn", "role", "text")
    given = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), blank).alias("role"), F.coalesce(F.col(text_col), blank).alias("text"))
    dealt = given.groupBy(*order).agg(F.count(F.lit(1)).alias("m")).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    base = materialize(dealt.select(F.monotonically_increasing_id().alias("at"), *order, "m"))
    seen, initial = F.rtrim("text", F.lit(ASCII_SPACE)), F.substr("role", F.lit(1), F.lit(1))
    narrow = base.select("conv", "turn", "role", F.xxhash64("text").alias("h"), F.hash("text").alias("h2"), "at", "m", (seen == "").alias("blank"), (~F.right(seen, F.lit(1)).isin(".", "!", "?")).alias("late"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"))
    # the first row of each role and text of a conversation
    firsts = narrow.groupBy("conv", "role", "h", "h2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    placed = materialize(narrow.drop("role", "h", "h2").join(firsts, "at", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False))))

    once = F.col("is_first").cast("long")
    counts = placed.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), F.sum(F.when(F.col("blank"), F.col("m")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("m") - once).otherwise(0)).alias("duplicate"), F.sum(F.when(~F.col("blank") & F.col("late"), once).otherwise(0)).alias("truncated"),
    )
    must_go = F.col("blank") | ~F.col("is_first")
    kind = F.when(must_go, "x").when(F.col("late"), F.upper("initial")).otherwise(F.col("initial"))
    blocks = placed.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(F.struct("at", "m", kind.alias("kind"), "initial"))).alias("r"))
    initials = F.transform("r", lambda r: r["initial"])
    legal = lambda a, b: F.concat(a, b).isin("su", "ua", "au")
    inside = F.aggregate("r", F.lit(0).cast("long"), lambda n, r: n + r["m"] - 1) + F.size(F.filter(F.zip_with(initials, F.slice(initials, 2, F.greatest(F.size("r") - 1, F.lit(0))), lambda a, b: legal(a, b)), lambda ok: ~ok))
    cells = blocks.select("conv", "block", F.transform("r", lambda r: r["at"]).alias("ats"), F.transform("r", lambda r: r["m"]).alias("copies"), F.array_join(F.transform("r", lambda r: r["kind"]), "").alias("kinds"), F.get(initials, F.lit(0)).alias("left"), F.element_at(initials, -1).alias("right"), inside.alias("inside"))
    cells = cells.select("*", _block_cells("kinds", "copies").alias("cells")).drop("kinds")
    whole = cells.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "copies", "left", "right", "inside", "cells", "ats"))).alias("b"))
    crossing = F.transform(F.sequence(F.lit(1), F.size("b")), lambda i: F.when((i < F.size("b")) & ~legal(F.get("b", i - 1)["right"], F.get("b", i)["left"]), 1).otherwise(0))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + x)
    parsed = materialize(
        whole.select("conv", (total(F.transform("b", lambda b: b["inside"])) + total(crossing)).alias("illegal"), F.flatten(F.transform("b", lambda b: b["ats"])).alias("ats"), _best(F.transform("b", lambda b: b["cells"]), F.transform("b", lambda b: b["copies"])).alias("best"))
    )
    told = parsed.select("conv", "illegal", "best.cost", F.translate("best.audit", "JS", "IR").alias("audit"))
    convs = told.alias("a").join(counts.alias("b"), _same("conv"), "left").select("a.conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = parsed.select("conv", F.explode(F.arrays_zip(F.col("ats").alias("at"), F.flatten("best.tokens").alias("token"))).alias("e")).select("conv", "e.at", "e.token")
    return convs, edits, base.select("at", "turn", "role", "text")


def repaired_rows(edits: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows that stand after the repair: ``conv``, ``at``, ``nr`` (their order), ``turn`` (null if inserted), ``edit``,
    ``role``, ``text``."""
    each = edits.join(texts, "at").select("*", F.posexplode(F.split("token", "")).alias("nr", "letter")).where(F.col("letter").isin("I", "J", "K", "R", "S"))
    new = F.col("letter").isin("I", "J")
    role = F.when(F.col("letter").isin("I", "R"), "user").when(F.col("letter").isin("J", "S"), "assistant").otherwise(F.col("role"))
    edit = F.when(new, "insert").when(F.col("letter") == "K", "keep").otherwise("rerole")
    return each.select("conv", "at", "nr", F.when(~new, F.col("turn")).alias("turn"), edit.alias("edit"), role.alias("role"), F.when(new, "").otherwise(F.col("text")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """``conv``, ``sha256`` of the ``role:text`` lines of each conversation, newline-joined: sorted rows stream by, and one digest
    is open at a time."""
    small_batches(rows.sparkSession)
    kind = rows.schema["conv"].dataType
    lines = rows.select("conv", "at", "nr", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition(partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", "at", "nr").select("conv", "line")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, of, shape = None, None, None

        def given(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], shape), pa.array([r[1] for r in rows], pa.string())], ["conv", "sha256"])

        for batch in batches:
            shape = batch.schema.field("conv").type
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if now is not None and conv == of:
                    now.update(b"\n")
                else:
                    if now is not None:
                        done.append((of, now.hexdigest()))
                    now, of = hashlib.sha256(), conv
                now.update(line.encode())
            if len(done) >= 4096:
                yield given(done)
                done = []
        if now is not None:
            yield given([*done, (of, now.hexdigest())])

    return dealt.mapInArrow(digest, StructType([StructField("conv", kind), StructField("sha256", StringType())]))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired rows of all conversations: ``conv_col``, ``turn_col`` (null if inserted), ``at`` and ``nr`` (their order),
    ``edit``, ``role_col``, ``text_col``."""
    _, edits, texts = parse(rows, conv_col, turn_col, role_col, text_col)
    return repaired_rows(edits, texts).select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "at", "nr", "edit", F.col("role").alias(role_col), F.col("text").alias(text_col))


def assess(originals: DataFrame, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One line for each conversation of ``originals``: its faults as ``rows`` show them, the cheapest repair, and the digest of the
    repaired conversation. One that has no rows left has zeros and nothing to repair."""
    convs, edits, texts = parse(rows, conv_col, turn_col, role_col, text_col)
    all_ = originals.select(F.col(conv_col).alias("conv")).distinct()
    with_counts = all_.alias("a").join(convs.alias("b"), _same("conv"), "left").select("a.conv", *[f"b.{c}" for c in convs.columns if c != "conv"])
    both = with_counts.alias("a").join(digests(repaired_rows(edits, texts)).alias("b"), _same("conv"), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(F.col("a.conv").alias(conv_col), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))

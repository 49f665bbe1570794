"""Benchmark decontamination: word windows of test items found in training documents (native).

The windows of all items, made distinct, are the hash set. Its bytes are counted first. Up to ``max_broadcast`` of them
it is broadcast, and a document is scanned once: the hash of the whole window at each position goes through a sieve, a bitmap of
the windows' hashes, and where it passes the window's own words, no more of the document, are looked up. Beyond that, (row, position, hash of the whole window) are dealt
out and joined with the windows, in PARTS parts each, so that a passage of a third of all documents is not one task's; only
what meets comes back to its document. Both ways the words themselves verify each hit, so hashes decide nothing. Which items hold
a window is joined once for each document and window, and only where it is asked for.

Null or empty text has no words and no hits; an item without words has no window; without items nothing is hit. Every
input row gives one output row, repeated rows and null ids included; an empty table gives an empty table. A very long
text costs time in proportion to its length, and items that begin or end alike cost no more than others. Items that share a window all count;
a null item id is no id, so it counts for hits but is not listed. Input columns are only read by name, so extra
columns with any names do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialize

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Ways in which the positions of one window are dealt out.
PARTS = 16


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = 10) -> DataFrame:
    """Distinct ``window`` (words) and ``item`` (id as string)."""
    w = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("window")).distinct()


def _doc_and(doc: Column, each: Column) -> Column:
    """An array to explode whose first element is ``doc`` alone and whose others have one of ``each`` alone. So a document comes
    along with what is looked up for it, and no looked-up row carries it: a long text is not copied to each of its words."""
    return F.concat(F.array(F.struct(doc.alias("doc"), F.lit(None).alias("x"))), F.transform(each, lambda x: F.struct(F.lit(None).alias("doc"), x.alias("x"))))


def _all_of(each: Callable[[int], Column], widths: list[int], kind: str) -> Column:
    return each(widths[0]) if len(widths) == 1 else F.flatten(F.array(*map(each, widths))) if widths else F.array().cast(kind)


def _doc(n_words: Column, keep: tuple[str, ...]) -> Column:
    return F.struct("_id", *[F.col(c) for c in keep], n_words.cast("long").alias("n_words"))


def _window_hashes(w: Column, k: int) -> Column:
    """At each position the hash of the ``k`` words from there on, put together from hashes of half as many, and so on down to
    single words: a few steps for each position instead of ``k``. The last k - 1 positions hold no window."""
    sizes: list[int] = []

    def needs(size: int) -> None:
        if size > 1 and size not in sizes:
            needs(size // 2)
            needs(size - size // 2)
            sizes.append(size)

    def grown(i: int, have: dict[int, Column]) -> Column:
        if i == len(sizes):
            return have[k]
        left, right = sizes[i] // 2, sizes[i] - sizes[i] // 2
        return let(F.transform(have[left], lambda x, j: F.xxhash64(x, F.get(have[right], j + left))), lambda v: grown(i + 1, have | {sizes[i]: v}))

    needs(k)
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda v: grown(0, {1: v}))


def _hash_of(window: Column, widths: list[int]) -> Column:
    """The hash that a window has among those of a document."""
    return F.coalesce(*[F.when(F.size(window) == k, F.get(_window_hashes(window, k), F.lit(0))) for k in widths]) if widths else F.lit(None).cast("long")


#: Bits of the sieve for each window: so a position without a window passes about once in as many.
SIEVE = 32


def _sieve(windows: DataFrame, widths: list[int]) -> Callable[[Column], Column]:
    """Whether a hash may be one of a window, by a bitmap of the windows' hashes. It is as large as SIEVE bits for each window, and
    these are few enough to broadcast."""
    n = windows.count()
    words = 1 << max(0, (n * SIEVE // 64 - 1).bit_length())  # of 64 bits
    at = lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(words - 1).cast("long")).cast("int")
    bit = lambda h: h.bitwiseAND(F.lit(63).cast("long")).cast("int")
    h = _hash_of(F.col("window"), widths)
    held = {r["at"]: r["bits"] for r in windows.select(at(h).alias("at"), F.expr("1L").alias("one"), bit(h).alias("bit")).groupBy("at").agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("bit"))).alias("bits")).collect()}
    bitmap = F.from_json(F.lit("[" + ",".join(str(held.get(i, 0)) for i in range(words)) + "]"), "array<bigint>")
    return lambda x: F.call_function("shiftright", F.get(bitmap, at(x)), bit(x)).bitwiseAND(F.lit(1).cast("long")) == 1


def _met_by_broadcast(scanned: DataFrame, windows: DataFrame, widths: list[int], keep: tuple[str, ...]) -> DataFrame:
    """Rows (_rid, doc) of documents and (_rid, start, window) of hits."""
    n, doc, may_be = F.size("_w"), _doc(F.size("_w"), keep), _sieve(windows, widths)
    kind = "array<struct<start:int,window:array<string>>>"

    def placed(k: int) -> Column:
        starts = let(_window_hashes(F.col("_w"), k), lambda h: F.array_compact(F.transform(h, lambda x, i: F.when((i <= n - k) & may_be(x), i))))
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice("_w", i + 1, k).alias("window")))

    rows = scanned.select("_rid", F.explode(_doc_and(doc, _all_of(placed, widths, kind))).alias("e")).select("_rid", "e.doc", "e.x.*")
    known = windows.select("window", F.lit(True).alias("_there"))
    return rows.join(F.broadcast(known), "window", "left").where(F.col("doc").isNotNull() | F.col("_there")).select("_rid", "doc", "start", "window")


def _met_by_shuffle(scanned: DataFrame, windows: DataFrame, widths: list[int], keep: tuple[str, ...]) -> DataFrame:
    """The same rows. Positions travel without their document and without words."""
    docs = materialize(scanned)  # row numbers must stay as they are
    n = F.size("_w")
    kind = "array<struct<i:int,h:bigint,k:int>>"

    def starts(k: int) -> Column:
        each = F.transform(_window_hashes(F.col("_w"), k), lambda x, i: F.struct((i + 1).alias("i"), x.alias("h"), F.lit(k).alias("k")))
        return F.when(n >= k, F.slice(each, F.lit(1), n - k + 1)).otherwise(F.array().cast(kind))

    placed = docs.select("_rid", F.explode(_all_of(starts, widths, kind)).alias("x")).select("_rid", F.col("x.i").alias("i"), F.col("x.h").alias("h"), F.col("x.k").alias("k"), F.pmod("_rid", F.lit(PARTS)).alias("part"))
    spread = windows.select("window", _hash_of(F.col("window"), widths).alias("h"), F.size("window").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("part"))
    may = placed.join(spread, ["h", "k", "part"]).groupBy("_rid").agg(F.collect_list(F.struct("i", "window")).alias("may"))
    both = docs.join(may, "_rid", "left")
    hits = F.filter(F.coalesce("may", F.array().cast("array<struct<i:int,window:array<string>>>")), lambda m: F.slice(F.col("_w"), m["i"], F.size(m["window"])) == m["window"])
    each = F.transform(hits, lambda m: F.struct((m["i"] - 1).alias("start"), m["window"].alias("window")))
    return both.select("_rid", F.explode(_doc_and(_doc(n, keep), each)).alias("e")).select("_rid", "e.doc", "e.x.*")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = 10, max_broadcast: int = 64 << 20, keep: tuple[str, ...] = (), name_items: bool = True) -> DataFrame:
    """One row per document: ``id_col``, ``keep`` columns, ``n_words``, ``hits`` (merged word spans start, end),
    ``n_hit`` and, with ``name_items``, ``item_ids`` (sorted strings). ``max_broadcast``: bytes of windows and of their items."""
    of_items = item_windows(items, item_col, width=width)
    windows = of_items.select("window").distinct()
    row_bytes = F.aggregate("window", F.lit(64).cast("long"), lambda a, x: a + F.octet_length(x) + 8) + F.coalesce(F.octet_length("item"), F.lit(0)) + 8
    sizes = {r["k"]: r["n"] for r in of_items.groupBy(F.size("window").alias("k")).agg(F.sum(row_bytes).alias("n")).collect()}
    few = sum(sizes.values()) <= max_broadcast
    scanned = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(id_col).alias("_id"), *[F.col(c) for c in keep], words(F.col(text_col)).alias("_w"))
    rows = (_met_by_broadcast if few else _met_by_shuffle)(scanned, windows, sorted(sizes), keep)
    grouped = rows.groupBy("_rid").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.size("window")).alias("end")))).alias("hit"), F.collect_set("window").alias("met"),
    )
    # the words that are hit, in order: a span begins where the word before is not hit, and ends where the word after is not
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("hit", lambda h: F.sequence(h["start"], h["end"] - 1)))))
    edge = lambda all_, by: F.filter(all_, lambda x, i: ~F.coalesce(F.get(all_, i + by) == x + by, F.lit(False)))
    spans = let(covered, lambda all_: F.zip_with(edge(all_, -1), edge(all_, 1), lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end"))))
    if name_items:
        # each window of a document meets its items once, and a set takes them up
        each = grouped.select("_rid", F.explode(_doc_and(F.struct("doc", spans.alias("hits")), F.col("met"))).alias("e")).select("_rid", F.col("e.doc").alias("found"), F.col("e.x").alias("window"))
        named = each.join(F.broadcast(of_items) if few else of_items, "window", "left").groupBy("_rid").agg(F.first("found", ignorenulls=True).alias("found"), F.array_sort(F.collect_set("item")).alias("item_ids"))
        merged = named.select(F.col("found.doc").alias("doc"), F.col("found.hits").alias("hits"), "item_ids")
    else:
        merged = grouped.select("doc", spans.alias("hits"))
    named_columns = [F.col("doc._id").alias(id_col), *[F.col("doc")[c].alias(c) for c in keep], F.col("doc.n_words").alias("n_words"), "hits", *(["item_ids"] if name_items else [])]
    return merged.select(*named_columns).withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"]))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = 10, mode: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="spans"``) with the words that are hit taken out:
    what stays is the words before, between and after the spans, normalised and joined by spaces. Documents
    without a hit keep their text in both modes."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_col].alias("_did"), docs[text_col].alias("_dtext"))
    found = find_contamination(rows, items, "_did", "_dtext", item_col, width, keep=("row",), name_items=False)
    if mode == "documents":
        return found.where(F.col("n_hit") == 0).select(*[F.col("row")[c].alias(c) for c in docs.columns])
    if mode != "spans":
        raise ValueError(f"mode is documents or spans, not {mode!r}")
    w = words(F.col("row")[text_col])
    edge = lambda i, name, otherwise: F.coalesce(F.get("hits", i)[name], otherwise)
    between = lambda all_: F.flatten(F.transform(F.sequence(F.lit(0), F.size("hits")), lambda i: _from_to(all_, F.when(i == 0, 0).otherwise(edge(i - 1, "end", F.lit(0))), edge(i, "start", F.size(all_)))))
    text = F.when(F.col("n_hit") == 0, F.col("row")[text_col]).otherwise(F.array_join(let(w, between), " "))
    return found.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _from_to(array: Column, start: Column, end: Column) -> Column:
    return F.slice(array, start + 1, end - start)

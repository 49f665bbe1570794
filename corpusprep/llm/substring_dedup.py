"""Substring dedup: word windows that occur more than once in the corpus are removed, by suffix automata.

A window is ``length`` consecutive words of one document. Every word that lies in a window whose words also
start anywhere else goes. The corpus is its own reference here, so one automaton of all of it can't be
broadcast. It is cut into shards by content instead, and each shard meets only the text that can match it:

1. Each window is named by its anchor, the smallest hash of ``anchor`` words in a row inside it. Equal
   windows have equal anchors. A run of windows with one anchor is a segment (12 windows or so).
2. Anchors are counted over the corpus with partial sums. A segment whose anchor occurs nowhere else
   holds no repeat.
3. The distinct segments of one anchor are a shard. Its suffix automaton, with the number of occurrences
   at each state, is built and the segments are streamed through it: where the match of the last
   ``length`` words stands at a state with two occurrences or more, a span is removed.
4. A shard of more than ``max_shard`` segments is split: its windows are dealt by their hash to shards of
   bounded size, where an automaton of each does the same. Equal windows meet in one of them.

So whatever is removed is found by an automaton. Segments are told apart by 128 bits of hashes (anchor and
content). Null texts and texts of fewer than ``length`` words lose nothing. A very long text is cut into
segments in one task and never shortened. A repeated row is an occurrence of its own, so both go wholly.
Ids may be null or repeat; a row is known by its id and the hash of its text. An empty table gives an empty
table. Extra columns pass through by name, whatever their names; one named n_words, n_removed or kept is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import discard, let, materialize, partitions, small_batches

LENGTH, ANCHOR = 35, 12
MAX_RUN = 64
#: A key with more than one part in so many of all segments is hot.
HOT = 1000
_M = np.uint64(0x9E3779B97F4A7C15)
_F = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 11)
        return h


def _rolled(h: np.ndarray, k: int) -> np.ndarray:
    n = len(h) - k + 1
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g *= _M
        g += h[j : j + n]
    g ^= g >> np.uint64(31)
    g *= _F
    return g ^ (g >> np.uint64(29))


def segments(words: list[bytes], cache: WordHashes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...] | None:
    """Start, number of windows, anchor and content hash of each segment, and whether it may hold one window
    twice (its anchor occurs in it again); None if there is no window."""
    n = len(words)
    if n < length:
        return None
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    grams, span = _rolled(h, anchor), length - anchor + 1
    least, a = grams, 1
    while a * 2 <= span:
        least, a = np.minimum(least[:-a], least[a:]), a * 2
    if span > a:
        least = np.minimum(least[: len(least) - (span - a)], least[span - a :])
    at = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    sizes = np.diff(np.r_[at, len(least)])
    # two equal windows of one run have their anchors either within one window or more than a window apart
    near = np.zeros(len(grams), bool)
    for d in range(1, min(span, len(grams))):
        near[:-d] |= grams[:-d] == grams[d:]
    upto = np.r_[0, np.cumsum(near)]
    again = (sizes > span) | (upto[at + sizes + span - 1] > upto[at])
    if sizes.max() > MAX_RUN:  # a long run of one anchor is cut: any cut leaves each window in one segment
        more = -(-sizes // MAX_RUN)
        at = np.repeat(at, more) + MAX_RUN * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more))
        again = np.repeat(again, more)
        sizes = np.diff(np.r_[at, len(least)])
    # a run's content is its windows in order: hash windows by content, weighted by their place in the run
    windows = _rolled(h, length)
    place = (np.arange(len(least)) - np.repeat(at, sizes)).astype(np.uint64)
    content = np.add.reduceat(windows * (place * np.uint64(2) + np.uint64(1)) ^ (windows >> np.uint64(17)), at) + sizes.astype(np.uint64)
    return at, sizes, least[at], content, again


def repeated_windows(parts: list[tuple[bytes, int]], length: int = LENGTH) -> list[list[bool]]:
    """For each of the (text, occurrences) of a shard: which of its windows occur at least twice in the shard.

    A generalised suffix automaton of words: state 0 is the root; ``count`` holds how often the words of a
    state end somewhere, an occurrence of a text counting as often as the text itself."""
    go: list[dict[int, int]] = [{}]
    size, link, count = [0], [-1], [0]
    ids: dict[bytes, int] = {}
    texts = [[ids.setdefault(w, len(ids)) for w in t.split()] for t, _ in parts]

    def clone(q: int, p: int, c: int) -> int:
        new = len(go)
        go.append(dict(go[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        count.append(0)
        link[q] = new
        while p != -1 and go[p].get(c) == q:
            go[p][c] = new
            p = link[p]
        return new

    for words, (_, times) in zip(texts, parts, strict=True):
        last = 0
        for c in words:
            q = go[last].get(c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else clone(q, last, c)
            else:
                cur = len(go)
                go.append({})
                size.append(size[last] + 1)
                link.append(0)
                count.append(0)
                p = last
                while p != -1 and c not in go[p]:
                    go[p][c] = cur
                    p = link[p]
                if p != -1:
                    q = go[p][c]
                    link[cur] = q if size[q] == size[p] + 1 else clone(q, p, c)
                last = cur
            count[last] += times
    for v in sorted(range(1, len(go)), key=size.__getitem__, reverse=True):
        count[link[v]] += count[v]
    out = []
    for words in texts:
        v, flags = 0, []
        for j, c in enumerate(words):
            v = go[v][c]
            while size[link[v]] >= length:  # matching statistics, cut to the last ``length`` words
                v = link[v]
            if j >= length - 1:
                flags.append(count[v] >= 2)
        out.append(flags)
    return out


def _runs(flags: list[bool], at: int) -> tuple[list[int], list[int]]:
    """Starts (from ``at`` on) and lengths of the runs of flagged windows."""
    if all(flags):
        return [at], [len(flags)]
    starts, sizes, begun = [], [], None
    for j, f in enumerate([*flags, False]):
        if f and begun is None:
            begun = j
        elif not f and begun is not None:
            starts.append(at + begun)
            sizes.append(j - begun)
            begun = None
    return starts, sizes


SEGMENT = "_id string, _tx long, start int, n int, m long, s long, again boolean"


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, max_shard: int = 2048) -> DataFrame:
    """Per document with a repeat: ``_id`` (id as text), ``_tx`` and ``spans``, windows (start, n) counted in words."""
    spark = docs.sparkSession
    n_parts = partitions(spark)
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("string").alias("_id"), F.xxhash64(F.col(text_col)).alias("_tx"), F.col(text_col).cast("binary").alias("_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            rows, found = [], []
            for i, t in enumerate(b.column(2).to_pylist()):
                if t and (seg := segments(t.split(), cache, length, anchor)) is not None:
                    rows.append(np.full(len(seg[0]), i))
                    found.append(seg)
            if found:
                at, sizes, m, s, again = (np.concatenate(x) for x in zip(*found, strict=True))
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(at.astype(np.int32)), pa.array(sizes.astype(np.int32)), pa.array(m.view(np.int64)), pa.array(s.view(np.int64)), pa.array(again)], names=["_id", "_tx", "start", "n", "m", "s", "again"])

    segs = materialize(texts.mapInArrow(cut, SEGMENT))
    # a hot anchor has more than a thousandth of all segments, so there are at most 1000 of them, and they are met by broadcast
    counts = materialize(segs.groupBy("m").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again")).where("c > 1 OR again").select("m", "c"))
    n_segs = segs.count()
    is_hot = F.col("c") * HOT > n_segs
    hits = materialize(_met(segs.drop("again"), counts.where(~is_hot).select("m"), counts.where(is_hot).select("m"), ["m"]))
    discard(segs)

    # the text of each distinct segment, with its number of occurrences
    wanted = materialize(hits.groupBy("m", "s").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("_id", "_tx", "start", "n")).alias("at")))
    large = wanted.groupBy("m").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > max_shard).select("m", F.ceil(F.col("k") / max_shard).alias("k"))
    sized = wanted.join(large, "m", "left")
    lists = sized.groupBy(F.col("at._id").alias("_id"), F.col("at._tx").alias("_tx")).agg(F.collect_list(F.struct("m", "s", "times", "k", F.col("at.start").alias("start"), F.col("at.n").alias("n"))).alias("segs"))
    # a row that repeats gives its segments once
    held = texts.join(lists, texts["_id"].eqNullSafe(lists["_id"]) & (texts["_tx"] == lists["_tx"])).select(texts["_id"], texts["_tx"], "_text", "segs")

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t, segs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = t.split()
                out += [(x["m"], x["s"], x["times"], x["k"], b" ".join(words[x["start"] : x["start"] + x["n"] + length - 1])) for x in segs]
            cols = zip(*out, strict=True) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.binary()), strict=True)], names=["m", "s", "times", "k", "seg"])

    distinct = held.select("_text", "segs").mapInArrow(texts_of, "m long, s long, times long, k long, seg binary")

    def automata(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows (shard, m, s, at, times, seg) sorted by these: the repeats of each segment or window, an automaton a shard."""
        m, s, starts, sizes, many = [], [], [], [], []

        def work(group: list[tuple]) -> None:
            for g, flags in zip(group, repeated_windows([(g[5], g[4]) for g in group], length), strict=True):
                if True in flags:
                    a, n = _runs(flags, g[3])
                    m.append(g[1])
                    s.append(g[2])
                    starts.extend(a)
                    sizes.extend(n)
                    many.append(len(a))

        def told() -> pa.RecordBatch:
            pairs = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())], names=["start", "n"])
            b = pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(s, pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pairs)], names=["m", "s", "runs"])
            for x in (m, s, starts, sizes, many):
                x.clear()
            return b

        group: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if group and group[0][0] != row[0]:
                    work(group)
                    group = []
                    if len(m) > 4000:
                        yield told()
                if not group or group[-1][1:4] != row[1:4]:  # a text of repeated rows gives its segments more than once
                    group.append(row)
        if group:
            work(group)
        yield told()

    # of large shards every window by itself, dealt by its hash; the same window of several segments is one text with their times
    one = F.array(F.struct(F.lit(0).alias("at"), F.col("seg").cast("string").alias("seg")))
    cut_up = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - length), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(w, i + 1, length), " ").alias("seg")))
    windows = let(F.split(F.col("seg").cast("string"), " "), cut_up)
    pieces = distinct.select("m", "s", "times", "k", F.explode(F.when(F.col("k").isNull(), one).otherwise(windows)).alias("x")).select("m", "s", "times", "k", F.col("x.at").alias("at"), F.col("x.seg").alias("seg"))
    shard = F.when(F.col("k").isNull(), F.col("m")).otherwise(F.xxhash64("m", F.pmod(F.xxhash64("seg"), F.col("k") * MAX_RUN)))
    ran = pieces.select(shard.alias("shard"), "m", "s", "at", "times", F.col("seg").cast("binary").alias("seg")).repartition(n_parts, "shard").sortWithinPartitions("shard", "m", "s", "at")
    told = ran.mapInArrow(automata, "m long, s long, runs array<struct<start:int,n:int>>")
    joined = materialize(told.groupBy("m", "s").agg(F.flatten(F.collect_list("runs")).alias("runs")))
    hot = F.broadcast(wanted.where(F.col("times") * HOT > n_segs).select("m", "s"))
    found = _met(hits, joined.join(hot, ["m", "s"], "left_anti"), joined.join(hot, ["m", "s"], "left_semi"), ["m", "s"])
    found = found.select("_id", "_tx", "start", F.explode("runs").alias("r")).select("_id", "_tx", (F.col("start") + F.col("r.start")).alias("start"), F.col("r.n").alias("n"))
    return found.groupBy("_id", "_tx").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"))


def _met(rows: DataFrame, rest: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``rest`` by shuffle and with ``hot``, HOT rows at most, by broadcast. A row meets one of them."""
    names = hot.select(*keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(F.broadcast(names), keys, "left_anti").join(rest, keys))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **how: int) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words that stay, joined by spaces."""
    spans = find_repeats(docs, id_col, text_col, length, **how)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[id_col].cast("string").alias("_rid"), docs[text_col].alias("_rtext"))
    both = rows.join(spans, rows["_rid"].eqNullSafe(spans["_id"]) & (F.xxhash64("_rtext") == spans["_tx"]), "left").select("_row", F.col("_rtext").cast("binary").alias("_text"), F.col("spans.start").alias("_at"), F.col("spans.n").alias("_n"))

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for t, at, n in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                words = (t or b"").split()
                total.append(len(words))
                if at:
                    a = np.array(at)
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, a, 1)
                    np.add.at(depth, a + np.array(n) + length - 1, -1)
                    stay = np.cumsum(depth)[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["_row", "n_words", "n_removed", "kept"])

    made = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]
    done = both.mapInArrow(strike, StructType([both.schema["_row"], *made]))
    new = [f.name for f in made]
    return done.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in new], *new)

"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

A text, with one space put before it, is cut where a space follows another character and around tabs
and newlines: no piece of the vocabulary crosses such a place, so the lattice of the text is a chain of lattices of these words. For
each distinct word the forward sums over its lattice are computed once and kept as the distribution of
the last piece at each place. Sampling then walks backward through all words of a group of texts at
once: each step draws the piece that ends at the present place. Draws come from a hash of row key, word
number and step, so a row's segmentation depends on its key, its text and ``seed`` alone, whatever the
partitioning.

A piece of merge rank r has weight 1/(r + 3) to the power ``alpha``; characters outside the vocabulary (among them
the space mark itself and newlines) become their bytes. Decoding joins the pieces' bytes and drops the
first space, and gives back every text exactly. Null and empty texts have no pieces and decode to the
empty text; null keys share one seed; repeated rows get the same segmentation. Pieces of equal weight are told apart
by the draw alone, so ties don't arise. A very long text is sampled whole, in one group of its own. An empty table gives
an empty table. Extra columns pass through, whatever their names; one named like the output is replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import small_batches

MARK = "▁"
CONTROL = re.compile(r"[\t\n]")
WORD = re.compile(r" *[^ \t\n]+|[\t\n]| +")
MULTIPLIER = 0x9E3779B97F4A7C15
#: Characters of text sampled at once, and distinct words remembered: both bound a task's memory.
GROUP_CHARS = 1_000_000
MAX_WORDS = 100_000
#: Short words whose lattices are made at once.
WORDS = 4096
#: Words whose pieces are drawn at once.
DRAWN = 1 << 15


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """Pieces by id, and the kind of each: 0 a piece, 1 a byte, 2 neither. Read by the driver; small and fixed."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    kinds = tuple(1 if p.is_byte(i) else 2 if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) else 0 for i in range(n))
    return tuple(p.id_to_piece(i) for i in range(n)), kinds


class Lattices:
    """Backward-sampling distributions of distinct words, in flat arrays.

    Place j of a word whose places begin at b has number b + j. The arcs that end there lie together from
    ``first[place]`` on, longest piece first; ``cum`` holds their cumulated probability, 1 at the last.
    Words that a second group of texts holds are kept, up to MAX_WORDS, and then learnt
    anew; the rest are forgotten with their group. So memory is bounded, and common words are seldom worked out again."""

    def __init__(self, pieces: tuple[str, ...], kinds: tuple[int, ...], alpha: float) -> None:
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == 1}
        known: dict[str, tuple[int, float]] = {}
        for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
            if not k:
                known[p.replace(MARK, " ")] = (i, (len(known) + 4) ** -alpha)
        if any(CONTROL.search(s) for s in known):
            raise ValueError("a piece holds a tab or newline; texts can't be cut there")
        self.known = known
        # prefixes of pieces by the hash of their characters: id (-1: no piece itself) and weight
        named = {s[:n]: (-1, 0.0) for s in known for n in range(1, len(s))} | known
        codes = np.array([self._hash(s) for s in named], np.uint64)
        if len(np.unique(codes)) != len(codes) or not codes.all():
            raise ValueError("two prefixes share a hash")
        self.code_ids = np.array([i for i, _ in named.values()], np.int32)
        self.code_weights = np.array([w for _, w in named.values()])
        self.longest = max(map(len, known))
        # an open table of the hashes, a quarter full at most; 0: nothing there
        bits = 2 + len(codes).bit_length()
        self.shift, self.slots, self.slot_codes = np.uint64(64 - bits), np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        at, left = self._slot(codes), np.arange(len(codes))
        while len(left):
            _, one = np.unique(at[left], return_index=True)  # of those that want a place, the first gets it
            one = left[one]
            one = one[self.slots[at[one]] == 0]
            self.slots[at[one]], self.slot_codes[at[one]] = codes[one], one
            left = left[self.slots[at[left]] != codes[left]]
            at[left] = (at[left] + 1) % len(self.slots)
        self.clear()

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for c in s:
            h = (h * MULTIPLIER + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0xD6E8FEB86659FD93) >> self.shift).astype(np.int64)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are of prefixes, and the numbers of these prefixes."""
        at = self._slot(h)
        there = self.slots.take(at)
        hit = there == h
        on = np.flatnonzero(~hit & (there != 0))
        while len(on):
            at[on] = (at[on] + 1) % len(self.slots)
            there = self.slots[at[on]]
            hit[on] = there == h[on]
            on = on[(there != h[on]) & (there != 0)]
        hit = np.flatnonzero(hit)
        return hit, self.slot_codes.take(at[hit])

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.once: set[str] = set()
        #: Words, places and arcs in use; the arrays have room for more.
        self.used = (0, 0, 0)
        self.bases, self.lens = np.empty(0, np.int64), np.empty(0, np.int32)
        self.first = np.empty(0, np.int64)
        self.cum, self.ids, self.back = np.empty(0), np.empty(0, np.int32), np.empty(0, np.int32)

    def prepare(self, words: list[str]) -> None:
        """Make all ``words``, each there once, known until forget()."""
        new = [w for w in words if w not in self.words]
        again = [w for w in new if w in self.once]
        if len(self.words) + len(again) > MAX_WORDS:
            self.clear()
            again, new = [], words
        if len(self.once) > 2 * MAX_WORDS:
            self.once.clear()
        self.once.difference_update(again)
        if again:
            self.add(again)
        self.kept = self.used
        self.passing = [w for w in new if w not in self.words] if again else new
        self.once.update(self.passing)
        if self.passing:
            self.add(self.passing)

    def forget(self) -> None:
        for w in self.passing:
            del self.words[w]
        self.used = self.kept

    def add(self, words: list[str]) -> None:
        """Learn words not known yet. Those with characters outside the vocabulary, and very long ones, go one by one."""
        short, alone = [w for w in words if len(w) <= 48], [w for w in words if len(w) > 48]
        for at in range(0, len(short), WORDS):
            alone += self._add_many(short[at : at + WORDS])
        for w in alone:
            self._add_one(w)

    def _append(self, words: list[str], units: np.ndarray, arcs: np.ndarray, cum: np.ndarray, ids: np.ndarray, back: np.ndarray) -> None:
        """``arcs``: how many arcs end at each place of each word, its place 0 included."""
        k, f, c = self.used
        self.words.update(zip(words, range(k, k + len(words)), strict=True))
        added = ("bases", k, f + np.cumsum(units + 1) - (units + 1)), ("lens", k, units), ("first", f, c + np.cumsum(arcs) - arcs), ("cum", c, cum), ("ids", c, ids), ("back", c, back)
        for name, at, x in added:
            if len(held := getattr(self, name)) < at + len(x):
                room = np.empty((at + len(x)) * 5 // 4, held.dtype)
                room[:at] = held[:at]
                setattr(self, name, held := room)
            held[at : at + len(x)] = x
        self.used = (k + len(words), f + len(arcs), c + len(cum))

    def _add_many(self, words: list[str]) -> list[str]:
        """All lattices of short words at once; returns the words that it can't take."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        chars += np.uint64(1)
        hit, code = self._find(chars)
        hit = hit[self.code_ids[code] >= 0]
        if len(hit) < len(chars):
            bare = np.ones(len(chars), bool)
            bare[hit] = False
            bad = np.zeros(len(words), bool)
            bad[np.searchsorted(np.cumsum(n), np.flatnonzero(bare), side="right")] = True
            if good := [w for w, x in zip(words, bad.tolist(), strict=True) if not x]:
                self._add_many(good)
            return [w for w, x in zip(words, bad.tolist(), strict=True) if x]
        ends = np.cumsum(n)
        room = np.repeat(ends, n) - np.arange(len(chars))  # characters up to the word's end
        # the place before a character: each word has one place more than characters
        before = np.arange(len(chars)) + np.repeat(np.arange(len(words)), n)
        count = np.zeros(len(chars) + len(words), np.int64)
        at, h, found = np.arange(len(chars)), np.zeros(len(chars), np.uint64), []
        for size in range(1, self.longest + 1):
            h *= np.uint64(MULTIPLIER)
            h += chars.take(at + (size - 1))
            hit, code = self._find(h)
            at, h = at.take(hit), h.take(hit)
            piece = np.flatnonzero(self.code_ids.take(code) >= 0)
            end = before.take(at.take(piece))
            end += size
            count[end] += 1  # of one size, one arc ends at a place
            found.append((end, code.take(piece)))
            on = np.flatnonzero(room.take(at) > size)
            at, h = at.take(on), h.take(on)
            if not len(at):
                break
        # arcs by the place of their end, longest piece first
        stop = np.cumsum(count)
        first = stop - count
        free = first.copy()
        arcs = np.empty(int(stop[-1]), np.int32)
        back = np.empty(len(arcs), np.int32)
        for size in range(len(found), 0, -1):
            end, code = found.pop()
            to = free.take(end)
            arcs[to], back[to] = code, size
            free[end] = to + 1
        # forward, all words one place at a time
        number = np.arange(len(count), dtype=np.int64)
        number -= np.repeat(ends - n + np.arange(len(words)), n + 1)
        place = np.repeat(np.arange(len(count)), count)
        step = number.astype(np.uint8).take(place)
        order = np.argsort(step, kind="stable")
        cuts = np.r_[0, np.cumsum(np.bincount(step))]
        place, weight = place.take(order), self.code_weights.take(arcs.take(order))
        start = place - back.take(order)
        heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        head_cuts = np.searchsorted(heads, cuts)
        sums, parts = np.zeros(len(count)), np.empty(len(arcs))
        sums[number == 0] = 1
        for j in range(1, len(cuts) - 1):
            a, b = cuts[j], cuts[j + 1]
            own = heads[head_cuts[j] : head_cuts[j + 1]]
            parts[a:b] = sums.take(start[a:b]) * weight[a:b]
            sums[place[own]] = np.add.reduceat(parts[a:b], own - a)
        parts /= sums.take(place)
        cum = np.empty(len(arcs))
        cum[order] = parts
        at, rank = np.flatnonzero(count > 1), 1
        while len(at):  # each place's arcs are added up on their own
            k = first.take(at) + rank
            cum[k] += cum.take(k - 1)
            rank += 1
            at = at[count.take(at) > rank]
        np.minimum(cum, 1.0, out=cum)
        cum[stop[count > 0] - 1] = 1.0
        self._append(words, n, count, cum, self.code_ids.take(arcs), back)
        return []

    def _add_one(self, word: str) -> None:
        known, n = self.known, len(word)
        starts, units = [], 0
        for c in word:
            starts.append(units)
            units += 1 if c in known else len(c.encode("utf-8", "surrogatepass"))
        starts.append(units)
        into: list[list[tuple[int, int, float]]] = [[] for _ in range(units + 1)]
        for i in range(n):
            a = starts[i]
            if word[i] not in known:
                for k, b in enumerate(word[i].encode("utf-8", "surrogatepass")):
                    into[a + k + 1].append((self.bytes[b], 1, 1e-3))
            for j in range(i + 1, min(n, i + self.longest) + 1):
                if (found := known.get(word[i:j])) is not None:
                    into[starts[j]].append((found[0], starts[j] - a, found[1]))
        sums = [1.0] + [0.0] * units
        cum, ids, back = [], [], []
        for j in range(1, units + 1):
            parts = [sums[j - d] * p for _, d, p in into[j]]
            sums[j] = total = sum(parts)
            run, last = 0.0, len(parts) - 1
            for k, (i, d, _) in enumerate(into[j]):
                run += parts[k]
                cum.append(1.0 if k == last else run / total)
                ids.append(i)
                back.append(d)
            if total < 1e-100:  # only ratios of nearby sums matter
                for k in range(max(0, j - 200), j + 1):
                    sums[k] *= 1e100
        self._append([word], np.array([units]), np.array([len(x) for x in into]), np.array(cum), np.array(ids, np.int32), np.array(back, np.int32))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sample(lattices: Lattices, texts: list[str | None], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts one after another, and the number of each text's pieces."""
    found, counts = [], []
    for t in texts:
        own = WORD.findall(" " + t) if t else []
        counts.append(len(own))
        found += own
    coded = pa.array(found, pa.string()).dictionary_encode()
    del found
    distinct = coded.dictionary.to_pylist()
    lattices.prepare(distinct)
    counts = np.array(counts, np.int64)
    w = np.fromiter(map(lattices.words.__getitem__, distinct), np.int64, len(distinct)).take(coded.indices.to_numpy())
    first = np.cumsum(counts) - counts
    seeds, number = np.repeat(np.array(keys, np.uint64), counts), np.arange(len(w)) - np.repeat(first, counts)
    drawn: list[tuple[np.ndarray, np.ndarray, int]] = []
    steps = np.zeros(len(w), np.int64)
    for at in range(0, len(w), DRAWN):
        active = np.arange(at, min(at + DRAWN, len(w)))
        noise = _mix(seeds[active] ^ _mix(number[active].astype(np.uint64)))
        base = lattices.bases.take(w[active])
        place, step = base + lattices.lens.take(w[active]), 0
        while len(active):
            noise = _mix(noise)
            u = (noise >> np.uint64(11)).astype(np.float64) * 2.0**-53
            arc = lattices.first.take(place)
            on = np.flatnonzero(u >= lattices.cum.take(arc))
            while len(on):
                arc[on] += 1
                on = on[u[on] >= lattices.cum[arc[on]]]
            drawn.append((active, lattices.ids.take(arc), step))
            step += 1
            place -= lattices.back.take(arc)
            on = np.flatnonzero(place > base)
            steps[active] = step
            active, place, base, noise = active.take(on), place.take(on), base.take(on), noise.take(on)
    lattices.forget()
    ends = np.cumsum(steps)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    for active, ids, step in drawn:
        out[ends.take(active) - (1 + step)] = ids
    per_text = np.add.reduceat(np.r_[steps, 0], np.minimum(first, len(steps))) if len(counts) else counts
    return out, np.where(counts > 0, per_text, 0)


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


_cached: dict[tuple, Lattices] = {}


def _lattices(name: tuple, shared: Broadcast, alpha: float) -> Lattices:
    """A worker that is used again keeps what it knows."""
    if name not in _cached:
        _cached.clear()
        _cached[name] = Lattices(*shared.value, alpha)
    return _cached[name]


class Spelling:
    """The bytes of each piece."""

    def __init__(self, pieces: tuple[str, ...], kinds: tuple[int, ...]) -> None:
        spelled = [bytes([int(p[3:5], 16)]) if k == 1 else b"" if k else p.replace(MARK, " ").encode() for p, k in zip(pieces, kinds, strict=True)]
        self.lens = np.array([len(s) for s in spelled], np.int64)
        self.begins = np.cumsum(self.lens) - self.lens
        self.pool = np.frombuffer(b"".join(spelled), np.uint8)

    def texts(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts that ``ids`` spell, ``sizes`` pieces each."""
        out: list[str] = []
        stop = np.r_[0, np.cumsum(sizes)]
        for i in range(0, len(sizes), 64):  # some rows at a time: the index arrays are wider than the text
            own = ids[stop[i] : stop[min(i + 64, len(sizes))]]
            n = self.lens.take(own)
            ends = np.cumsum(n)
            at = np.repeat(self.begins.take(own) - (ends - n), n)
            at += np.arange(len(at))
            raw = self.pool.take(at).tobytes()
            start = 0
            for end in np.r_[0, ends][stop[i + 1 : i + 65] - stop[i]].tolist():
                out.append(raw[start + 1 : end].decode("utf-8", "replace"))  # the first byte is the space put before
                start = end
        return out


def _sampled(lattices: Lattices, b: pa.RecordBatch, at_text: int, seed: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Group by group: the rows, all their pieces, and the number of each row's. Column 1 is the key."""
    texts = pc.struct_field(b.column(0), at_text).to_pylist()
    keys = [xxhash.xxh64_intdigest("" if k is None else f"={k}", seed) for k in b.column(1).to_pylist()]
    for at, to in _groups(texts):
        yield b.column(0).slice(at, to - at), *sample(lattices, texts[at:to], keys[at:to])


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), ids)


def _rows(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[id_col].cast("string").alias("_key"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "pieces", model: str | None = None, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` with ``out_col`` (array<int>), a sampled segmentation of ``text_col``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_vocabulary(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices((model, alpha), shared, alpha)
        for b in batches:
            for rows, ids, sizes in _sampled(lattices, b, at_text, seed):
                yield pa.RecordBatch.from_arrays([rows, _lists(ids, sizes)], names=["_row", "_pieces"])

    rows, at_text = _rows(docs, id_col), docs.columns.index(text_col)
    done = rows.mapInArrow(run, StructType([rows.schema["_row"], StructField("_pieces", ArrayType(IntegerType()))]))
    return done.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != out_col], F.col("_pieces").alias(out_col))


def decode(df: DataFrame, pieces_col: str = "pieces", out_col: str = "decoded", model: str | None = None) -> DataFrame:
    """``df`` with ``out_col``, the text that ``pieces_col`` spells. Null pieces spell the empty text."""
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(*shared.value)
        for b in batches:
            col = pc.struct_field(b.column(0), at_pieces)
            sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = spelling.texts(col.flatten().to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["_row", "_text"])

    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"))
    at_pieces = df.columns.index(pieces_col)
    done = rows.mapInArrow(run, StructType([rows.schema["_row"], StructField("_text", StringType())]))
    return done.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != out_col], F.col("_text").alias(out_col))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "pieces", decoded_col: str = "decoded", model: str | None = None, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """What ``decode`` makes of ``encode``, in one worker of a task instead of two: rows go there and back once."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_vocabulary(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, spelling = _lattices((model, alpha), shared, alpha), Spelling(*shared.value)
        for b in batches:
            for rows, ids, sizes in _sampled(lattices, b, at_text, seed):
                yield pa.RecordBatch.from_arrays([rows, _lists(ids, sizes), pa.array(spelling.texts(ids, sizes), pa.string())], names=["_row", "_pieces", "_text"])

    rows, at_text = _rows(docs, id_col), docs.columns.index(text_col)
    done = rows.mapInArrow(run, StructType([rows.schema["_row"], StructField("_pieces", ArrayType(IntegerType())), StructField("_text", StringType())]))
    return done.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in (out_col, decoded_col)], F.col("_pieces").alias(out_col), F.col("_text").alias(decoded_col))

"""Language-model scoring by online logistic context mixing, beside a smoothed unigram base.

A text is told bit by bit. Frequent training tokens (by exact counts, at most ``max_head``, which bounds what is
broadcast) and an escape have Huffman codes; every other token is the escape and is then spelled, its bytes in
Huffman codes as well; the end of a text is a token of its own. Each bit is predicted by several tables of counts,
looked up by a hash of a context and of the place in the code:

* tokens: none; the commonest of the sixteen tokens before (which tells the language); the token before; the two before;
* letters of a spelled token: the last 1, 2, 3 and 5 bytes of it.

The predictions are combined in the logistic domain by weights that a gate chooses (which contexts were seen, how
deep the code is), and an adaptive map refines the result. The tables hold the bits of every training token. Weights
and map are learnt online over every bit of every training token too: rows are dealt by a hash of id and text into parts of about PART
tokens, each part moves fresh weights over its rows, in a fixed order, by Newton steps, a token's own occurrence being taken out
of the counts, and the sums of all parts, added up in the order of their numbers, give the model. So scores are a function of the
table, whatever files, tasks or executors there are. The sum over the bits is the
text's log probability; divided by its bytes it gives bits per byte. Word order counts: a token's probability hangs on
those before it.

What is broadcast is bounded by parameters: head tokens and their codes, tables of fixed size. Token counts are not
bounded and stay in Spark: the rare tokens of a document are joined with the table of all tokens, which holds their
counts and, each spelled once, their probability as spelled. Tables are counted per task and added up by segment.

Null and empty texts are one end token. Rows that repeat come back each and count as often as they stand there. A null
id has the remainder of the text "null". A very long text is one array of token numbers in one task, never cut. Ties
of token counts at the end of the head go to the smaller token. Without training rows nothing is known and every bit
costs one bit. An empty table gives an empty table. Only the id and the text are read, so no other column can clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, small_batches

END = ""  # the empty word: the end of a text
ESCAPE = 1  # the symbol of a token that is spelled; END is symbol 0
NEVER = np.int64(1 << 40)
BLOCK = 2048  # symbols that are worked on at once; a step of the weights is made after each block
TOLD = 4096  # the same where nothing is learnt and the result doesn't hang on it
SEGMENT = 1 << 16
UNSEEN = 128  # of a table's bytes: log odds in steps of 1/STEP around it
STEP = 15
STRIDE = 4  # levels of a code whose bits lie side by side in a table, so that one look into memory serves them
LINE_SLOTS = 1 << STRIDE
BUCKETS = 129
LINE = np.linspace(-8, 8, BUCKETS, dtype=np.float32)
_M = np.uint32(0x9E3779B1)

#: Bits of the tables' sizes, for each context.
TOKEN_BITS = (18, 21, 22, 22)
LETTER_BITS = (18, 20, 21, 22)
CONTEXTS = 4
GATES = (1 << CONTEXTS) * 3
_MIDDLES = np.arange(GATES) * BUCKETS + (BUCKETS - 1) // 2  # of each gate's part of the map


# codes


@dataclass(frozen=True)
class Code:
    """Huffman codes: symbol i is told by the bits from ``start[i]`` on, ``size[i]`` of them, in the groups from ``begin[i]`` on:
    STRIDE levels of the tree or what is left of them, below a node which ``roots`` tells by a hash. A bit of ``nodes`` holds its
    group's node, its place below that node (a heap's number), and in the last three places a step of its depth and the bit. Of
    each group, ``tails`` hold the last byte of its first bit, its second and so on, zero where there is none."""

    start: np.ndarray
    size: np.ndarray
    nodes: np.ndarray
    begin: np.ndarray
    roots: np.ndarray
    tails: np.ndarray

    @staticmethod
    def of(weights: np.ndarray) -> Code:
        """Codes for symbols of these weights (two at least); ties go by number, so the tree is settled."""
        n = len(weights)
        heap = [(float(w), i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        for new in range(n, 2 * n - 1):
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b], side[b] = new, new, 1
            heapq.heappush(heap, (wa + wb, new))
        at, rows = np.arange(n), []
        while (up := np.flatnonzero(at != 2 * n - 2)).size:  # all symbols climb one step
            rows.append((up, parent[at[up]] - n, side[at[up]]))
            at[up] = parent[at[up]]
        symbol, node, bit = (np.concatenate([r[k] for r in rows]) for k in range(3))
        order = np.lexsort((-np.arange(len(symbol)), symbol))  # by symbol, from the root down
        size = np.bincount(symbol, minlength=n)
        start = np.cumsum(size) - size
        depth = np.arange(len(order)) - np.repeat(start, size)
        node, bit, within = node[order], bit[order].astype(np.int64), depth % STRIDE
        root, below = node.copy(), np.ones(len(node), np.int64)
        for level in range(1, STRIDE):
            here = np.flatnonzero(within == level)
            root[here], below[here] = root[here - 1], 2 * below[here - 1] + bit[here - 1]
        steps = np.searchsorted([2, 6], depth, side="right") * 2 + bit
        nodes, heads, groups = (root << STRIDE | below) << 3 | steps, np.flatnonzero(within == 0), -(-size // STRIDE)
        tails = np.zeros((STRIDE, len(heads)), np.uint8)
        tails[within, np.cumsum(within == 0) - 1] = nodes & 127
        return Code(start, size, nodes, np.cumsum(groups) - groups, _mixed(root[heads].astype(np.uint32) + np.uint32(1)), tails)


# contexts: arrays of 32-bit hashes, one per symbol


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)


def _before(x: np.ndarray, place: np.ndarray, k: int, nothing: int) -> np.ndarray:
    """``x`` shifted by ``k`` within its text."""
    out = np.full(len(x), nothing, x.dtype)
    out[k:] = np.where(place[k:] >= k, x[: max(len(x) - k, 0)], out[k:])
    return out


def token_contexts(ids: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """``ids``: numbers of head tokens, or below zero a hash of another; ``place``: of each in its text."""
    one, two = _before(ids, place, 1, -1), _before(ids, place, 2, -1)
    common = _before(np.where(ids >= 0, ids, NEVER), place, 1, NEVER)
    for d in (1, 2, 4, 8):  # the least number of the sixteen before is the commonest of them
        common = np.minimum(common, _before(common, place, d, NEVER))
    w1, w2 = _mixed(one.astype(np.uint32)), _mixed(two.astype(np.uint32))
    return [np.zeros(len(ids), np.uint32), _mixed(common.astype(np.uint32) + np.uint32(77)), w1, _mixed(w1 * np.uint32(3) + w2)]


def letter_contexts(raw: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """``raw``: bytes of words; ``place``: of each in its word."""
    h, out = np.zeros(len(raw), np.uint32), []
    for k in range(1, 6):
        h = _mixed(h * np.uint32(31) + _before(raw.astype(np.int64) + 1, place, k, 0).astype(np.uint32))
        if k != 4:
            out.append(h)
    return out


@dataclass(frozen=True)
class Kind:
    """What a stream of symbols is made of."""

    name: str
    contexts: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]
    symbols: Callable[[np.ndarray], np.ndarray]
    bits: tuple[int, ...]

    @property
    def offsets(self) -> np.ndarray:
        return np.cumsum([0, *[1 << b for b in self.bits]])


TOKENS = Kind("tokens", token_contexts, lambda ids: np.where(ids >= 0, ids, ESCAPE), TOKEN_BITS)
LETTERS = Kind("letters", letter_contexts, lambda raw: raw, LETTER_BITS)


@dataclass(frozen=True)
class Spelt:
    """The bits of some symbols: how many each symbol has, its first group, the symbol of each group, a hash of each group, and in
    STRIDE rows the first bit of every group, the second and so on: whether there is one, its place in the group, and its signs
    (the bit, and twice a step of depth)."""

    size: np.ndarray
    first: np.ndarray
    of: np.ndarray
    roots: np.ndarray
    there: np.ndarray
    below: np.ndarray
    signs: np.ndarray

    @staticmethod
    def out(code: Code, s: np.ndarray) -> Spelt:
        size = code.size.take(s)
        groups = (size + STRIDE - 1) // STRIDE
        first = np.cumsum(groups) - groups
        of = np.repeat(np.arange(len(s)), groups)
        group = (code.begin.take(s) - first).take(of, mode="clip")
        group += np.arange(len(group))
        tails = code.tails.take(group, axis=1, mode="clip")
        return Spelt(size, first, of, code.roots.take(group, mode="clip"), tails != 0, (tails >> np.uint8(3)).astype(np.int64), tails & np.uint8(7))

    def slots(self, context: np.ndarray, bits: int) -> np.ndarray:
        """Places in a table of 2 to the power ``bits``: those of a group lie side by side, in an order of its own."""
        x = context.take(self.of, mode="clip")
        x ^= self.roots
        x *= _M
        x >>= np.uint32(32 - bits)
        return self.below ^ x.astype(np.int64)

    def in_order(self, x: np.ndarray) -> np.ndarray:
        """The bits of ``x``, symbol by symbol."""
        return x.T[self.there.T]


def cells_of(kind: Kind, code: Code, values: np.ndarray, place: np.ndarray, block: int = BLOCK) -> Iterator[tuple[slice, Spelt, Iterator[np.ndarray]]]:
    """Block by block: which symbols, their bits, and the bits' slots in each table."""
    symbols, contexts = kind.symbols(values), kind.contexts(values, place)
    for lo in range(0, len(symbols), block):
        part = slice(lo, lo + block)
        spelt = Spelt.out(code, symbols[part])
        yield part, spelt, (spelt.slots(c[part], b) for c, b in zip(contexts, kind.bits, strict=True))


def bits_of(kind: Kind, code: Code, values: np.ndarray, place: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """``cells_of`` bit by bit: which symbols, the number of bits of each, the bits' signs, and their slots in each table."""
    for part, spelt, slots in cells_of(kind, code, values, place):
        yield part, spelt.size, spelt.in_order(spelt.signs), [spelt.in_order(s) for s in slots]


# tables of counts


def log_odds(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Log odds of a one as bytes: UNSEEN where nothing was seen, and there only."""
    q = np.clip(np.rint(np.log((ones + 0.2) / (zeros + 0.2)) * STEP), -127, 127)
    q = np.where((q == 0) & (ones + zeros > 0), 1, q)
    return (q + UNSEEN).astype(np.uint8)


def as_bytes(zeros: np.ndarray, ones: np.ndarray) -> tuple[bytes, bytes]:
    """Of the counts of a segment: log odds, and those without one zero and without one one, side by side."""
    less = np.stack([log_odds(ones, np.maximum(zeros - 1.0, 0)), log_odds(np.maximum(ones - 1.0, 0), zeros)], axis=1)
    return log_odds(ones.astype(float), zeros.astype(float)).tobytes(), less.tobytes()


class Counts:
    """Zeros and ones of every slot, side by side. Symbols are gathered with their contexts: what occurs again is told once, with
    its count, and as contexts come in order the same slots are met one after another."""

    gather = 1 << 19

    def __init__(self, kind: Kind) -> None:
        self.kind, self.of = kind, [np.zeros(2 << b, np.uint32) for b in kind.bits]
        self.keys: list[list[np.ndarray]] = [[] for _ in kind.bits]
        self.times: list[np.ndarray] = []
        self.n = 0

    def add(self, slots: list[np.ndarray], bits: np.ndarray, times: np.ndarray | None) -> None:
        for count, s in zip(self.of, slots, strict=True):
            np.add.at(count, 2 * s + bits, np.uint32(1) if times is None else times.astype(np.uint32))

    def add_symbols(self, code: Code, values: np.ndarray, place: np.ndarray, times: np.ndarray | None) -> None:
        """The bits of these symbols, each ``times``."""
        symbols = self.kind.symbols(values).astype(np.uint64)
        for keys, c in zip(self.keys, self.kind.contexts(values, place), strict=True):
            keys.append(c.astype(np.uint64) << np.uint64(32) | symbols)
        if times is not None:
            self.times.append(times.astype(np.uint32))
        self.n += len(symbols)
        if self.n > self.gather:
            self.settle(code)

    def settle(self, code: Code) -> None:
        times = np.concatenate(self.times) if self.times else None
        for count, keys, b in zip(self.of, self.keys, self.kind.bits, strict=True):
            if not keys:
                continue
            x = np.concatenate(keys)
            keys.clear()
            if times is None:
                x.sort()
            else:
                order = np.argsort(x)
                x = x.take(order)
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            n = np.diff(np.r_[first, len(x)]).astype(np.uint32) if times is None else np.add.reduceat(times.take(order), first, dtype=np.uint32)
            x = x.take(first)
            context, symbols = (x >> np.uint64(32)).astype(np.uint32), (x & np.uint64(0xFFFFFFFF)).astype(np.int64)
            for lo in range(0, len(x), TOLD):
                part = slice(lo, lo + TOLD)
                spelt = Spelt.out(code, symbols[part])
                at = spelt.slots(context[part], b)
                at <<= 1
                at |= spelt.signs & np.uint8(1)
                np.add.at(count, at.ravel(), (n[part].take(spelt.of) * spelt.there).ravel())
        self.times.clear()
        self.n = 0

    def finished(self) -> np.ndarray:
        return np.concatenate(self.of)


# the mixer


@dataclass
class Mixer:
    weights: np.ndarray  # (GATES, contexts + 1): the last is of a constant
    refine: np.ndarray  # (GATES, BUCKETS): probability at each step of log odds

    @staticmethod
    def fresh() -> Mixer:
        weights = np.full((GATES, CONTEXTS + 1), 0.3)
        weights[:, CONTEXTS] = 0
        return Mixer(weights, np.tile(1 / (1 + np.exp(-LINE)), (GATES, 1)))

    def mix(self, st: list[np.ndarray], gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of a one as mixed, and where they lie on the map."""
        w = self.weights.T.astype(np.float32)
        dot, part = w[-1].take(gate, mode="clip"), np.empty(gate.shape, np.float32)
        for k, x in enumerate(st):
            w[k].take(gate, mode="clip", out=part)
            part *= x
            dot += part
        np.clip(dot, -12, 12, out=dot)
        np.clip(dot, -8, 8, out=part)
        part *= np.float32((BUCKETS - 1) / 16)
        at = np.rint(part, out=part).astype(np.int64)
        at += _MIDDLES.take(gate, mode="clip")
        return dot, at

    def predict(self, st: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """Probability of a one: half as mixed, half as the map refines it."""
        dot, at = self.mix(st, gate)
        np.exp(np.negative(dot, out=dot), out=dot)
        dot += 1
        np.divide(np.float32(0.5), dot, out=dot)
        return dot + (self.refine * 0.5).ravel().take(at, mode="clip")


def looked_up(table: np.ndarray, kind: Kind, slots: Iterable[np.ndarray], signs: np.ndarray, itself: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """Log odds of each context and the gate. ``itself``: the table is the one without a bit itself."""
    st, gate, bits = [], signs >> 1 << CONTEXTS, signs & 1
    for k, (s, start) in enumerate(zip(slots, kind.offsets, strict=False)):
        if itself:
            s = s << 1
            s |= bits
        q = table[start << itself : start + (1 << kind.bits[k]) << itself].take(s, mode="clip")
        x = q.astype(np.float32)
        x -= UNSEEN
        x *= np.float32(1 / STEP)
        st.append(x)
        gate += (q != UNSEEN).view(np.uint8) * np.uint8(1 << k)
    return st, gate.astype(np.int64)


class Learner:
    """Online steps of the weights, each block's error against the curvature so far, and sums of the map."""

    def __init__(self) -> None:
        self.mixer, n = Mixer.fresh(), CONTEXTS + 1
        self.curve, self.seen = np.zeros((GATES, n, n)), np.zeros(2 * GATES * BUCKETS)

    def learn(self, st: list[np.ndarray], gate: np.ndarray, bits: np.ndarray, times: np.ndarray | None) -> None:
        """From arrays of any one shape; what is behind the last gate is no bit."""
        # all bits in the order of their gates: what is mixed, and the products of inputs and errors, are matrix products of each
        n, size, gate = len(st) + 1, GATES * BUCKETS, gate.ravel()
        many = np.bincount(gate, minlength=GATES)[:GATES]
        m = many.sum()
        order = np.argsort(gate.astype(np.uint8), kind="stable")[:m]
        spans = [(g, end - k, end) for g, (k, end) in enumerate(zip(many.tolist(), np.cumsum(many).tolist(), strict=True)) if k]
        x, y, dot = np.ones((n, m), np.float32), np.empty((n + 1, m), np.float32), np.empty(m, np.float32)
        for k, one in enumerate(st):
            np.take(one, order, out=x[k], mode="clip")
        weights, slope = self.mixer.weights.astype(np.float32), np.zeros((GATES, n))
        for g, begin, end in spans:
            np.matmul(weights[g], x[:, begin:end], out=dot[begin:end])
        np.clip(dot, -12, 12, out=dot)
        at = np.rint(np.clip(dot, -8, 8) * np.float32((BUCKETS - 1) / 16)).astype(np.int64)
        at += np.repeat(_MIDDLES, many)
        np.exp(np.negative(dot, out=dot), out=dot)
        dot += 1
        p, bits = np.reciprocal(dot, out=dot), bits.take(order, mode="clip")
        err, v = bits.astype(np.float32) - p, p - p * p
        if times is not None:
            times = times.take(order)
            err, v = err * times, v * times
        at <<= 1
        at |= bits
        self.seen += np.bincount(at, times, 2 * size)
        np.multiply(x, v, out=y[:n])
        y[n] = err
        for g, begin, end in spans:
            both = y[:, begin:end] @ x[:, begin:end].T
            self.curve[g] += both[:n]
            slope[g] = both[n]
        met = [g for g, _, _ in spans]
        self.mixer.weights[met] += np.clip(np.linalg.solve(self.curve[met] + 10 * np.eye(n), slope[met, :, None])[:, :, 0], -0.25, 0.25)

    def sums(self) -> np.ndarray:
        seen = self.seen.reshape(-1, 2)
        return np.concatenate([self.curve.ravel(), np.einsum("gij,gj->gi", self.curve, self.mixer.weights).ravel(), seen[:, 1], seen.sum(axis=1)])

    @staticmethod
    def merged(sums: np.ndarray | None) -> Mixer:
        """The model that all tasks' sums lead to; a fresh one where nothing was learnt."""
        fresh = Mixer.fresh()
        if sums is None:
            return fresh
        n = CONTEXTS + 1
        curve, pull, seen = np.split(sums, [GATES * n * n, GATES * n * n + GATES * n])
        weights = np.linalg.solve(curve.reshape(GATES, n, n) + np.eye(n), pull.reshape(GATES, n, 1) + fresh.weights[:, :, None])[:, :, 0]
        ones, total = seen.reshape(2, GATES, BUCKETS)
        return Mixer(weights, ((ones + 2 * fresh.refine) / (total + 2)).astype(np.float32))


def log2_of(kind: Kind, code: Code, table: np.ndarray, mixer: Mixer, values: np.ndarray, place: np.ndarray) -> np.ndarray:
    """log2 of the model's probability of each symbol."""
    out = np.zeros(len(values))
    for part, spelt, slots in cells_of(kind, code, values, place, TOLD):
        p = mixer.predict(*looked_up(table, kind, slots, spelt.signs))
        p -= (spelt.signs & 1) ^ 1  # of a zero: what is left of one
        each = np.log(np.maximum(np.abs(p, out=p), np.float32(1e-12), out=p), out=p)
        each *= spelt.there
        out[part] = np.add.reduceat(sum(each), spelt.first)
    return out / np.log(2)


# streams of symbols out of Arrow batches: values, place of each in its text or word, and how often it counts

Feed = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray | None]]


def _places(lens: np.ndarray) -> np.ndarray:
    return np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)


def fed_tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, None]:
    """Column 0: the token numbers of each text, as a list or as the bytes of 32-bit numbers."""
    x = b.column(0)
    if pa.types.is_list(x.type):
        return x.flatten().to_numpy().astype(np.int64), _places(np.diff(x.offsets.to_numpy())), None
    return np.frombuffer(b"".join(x.to_pylist()), np.int32).astype(np.int64), _places(pc.binary_length(x).to_numpy() // 4), None


def fed_letters(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column 0: words, spelled with a space after each; column 1: their counts."""
    spaced = pc.binary_join_element_wise(b.column(0), "", " ")
    lens, raw = pc.binary_length(spaced).to_numpy().astype(np.int64), np.frombuffer("".join(spaced.to_pylist()).encode(), np.uint8)
    return raw, _places(lens), np.repeat(b.column(1).to_numpy(zero_copy_only=False).astype(np.float32), lens)


SUMS = "all int, x binary"


def told(x: np.ndarray) -> pa.RecordBatch:
    """What a task adds to ``summed_up``."""
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["all", "x"])


def summed_up(parts: DataFrame) -> np.ndarray | None:
    """The sum of all rows' ``x`` (doubles); None of no row."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.zeros(1)
        for b in batches:
            for y in b.column("x"):
                x = x + np.frombuffer(y.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["x"])

    got = parts.groupBy("all").applyInArrow(run, "x binary").first()
    return None if got is None else np.frombuffer(got["x"]).copy()


def count_tables(rows: DataFrame, feed: Feed, kind: Kind, shared: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Count the bits of all rows. Returns the table of log odds, and that without a bit itself."""
    n_slots, context = int(kind.offsets[-1]), rows.sparkSession.sparkContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, counts = shared.value, Counts(kind)
        for b in batches:
            values, place, times = feed(b)
            counts.add_symbols(code, values, place, times)
        counts.settle(code)
        for k, whole in enumerate(x for count in counts.of for x in count.reshape(-1, 2 * SEGMENT)):
            if not whole.any():
                continue
            large = np.flatnonzero(whole > 255).astype(np.int32)  # counts of one byte, and the few that are larger
            parts = whole.astype(np.uint8), large, whole[large] - (whole[large] & 255)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["segment", "low", "at", "more"])

    def add_up(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SEGMENT, np.int64)
        for b in batches:
            for low, at, more in zip(*(b.column(c) for c in ("low", "at", "more")), strict=True):
                total += np.frombuffer(low.as_buffer(), np.uint8)
                total[np.frombuffer(at.as_buffer(), np.int32)] += np.frombuffer(more.as_buffer(), np.uint32)
        plain, less = as_bytes(*total.reshape(SEGMENT, 2).T)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([plain], pa.binary()), pa.array([less], pa.binary())], names=["segment", "plain", "less"])

    counted = rows.coalesce(context.defaultParallelism).mapInArrow(run, "segment int, low binary, at binary, more binary")
    table, less = np.full(n_slots, UNSEEN, np.uint8), np.full(2 * n_slots, UNSEEN, np.uint8)
    for r in counted.groupBy("segment").applyInArrow(add_up, "segment int, plain binary, less binary").toLocalIterator():
        a = r["segment"] * SEGMENT
        table[a : a + SEGMENT] = np.frombuffer(r["plain"], np.uint8)
        less[2 * a : 2 * (a + SEGMENT)] = np.frombuffer(r["less"], np.uint8)
    return table, less


#: Training symbols of a part, about: what one learner goes through on its own.
PART = 1 << 18
#: Symbols that are worked on at once while learning.
HELD = 1 << 15
#: Sums that one task adds up in a round.
FAN_BITS = 6


def in_parts(rows: DataFrame, n_symbols: int, by: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their ``part``, and how many parts there are: both follow from the rows alone, not from files, tasks or
    cluster. Each part is in one task, ordered by ``by``; rows equal in ``by`` are equal for the model."""
    n = max(1, -(-n_symbols // PART))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*by), F.lit(n)))
    return dealt.repartition(partitions(rows.sparkSession), "part").sortWithinPartitions("part", *by), n


def added_in_order(parts: DataFrame, n: int) -> np.ndarray | None:
    """The sum of ``x`` (doubles) of ``n`` parts, in the order of their numbers: 64 in a group, then 64 groups, and so on."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((at, y.as_buffer()) for b in batches for at, y in zip(b.column("at").to_pylist(), b.column("x"), strict=True))
        total = np.zeros(1)
        for _, y in held:
            total = total + np.frombuffer(y)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "x"])

    while n > 1:
        parts = parts.select(F.shiftright("part", FAN_BITS).alias("group"), F.col("part").alias("at"), "x").groupBy("group").applyInArrow(run, "part long, x binary")
        n = -(-n >> FAN_BITS)
    got = parts.first()
    return None if got is None else np.frombuffer(got["x"]).copy()


def learn(rows: DataFrame, feed: Feed, kind: Kind, shared: Broadcast, less: np.ndarray, n_symbols: int, by: list[str]) -> Mixer:
    """Weights and map, online over all rows of each part, then merged. The model is the same however rows are dealt: parts, the
    order within them, the blocks that a learner sees and the order of the sums all follow from the rows."""
    tables = rows.sparkSession.sparkContext.broadcast(less)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, table = shared.value, tables.value
        learner, part, held, size = Learner(), None, [], 0

        def flush() -> None:
            values, place = (np.concatenate([h[k] for h in held]) for k in range(2))
            times = None if held[0][2] is None else np.concatenate([h[2] for h in held])
            for own, spelt, slots in cells_of(kind, code, values, place):
                st, gate = looked_up(table, kind, slots, spelt.signs, True)
                gate[~spelt.there] = GATES
                learner.learn(st, gate, spelt.signs & 1, None if times is None else np.tile(times[own].take(spelt.of), STRIDE))
            held.clear()

        def told_of(part: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([learner.sums().tobytes()], pa.binary())], names=["part", "x"])

        for b in batches:
            parts = b.column("part").to_numpy()
            values, place, times = feed(b)
            starts = np.flatnonzero(place == 0)
            ends, i = np.r_[starts[1:], len(values)], 0
            while i < len(starts):
                if parts[i] != part:
                    if held:
                        flush()
                    if part is not None:
                        yield told_of(part)
                    learner, part, size = Learner(), int(parts[i]), 0
                # rows of this part, up to the one that fills what is held
                j = min(np.searchsorted(parts, part, side="right"), np.searchsorted(ends, starts[i] + HELD - size) + 1)
                own = slice(starts[i], ends[j - 1])
                held.append((values[own], place[own], None if times is None else times[own]))
                size += ends[j - 1] - starts[i]
                if size >= HELD:
                    flush()
                    size = 0
                i = j
        if held:
            flush()
        if part is not None:
            yield told_of(part)

    dealt, n = in_parts(rows, n_symbols, by)
    mixer = Learner.merged(added_in_order(dealt.mapInArrow(run, "part long, x binary"), n))
    tables.unpersist()
    return mixer


# documents


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, in order, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, lens = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    there = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    if not pc.all(there).as_py():
        lens = np.diff(np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))][np.r_[0, np.cumsum(lens)]])
        words = words.filter(there)
    return words, lens


def count_words(texts: DataFrame, most: int = 3_000_000) -> DataFrame:
    """``word`` and ``c``, its count in rows where ``train``; words of other rows are there with what they have (zero). The
    empty word is the end of a text. Tasks add up ``most`` words before they hand on what they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[pa.Array], list[pa.Array]] = ([], [])

        def met() -> Iterator[pa.RecordBatch]:
            for train in (0, 1):
                counted = pa.chunked_array(held[train], pa.string()).value_counts()
                n = counted.field("counts") if train else pa.array(np.zeros(len(counted), np.int64))
                yield pa.RecordBatch.from_arrays([counted.field("values"), n], names=["word", "c"])
                held[train].clear()

        n = 0
        for b in batches:
            for train in (0, 1):
                texts = b.column(1).filter(b.column(0) if train else pc.invert(b.column(0)))
                words, _ = words_of(texts)
                held[train].extend([words, pa.array([END] * len(texts), pa.string())])
                n += len(words)
            if n > most:
                yield from met()
                n = 0
        yield from met()

    return texts.select("train", "text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def number(texts: DataFrame, id_col: str, words: Broadcast) -> DataFrame:
    """Per row: ``rid``, the id, ``train``, ``n_bytes``, ``ids`` (token numbers in order, below zero a hash of another token, as
    bytes of 32-bit numbers: nothing in Spark looks at one of them), ``rest`` and ``n``: other tokens and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = pa.array(words.value, pa.string())
        for b in batches:
            found, lens = words_of(b.column(3))
            known = pc.index_in(found, value_set=head)
            own = pc.fill_null(known, 0).to_numpy().copy()
            other = known.is_null().to_numpy(zero_copy_only=False)
            rest = found.filter(pa.array(other)).dictionary_encode()
            codes, hashes = rest.indices.to_numpy().astype(np.int64), np.fromiter((-1 - (crc32(w.as_buffer()) & 0x7FFFFFFF) for w in rest.dictionary), np.int32, len(rest.dictionary))
            own[other] = hashes[codes]
            row = np.repeat(np.arange(len(lens)), lens)
            distinct, n = np.unique(row[other] * max(len(hashes), 1) + codes, return_counts=True)
            n_rest = np.bincount(distinct // max(len(hashes), 1), minlength=len(lens))
            ends = np.cumsum(lens)
            lists = pa.array(np.r_[0, np.cumsum(n_rest)].astype(np.int32))
            ids, stops = np.insert(own, ends, 0).astype(np.int32).tobytes(), (4 * np.cumsum(lens + 1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pc.fill_null(pc.binary_length(b.column(3)), 0).cast(pa.int64()), pa.array([ids[a:z] for a, z in zip([0, *stops], stops, strict=False)], pa.binary()),
                 pa.ListArray.from_arrays(lists, rest.dictionary.take(pa.array(distinct % max(len(hashes), 1)))), pa.ListArray.from_arrays(lists, pa.array(n.astype(np.int32)))],
                names=["rid", id_col, "train", "n_bytes", "ids", "rest", "n"],
            )

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.select("rid", id_col, "train", "text").mapInArrow(run, f"rid long, `{id_col}` {kind}, train boolean, n_bytes long, ids binary, rest array<string>, n array<int>")


def byte_counts(rare: DataFrame) -> np.ndarray:
    """How often each byte is spelled in rare training tokens, and one more of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256)
        for b in batches:
            raw, _, times = fed_letters(b)
            total += np.bincount(raw, times, 256)
        yield told(total)

    sums = summed_up(rare.mapInArrow(run, SUMS))
    return np.ones(256) if sums is None else sums + 1


def in_steps(x: Column, bits: int = 36) -> Column:
    """The sum of ``x``, the same in whatever order rows come: whole parts, and what is left in steps of 2 to the power -``bits``,
    are added up as whole numbers."""
    whole = F.floor(x)
    return F.sum(whole) + F.sum(F.rint((x - whole) * float(1 << bits)).cast("long")) / float(1 << bits)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, max_head: int = 1 << 16) -> DataFrame:
    """Per row of ``docs``: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    small_batches(spark)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    train: Column = F.crc32(name.cast("binary")) % folds != held_out
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col), train.alias("train"), F.col(text_col).alias("text"))

    # the head: END, the escape, and the commonest tokens of all training rows
    vocabulary = materialize(count_words(texts))
    told = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.max(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    n_train, n_distinct = int(told["n"]), int(told["v"])
    real = vocabulary.where(F.col("word") != END)
    top = real.where("c > 1").orderBy(F.desc("c"), "word").limit(max_head - 2).toArrow()
    words, counts = [END, " ", *top.column(0).to_pylist()], top.column(1).to_numpy().astype(np.int64)
    n_ends = int(told["ends"] or 0)
    least = (int(counts[-1]), words[-1]) if len(counts) else (1 << 62, "")
    rare = real.where((F.col("c") < least[0]) | (F.col("c") == least[0]) & (F.col("word") > F.lit(least[1])))
    head_counts = np.r_[n_ends, 0, counts]
    weights = head_counts + 1.0
    weights[ESCAPE] = max(n_train - head_counts.sum(), 0) + 1.0
    code, listed = context.broadcast(Code.of(weights)), context.broadcast(words)
    dealt = materialize(number(texts, id_col, listed))

    # tokens, then letters: count, learn
    taught = dealt.where("train").select("ids", F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "ids").alias("row"))
    table, less = count_tables(taught, fed_tokens, TOKENS, code)
    token_model = context.broadcast((table, learn(taught, fed_tokens, TOKENS, code, less, n_train, ["row"])))
    spelled = rare.where("c > 0").select("word", "c")
    spelt_bytes = byte_counts(spelled)
    n_spelled = int(spelled.agg(F.coalesce(F.sum(F.octet_length("word") + 1), F.lit(0))).first()[0])
    letter_code = context.broadcast(Code.of(spelt_bytes))
    table, less = count_tables(spelled, fed_letters, LETTERS, letter_code)
    letter_model = context.broadcast((table, learn(spelled, fed_letters, LETTERS, letter_code, less, n_spelled, ["word"])))
    del table, less
    head = context.broadcast(head_counts)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, place, _ = fed_letters(b)
            if len(raw):
                own = log2_of(LETTERS, letter_code.value, *letter_model.value, raw, place)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.add.reduceat(own, np.flatnonzero(place == 0)))], names=["word", "c", "bits"])

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = head.value
        base = np.log10(c + 0.5)
        for b in batches:
            ids, place, _ = fed_tokens(b)
            if len(ids):
                first, known = np.flatnonzero(place == 0), np.maximum(ids, 0)
                own = log2_of(TOKENS, code.value, *token_model.value, ids, place)
                sums = [np.add.reduceat(x, first) for x in (own, np.where(ids >= 0, base[known], 0.0), ((ids >= 0) & (c[known] > 0)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.diff(np.r_[first, len(ids)])), *map(pa.array, sums)], names=["rid", id_col, "train", "n_bytes", "n_tokens", "bits", "base", "known"])

    # rare tokens: a join with the table of all of them
    spelt = rare.mapInArrow(spell, "word string, c long, bits double")
    met = dealt.select("rid", F.explode(F.arrays_zip("rest", "n")).alias("x")).select("rid", F.col("x.rest").alias("word"), F.col("x.n").alias("n"))
    tail = met.join(spelt, "word").groupBy("rid").agg(
        # whole numbers add up to the same sum in any order
        in_steps(F.col("n") * F.col("bits")).alias("t_bits"), in_steps(F.col("n") * F.log10(F.col("c") + 0.5)).alias("t_base"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("t_known")
    )
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = dealt.select("ids", "rid", id_col, "train", "n_bytes").mapInArrow(score_rows, f"rid long, `{id_col}` {kind}, train boolean, n_bytes long, n_tokens long, bits double, base double, known long")
    bits = F.col("bits") + F.coalesce("t_bits", F.lit(0.0))
    log_total = float(np.log10(n_train + 0.5 * (n_distinct + 1)))
    return rows.join(tail, "rid", "left").select(
        F.col(id_col), (~F.col("train")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("t_known", F.lit(0))).cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("t_base", F.lit(0.0)) - F.col("n_tokens") * log_total).alias("base_score"), (bits * float(np.log10(2))).alias("score"), (-bits / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

"""SimHash near-dedup by segment popcounts.

A fingerprint of 64 bits is mapped to the bit counts of its 2-bit segments. The Manhattan distance of two
such vectors never exceeds the Hamming distance of the fingerprints, so fingerprints within ``max_bits``
lie within that distance in the grid of bit counts too. The range join on the grid works by groups of
coordinates: with ``max_bits`` + 3 groups, two vectors within range agree wholly on at least three of
them, so each fingerprint is filed under every choice of three groups and meets there all it can link to.
Then the Manhattan bound and the Hamming distance itself are checked.

Work is done once per distinct fingerprint. A cell that holds more than ``block`` of them is cut into
blocks, and pairs of blocks are compared in tasks of their own, so no task sees an unbounded cell and no
pair is skipped. A task returns only edges that join two trees it has not joined yet.

Null and wordless texts have fingerprint zero. A very long text is hashed in parts, never cut. Ids may be of any ordered
type; ties don't arise, as a component is named by its smallest id. Repeated rows come back each. An empty table gives an
empty table. Only the id and the text are read, so no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import materialize, partitions, small_batches
from .components import connected_components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
CHUNK = 100_000


def fingerprint(text: str | bytes | None, width: int = SHINGLE) -> int:
    """Fingerprint of one text: 64 majority votes over its shingles; 0 without words."""
    raw = (text.encode() if isinstance(text, str) else text or b"").lower().split()
    n = len(raw)
    if not n:
        return 0
    joined, digest = b" ".join(raw), xxhash.xxh64_intdigest
    if n <= width:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in raw]).tolist()
    starts = [0, *ends]
    votes = np.zeros(64, np.int64)
    count = n - width + 1
    for at in range(0, count, CHUNK):
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts[at : min(at + CHUNK, count)], ends[at + width - 1 :], strict=False)], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count).tobytes(), "big")


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_fp`` (bigint, the fingerprint's bits) per row."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("_id"), _fingerprints(F.col(text_col).cast("binary")).alias("_fp"))


def popcounts(fps: np.ndarray) -> np.ndarray:
    """The grid point of each fingerprint: 2-bit fields holding the bit counts (0 to 2) of its 32 segments."""
    x = fps.view(np.uint64)
    odd = np.uint64(0x5555555555555555)
    return (x & odd) + ((x >> np.uint64(1)) & odd)


def manhattan(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of grid points. A 2-bit field holds 0, 1 or 2; spread to 4 bits, p + 2 - q is 0 to 4 in each, and how far
    from 2 it is is told by its bits: 2 is none, 1 and 3 are one, 0 and 4 are two."""
    low, two, total = np.uint64(0x3333333333333333), np.uint64(0x2222222222222222), np.zeros(len(p), np.uint8)
    for k in (0, 2):
        s = np.uint64(k)
        d = ((p >> s) & low) + two - ((q >> s) & low)
        one = d & np.uint64(0x1111111111111111)
        far = ~(d | d >> np.uint64(1)) & ~(d >> np.uint64(2)) & np.uint64(0x1111111111111111)  # 0
        four = d >> np.uint64(2) & np.uint64(0x1111111111111111)
        total += np.bitwise_count(one) + np.uint8(2) * (np.bitwise_count(far) + np.bitwise_count(four))
    return total


def group_masks(max_bits: int) -> list[int]:
    """Masks over the 32 fields: every choice of three of ``max_bits`` + 3 groups of fields."""
    groups = np.array_split(np.arange(32), max_bits + 3)
    masks = [sum(3 << int(2 * k) for k in g) for g in groups]
    return [sum(masks[i] for i in chosen) for chosen in combinations(range(len(masks)), 3)]


class _Forest:
    """Union-find over the fingerprints of one cell or pair of blocks."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs link: those within the bound in the grid, then by the fingerprints themselves."""
    near = np.flatnonzero(manhattan(popcounts(x), popcounts(y)) <= max_bits)
    return near[np.bitwise_count(x[near] ^ y[near]) <= max_bits]


def _cell_edges(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> Iterator[tuple[int, int]]:
    """Forest edges within ``left`` (right None) or between two blocks; rows are compared one against all, in the grid first."""
    all_of = left if right is None else np.concatenate([left, right])
    grid, forest, n = popcounts(all_of), _Forest(len(all_of)), len(left)
    for i in range(n):
        first = i + 1 if right is None else n
        found = first + np.flatnonzero(manhattan(grid[first:], grid[i : i + 1]) <= max_bits)
        for j in found[np.bitwise_count(all_of[found] ^ all_of[i]) <= max_bits].tolist():
            if forest.join(i, j):
                yield int(all_of[i]), int(all_of[j])


def _edges_of_cells(max_bits: int, small: int = 64):
    """Over rows sorted by (cell, side): edges of each cell. Small cells are compared together by shifts."""

    def of_many(cells: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, d = [(fps[:0], fps[:0])], 1
        while d < len(cells):
            same = np.flatnonzero(cells[:-d] == cells[d:])
            if not len(same):
                break
            x, y = fps[same], fps[same + d]
            near = _near(x, y, max_bits)
            out.append((x[near], y[near]))
            d += 1
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def finish(cells: np.ndarray, sides: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        sizes = np.diff(np.r_[starts, len(cells)])
        plain = np.repeat((sizes <= small), sizes) & np.repeat(np.maximum.reduceat(sides, starts) == 0, sizes)
        a, b = of_many(cells[plain], fps[plain])
        more: list[tuple[int, int]] = []
        for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
            if not plain[s]:
                f, side = fps[s : s + n], sides[s : s + n]
                more += _cell_edges(f, None, max_bits) if not side.any() else _cell_edges(f[side == 1], f[side == 2], max_bits)
        a = np.concatenate([a.view(np.int64), np.array([x for x, _ in more], np.uint64).view(np.int64)])
        b = np.concatenate([b.view(np.int64), np.array([y for _, y in more], np.uint64).view(np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.uint64)]
        for x in batches:
            cells, sides, fps = (x.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            now = [np.concatenate([r, y]) for r, y in zip(rest, (cells, sides, fps.view(np.uint64)), strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last cell may go on
            if cut:
                yield finish(*[y[:cut] for y in now])
            rest = [y[cut:] for y in now]
        if len(rest[0]):
            yield finish(*rest)

    return run


def near_edges(fps: DataFrame, max_bits: int = MAX_BITS, block: int = 2048) -> DataFrame:
    """``fps``: distinct ``fp`` (bigint). Edges ``a``, ``b`` whose components are those of all pairs within ``max_bits``."""
    spark, masks = fps.sparkSession, group_masks(max_bits)

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            grid = popcounts(x)
            for k, mask in enumerate(masks):
                key = ((grid & np.uint64(mask)) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)  # mixed, so that cells spread; two cells that meet only add pairs to check
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(x.view(np.int64))], names=["cell", "fp"])

    filed = fps.mapInArrow(cells_of, "cell long, fp long")
    sizes = materialize(filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").where(F.col("n") > block).withColumn("k", F.ceil(F.col("n") / block).cast("int")).select("cell", "k"))
    n = partitions(spark)
    big = filed.join(sizes, "cell")
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("k")).cast("int")
    other = F.sequence(F.lit(0), F.col("k") - 1)
    paired = big.withColumn("i", own).withColumn("j", F.explode(other)).select(
        F.xxhash64("cell", F.least("i", "j"), F.greatest("i", "j")).alias("cell"),
        F.when(F.col("i") == F.col("j"), 0).when(F.col("i") < F.col("j"), 1).otherwise(2).cast("byte").alias("side"), "fp",
    )
    plain = filed.join(sizes, "cell", "left_anti").select("cell", F.lit(0).cast("byte").alias("side"), "fp")
    dealt = plain.union(paired).repartition(n, "cell").sortWithinPartitions("cell", "side", "fp")
    return dealt.mapInArrow(_edges_of_cells(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``, the smallest id
    reachable over links of ``max_bits`` or fewer differing bits, itself included.

    Null and wordless texts have fingerprint zero and link like others. Repeated rows each come back. A null
    id never names a component unless all ids of it are null."""
    rows = materialize(with_fingerprints(docs, id_col, text_col))
    nodes = materialize(rows.groupBy("_fp").agg(F.min("_id").alias("least")))
    roots = connected_components(near_edges(nodes.select(F.col("_fp").alias("fp")), max_bits))
    labelled = nodes.join(roots, nodes["_fp"] == roots["node"], "left").select("_fp", "least", F.coalesce("root", "_fp").alias("root"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(named, "root").select("_fp", "component_id")
    hex16 = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return rows.join(classes, "_fp").select(F.col("_id").alias(id_col), hex16.alias("fingerprint"), "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id. Rows with a null id have no
    representative to be told by and stay; rows that repeat the representative's id stay with it.

    The ids that go are settled and written first, so texts meet nothing but their own id."""
    groups = near_duplicates(docs.where(F.col(id_col).isNotNull()), id_col, text_col, max_bits)
    gone = materialize(groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct())
    return docs.join(gone.hint("shuffle_hash"), docs[id_col] == gone["_gone"], "left_anti")

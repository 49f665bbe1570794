"""Line dedup, substring dedup, SimHash and decontamination against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusprep.llm import decontaminate, line_dedup, simhash, substring_dedup
from corpusprep.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, row string"


def frame(spark, texts, schema=DOCS):
    """Documents with an extra column whose name clashes with a working name."""
    return spark.createDataFrame([(i, t, "en", "extra") for i, t in texts], schema)


ODD = [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "\n\n \n"), (5, "long " * 5000)]


# line dedup


def lines_by_hand(texts, min_docs):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    seen = defaultdict(set)
    for i, t in texts:
        for line in (t or "").split("\n"):
            seen[key(line)].add((i, t))
    gone = {k for k, d in seen.items() if k and len(d) >= min_docs}
    return sorted((str(i), len((t or "").split("\n")), sum(key(x) in gone for x in (t or "").split("\n")), "\n".join(x for x in (t or "").split("\n") if key(x) not in gone)) for i, t in texts)


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_line_dedup(spark, min_docs):
    rng = random.Random(min_docs)
    pool = ["Alpha", " alpha\t", "ALPHA", "beta", "Éa", "éa", "", " ", "\x0bgamma ", "delta"]
    texts = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(25)] + ODD
    got = line_dedup.line_dedup(frame(spark, texts), min_docs=min_docs)
    assert got.columns == ["doc_id", "text", "lang", "row", "n_lines", "n_dropped", "kept"]
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got.collect()) == lines_by_hand(texts, min_docs)


def test_line_dedup_bitmaps(spark):
    keep = line_dedup.keep_bitmaps(frame(spark, [(1, "a\nb\na\nc"), (2, "a")]), min_docs=2).orderBy("_id").collect()
    assert [[(r.start, r.len) for r in x.keep] for x in keep] == [[(1, 1), (3, 1)], []]
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


# substring dedup


def repeats_by_hand(texts, length):
    words = [(i, (t or "").encode().split()) for i, t in texts]
    seen = Counter(tuple(w[k : k + length]) for _, w in words for k in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - length + 1) if seen[tuple(w[k : k + length])] > 1 for j in range(length)}
        out.append((str(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def corpus(rng, n, vocabulary):
    passage = [[rng.choice(vocabulary) for _ in range(rng.randint(20, 60))] for _ in range(3)]
    out = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            p = rng.choice(passage)
            a = rng.randint(0, 10)
            w = w[:30] + p[a:] + w[30:]
        out.append((i, rng.choice((" ", "\n", "\t")).join(w)))
    return out


@pytest.mark.parametrize(("seed", "vocabulary", "length", "anchor", "max_shard"), [(0, 500, 12, 5, 512), (1, 3, 8, 3, 512), (2, 2, 10, 4, 3), (3, 1, 7, 3, 2), (4, 40, 35, 12, 4)])
def test_substring_dedup(spark, monkeypatch, seed, vocabulary, length, anchor, max_shard):
    monkeypatch.setattr(substring_dedup, "HOT", (1000, 1, 20)[seed % 3])  # all keys hot, none, some
    rng = random.Random(seed)
    texts = corpus(rng, 30, [f"w{k}" for k in range(vocabulary)]) + [x for x in ODD if vocabulary > 1]
    got = substring_dedup.remove_repeats(frame(spark, texts), length=length, anchor=anchor, max_shard=max_shard)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got.collect()) == repeats_by_hand(texts, length)


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    got = substring_dedup.remove_repeats(frame(spark, ODD[:5]).withColumn("kept", F.lit("mine")))
    assert got.columns == ["doc_id", "text", "lang", "row", "n_words", "n_removed", "kept"] and {r.n_removed for r in got.collect()} == {0}


def test_suffix_automaton():
    rng = random.Random(5)
    for _ in range(30):
        parts = [(b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randint(4, 14))), rng.randint(1, 2)) for _ in range(4)]
        seen = Counter()
        for t, times in parts:
            w = t.split()
            for k in range(len(w) - 3):
                seen[tuple(w[k : k + 4])] += times
        for (t, _), flags in zip(parts, substring_dedup.repeated_windows(parts, 4), strict=True):
            w = t.split()
            assert flags == [seen[tuple(w[k : k + 4])] > 1 for k in range(len(w) - 3)]


# SimHash


def fingerprint_by_hand(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def components_by_hand(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    rng = random.Random(1)
    for _ in range(30):
        t = " ".join(rng.choice(["One", "two", "THREE", "é"]) for _ in range(rng.randint(0, 12)))
        assert simhash.fingerprint(t) == fingerprint_by_hand(t)


def test_spark_has_the_same_hash(spark):
    got = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_bound():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    assert (simhash.manhattan(simhash.popcounts(x), simhash.popcounts(y)) <= np.bitwise_count(x ^ y)).all()
    z = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    counts = lambda v: np.array([[bin(int(f) >> k & 3).count("1") for k in range(0, 64, 2)] for f in v])
    assert (simhash.manhattan(simhash.popcounts(x), simhash.popcounts(z)) == np.abs(counts(x) - counts(z)).sum(1)).all()


@pytest.mark.parametrize("block", [4, 2048])
def test_near_edges(spark, block):
    """Clouds of near fingerprints: the same components as all pairs, also when cells are cut into blocks."""
    rng = np.random.default_rng(block)
    fps = set()
    for _ in range(12):
        c = int(rng.integers(0, 2**63))
        for _ in range(20):
            fps.add(c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(0, 5))))))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_edges(df, 4, block).collect()]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in got)
    want = [(a, b) for k, a in enumerate(fps) for b in fps[k + 1 :] if bin(a ^ b).count("1") <= 4]
    assert components_by_hand(got, fps) == components_by_hand(want, fps)


def test_near_duplicates(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(80)) for _ in range(6)]
    texts = [(i, (lambda w: " ".join(w[:k] + ["changed"] + w[k + 1 :]) if i % 3 else " ".join(w))(base[i % 6].split())) for i in range(24) for k in [rng.randint(0, 79)]]
    texts += [(100, None), (101, ""), (102, "  "), (7, texts[7][1])]
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    fps = {i: fingerprint_by_hand(t) for i, t in texts}
    ids = sorted(fps)
    want = components_by_hand([(a, b) for a in ids for b in ids if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4], ids)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{fps[i]:016x}", want[i]) for i, _ in texts)
    kept = simhash.dedup(frame(spark, texts + [(None, "x")]))
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None}
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 90), (200, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90, 105: 90}


# decontamination


def contaminated_by_hand(texts, items, width=10):
    import re

    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if w]
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k : k + width])].add(str(i))
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for g, ids in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= ids
        out.append((str(i), len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_decontamination(spark, limit):
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "beta", "g4mma", "élan", "É", "x"])
    items = [(k, ", ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for k in range(9)] + [(20, None), (21, ""), (3, "dup"), (5, "rare rare2 rare3 rare4")]
    texts = [(i, "-".join(word() for _ in range(rng.randint(0, 40))) + " " + (items[i % 9][1] or "")) for i in range(100, 120)] + ODD
    df, it = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(df, it, max_broadcast=limit)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids)) for r in got.collect()) == contaminated_by_hand(texts, items)
    clean = decontaminate.decontaminate(df, it)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(i for i, _, n, _ in contaminated_by_hand(texts, items) if n == 0)
    cut = {str(r.doc_id): r.text for r in decontaminate.decontaminate(df, it, mode="spans").collect()}
    assert cut["2"] == "" and all(len((cut[i] or "").split()) == n - h for i, n, h, _ in contaminated_by_hand(texts, items) if h)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_decontamination_of_a_very_long_text(spark, limit):
    """200,000 words with 2,000 passages, in seconds on either way."""
    import time

    item = [f"q{k}" for k in range(12)]
    w = [f"w{k % 977}" for k in range(200_000)]
    for k in range(0, 200_000, 100):
        w[k : k + 12] = item
    docs = frame(spark, [(1, " ".join(w)), (2, " ".join(item))])
    began = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, len(r.hits)) for r in decontaminate.find_contamination(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), max_broadcast=limit).collect()}
    assert got == {1: (200_000, 24_000, 2000), 2: (12, 12, 1)}
    assert time.time() - began < 60
    cut = decontaminate.decontaminate(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), mode="spans")
    assert {r.doc_id: len(r.text.split()) for r in cut.collect()} == {1: 176_000, 2: 0}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_items_with_a_common_beginning_cost_no_more(spark, limit):
    """Questions that begin alike, in texts that are full of that beginning: nothing is looked up by the beginning alone."""
    import time

    text = " ".join(f"which of the x{k % 50}" for k in range(10_000))
    docs = frame(spark, [(1, text), (2, "which of the " + " ".join(f"y{k}" for k in range(7)) + " end")])

    def took(n):
        items = spark.range(n).select(F.col("id").alias("item_id"), F.concat(F.lit("which of the y0 y1 y2 y3 y4 y5 y"), (F.col("id") + 6).cast("string")).alias("text"))
        began = time.time()
        got = {r.doc_id: (r.n_hit, list(r.item_ids)) for r in decontaminate.find_contamination(docs, items, max_broadcast=limit).collect()}
        assert got == {1: (0, []), 2: (10, ["0"])}
        return time.time() - began

    took(10)
    few, many = took(2000), took(32_000)
    assert many < 2 * few + 15


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_a_window_of_many_items(spark, limit):
    items = spark.range(3000).select(F.col("id").alias("item_id"), F.lit("a b c d e f g h i j").alias("text"))
    docs = frame(spark, [(k, "a b c d e f g h i j " * 20) for k in range(5)])
    got = decontaminate.find_contamination(docs, items, max_broadcast=limit).collect()
    assert len(got) == 5 and all(len(r.item_ids) == 3000 and r.n_hit == 200 for r in got)


def test_window_hashes(spark):
    """Equal windows have equal hashes wherever they stand, others have others; the sieve lets all windows pass."""
    rng = random.Random(11)
    w = [rng.choice("abc") for _ in range(400)]
    for k in (1, 2, 3, 7, 10):
        h = spark.createDataFrame([(w,)], "w array<string>").select(decontaminate._window_hashes(F.col("w"), k)).first()[0][: len(w) - k + 1]
        seen = {}
        for i, x in enumerate(h):
            assert seen.setdefault(x, w[i : i + k]) == w[i : i + k]
        assert len(set(h)) == len({tuple(w[i : i + k]) for i in range(len(h))})
    windows = spark.createDataFrame([([f"w{i}", f"v{i % 7}"],) for i in range(500)], "window array<string>")
    passes = decontaminate._sieve(windows, [2])
    assert windows.where(passes(decontaminate._hash_of(F.col("window"), [2]))).count() == 500
    assert spark.range(20_000).where(passes(F.xxhash64("id"))).count() < 20_000 / decontaminate.SIEVE * 2


def test_decontamination_without_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(frame(spark, ODD), none).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(frame(spark, []), none).count() == 0


def test_kept_hash_is_of_utf8(spark):
    r = spark.createDataFrame([("é\n",)], "t string").select(F.sha2(F.col("t").cast("binary"), 256)).first()
    assert r[0] == hashlib.sha256("é\n".encode()).hexdigest()

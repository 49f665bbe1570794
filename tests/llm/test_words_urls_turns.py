"""Spelling variants, URL filters and conversation repair against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import conversations, spelling, url_filter

# spelling variants


def near_by_hand(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(count, ratio=5):
    out = {}
    for w, n in count.items():
        near = [x for x in count if x != w and near_by_hand(w, x)]
        best = min(near, key=lambda x: (-count[x], x), default=None)
        out[w] = (n, len(near), best if best is not None and count[best] >= ratio * n else None)
    root = lambda w: w if out[w][2] is None else root(out[w][2])
    return {w: (n, k, f, count[f] if f else None, root(w)) for w, (n, k, f) in out.items()}


def words_by_hand(texts, min_chars=6, min_count=5):
    count = Counter()
    for i, t in texts:
        run = ""
        for c in [*(t or ""), " "]:
            if "a" <= c <= "z" or "A" <= c <= "Z" or "\u00c0" <= c <= "\u00ff":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
                word = run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]
                count[word] += len(word) >= min_chars
                run = ""
    return {w: n for w, n in count.items() if n >= min_count}


@pytest.mark.parametrize("seed", range(4))
def test_variants(spark, seed):
    rng = random.Random(seed)
    count = {"".join(rng.choice("aab" if seed % 2 else "abcdé") for _ in range(rng.randint(3, 6))): rng.choice([1, 1, 2, 5, 6, 25, 30, 125]) for _ in range(150)}
    got = spelling.group_variants(spark.createDataFrame(list(count.items()), "word string, n long"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()} == variants_by_hand(count)


def test_every_pair_is_met_once(spark):
    count = {"aaaa": 1, "aaa": 1, "baaa": 1, "aaab": 1, "abaa": 1, "aaaaa": 9}
    got = {r.word: r.n_near for r in spelling.neighbours(spark.createDataFrame(list(count.items()), "word string, n long")).collect()}
    assert got == {w: sum(near_by_hand(w, x) for x in count if x != w) for w in count}


def test_chain_of_forms_is_followed(spark):
    chain = [("aaaaaa", 1), ("baaaaa", 5), ("bbaaaa", 25), ("bbbaaa", 125), ("bbbbaa", 625), ("bbbbba", 3125)]
    assert {r.root for r in spelling.group_variants(spark.createDataFrame(chain, "word string, n long")).collect()} == {"bbbbba"}


def test_words_of_texts(spark):
    rng = random.Random(5)
    pool = ["planet", "Planet", "plañet", "PLÀNET", "short", "planets", "xplanet", "gardening", "ÉCOLES", "a×b÷cdef"]
    texts = [(i, " ".join(rng.choice(pool) for _ in range(60))) for i in range(40)] + [(None, "planet " * 300), (7, None), (8, ""), (9, "1 2 -"), (3, "planet"), (3, "planet"), (10, "x" * 30000 + " gardening")]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in texts], "doc_id long, text string, n int, word string")
    want = words_by_hand(texts)
    assert any(w not in {x.lower() for x in pool} for w in want) or len(want) > 5
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == want
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(docs).collect()} == variants_by_hand(want)
    assert spelling.spelling_variants(docs.where("false")).count() == 0


def test_rotations_are_dealt_once(spark):
    words = spark.createDataFrame([("planet", 5)], "word string, n long")
    plan = spelling.neighbours(words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1, "windows reuse the ranges; the other exchange adds up by word"


# URL filters


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[k:]
    j = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k]), path[:j]


def judged_by_hand(url, rules, default="allow"):
    host, path = url_parts(url)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, *((best[3], best[2]) if best else (None, default))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("org", "", "block"), ("a.org", "/x", "allow"), ("a.org", "/x/y/z", "block"), ("a.org", "/x/y", "allow"), ("", "/q", "block"), ("example.com", "/en/", "allow")]


def urls(rng, n):
    host = lambda: ".".join(rng.choice(["www", "a", "example", "com", "org", "net", "Ex", "", "m"]) for _ in range(rng.randint(1, 5)))
    path = lambda: "".join(rng.choice(["/", "/en/", "/x", "/x/y", "/z", "/es/", "", "/q", "é"]) for _ in range(rng.randint(0, 4)))
    return [f"{rng.choice(['http', 'HTTPS', ''])}://{host()}{path()}{rng.choice(['', '?a=/en/', '#x://y', '?'])}" for _ in range(n)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_url_filter(spark, partitions):
    rng = random.Random(1)
    given = urls(rng, 600) + [None, "", "no scheme", "://", "http://", "http://com", "http://x.com.", "http://" + "a." * 3000 + "org/x/y", "http://www.example.com/en/1"] + ["http://hot.example.com/en/1"] * 400
    rows = [(i, u, "r", "rule", 3) for i, u in enumerate(given)]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, rule string, n int")
    once = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = url_filter.filter_urls(pages, url_filter.rules_of(spark, RULES))
        assert got.columns == ["page_id", "url", "key", "n", "host", "path", "rule", "verdict"]
        rules = [r for r in RULES if r != ("example.com", "/en/", "allow")]
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: judged_by_hand(u, rules) for i, u in enumerate(given)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", once)


def test_url_filter_with_many_rules(spark):
    rng = random.Random(2)
    rules = list({(h, p): (h, p, v) for h, p, v in ((rng.choice(["com", "a.com", "b.a.com", "org", "x.org", "a.x.org"]), "/" + "/".join(rng.choice("xyz") for _ in range(rng.randint(0, 4))), rng.choice(["allow", "block"])) for _ in range(300))}.values())
    given = [f"http://{rng.choice(['', 'w.', 'b.', 'a.b.'])}{rng.choice(['com', 'a.com', 'b.a.com', 'org', 'x.org', 'a.x.org', 'net'])}/" + "/".join(rng.choice("xyzw") for _ in range(rng.randint(0, 5))) for _ in range(800)]
    got = url_filter.filter_urls(spark.createDataFrame(list(enumerate(given)), "page_id long, url string"), url_filter.rules_of(spark, rules), default="none")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: judged_by_hand(u, rules, "none") for i, u in enumerate(given)}


def test_url_filter_of_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    none = url_filter.rules_of(spark, RULES).where("false")
    assert [r.verdict for r in url_filter.filter_urls(pages, none, default="block").collect()] == ["block"] * 3
    assert url_filter.filter_urls(pages.where("false"), url_filter.rules_of(spark, RULES)).count() == 0
    plan = url_filter.filter_urls(pages, none)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# conversations

ORDER = {"D": 0, "I": 1, "K": 2, "R": 3}


def faults_by_hand(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired_by_hand(rows):
    """Dijkstra over (row, state) with whole audits, insertions one at a time."""
    faults = faults_by_hand(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {(0, ""): (0, "", ())}
    names = {"u": "user", "a": "assistant"}
    import heapq

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        best[i, state] = (cost, audit, out)
        for c in "ua":
            if (state, c) in step:
                heapq.heappush(heap, (cost + 2, audit + "I", i, c, (*out, f"{names[c]}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                if (state, role[:1]) in step:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, step[state, role[:1]], (*out, f"{role}:{text}")))
                for c in "ua":
                    if (state, c) in step:
                        heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, c, (*out, f"{names[c]}:{text}")))
    return min(best[len(rows), s] for s in ("", "a") if (len(rows), s) in best)


def assessed_by_hand(rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = Counter(faults_by_hand(rows))
    cost, audit, lines = repaired_by_hand(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def sorted_rows(rows):
    blank = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(blank, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string, at int, conv string"


def made(rng, n, size):
    out = []
    for c in range(n):
        for _ in range(rng.randint(1, size)):
            out.append((c if c else None, rng.choice([None, 0, 1, 2, 3, 5, 8]), rng.choice(["user", "assistant", "system", "tool", "admin", "u", None]), rng.choice(["Hi.", "What? ", "cut off", "", " \n", None, "Done!", "é"])))
    return out


@pytest.mark.parametrize(("bits", "size"), [(8, 7), (1, 7), (2, 60)])
def test_conversations(spark, monkeypatch, bits, size):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rng = random.Random(size + bits)
    rows = made(rng, 60, size)
    per = defaultdict(list)
    for c, *r in rows:
        per[c].append(tuple(r))
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversations.assess(given, given).collect()}
    assert got == {c: assessed_by_hand(sorted_rows(r)) for c, r in per.items()}


def test_every_split_gives_the_same_cell():
    """The whole chart with all splits of all spans, and the one in use."""
    rng = random.Random(3)
    for _ in range(60):
        kinds = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(1, 9)))
        n, cell = len(kinds), {}
        for i, k in enumerate(kinds):
            cell[i, i + 1] = conversations.TERMINAL[k]
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                ways = [conversations.joined(cell[i, k], cell[k, i + length]) for k in range(i + 1, i + length)]
                assert all(w == ways[0] for w in ways)
                cell[i, i + length] = ways[0]
        assert cell[0, n] == conversations.chart([conversations.row_cell(k, 1) for k in kinds])


def test_grammar():
    assert len(conversations.NONTERMINALS) == 11 and len(conversations.BINARY) == 26
    accept = lambda cell: min(c for c in (cell[conversations.NONTERMINALS.index((0, q))] for q in (0, 3)) if c)
    assert accept(conversations.EMPTY) == (0, "") and accept(conversations.chart([conversations.row_cell(k, 1) for k in "sua"])) == (0, "KKK")
    assert accept(conversations.row_cell("u", 1)) == (2, "KJ") and accept(conversations.row_cell("x", 3)) == (9, "DDD")


def test_repaired_rows_and_empty_tables(spark):
    given = spark.createDataFrame([(1, 0, "user", "Hi.", 0, "c"), (1, 0, "user", "Hi.", 0, "c"), (1, 2, "user", "cut", 0, "c"), (2, 0, "user", " ", 0, "c"), (3, 1, "assistant", "word " * 40000 + ".", 0, "c")], TURNS)
    got = conversations.repair(given).orderBy("conv_id", "at", "nr").collect()
    assert [(r.conv_id, r.turn, r.edit, r.role, r.text[:6]) for r in got] == [(1, 0, "keep", "user", "Hi."), (1, 2, "rerole", "assistant", "cut"), (3, None, "insert", "user", ""), (3, 1, "keep", "assistant", "word w")]
    empty = hashlib.sha256().hexdigest()
    all_gone = {r.conv_id: (r.cost, r.audit, r.repaired_sha256) for r in conversations.assess(given, given.where("conv_id <> 2")).collect()}
    assert all_gone[2] == (0, "", empty) and all_gone[1][:2] == (6, "KDR")
    assert conversations.assess(given.where("false"), given.where("false")).count() == 0


def test_damage(spark):
    rows = [(c, t, r, x, 0, "c") for c in [*range(40), None] for t, r, x in ((0, "system", "A. b!"), (1, "assistant", None), (None, None, "q?"))]
    want = []
    for c, t, r, x, *_ in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        want += [] if h == 0 else [(c, t, "user" if h == 4 else r, "" if h == 1 else x.translate({46: None, 33: None, 63: None}) if h == 2 else x)] * (2 if h == 3 else 1)
    got = conversations.damaged(spark.createDataFrame(rows, TURNS))
    assert got.columns == ["conv_id", "turn", "role", "text"] and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) > 100


def test_one_very_long_conversation_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_BITS", 4)
    given = spark.range(2000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 7 == 3, "assistant").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), (F.col("id") % 700).cast("string"), F.lit(".")).alias("text"))
    r = conversations.assess(given, given).first()
    rows = [(i, "assistant" if i % 7 == 3 or i % 2 else "user", f"t{i % 700}.") for i in range(2000)]
    assert tuple(r[c] for c in COLUMNS) == assessed_by_hand(rows)

"""Personal data: exact patterns, and a character-level BiLSTM-CRF that adds what they miss.

The patterns (email, ip, card, phone) give the base spans, which always stay. A bidirectional LSTM with
CRF transitions, trained in numpy on base spans of a bounded sample with their surroundings, reads every
place that could hold such data: the surroundings of every digit and every ``@`` of the whole text, in
overlapping windows. Each character takes its scores from the window in which it lies most central; the CRF
is then decoded once over the whole place, so windows can't disagree. A span that the model finds is added
if it overlaps no base span and is valid by itself (as the patterns' checks demand): it catches data that
greedy patterns lose, such as a card number that follows a phone number.

So the model adds nothing of another shape (an address written out in words, say), whatever it scores.

Null and empty texts have no spans; a very long text is read whole, place by place. Rows that repeat come back
each. With no base span in the sample there is nothing to learn, and only base spans are found. Of tied tag
sequences the one with smaller tags is taken. An empty table gives an empty table. Other columns pass through,
whatever their names; those named base_spans or added_spans are replaced. Offsets are code points, end exclusive.
Training is bounded by parameters: ``max_docs`` documents, ``per_doc`` places of each, 256 characters of a place and
2,400 windows; what is searched is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
TRIGGER = re.compile(r"[0-9@]+")

WINDOW, STRIDE, MARGIN = 64, 32, 28
HIDDEN = 16
TAGS = 1 + 2 * len(KINDS)  # 0 outside; 1 + 2k begins and 2 + 2k continues kind k
#: Characters with a class of their own; the rest share one by sort.
OWN = "@._%+-()=\"':/,\n "


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def valid(kind: int, s: str) -> bool:
    """The check that a match of a kind's pattern must pass."""
    if kind == 0:
        return True
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    n = len(digits := NOT_DIGIT.sub("", s))
    return 12 <= n <= 19 and _luhn(digits) if kind == 2 else 9 <= n <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass, in order."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return sorted(found)


FULL = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), IP, CARD, PHONE)


def _class_table() -> np.ndarray:
    table = np.empty(256, np.int64)
    for b in range(256):
        c = chr(b)
        table[b] = OWN.index(c) if c in OWN else len(OWN) + (0 if c.isdigit() else 1 if c.islower() and b < 128 else 2 if c.isupper() and b < 128 else 3 if b < 128 else 4)
    return table


CLASSES = _class_table()
N_CLASSES = len(OWN) + 6  # the last pads windows


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASSES[np.minimum(code, 255)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """BiLSTM over character classes with a CRF on top. Parameters are a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray]) -> None:
        self.p = params

    @staticmethod
    def fresh(seed: int = 0) -> Tagger:
        rng, h = np.random.default_rng(seed), HIDDEN
        p = {"out": rng.normal(0, 0.2, (2 * h, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS)), "begin": np.zeros(TAGS)}
        for d in "fb":
            p |= {f"x{d}": rng.normal(0, 0.3, (N_CLASSES, 4 * h)), f"h{d}": rng.normal(0, h**-0.5, (h, 4 * h))}
            p[f"x{d}"][:, h : 2 * h] += 1  # forget little at first
        for k in range(len(KINDS)):
            for t in range(TAGS):
                if t not in (1 + 2 * k, 2 + 2 * k):
                    p["trans"][t, 2 + 2 * k] = -1e4  # a span continues only itself
            p["begin"][2 + 2 * k] = -1e4
        return Tagger({k: v.astype(np.float64) for k, v in p.items()})

    def _lstm(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: classes (windows, places); returns the states in place order."""
        n, t_max, h = *x.shape, HIDDEN
        wx, wh = self.p[f"x{d}"], self.p[f"h{d}"]
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        out = np.empty((t_max, n, h))
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            z = wx[x[:, t]] + state @ wh
            i, f, o = _sigmoid(z[:, :h]), _sigmoid(z[:, h : 2 * h]), _sigmoid(z[:, 2 * h : 3 * h])
            g = np.tanh(z[:, 3 * h :])
            before, last = cell, state
            cell = f * cell + i * g
            tc = np.tanh(cell)
            state = out[t] = o * tc
            if keep is not None:
                keep.append((t, i, f, o, g, before, tc, last))
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = ([], []) if keep is not None else (None, None)
        both = np.concatenate([self._lstm(x, "f", kf), self._lstm(x, "b", kb)], axis=2)
        if keep is not None:
            keep |= {"f": kf, "b": kb, "both": both}
        return both @ self.p["out"] + self.p["bias"]  # (places, windows, tags)

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        e = self.emissions(x, keep)
        t_max, n, h = e.shape[0], e.shape[1], HIDDEN
        a = np.empty_like(e)
        a[0] = e[0] + self.p["begin"]
        lse = lambda v, axis: (m := v.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis))
        for t in range(1, t_max):
            a[t] = e[t] + lse(a[t - 1][:, :, None] + self.p["trans"], 1)
        total = lse(a[-1], 1)
        b = np.zeros_like(e)
        for t in range(t_max - 2, -1, -1):
            b[t] = lse(self.p["trans"] + (e[t + 1] + b[t + 1])[:, None, :], 2)
        marginal = np.exp(a + b - total[None, :, None])
        yt, rows = y.T, np.arange(n)
        gold = self.p["begin"][yt[0]] + e[0, rows, yt[0]]
        de, trans = marginal.copy(), np.zeros((TAGS, TAGS))
        de[0, rows, yt[0]] -= 1
        for t in range(1, t_max):
            gold = gold + self.p["trans"][yt[t - 1], yt[t]] + e[t, rows, yt[t]]
            de[t, rows, yt[t]] -= 1
            trans += np.exp(np.clip(a[t - 1][:, :, None] + self.p["trans"] + (e[t] + b[t])[:, None, :] - total[:, None, None], -700, 50)).sum(0)
            np.add.at(trans, (yt[t - 1], yt[t]), -1)
        begin = marginal[0].sum(0) - np.bincount(yt[0], minlength=TAGS)
        g = {"out": np.einsum("tnh,tnk->hk", keep["both"], de), "bias": de.sum((0, 1)), "trans": trans, "begin": begin}
        dboth = de @ self.p["out"].T
        for d, ds in (("f", dboth[:, :, :h]), ("b", dboth[:, :, h:])):
            wh, gx, gh = self.p[f"h{d}"], np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"])
            dstate, dcell = np.zeros((n, h)), np.zeros((n, h))
            for t, i, f, o, c, before, tc, last in reversed(keep[d]):
                dstate = dstate + ds[t]
                dcell = dcell + dstate * o * (1 - tc * tc)
                dz = np.concatenate([dcell * c * i * (1 - i), dcell * before * f * (1 - f), dstate * tc * o * (1 - o), dcell * i * (1 - c * c)], axis=1)
                np.add.at(gx, x[:, t], dz)
                gh += last.T @ dz
                dstate, dcell = dz @ wh.T, dcell * f
            g |= {f"x{d}": gx, f"h{d}": gh}
        fixed = self.p["trans"] < -1e3
        g["trans"][fixed] = 0
        g["begin"][self.p["begin"] < -1e3] = 0
        return float((total - gold).mean()), {k: v / n for k, v in g.items()}

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags of one place's emissions (characters, tags)."""
        best, back = e[0] + self.p["begin"], np.empty(e.shape, np.int64)
        for t in range(1, len(e)):
            s = best[:, None] + self.p["trans"]
            back[t] = s.argmax(0)
            best = s.max(0) + e[t]
        tags = np.empty(len(e), np.int64)
        tags[-1] = best.argmax()
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


def places(text: str) -> list[tuple[int, int]]:
    """Stretches within ``MARGIN`` characters of a digit or an @, merged."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _windows(n: int) -> list[int]:
    return list(range(0, max(1, n - WINDOW + STRIDE), STRIDE))


def model_spans(tagger: Tagger, texts: list[str], batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) that the model finds in each text, valid by themselves."""
    all_places = [(i, a, b) for i, t in enumerate(texts) for a, b in places(t)]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for at in range(0, len(all_places), batch):
        part = all_places[at : at + batch]
        codes = [classes(texts[i][a:b]) for i, a, b in part]
        where = [(k, s) for k, c in enumerate(codes) for s in _windows(len(c))]
        x = np.full((len(where), WINDOW), N_CLASSES - 1)
        for r, (k, s) in enumerate(where):
            piece = codes[k][s : s + WINDOW]
            x[r, : len(piece)] = piece
        scores = [np.zeros((len(c), TAGS)) for c in codes]
        for lo in range(0, len(x), 4096):
            e = tagger.emissions(x[lo : lo + 4096])
            for r, (k, s) in enumerate(where[lo : lo + 4096]):
                n = min(WINDOW, len(codes[k]) - s)
                first = 0 if s == 0 else STRIDE // 2  # each character from the window in which it is most central
                last = n if s + WINDOW >= len(codes[k]) else WINDOW - STRIDE // 2
                scores[k][s + first : s + last] = e[first:last, r]
        for (i, a, _), e in zip(part, scores, strict=True):
            tags = tagger.viterbi(e)
            starts = np.flatnonzero(tags % 2 == 1)
            for s in starts.tolist():
                kind, end = int(tags[s] - 1) // 2, s + 1
                while end < len(tags) and tags[end] == tags[s] + 1:
                    end += 1
                body = texts[i][a + s : a + end]
                if FULL[kind].fullmatch(body) and valid(kind, body):
                    found[i].append((a + s, kind, a + end))
    return found


def _training_windows(samples: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 0, most: int = 2400) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: the samples as they are, and spans set one after another between their surroundings."""
    rng = np.random.default_rng(seed)
    drawn: list[tuple[np.ndarray, np.ndarray]] = []

    def put(text: str, spans: list[tuple[int, int, int]]) -> None:
        tags = np.zeros(len(text), np.int64)
        for s, kind, e in spans:
            tags[s], tags[s + 1 : e] = 1 + 2 * kind, 2 + 2 * kind
        at = int(rng.integers(0, max(1, len(text) - WINDOW)))
        while at and tags[at] and tags[at] % 2 == 0:
            at -= 1
        c, t = np.full(WINDOW, N_CLASSES - 1), np.zeros(WINDOW, np.int64)
        n = min(WINDOW, len(text) - at)
        c[:n], t[:n] = classes(text[at : at + n]), tags[at : at + n]
        drawn.append((c, t))

    for text, spans in samples:
        put(text, spans)
    by_kind = [[t[s:e] for t, spans in samples for s, k, e in spans if k == kind] for kind in range(len(KINDS))]
    known = [k for k in range(len(KINDS)) if by_kind[k]]
    for _ in range(most - len(drawn) if known else 0):
        before, after = (samples[int(rng.integers(len(samples)))][0] for _ in range(2))
        text, spans = before[: int(rng.integers(4, 24))] + " ", []
        text = TRIGGER.sub("", text)
        for _ in range(int(rng.integers(1, 4))):
            kind = int(rng.choice(known))
            body = by_kind[kind][int(rng.integers(len(by_kind[kind])))]
            spans.append((len(text), kind, len(text) + len(body)))
            text += body + (" ", " ", ", ", ". ", "\n", " and ")[int(rng.integers(6))]
        put(text + TRIGGER.sub("", after[:40]), spans)
    order = rng.permutation(len(drawn))
    return np.array([drawn[i][0] for i in order]), np.array([drawn[i][1] for i in order])


def fit(samples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 10, batch: int = 48, rate: float = 0.02) -> Tagger | None:
    if not any(spans for _, spans in samples):
        return None
    x, y = _training_windows(samples)
    tagger = Tagger.fresh()
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(w) for k, w in tagger.p.items()}
    step = 0
    for epoch in range(epochs):
        for at in range(0, len(x), batch):
            _, grads = tagger.loss_and_grads(x[at : at + batch], y[at : at + batch])
            step += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                tagger.p[k] = tagger.p[k] - rate * 0.7**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 1200, per_doc: int = 4) -> Tagger | None:
    """Fit on the surroundings of at most ``per_doc`` places of each of at most ``max_docs`` documents that hold a
    digit or an @ (the smallest by a hash of id and text): a bounded sample that comes to the driver."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                for a, e in places(t)[:per_doc]:
                    e = min(e, a + 4 * WINDOW)
                    inner = [(s - a, k, z - a) for s, k, z in base_spans(t) if a <= s and z <= e]
                    out.append({"text": t[a:e], "spans": [x for s in inner for x in s]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("text", pa.string()), ("spans", pa.list_(pa.int32()))]))

    held = docs.where(F.col(text_col).rlike("[0-9@]")).select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    # two steps: the ids alone are sorted, then their texts are read
    chosen = held.select(F.xxhash64("_id", "_text").alias("_h")).orderBy("_h").limit(max_docs)
    picked = held.withColumn("_h", F.xxhash64("_id", "_text")).join(F.broadcast(chosen), "_h", "left_semi").select("_text")
    got = picked.mapInArrow(cut, "text string, spans array<int>").distinct().collect()
    samples = [(r["text"], list(zip(*[iter(r["spans"])] * 3, strict=True))) for r in sorted(got, key=lambda r: (r["text"], r["spans"]))]
    return fit(samples)


SPAN = StructType([StructField("start", IntegerType()), StructField("kind", StringType()), StructField("end", IntegerType())])


def find_pii(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``added_spans``, arrays of (start, kind, end) in order."""
    shared = docs.sparkSession.sparkContext.broadcast(None if tagger is None else tagger.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if shared.value is None else Tagger(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        rows = lambda spans: [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in spans]
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            added: list[list] = [[] for _ in texts]
            if own is not None:
                for i, found in enumerate(model_spans(own, texts)):
                    added[i] = [x for x in found if all(x[2] <= s or x[0] >= e for s, _, e in base[i])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([rows(x) for x in base], kind), pa.array([rows(x) for x in added], kind)], names=["_row", "base_spans", "added_spans"])

    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[text_col].alias("_text"))
    new = ["base_spans", "added_spans"]
    done = given.mapInArrow(run, StructType([given.schema["_row"], *[StructField(c, ArrayType(SPAN)) for c in new]]))
    return done.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in new], *new)


def rank(kind):
    """Place of a kind in the order they are listed."""
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def spell(spans):
    """kind:start:end, by start, then kind as listed, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""The pipeline against a version of each stage in plain Python."""

import random

import numpy as np
from test_dedup import components_by_hand, contaminated_by_hand, fingerprint_by_hand, lines_by_hand

import corpus_pipeline
from corpusprep.llm import toxicity


def make(spark, folder):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefghijklm") + str(rng.randint(0, 99))
    docs = []
    for i in range(150):
        lines = [" ".join(word() for _ in range(rng.randint(3, 20))) for _ in range(rng.randint(1, 5))]
        if i % 5 == 0:
            lines.insert(0, " Share This Page ")
        if i % 6 == 1:
            lines.append("utterly nasty awful words, nasty again")
        docs.append([i, "\n".join(lines), "en", f"s{i % 3}"])
    for i in range(150, 170):  # copies, exact and near
        text = docs[i - 150][1]
        docs.append([i, text if i % 2 else text + " tail", "en", "s0"])
    item = " ".join(word() for _ in range(14))
    for i in (3, 8, 40):
        docs[i][1] += "\n" + item.upper()
    docs += [[170, None, None, None], [171, "", "en", None], [172, "Share this page", "en", "s1"]]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 1)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return [(i, t) for i, t, _, _ in docs], [(1, item), (2, None)]


def test_pipeline(spark, tmp_path):
    folder = str(tmp_path)
    texts, items = make(spark, folder)
    got = corpus_pipeline.run(spark, folder).collect()
    model = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet").where(toxicity.may_teach()))
    weights = dict(zip(model.places.tolist(), model.weights.tolist(), strict=True))

    def toxic(t):
        x = sum(weights.get(p, 0.0) for p in set(toxicity.features((t or "").encode(), toxicity.WordHashes()).tolist()))
        return 1 / (1 + np.exp(-(model.bias + x))) >= 0.7

    rows = [(i, t) for i, t in texts if not toxic(t)]
    assert 0 < len(texts) - len(rows) <= 30
    by_id = {r[0]: r[3] for r in lines_by_hand(rows, 10)}
    rows = [(i, by_id[str(i)]) for i, _ in rows]
    fps = {i: fingerprint_by_hand(t) for i, t in rows}
    ids = sorted(fps)
    roots = components_by_hand([(a, b) for a in ids for b in ids if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4], ids)
    rows = [(i, t) for i, t in rows if roots[i] == i]
    hit = {i for i, _, n, _ in contaminated_by_hand(rows, items) if n}
    assert hit
    rows = {i: t for i, t in rows if str(i) not in hit}
    assert {r.doc_id for r in got} == set(rows)
    assert all(r.lossless and r.n_chars == len(rows[r.doc_id]) and r.n_pieces == len(r.pieces) for r in got)


def test_stages_keep_the_columns(spark, tmp_path):
    folder = str(tmp_path)
    make(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), folder).count() == 0

"""The pipeline against brute-force versions of its stages, one after another."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ledgerloom.llm import language
from ledgerloom.llm.base import materialise, read
from tests.llm import test_decontaminate as dc
from tests.llm import test_line_runs as lr
from tests.llm import test_packing as pk
from tests.llm import test_simhash as sh
from tests.llm.conftest import documents


def stage(name):
    return dict(cp.STAGES)[name]


def texts(df):
    return sorted((str(r.doc_id), str(r.text)) for r in df.collect())


def check(spark, sf, docs):
    cols = docs.columns
    # 1: every text with a letter has a language, whatever its score
    names, w = language.learn(docs)
    want, first = [], {}
    for r in docs.collect():
        if r.text and any(c.isalpha() for c in r.text):
            p = language.document_probabilities(w, [r.text.encode()])[0]
            want.append((str(r.doc_id), r.text))
            first.setdefault((str(r.doc_id), r.text), set()).add(r.lang or names[int(p.argmax())])
    now = materialise(stage("language_id")(spark, docs, sf), "t-stage")
    assert now.columns == cols and texts(now) == sorted(want)
    assert all(r.lang in first[str(r.doc_id), r.text] for r in now.collect())
    # 2
    had = {(str(r.doc_id), str(r.text)) for r in now.collect()}
    want = sorted((k, t) for k, t, n in lr.brute(lr.keyed(now)) if t or not n)
    now = materialise(stage("line_dedup")(spark, now, sf), "t-stage")
    assert now.columns == cols and texts(now) == want and had
    assert all(r.n_chars == len(r.text) for r in now.collect())
    # 3
    rows = [(r.doc_id, r.text, r.h) for r in now.withColumn("h", F.xxhash64("text")).collect()]
    root = {}
    fps = [sh.brute_fp(t) for _, t, _ in rows]
    for (k, f, c) in sh.brute_classes([(i, f) for i, f in enumerate(fps)]):
        root[int(k)] = c
    best = {}
    for i, (k, t, h) in enumerate(rows):
        best.setdefault(root[i], []).append((k is None, k or 0, h, str(k), t))
    now = materialise(stage("near_dedup")(spark, now, sf), "t-stage")
    assert now.columns == cols and texts(now) == sorted(min(v)[3:] for v in best.values())
    # 4
    items = [tuple(r) for r in read(spark, sf, "benchmark").select("item_id", "text").collect()]
    grams = {}
    for k, t in items:
        w10 = dc.words(t)
        for i in range(max(1, len(w10) - 9) if w10 else 0):
            grams.setdefault(len(w10[i:i + 10]), set()).add(tuple(w10[i:i + 10]))

    def clean(t):
        own = dc.words(t)
        return not any(tuple(own[i:i + n]) in g for n, g in grams.items() for i in range(len(own) - n + 1))

    want = [x for x in texts(now) if clean(x[1])]
    now = materialise(stage("decontamination")(spark, now, sf), "t-stage")
    assert now.columns == cols and texts(now) == want
    # 5
    e = pk.WordEncoder(pk.WORD)
    got = stage("best_fit_packing")(spark, now, sf).collect()
    lengths = sorted(min(4096, len(e.encode(t)) // 4 + 1 - a)
                     for _, t in want for a in range(0, len(e.encode(t)) // 4 + 1, 4096))
    assert sorted(r.length for r in got) == lengths
    assert pk._check(got, 4096) <= -(-sum(lengths) // 4096) + 1
    return got


def test_whole_tables(spark, sf):
    by_stage = check(spark, sf, read(spark, sf, "documents"))
    run = cp.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in run) == \
        sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in by_stage)


def test_odd_rows(spark, sf):
    rng = np.random.default_rng(2)
    rows = [(i, "\n".join("".join(rng.choice(list("abc " if i % 2 else "éü k"), 60)) for _ in range(4)),
             "xx" if i % 2 else "yy") for i in range(60)]
    rows += [(1, None, "xx"), (None, rows[3][1], "xx"), (None, rows[3][1], "xx"), (7, rows[7][1], "xx"),
             (70, "", None), (71, "a b c " * 4000, None), (72, "12 34", "yy"), (73, read(spark, sf, "benchmark").first().text, None)]
    check(spark, sf, documents(spark, rows))


def test_empty(spark, sf):
    none = documents(spark, [])
    for _, f in cp.STAGES:
        none = materialise(f(spark, none, sf), "t-stage") if f is not cp.best_fit_packing else f(spark, none, sf)
    assert none.count() == 0

import math
import random
import zlib

import numpy as np

from ledgerloom.llm import language as la
from ledgerloom.llm.base import read
from tests.llm.conftest import documents


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    w = la.init(3, 5, rng)
    x, y = la.pad([b"hello w", b"abc", b"zz top"]), np.array([0, 2, 1])
    _, grad = la.gradients(w, x, y)
    for k in w:
        for _ in range(4):
            at = tuple(int(rng.integers(s)) for s in w[k].shape)
            if k[0] == "E":
                at = (int(x[rng.integers(3), 0]), at[1])
            step, losses = 1e-2, []
            for s in (step, -step):
                moved = {n: v.copy() for n, v in w.items()}
                moved[k][at] += s
                losses.append(la.gradients(moved, x, y)[0])
            assert abs((losses[0] - losses[1]) / (2 * step) - grad[k][at]) < 2e-4, (k, at)


def test_batches_do_not_change_a_document():
    w = la.init(4, 6, np.random.default_rng(1))
    texts = [b"", b"a", b"x" * 127, b"y" * 128, b"z" * 129, bytes(range(256)) * 9, b"short one"]
    together = la.document_probabilities(w, texts, block=5)
    for t, p in zip(texts, together):
        assert np.allclose(la.document_probabilities(w, [t])[0], p, atol=1e-5)
        assert abs(p.sum() - bool(t)) < 1e-4


def _plain(w, text):
    """The network byte by byte with Python's floats: label probabilities of every
    position, and their mean."""
    size = w["Uf"].shape[1]

    def dot(row, v):
        return sum(float(a) * b for a, b in zip(row, v))

    def run(d, order):
        h, out = [0.0] * size, {}
        for t in order:
            e = [float(x) for x in w[f"E{d}"][text[t]]]
            gate = [min(1.0, max(0.0, 0.2 * (dot(w[f"U{d}"][k], h) + e[k]) + 0.5)) for k in range(2 * size)]
            r, u = gate[:size], gate[size:]
            rh = [a * b for a, b in zip(r, h)]
            n = [math.tanh(dot(w[f"N{d}"][k], rh) + e[2 * size + k]) for k in range(size)]
            h = [u[k] * h[k] + (1 - u[k]) * n[k] for k in range(size)]
            out[t] = h
        return out

    total = [0.0] * len(w["c"])
    for a in range(0, len(text), la.WINDOW):
        part = range(a, min(a + la.WINDOW, len(text)))
        f, b = run("f", part), run("b", reversed(part))
        for t in part:
            z = [dot(w["Vf"][k], f[t]) + dot(w["Vb"][k], b[t]) + float(w["c"][k, 0]) for k in range(len(total))]
            top = sum(math.exp(x - max(z)) for x in z)
            total = [s + math.exp(x - max(z)) / top for s, x in zip(total, z)]
    return [s / max(1, len(text)) for s in total]


def test_pass_and_pooling_equal_a_plain_loop():
    rng = np.random.default_rng(7)
    w = {k: (3 * v + rng.normal(0, 0.3, v.shape)).astype(np.float32) if k != "c" else v + np.float32(0.2)
         for k, v in la.init(4, 5, rng).items()}
    texts = [b"", b"a", "é日k".encode(), bytes(range(256)), b"the quick brown fox " * 20]
    got = la.document_probabilities(w, texts, block=3)
    for t, p in zip(texts, got):
        assert np.allclose(p, _plain(w, t), atol=2e-4), t


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang, signs = ("xx", "abc ") if i % 2 else ("yy", "é日k ")
        rows.append((i, "".join(rng.choices(signs, k=rng.randint(20, 200))), lang))
    rows += [(500, None, "xx"), (501, "", None), (502, "123 %% \u00b2\u2167", "xx"), (None, "ab ca bb", None), (503, "日é" * 60_000, None)]
    docs = documents(spark, rows).withColumnRenamed("source", "score")
    model = la.learn(docs, steps=60)
    assert model[0] == ["xx", "yy"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in la.predict(docs, model).collect()}
    assert [got[k] for k in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[None][0] == "xx" and got[503][0] == "yy"
    assert sum(got[i][0] == ("xx" if i % 2 else "yy") for i in range(120)) > 115
    none = la.learn(documents(spark, []))
    assert none == ([], {})
    assert {r.lang_pred for r in la.predict(docs, none).collect()} == {"und"}
    assert la.predict(documents(spark, []), model).count() == 0


def test_languages_of_few_texts_are_learned(spark, monkeypatch):
    rng = random.Random(2)

    def text(signs):
        return "".join(rng.choices(signs, k=80))
    few = [text("qvw ") for _ in range(3)]
    rows = [(i, few[i % 3], "zz") for i in range(20_000)]
    rows += [(30_000 + i, text("abc "), "xx") for i in range(300)]
    seen = []
    monkeypatch.setattr(la, "train", lambda samples, n, **k: seen.append((samples, n)) or {})
    names, _ = la.learn(documents(spark, rows), per_language=10)
    samples, n = seen[0]
    assert names == ["xx", "zz"] and n == 2
    # each distinct text once, four stretches of it; no more than per_language texts
    assert sorted(s for s, y in samples if y == 1) == sorted(t.encode() for t in few for _ in range(4))
    assert len([s for s, y in samples if y == 0]) == 40 == 4 * len({s for s, y in samples if y == 0})


def test_low_scores_are_kept(spark, monkeypatch):
    w = {k: v * 0 if k[0] == "V" else v for k, v in la.init(5, 4, np.random.default_rng(0)).items()}
    monkeypatch.setattr(la, "learn", lambda docs: (["l1", "l2", "l3", "l4", "l5"], w))
    docs = documents(spark, [(1, "A.", None), (2, "a long clean text " * 40, "l3"), (3, "12 %", "l1"), (4, None, "l1"), (5, "", None)])
    assert all(abs(r.score - 0.2) < 1e-4 for r in la.predict(docs, la.learn(docs)).collect() if r.doc_id < 3)
    assert sorted((r.doc_id, r.lang) for r in la.of_known_language(docs).collect()) == [(1, "l1"), (2, "l3")]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in read(spark, sf, "documents").collect()}
    got = la.op5_language_id(spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)

import zlib

import numpy as np
import pytest

from tallyforge.llm import quality
from tallyforge.llm.queries import QUERIES

AT = "/root/testdata/sf0.1"


def small(seed=0):
    rng = np.random.default_rng(seed)
    model = quality.Attention(np.zeros(6), np.ones(6), hidden=5, gates=4)
    counts = np.array([3, 1, 4])
    return model, rng.standard_normal((8, 6)), counts, np.array([1.0, 0.0, 1.0])


def test_forward_bag_by_bag():
    model, x, counts, _ = small()
    p, at = model.p, 0
    got = model.forward(x, counts)["y"]
    for i, n in enumerate(counts):
        h = np.tanh(x[at : at + n] @ p["W"] + p["b"])
        e = (np.tanh(h @ p["V"]) * (1 / (1 + np.exp(-h @ p["U"])))) @ p["w"]
        a = np.exp(e) / np.exp(e).sum()
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(a @ h @ p["c"] + p["d"][0]))), abs=1e-6)
        at += n


def test_gradients_against_differences():
    model, x, counts, y = small()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        q = model.forward(x, counts)["y"]
        return -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()

    g = model.gradients(x, counts, y, 0.0)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for i in range(0, len(flat), 3):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert np.asarray(g[name]).reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_texts_together_and_alone_give_equal_passages():
    texts = ["", None, " \n ", "One", "a B 7 é — ! " * 50, "  leading and trailing \n", "x" * 5000, "w " * 1000]
    x, counts = quality.passages(texts)
    assert counts.tolist() == [1, 1, 1, 1, 7, 1, 1, 21]
    at = 0
    for t, n in zip(texts, counts):
        own, alone = quality.passages([t])
        assert alone[0] == n
        assert (own == x[at : at + n]).all()
        at += n
    assert np.isfinite(x).all()


def test_bad_passages_in_good_documents_and_odd_inputs(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("etaoinshr"), 5))
    good = [" ".join(word() for _ in range(150)) for _ in range(300)]
    rows = [(i, g if i % 2 else g + "\n" + "BUY NOW!! $$$ " * 25) for i, g in enumerate(good)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)] + [(3, None), (None, 1), (99999, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.predicted for r in quality.score(docs, model).collect()}
    assert np.mean([got[i] == i % 2 for i in range(240, 300)]) > 0.9
    odd = spark.createDataFrame([(1, None, ""), (1, None, ""), (None, "", ""), (2, "é", ""), (3, "word " * 40000, "")], docs.schema)
    out = quality.score(odd, model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert len({r.score for r in out if not r.text}) == 1
    assert quality.score(docs.limit(0), model).count() == 0
    for few, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {r.score for r in quality.score(odd, quality.train(docs, few)).collect()} == {want}


def test_held_out_labels_on_the_whole_table(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{AT}/labels.parquet").collect()}
    got = QUERIES["op9_quality_attention"](spark, AT).collect()
    assert len(got) == 10000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.99
    assert {(r.doc_id, r.score) for r in QUERIES["op9_quality_attention"](spark, AT).collect()} == {(r.doc_id, r.score) for r in got}

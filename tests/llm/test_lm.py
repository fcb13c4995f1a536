from collections import Counter

import numpy as np
import pytest
from cases import ODD, docs, words
from daybook.llm import lm as L
from daybook.llm import queries
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.01"


def small(kinds=12):
    top = [(b"", 30), *((f"w{i}".encode(), 20 - i) for i in range(kinds))]
    return L.vocabulary(top, 17, classes=5)


def shaken(v, seed=0):
    net = L.Network(v, embed=4, hidden=5)
    net.flat = net.flat.astype(np.float64) + np.random.default_rng(seed).normal(0, 0.3, net.flat.shape)
    net.w = net.views(net.flat)
    return net


def slow_score(net, ids):
    """Token by token, with the full softmax."""
    h, last, out = np.zeros(net.hidden), net.v.ids[b""], 0.0
    of = net.v.class_of()
    for i in ids:
        h = net.step((net.w["x"][last] @ net.w["wx"] + net.w["b"])[None], h[None])[0][0]
        c = np.exp(h @ net.w["cw"] + net.w["cb"])
        inner = np.exp(net.w["ow"] @ h + net.w["ob"])
        p = c[of] / c.sum() * inner / np.array([inner[of == k].sum() for k in of])
        assert p.sum() == pytest.approx(1)
        out, last = out + np.log10(p[i]), i
    return out


def test_scores_against_the_full_softmax():
    v = small()
    net, rng = shaken(v), np.random.default_rng(1)
    texts = [rng.integers(0, v.size, n) for n in (1, 2, 31, 32, 33, 100, 7)]
    got = L.network_scores(net, texts, lanes=3, window=8)
    assert got == pytest.approx([slow_score(net, t) for t in texts], rel=1e-5)


def test_gradients_against_differences():
    v = small()
    net, rng = shaken(v), np.random.default_rng(2)
    previous, target = rng.integers(0, v.size, (6, 3)), rng.integers(0, v.size, (6, 3))
    fresh, h0 = rng.random((6, 3)) < 0.3, rng.normal(0, 0.3, (3, net.hidden))

    def loss():
        h, s = h0, 0.0
        for t in range(6):
            h = np.where(fresh[t][:, None], 0, h)
            h, _ = net.step(net.w["x"][previous[t]] @ net.w["wx"] + net.w["b"], h)
            s -= net.log_p(h, target[t]).sum()
        return s

    grad = np.zeros_like(net.flat)
    net.window(previous, target, fresh, h0, net.views(grad))
    for i in rng.choice(len(grad), 80, replace=False):
        old = net.flat[i]
        net.flat[i] = old + 1e-5
        up = loss()
        net.flat[i] = old - 1e-5
        down = loss()
        net.flat[i] = old
        assert (up - down) / 2e-5 == pytest.approx(grad[i], abs=1e-5)


def test_fresh_network_is_the_unigram_model():
    v = small()
    net = L.Network(v)
    p = v.prior / v.prior.sum()
    got = L.network_scores(net, [np.array([i]) for i in range(v.size)])
    assert got == pytest.approx(np.log10(p), rel=1e-4)


def test_training_learns_an_order():
    v = small()
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(300):
        a = int(rng.integers(2, 8))
        texts.append(np.array([*([a, a + 1] * int(rng.integers(3, 20))), v.ids[b""]]))
    net = L.Network(v)
    before = L.network_scores(net, texts[:20]).sum()
    trainer = L.Trainer(net, lanes=8, window=8, rate=0.02)
    for t in texts[20:]:
        trainer.add(t)
    trainer.finish()
    assert L.network_scores(net, texts[:20]).sum() > 0.6 * before
    assert trainer.tokens <= sum(map(len, texts[20:]))


@pytest.mark.parametrize("lengths", [[3], [5, 16, 40], [1] * 9, [700, 2, 33, 8, 16, 1, 90, 17, 4, 250, 31, 32]])
def test_every_token_is_trained_on(lengths):
    v, rng = small(), np.random.default_rng(7)
    trainer = L.Trainer(L.Network(v), lanes=8, window=16)
    start = trainer.net.flat.copy()
    for n in lengths:
        trainer.add(rng.integers(0, v.size, n))
    trainer.finish()
    assert trainer.tokens == sum(lengths) and np.isfinite(trainer.net.flat).all() and (trainer.net.flat != start).any()


def test_steps_without_a_token_have_no_gradient():
    v = small()
    net, rng = shaken(v), np.random.default_rng(3)
    previous, target, fresh, h0 = rng.integers(0, v.size, (6, 3)), rng.integers(0, v.size, (6, 3)), np.zeros((6, 3), bool), rng.normal(0, 0.3, (3, net.hidden))
    real = np.arange(6)[:, None] < np.array([6, 4, 1])
    got, want = np.zeros_like(net.flat), np.zeros_like(net.flat)
    net.window(previous, target, fresh, h0, net.views(got), real)
    for lane, n in enumerate((6, 4, 1)):
        net.window(previous[:n, lane:lane + 1], target[:n, lane:lane + 1], fresh[:n, lane:lane + 1], h0[lane:lane + 1], net.views(want))
    assert got == pytest.approx(want, abs=1e-9)


def plain_base(train, text):
    counts = Counter()
    for t in train:
        counts.update((t or "").encode().lower().split())
        counts[b""] += 1
    n, kinds = counts.total(), len(counts)
    words_ = [*(text or "").encode().lower().split(), b""]
    return (len(words_), sum(counts[w] > 0 for w in words_), n, sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in words_))


@pytest.mark.parametrize("known", [5, 200_000])
def test_base_scores_with_and_without_the_join(spark, monkeypatch, known):
    monkeypatch.setattr(L, "KNOWN", known)
    rows = ODD + [(30 + i, words(80, 30 + i, 60), "en", "a", 1) for i in range(10)]
    d = docs(spark, rows, clash=("word", "n", "row", "score", "p"))
    train = [r[1] for r in rows if r[0] is None or r[0] % 2]
    model = L.fit(d.where("doc_id IS NULL OR doc_id % 2 = 1"), words=20, rounds=1)
    got = L.score(d, model).collect()
    assert len(got) == len(rows)
    want = sorted([(r[0] or 0, *plain_base(train, r[1])) for r in rows])
    for r, w in zip(sorted(got, key=lambda r: (r["doc_id"] or 0, r["n_tokens"])), want):
        assert (r["doc_id"] or 0, r["n_tokens"], r["n_known"], model.total) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9) and r["score"] < 0


def test_probabilities_of_rare_words_sum_to_one(spark):
    """Every training word outside the network, and one share for what is new."""
    rows = [(i, words(30, i, 50), "en", "a", 1) for i in range(8)]
    model = L.fit(docs(spark, rows), words=6, rounds=1)
    inside = {w.decode() for w in model.network.v.ids}
    rare = [r["n"] for r in model.counts.collect() if r["word"] not in inside]
    assert sum(n + 0.5 for n in rare) + 0.5 == pytest.approx(10 ** model.rare_norm)


def test_every_training_document_trains_the_network(spark):
    d = docs(spark, [(i, words(60, i, 50), "en", "a", 1) for i in range(24)] + [(99, None, None, None, None)]).repartition(3)
    net = L.fit(d, words=30, rounds=0).network
    seen = d.select("text").mapInPandas(L._train(net.v, net.flat), L.fields(weights="double[]", tokens="long"))
    assert seen.agg({"tokens": "sum"}).first()[0] == 24 * 61 + 1


def test_no_training_rows(spark):
    model = L.fit(docs(spark, []))
    got = L.score(docs(spark, ODD[:2]), model).orderBy("doc_id").collect()
    assert got[1]["n_known"] == 0 and got[1]["base_score"] == pytest.approx(0) and np.isfinite(got[0]["score"])
    assert L.score(docs(spark, []), model).count() == 0


def test_held_out_text_is_more_probable_than_under_the_base(spark):
    got = queries.recurrent_lm(spark, SF_SMALL).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_words_of_odd_texts():
    texts = [None, "", " \n\t ", "a", "  A\x0b\x0cb \x1fC\r\nd\x85e ", "É KK　x\x1cy \xa0", "x\x00y  z", *(r[1] for r in ODD)]
    found, starts = L.words_of(texts)
    want = [[w.decode() for w in (t or "").encode().lower().split()] + [L.END] for t in texts]
    assert [found[i:j].to_pylist() for i, j in zip(starts.tolist(), starts.tolist()[1:])] == want


def test_a_long_document_at_the_end_takes_few_updates():
    v, rng = small(), np.random.default_rng(11)
    trainer = L.Trainer(L.Network(v), lanes=8, window=16)
    for n in [20] * 30 + [8 * 16 * 5]:
        trainer.add(rng.integers(0, v.size, n))
    trainer.finish()
    assert trainer.tokens == 30 * 20 + 8 * 16 * 5 and trainer.updates <= 2 * (trainer.tokens // (8 * 16) + 1)


def test_large_logits_stay_finite():
    v, rng = small(), np.random.default_rng(13)
    net = shaken(v)
    net.w["ob"][3], net.w["cb"][1] = 90, -90
    single = L.Network(v, net.flat, embed=4, hidden=5)
    texts = [rng.integers(0, v.size, n) for n in (1, 9, 40)]
    assert L.network_scores(single, texts, lanes=2, window=4) == pytest.approx([slow_score(net, t) for t in texts], rel=1e-4)
    previous, target = rng.integers(0, v.size, (6, 3)), rng.integers(0, v.size, (6, 3))
    grad = np.zeros_like(single.flat)
    single.window(previous, target, np.zeros((6, 3), bool), np.zeros((3, 5), np.float32), single.views(grad))
    assert np.isfinite(grad).all()

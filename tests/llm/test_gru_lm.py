import math
import random
import zlib
from collections import Counter

import frames
import numpy as np
import pytest

from tierstone.llm import gru_lm as G


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = G.Network(40)
    ids = rng.integers(0, 40 + G.RARE_CLASSES, (4, 3)).astype(np.int32)
    ids[3, 2] = -1
    fresh = np.zeros((4, 3), bool)
    fresh[0], fresh[2, 1] = True, True
    found = {}
    copy = net.copy()
    copy._step = lambda name, grad, rate, rows=slice(None): found.__setitem__(name, (grad, rows))
    copy.learn(ids, fresh, np.zeros((3, G.HIDDEN), np.float32), 0.1)

    def loss(one):
        before, _, _ = one.read(np.where(ids >= 0, ids, 0), fresh, np.zeros((3, G.HIDDEN), np.float32))
        return -one.predict(before[ids >= 0], ids[ids >= 0], False).sum()

    for name, (grad, rows) in found.items():
        full = np.zeros_like(getattr(net, name))
        full[rows] = grad
        at = np.unravel_index(np.abs(full).argmax(), full.shape)
        sides = []
        for step in (1e-2, -1e-2):
            moved = net.copy()
            getattr(moved, name)[at] += step
            sides.append(loss(moved))
        assert (sides[0] - sides[1]) / 2e-2 == pytest.approx(full[at], rel=0.1, abs=2e-3)


def test_probabilities_sum_to_one():
    net = G.Network(40)
    states = np.random.default_rng(1).standard_normal((1, G.HIDDEN)).astype(np.float32)
    every = np.arange(40 + G.RARE_CLASSES)
    total = np.exp(net.predict(np.repeat(states, len(every), 0), every, False)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_state_is_carried_over_windows():
    net, rng = G.Network(40), np.random.default_rng(2)
    docs = [rng.integers(0, 40, n).astype(np.int32) for n in (1, 5, 40, 100, 3)]
    together = G.score_docs(net, docs)
    alone = [G.score_docs(net, [d])[0] for d in docs]
    assert together == pytest.approx(alone, rel=1e-4)


def corpus():
    rng = random.Random(11)
    rows = []
    for k in range(300):
        own = frames.WORDS[:8] if k % 2 else frames.WORDS[8:]
        rows.append((k, " ".join(rng.choice(own) + ("" if rng.random() < 0.9 else str(rng.randrange(10**6))) for _ in range(rng.randrange(5, 80)))))
    return rows + frames.ODD + [(900, "Alpha\x0bBETA " * 30000)]


@pytest.mark.parametrize("known", [1 << 18, 20])
def test_counts_and_base_score_equal_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(G, "KNOWN_WORDS", known)
    monkeypatch.setattr(G, "HEAD", 16)
    rows = corpus()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if i is not None and not held(i) for w in G.words_of((t or "").encode()))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        words = G.words_of((t or "").encode())
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want.append((repr(i), held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 3)))
    found = G.score(frames.docs(spark, rows)).collect()
    got = [(repr(r[0]), r[1], r[2], r[3], r[4], round(r["base_score"], 3)) for r in found]
    assert sorted(got) == sorted(want)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    if known > 20:
        rest = [r for r in found if r["held_out"] and r["doc_id"] < 300]
        assert sum(r["score"] for r in rest) > sum(r["base_score"] for r in rest)


def test_the_thousand_commonest_words_are_predicted_from_the_state(spark):
    words = [f"w{k}" for k in range(1000)]
    text = " ".join(w for k, w in enumerate(words) for _ in range(2 + (k < 500)))
    vocab, _, _ = G.vocabulary(G.word_counts(frames.docs(spark, [(1, text)])))
    ids = vocab.encode(" ".join(words).encode())[0]
    assert len(set(ids.tolist())) == 1001 and ids.max() < vocab.head == 1001
    net, rng = G.Network(vocab.head), np.random.default_rng(3)
    assert len(net.gate) >= 16 and len(net.class_bias) - G.RARE_CLASSES >= 32
    one, other = (np.repeat(rng.standard_normal((1, G.HIDDEN)).astype(np.float32), len(ids), 0) for _ in range(2))
    assert (net.predict(one, ids, False) != net.predict(other, ids, False)).mean() > 0.99


def test_empty_and_untrained(spark):
    assert G.score(frames.docs(spark, [])).collect() == []
    found = G.score(frames.docs(spark, [(None, "a b")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found] == [(3, 0, 0)]


def test_documents_are_scored_in_chunks_however_they_are_batched(monkeypatch):
    import pyarrow as pa

    net = G.Network(8)
    docs = [np.arange(n % 5 + 1, dtype=np.int16) for n in range(30)]
    kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "key": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(),
             "base_log": pa.float64(), "inside_log": pa.float64()}

    def batch(some):
        columns = {name: pa.nulls(len(some), kind) for name, kind in kinds.items()}
        return pa.RecordBatch.from_pydict(columns | {"doc_id": pa.array(some, pa.int64()), "ids": pa.array([docs[k].tobytes() for k in some], pa.binary())})

    class Shared:
        value = net

    calls, plain = [], G.score_docs
    monkeypatch.setattr(G, "score_docs", lambda net, docs: calls.append(len(docs)) or plain(net, docs))
    batches = [batch(range(k, min(k + 7, 30))) for k in range(0, 30, 7)] + [batch([])]
    found = [r for b in G._scored(Shared)(iter(batches)) for r in b.to_pylist()]
    assert calls == [30]
    assert [r["doc_id"] for r in found] == list(range(30)) and list(found[0]) == G.SCORED
    np.testing.assert_allclose([r["model_log"] for r in found], plain(net, docs), rtol=1e-5)
    monkeypatch.setattr(G, "CHUNK_TOKENS", 20)
    calls.clear()
    again = [r["model_log"] for b in G._scored(Shared)(iter(batches)) for r in b.to_pylist()]
    assert sum(calls) == 30 and len(calls) > 1
    np.testing.assert_allclose(again, [r["model_log"] for r in found], rtol=1e-5)

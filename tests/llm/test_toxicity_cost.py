import random
import zlib

import numpy as np

from litfunnel.llm import toxicity


def by_definition(model, word):
    f = [zlib.crc32(f"{n}:{word[:n]}".encode()) % toxicity.BUCKETS for n in (99, *(n for n in toxicity.STEMS if n < len(word)))]
    z = np.abs(model.delta[f] / model.error[f])
    d, e = float(model.delta[f[int(np.argmax(z))]]), toxicity.SHRINK * float(model.error[f[int(np.argmax(z))]])
    return f, (d - e if d > e else d + e if d < -e else 0.0) - toxicity.DRIFT


def a_model(mean):
    r = np.random.default_rng(5)
    return toxicity.Model(r.normal(mean, 1, toxicity.BUCKETS).astype(np.float32), r.uniform(0.1, 0.8, toxicity.BUCKETS).astype(np.float32), rate=1.1, scale=0.1)


def test_words_score_by_their_surest_bucket():
    model, r = a_model(0), random.Random(3)
    words = ["".join(r.choices("abcé文𝒳_9", k=r.randrange(1, 12))) for _ in range(2000)] + ["x" * 98, "x" * 99, "x" * 200, "é" * 99, "é" * 120]
    for w in words:
        f, score = by_definition(model, w)
        assert toxicity.features(w) == f and model.word_score(w) == score


def test_only_texts_that_could_be_significant_are_cut_into_segments(monkeypatch):
    """The evidence stays that of all segments, though most clean texts aren't searched for them."""
    model, r, cut = a_model(-2.5), random.Random(4), []
    for i in range(20):
        f = toxicity.features(f"w{i}")[0]
        model.delta[f], model.error[f] = 9, 0.1
    texts = [" ".join("w" + str(r.randrange(5000)) for _ in range(r.choice((0, 1, 5, 80)))) for _ in range(400)]
    plain = toxicity.maximal_segments
    monkeypatch.setattr(toxicity, "maximal_segments", lambda s: cut.append(len(s)) or plain(s))
    for at_most in (1.0, 0.01):
        cut.clear()
        found = 0
        for text in texts:
            s = model.scores(text, {})
            base = np.log(max(model.scale * len(s), 1e-9))
            expected = [(a, b, e) for a, b, x in plain(s) if (e := model.rate * x - base) > -np.log(at_most)]
            assert model.significant(text, {}, at_most) == (expected, len(s))
            found += bool(expected)
        assert 0 < found <= len(cut) < len(texts)

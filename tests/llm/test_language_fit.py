"""The fit of the language machines: its memory on the driver, and its weights against steps on dense profiles."""

import random
import tracemalloc

import numpy as np

from kalendria.llm import language_id


def labelled(n):
    r = random.Random(3)
    words = {lang: ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß"[: 20 + 2 * i]) for _ in range(r.randint(2, 9))) for _ in range(600)] for i, lang in enumerate(("de", "en", "fr", "xx"))}
    rows = [(lang, " ".join(r.choice(words[lang if r.random() < 0.8 else "en"]) for _ in range(r.randint(1, 120)))) for lang in words for _ in range(n)]
    r.shuffle(rows)
    return sorted(words), [t for _, t in rows], [lang for lang, _ in rows]


def dense_steps(x, y, rounds=200, c=10.0):
    """The same loss by accelerated steps on the weights themselves."""
    n = len(x)
    weight = np.where(y > 0, n / (2 * (y > 0).sum()), n / (2 * (y < 0).sum()))
    v0 = np.random.default_rng(0).standard_normal(x.shape[1]).astype(np.float32).astype(float)
    for _ in range(20):
        v0 = x.T @ (x @ v0)
        v0 /= np.linalg.norm(v0)
    lipschitz = 1 + 2 * c / n * weight.max() * (np.linalg.norm(x @ v0) ** 2 + n)
    w, b = np.zeros(x.shape[1]), 0.0
    v, vb = w, b
    for t in range(1, rounds + 1):
        slack = np.maximum(0, 1 - y * (x @ v + vb)) * weight
        nw, nb = v - (v - 2 * c / n * (x.T @ (y * slack))) / lipschitz, vb + 2 * c / n * (y * slack).sum() / lipschitz
        v, vb, w, b = nw + (t - 1) / (t + 2) * (nw - w), nb + (t - 1) / (t + 2) * (nb - b), nw, nb
    return w, b


def test_weights_against_dense_profiles():
    langs, texts, labels = labelled(40)
    model = language_id.LanguageModel(langs).fit(texts, labels)
    x = np.stack([language_id.profile(t) for t in texts]).astype(float)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-6)
    of = [model.family[lab] for lab in labels]
    for i, (level, a, b) in enumerate(model.duels):
        by = np.array(of if level == "family" else labels)
        rows = (by == a) | (by == b)
        w, bias = dense_steps(x[rows] * scale, np.where(by[rows] == a, 1.0, -1.0))
        assert np.allclose(model.weights[:, i], w * scale, rtol=1e-3, atol=1e-3 * np.abs(w * scale).max()) and abs(model.bias[i] - bias) < 1e-3


def test_fit_holds_no_dense_profiles():
    """800 rows are 52 MB as a dense matrix, and a copy of it was made for each machine."""
    langs, texts, labels = labelled(200)
    tracemalloc.start()
    try:
        language_id.LanguageModel(langs).fit(texts, labels)
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()

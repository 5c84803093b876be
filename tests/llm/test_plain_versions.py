"""Learned and signal parts against plain versions written another way."""

import math
import random

import numpy as np

from evigrid.llm import language, media, toxicity


def plain_peaks(samples):
    """Strongest bin of each band and frame that is above the frame before and not below the one after, by direct sums."""
    signal = [float(s) - 128 for s in samples]
    frames = max(1, -(-(len(signal) - media.FRAME) // media.HOP) + 1)
    signal += [0.0] * ((frames - 1) * media.HOP + media.FRAME - len(signal))
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / (media.FRAME - 1)) for i in range(media.FRAME)]
    waves = np.exp(-2j * np.pi * np.outer(np.arange(media.FRAME // 2 + 1), np.arange(media.FRAME)) / media.FRAME)
    heights = [abs(waves @ (np.array(signal[f * media.HOP : f * media.HOP + media.FRAME]) * window)) for f in range(frames)]
    edges = [int(x) for x in np.linspace(1, media.FRAME // 2 + 1, media.BANDS + 1)]
    best = [[max(range(a, b), key=lambda i, row=row: (row[i], -i)) for a, b in zip(edges, edges[1:], strict=False)] for row in heights]
    found = []
    for f in range(frames):
        for band in range(media.BANDS):
            own = heights[f][best[f][band]]
            before = heights[f - 1][best[f - 1][band]] if f else -1
            after = heights[f + 1][best[f + 1][band]] if f + 1 < frames else -1
            if own > before and own >= after:
                found.append((f, best[f][band]))
    return found


def test_peak_pairs_equal_plain_ones():
    rng = np.random.default_rng(3)
    t = np.arange(6000)
    samples = (128 + 50 * np.sin(t * 0.3) * (t < 3000) + 40 * np.sin(t * 1.1 + t * t / 9000) + rng.normal(0, 6, len(t))).clip(0, 255).astype(np.uint8)
    want = plain_peaks(samples)
    pairs = sorted((want[i][0], want[i][1] << 15 | want[i + n][1] << 7 | min(want[i + n][0] - want[i][0], 127)) for n in range(1, media.FAN + 1) for i in range(len(want) - n))
    hashes, times = media.fingerprint(samples)
    assert len(pairs) > 100 and list(zip(times.tolist(), hashes.tolist(), strict=True)) == pairs


def test_clusters_equal_plain_iterations():
    rng = np.random.default_rng(4)
    v = np.abs(rng.standard_normal((60, 7))) + np.repeat(np.eye(7)[[0, 3, 5]], 20, axis=0) * 4
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    got = language._clusters(v, 3)
    middle = v - v.mean(axis=0)
    values, vectors = np.linalg.eigh(middle.T @ middle)
    along = middle @ vectors[:, -1]
    order = min((sorted(range(len(v)), key=lambda i, s=s: s * along[i]) for s in (1, -1)), key=lambda o: np.abs(got - plain_rounds(v, o)).sum())
    assert np.allclose(got, plain_rounds(v, order), atol=1e-6)
    assert len({int(np.argmax(c)) for c in got}) == 3


def plain_rounds(v, order):
    parts = [order[:20], order[20:40], order[40:]]
    centres = [np.mean([v[i] for i in p], axis=0) for p in parts]
    for _ in range(12):
        near = [max(range(3), key=lambda k, x=x: (float(x @ centres[k]), -k)) for x in v]
        sums = [sum((v[i] for i in range(len(v)) if near[i] == k), np.zeros(v.shape[1])) if k in near else centres[k] for k in range(3)]
        centres = [s / np.linalg.norm(s) for s in sums]
    return np.array(centres)


def test_rejection_limits_are_low_quantiles():
    rng = np.random.default_rng(5)
    size, cosine = np.concatenate([np.full(500, 6.0), np.full(500, 10.0), np.full(5, 3.0)]), np.concatenate([rng.uniform(0.4, 0.6, 500), rng.uniform(0.7, 0.9, 500), np.zeros(5)])
    got = language._least(size, cosine)
    for at, part in ((6, cosine[:500]), (10, cosine[500:1000])):
        ordered = sorted(part)
        place = 0.01 * (len(ordered) - 1)
        low = ordered[int(place)] + (place % 1) * (ordered[int(place) + 1] - ordered[int(place)])
        assert abs(got[at] - (low - 0.25 * (float(np.median(part)) - low))) < 1e-9
    assert got[3] == got[6] * 0.5 and abs(got[8] - (got[6] + got[10]) / 2) < 1e-9 and got[22] == got[10]


def test_lexicon_entries_equal_plain_choice():
    rng = random.Random(6)
    stems = ["scum", "idio", "trasher", "vermin"]
    rows = [{"entry": s + t, "toxic": rng.randint(5, 60), "clean": rng.randint(0, 4)} for s in stems for t in ("", "s", "bag ", "like", " ")] + [{"entry": "the ", "toxic": 50, "clean": 900}]
    n_toxic, n_clean, least, base = 300, 3000, 8.0, 300 / 3300
    got = toxicity._choose(rows, n_toxic, n_clean, least, base)
    support = {r["entry"]: r["toxic"] for r in rows}
    want = {}
    for r in sorted(rows, key=lambda r: (len(r["entry"]), -r["toxic"], r["entry"])):
        e = r["entry"]
        if any(len(o) > len(e) and o.rstrip(" ") != e and o.startswith(e) and support[o] >= 0.8 * support[e] and len(e) in toxicity.PREFIXES for o in support if not e.endswith(" ")):
            continue
        if any(w != e and e.startswith(w) and not w.endswith(" ") for w in want):
            continue
        odds = math.log((r["toxic"] + 0.5) / 301) - math.log((r["clean"] + 0.5) / 3001)
        if r["toxic"] * math.log(r["toxic"] / (r["toxic"] + r["clean"]) / base) >= least and odds > 0:
            want[e] = odds
    assert set(got) - {"the "} == set(want) - {"the "} and all(abs(got[e] - want[e]) < 1e-12 for e in got)


def test_score_fit_descends_to_the_least_loss():
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    x = np.stack([y * 2.0 + rng.normal(0, 1, 400), y + rng.normal(0, 1, 400)], axis=1)
    b, w1, w2 = toxicity._fit_score([tuple(r) for r in x], y.tolist())
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(b, w1, w2):
        z = x @ np.array([w1, w2]) + b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5e-4 * (w1**2 + w2**2))

    own = loss(b, w1, w2)
    assert all(own <= loss(b + db, max(w1 + d1, 0.05), max(w2 + d2, 0.05)) + 1e-6 for db in (-0.05, 0, 0.05) for d1 in (-0.05, 0, 0.05) for d2 in (-0.05, 0, 0.05))

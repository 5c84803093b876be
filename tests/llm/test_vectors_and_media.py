import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from evigrid.llm import ann, media


def brute(ids, x, every, k=10):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], "e") for i, row in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, score string")


def test_full_recall_is_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 8)).astype(np.float32).astype(float)
    x[10:30] = x[0]
    ids = np.arange(60)
    odd = spark.createDataFrame([(100, None, "e"), (110, [0.0] * 8, "e"), (120, [1.0, None] + [1.0] * 6, "e"), (130, [float("nan")] * 8, "e"), (140, [1.0], "e"), (None, [1.0] * 8, "e")], "vec_id long, embedding array<float>, score string")
    df = frame(spark, ids, x).union(odd).union(frame(spark, ids[:1], x[:1]))
    got: dict = {}
    for r in ann.nearest(df, every=10, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = brute(ids, x, 10)
    assert {q: [v for v, _ in w] for q, w in got.items()} == {q: [v for v, _ in w] for q, w in want.items()}
    assert all(np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-14) for q in want)
    few = ann.nearest(frame(spark, ids[:4], x[:4]), every=2).collect()
    assert len(few) == 6
    assert ann.nearest(df.limit(0)).count() == 0 and ann.nearest(odd.where("embedding is null")).count() == 0


def test_recall(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 24)).astype(np.float32).astype(float)
    ids = np.arange(3000)
    monkeypatch.setattr(ann, "CHUNK", 500)
    want, found = brute(ids, x, 30), {}
    for r in ann.nearest(frame(spark, ids, x), every=30).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len({v for v, _ in w} & found[q]) / 10 for q, w in want.items()])
    assert recall >= 0.9
    assert all(len(f) == 10 for f in found.values())


def recall_of(spark, x, every):
    ids = np.arange(len(x))
    want, found = brute(ids, x, every), {}
    for r in ann.nearest(frame(spark, ids, x), every=every).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    return {q: len({v for v, _ in w} & found.get(q, set())) / 10 for q, w in want.items()}


def share_compared(model, x, every):
    """Share of all rows that lie in the buckets which a query visits."""
    q = np.arange(0, len(x), every)
    pull, spread = model.around(q, x[q], 10)
    seen = np.zeros((len(q), len(x)), bool)
    for t in range(len(model.directions)):
        seen |= model.probes(x[q], t, pull, spread)[:, model.cells(x, t)]
    return seen.mean()


def test_recall_on_clusters_and_shifted_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 500)
    monkeypatch.setattr(ann, "SAMPLE", 1500)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 24))
    x[::3] = rng.standard_normal(24) + 0.05 * rng.standard_normal((1000, 24))
    hot = recall_of(spark, x.astype(np.float32).astype(float), 40)
    assert np.mean([r for q, r in hot.items() if q % 3 == 0]) >= 0.9 and np.mean([r for q, r in hot.items() if q % 3]) >= 0.9
    shifted = recall_of(spark, (rng.standard_normal((3000, 24)) + 5).astype(np.float32).astype(float), 60)
    assert np.mean(list(shifted.values())) >= 0.9


def test_few_rows_are_compared_where_vectors_have_clusters(spark):
    rng = np.random.default_rng(8)
    x = (rng.standard_normal((60, 32))[rng.integers(0, 60, 6000)] + 0.05 * rng.standard_normal((6000, 32))).astype(np.float32).astype(float)
    df = frame(spark, np.arange(6000), x)
    model = ann.fit(ann.valid_vectors(df))
    assert share_compared(model, x, 100) <= 0.1
    assert np.mean(list(recall_of(spark, x, 100).values())) >= 0.9


def test_projections_grow_with_the_table(spark):
    x = np.random.default_rng(9).standard_normal((2000, 8)).astype(np.float32).astype(float)
    valid = ann.valid_vectors(frame(spark, np.arange(2000), x))
    few, many = (ann.fit(valid, n=n).directions.shape[1] for n in (50, 5_000_000))
    assert few < many


def test_a_query_that_found_too_few_visits_all(spark):
    x = np.concatenate([np.tile([5.0, 5.0], (3, 1)) + [[0, 0], [0.1, 0], [0, 0.1]], np.random.default_rng(3).standard_normal((200, 2)) - 5])
    df = frame(spark, np.arange(203), x)
    model = ann.fit(ann.valid_vectors(df), recall=0.1, tables=1, projections=4)
    got = ann.nearest(df, every=200, model=model)
    want = {q: [v for v, _ in w] for q, w in brute(np.arange(203), x.astype(np.float32).astype(float), 200).items()}
    assert {r.query_id for r in got.collect()} == {0, 200} and got.count() == 20
    assert [r.vec_id for r in got.where("query_id = 0").orderBy("rank").collect()] == want[0]


def test_chunks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 8)).astype(np.float32).astype(float)
    df = frame(spark, np.arange(400), x)
    model = ann.fit(ann.valid_vectors(df), recall=0.5, projections=5)
    found = []
    for chunk in (37, 399, 400, 4096):
        monkeypatch.setattr(ann, "CHUNK", chunk)
        found.append(sorted(map(tuple, ann.nearest(df, every=20, model=model).collect())))
    assert found[0] == found[1] == found[2] == found[3]


def test_chances_add_up_and_buckets_come_in_order():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((50, 5))
    model = ann.Tables(rng.standard_normal((1, 3, 5)), 0.3 * rng.standard_normal((1, 3)), x.mean(axis=0), np.arange(50), x, 0.8)
    q = rng.standard_normal((7, 5))
    pull, spread = model.around(np.arange(7) + 100, q, 10)
    chance = model.chances(q, 0, pull, spread)
    assert np.allclose(chance.sum(axis=1), 1)
    visit, own = model.probes(q, 0, pull, spread), model.cells(q, 0)
    for i in range(7):
        least = np.sort(chance[i])[::-1][: np.searchsorted(np.cumsum(np.sort(chance[i])[::-1]), 0.8) + 1][-1]
        assert visit[i, own[i]] and set(np.flatnonzero(visit[i])) == set(np.flatnonzero(chance[i] >= least)) | {own[i]}


def test_media_round_trip(spark):
    texts = [None, "", "x", "é" * 31, "a" * 64, "b" * 65, "lorem ipsum " * 5000, "x"]
    df = spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)], "doc_id long, text string, feature string")
    rows = {r.doc_id: r for r in media.describe_documents(df, store_media=True).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + bytes((-len(raw)) % 64 if raw else 64)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and media.read_wav(bytes(r.media)) == payload
        assert (r.media_bytes, r.media_sha256) == (len(r.media), hashlib.sha256(bytes(r.media)).hexdigest())
        assert len(r.peak_hashes) == len(r.peak_times) and r.feature.startswith(f"{len(r.peak_hashes)}:")
    assert rows[2].feature == rows[7].feature and rows[0].feature == rows[1].feature
    assert media.describe_documents(df.limit(0)).count() == 0


def test_spectrogram_equals_direct_transform():
    samples = np.random.default_rng(0).integers(0, 256, 3000).astype(np.uint8)
    got = np.concatenate(list(media.spectrogram(samples)))
    padded = np.concatenate([samples.astype(float) - 128, np.zeros(media.FRAME)])
    for f in (0, 3, len(got) - 1):
        piece = padded[f * media.HOP : f * media.HOP + media.FRAME] * np.hanning(media.FRAME)
        assert np.allclose(got[f], np.abs(np.fft.rfft(piece)), atol=1e-1)


def test_peaks_survive_blocks(monkeypatch):
    samples = np.frombuffer(("the quick brown fox " * 400).encode(), np.uint8)
    whole = media.fingerprint(samples)
    monkeypatch.setattr(media, "BLOCK_FRAMES", 5)
    parts = media.fingerprint(samples)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def test_invalid_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, float("inf")]), (2, [1.0, 2.0]), (3, [])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in ann.valid_vectors(df).select(F.col("vec_id")).collect()] == [2]

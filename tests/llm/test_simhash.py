import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from evigrid.llm import graph, simhash


def brute_fingerprint(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(pairs, bits=3):
    """pairs: (doc_id, fingerprint); least id reachable, by exhaustive comparison."""
    root = {i: i for i in range(len(pairs))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    out = {}
    for i in range(len(pairs)):
        out.setdefault(find(i), []).append(pairs[i][0])
    return [min((d for d in out[find(i)] if d is not None), default=None) for i in range(len(pairs))]


def texts():
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    out = [None, "", " \n", "One", "one two", "ONE two", "É é", "x y z", "x  y\tz"]
    for _ in range(15):
        base = [rng.choice(words) for _ in range(rng.randint(30, 400))]
        out.append(" ".join(base))
        for _ in range(6):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = rng.choice(words)
            out.append(" ".join(other))
    return out


def test_fingerprints():
    for t in [*texts(), "long " * 1000 + "tail"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_chunks_make_no_difference(monkeypatch):
    t = " ".join(map(str, range(1000)))
    whole = simhash.fingerprint(t)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(t) == whole == brute_fingerprint(t)


def test_classes_equal_brute_force(spark):
    rows = [(i, t, "e", 5) for i, t in enumerate(texts())] + [(None, "only here", None, None), (3, "One", "f", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id long").repartition(5)
    got = simhash.classes(docs).collect()
    pairs = [(r.doc_id, r.fp & 0xFFFFFFFFFFFFFFFF) for r in got]
    assert sorted(map(str, pairs)) == sorted(str((d, brute_fingerprint(t))) for d, t, *_ in rows)
    assert [r.component_id for r in got] == brute_classes(pairs)
    assert simhash.classes(docs.limit(0)).count() == 0


def test_links_at_every_distance():
    rng = random.Random(9)
    tuples = simhash._postings_64(3)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        same = [(a >> 8 * p & 255) == (b >> 8 * p & 255) for p in range(8)]
        assert sum(same) >= 5 and any(all(same[p] for p in t) for t in tuples)


def test_long_posting_lists_are_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    base = rng.getrandbits(40)
    fps = sorted({base ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)) for _ in range(300)})
    nodes = spark.createDataFrame([(f,) for f in fps], "node long").withColumn("words", F.array("node"))
    monkeypatch.setattr(simhash, "BLOCK", 40)
    links = simhash.linked_pairs(nodes.select(F.lit(1).cast("long").alias("key"), "node"), nodes, 1, 3, 5)
    roots = {r.node: r.root for r in graph.components(links).collect()}
    assert [roots.get(f, f) for f in fps] == brute_classes([(f, f) for f in fps])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, j) for j in range(101, 200)] + [(300, 300), (401, 400), (400, 401)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 200)}, 400: 400, 401: 400}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_class_stays(spark):
    rng = random.Random(8)
    words = ["v%d" % i for i in range(2000)]
    base = [rng.choice(words) for _ in range(400)]
    near = list(base)
    near[200] = "other"
    far = [rng.choice(words) for _ in range(400)]
    rows = [(5, " ".join(base)), (2, " ".join(near)), (9, " ".join(base)), (7, " ".join(far)), (None, " ".join(far)), (7, " ".join(far)), (11, " ".join(far[:200] + base[:200]))]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, _kept string, component long")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 7, 11]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_wide_fingerprints_estimate_similarity():
    rng = random.Random(4)
    words = ["v%d" % i for i in range(5000)]
    base = [rng.choice(words) for _ in range(2000)]
    other = base[:1800] + [rng.choice(words) for _ in range(200)]
    a, b = (set(zip(*(x[i:] for i in range(5)), strict=False)) for x in (base, other))
    jaccard = len(a & b) / len(a | b)
    x = simhash.wide_fingerprint(" ".join(base), 5, 32) ^ simhash.wide_fingerprint(" ".join(other), 5, 32)
    assert abs(int(np.bitwise_count(x).sum()) / (32 * 64) - simhash.max_share(jaccard)) < 0.03


def brute_sets(rows, similarity=0.8, k=5):
    """Rows of one class by exhaustive comparison of shingle sets."""
    sets = []
    for t in rows:
        w = t.lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= similarity * len(a | b) - 1e-9:
                root[find(i)] = find(j)
    return {frozenset(j for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))}


def threshold_texts():
    """Pairs at and just around a similarity of 0.8, long and short."""
    out = []
    for pair in range(40):
        w = [f"p{pair}x{i}" for i in range(400)]
        for n, cut in ((9, 8), (10, 9), (11, 10), (12, 9), (84, 68), (84, 67), (304, 244), (304, 243)):
            out += [" ".join(f"{n}{x}" for x in w[:n]), " ".join(f"{n}{x}" for x in w[:cut])]
    shared = " ".join(f"s{i}" for i in range(60))
    return out + [f"a{i} b{i} c{i} {shared}" for i in range(30)] + [f"{shared} " + " ".join(f"own{i}x{j}" for j in range(60)) for i in range(30)] + ["", " ", "one"]


def test_near_copies_equal_brute_force_at_the_threshold(spark, monkeypatch):
    rows = threshold_texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    want = brute_sets(rows)
    for chars in (1 << 24, 3000):
        monkeypatch.setattr(simhash, "GROUP_CHARS", chars)
        found: dict = {}
        for r in simhash.near_copies(docs).collect():
            found.setdefault(r.component, set()).add(r.doc_id)
        assert set(map(frozenset, found.values())) == want


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    for n in range(1, 120):
        h = np.sort(rng.integers(0, 1 << 63, n + 60).astype(np.uint64))
        often = np.sort(rng.choice(h, 20, replace=False))
        a = np.sort(rng.choice(h, n, replace=False))
        b = np.sort(rng.choice(a, -(-8 * n // 10), replace=False))
        assert set(simhash.prefix(a, 0.8, often)) & set(simhash.prefix(b, 0.8, often))

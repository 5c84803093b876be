"""SimHash near-duplicates by an inverted index over positional bytes with count filtering.

A fingerprint of 64 bits has eight positional bytes. Two fingerprints that differ in at most ``d``
bits share at least ``8 - d`` of them, so ``8 - d`` is the guaranteed minimum of shared bytes. The
index posts a fingerprint under tuples of its bytes; any pair that reaches the minimum meets in a
posting list. There the shared positional bytes are tallied, pairs below the minimum are dropped
and the rest are verified by Hamming distance. A list gives a spanning forest of its verified
links, never its pairs.

Wide fingerprints (several 64-bit words) estimate the resemblance of shingle sets: two sets of
cosine ``c`` differ in a share ``acos(c) / pi`` of bits. They tell which sets may be near copies of
a Jaccard similarity of 0.8 or more, whose 64-bit fingerprints may differ in a dozen bits; the sets
themselves decide.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import each_text, fresh, ids_and_texts, own_columns, remove, small_batches, stored
from .graph import components

SEED = 42
#: Rows of a posting list that one task compares; longer lists are compared block by block.
BLOCK = 32_768
#: Shingles hashed at once, so that long texts need bounded memory.
CHUNK = 262_144
#: Of distinct shingles that are counted at once for a wide fingerprint.
WIDE_CHUNK = 8192

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, k: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the ``k``-word shingles of a text, in chunks.

    Words are maximal runs free of ASCII white space, A-Z lower-cased. A text of fewer than ``k``
    words gives one shingle of all its words; a text without words gives none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    if len(words) < k:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    total = len(words) - k + 1
    for at in range(0, total, CHUNK):
        part = words[at : min(at + CHUNK, total) + k - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(k)), strict=False))
        yield np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64, len(part) - k + 1)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, by a histogram of each positional byte."""
    columns = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        return np.unpackbits(columns, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS_OF_BYTE for i in range(8)])


def _packed(counts: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)


def fingerprint(text: str | None, k: int = 3) -> int:
    """The 64-bit SimHash: a bit is 1 if set in over half the shingle hashes, repeats included; 0 without words."""
    counts, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, k):
        counts += _bit_counts(h)
        n += len(h)
    return int(_packed(counts, n)[0]) if n else 0


def _mixed(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` further independent 64-bit hashes of each shingle hash, words x shingles."""
    rounds = np.arange(1, words + 1, dtype=np.uint64)[:, None] * _MIX
    g = (h[None, :] ^ rounds) * np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(31)
    g *= np.uint64(0x94D049BB133111EB)
    g ^= g >> np.uint64(29)
    return g


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Distinct shingle hashes of a text in ascending order, none without words."""
    parts = list(shingle_hashes(text, k))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def wide_fingerprint(text: str | None, k: int, words: int) -> np.ndarray:
    """A SimHash of ``words`` x 64 bits over the set of shingles, all zero without words."""
    return _wide(shingle_set(text, k), words)


def _wide(h: np.ndarray, words: int) -> np.ndarray:
    """One histogram over all positional bytes of a chunk gives the counts of all bits."""
    if not len(h):
        return np.zeros(words, np.uint64)
    histogram = np.zeros(words * 8 * 256, np.int64)
    place = (np.arange(words * 8, dtype=np.int64) * 256).reshape(words, 1, 8)
    for at in range(0, len(h), WIDE_CHUNK):
        g = _mixed(h[at : at + WIDE_CHUNK], words)
        histogram += np.bincount((g.view(np.uint8).reshape(words, -1, 8) + place).ravel(), minlength=len(histogram))
    counts = histogram.reshape(-1, 256).astype(np.float64) @ _BITS_OF_BYTE.astype(np.float64)
    return np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's bits as a signed long), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in each_text(batches):
            fps = np.array([fingerprint(t, k) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(fps)], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return ids_and_texts(docs).mapInArrow(run, "doc_id long, fp long")


def _byte(word: Column, position: int) -> Column:
    return F.shiftrightunsigned(word, 8 * position).bitwiseAND(F.lit(255))


def _postings_64(max_bits: int) -> list[tuple[int, ...]]:
    """Byte tuples such that fingerprints within ``max_bits`` share one whole tuple.

    At least m = 8 - max_bits bytes are shared. Of the first t + max_bits positions at least t are,
    for any t up to m; tuples of t of them are the keys. t = 3 keeps lists short at 20 keys.
    """
    least = 8 - max_bits
    if least < 1:
        raise ValueError("max_bits must be below 8: no byte is sure to be shared otherwise")
    t = min(3, least)
    return list(itertools.combinations(range(t + max_bits), t))


def _near(words: np.ndarray, one: np.ndarray, max_bits: int, min_bytes: int) -> np.ndarray:
    """Which rows of ``words`` share at least ``min_bytes`` positional bytes with ``one`` and differ in at most ``max_bits``."""
    x = words ^ one
    shared = (x.view(np.uint8).reshape(len(x), -1) == 0).sum(axis=1)
    kept = np.flatnonzero(shared >= min_bytes)
    return kept[np.bitwise_count(x[kept]).sum(axis=1) <= max_bits]


def _forest(words: np.ndarray, max_bits: int, min_bytes: int) -> list[tuple[int, int]]:
    """Spanning forest (child, parent) of the rows that link, by breadth-first search."""
    left = np.arange(len(words))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            hit = _near(words[left], words[queue.pop()], max_bits, min_bytes)
            if len(hit):
                found = left[hit]
                edges += [(int(i), int(root)) for i in found]
                queue += found.tolist()
                left = np.delete(left, hit)
    return edges


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Whole posting lists (key, node, words) of a stream sorted by key; a list is at most BLOCK rows or one block pair."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        words = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, width)
        last = key != key[-1]
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            held.append((key[:cut], node[:cut], words[:cut]))
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
        elif held and held[-1][0][-1] != key[0]:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
        held.append((key[cut:], node[cut:], words[cut:]))
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _links(width: int, max_bits: int, min_bytes: int):
    """Map function: sorted posting lists to verified links (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node, words in _runs(batches, width):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            u: list[np.ndarray] = []
            v: list[np.ndarray] = []
            two = starts[sizes == 2]
            if len(two):
                x = words[two] ^ words[two + 1]
                shared = (x.view(np.uint8).reshape(len(x), -1) == 0).sum(axis=1)
                ok = two[(shared >= min_bytes) & (np.bitwise_count(x).sum(axis=1) <= max_bits)]
                u.append(node[ok + 1])
                v.append(node[ok])
            for at, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                edges = _forest(words[at : at + size], max_bits, min_bytes)
                if edges:
                    e = np.array(edges) + at
                    u.append(node[e[:, 0]])
                    v.append(node[e[:, 1]])
            if u and sum(map(len, u)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    return run


def linked_pairs(postings: DataFrame, nodes: DataFrame, width: int, max_bits: int, min_bytes: int) -> DataFrame:
    """Verified links ``u``, ``v`` between the nodes that share a posting list.

    ``postings`` has ``key``, ``node``; ``nodes`` has ``node`` and ``words`` (array of ``width``
    longs). Lists of one row are dropped by a count with map-side combine. A list longer than BLOCK
    is dealt into random blocks and each pair of blocks becomes a list of its own, so that no task
    holds more than two blocks and no link is lost.
    """
    spark = postings.sparkSession
    counts = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    several, path = stored(postings.join(counts, "key"), "postings")
    short = several.where(F.col("n") <= BLOCK).select("key", "node")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # a key of a block pair (i, j) holds the members of both blocks
    long_lists = (
        several.where(F.col("n") > BLOCK)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(F.xxhash64("key", F.least(own, "other"), F.greatest(own, "other")).alias("key"), "node")
        .distinct()
    )
    lists = short.union(long_lists).join(nodes, "node").select("key", "node", "words")
    links = lists.repartition("key").sortWithinPartitions("key").mapInArrow(_links(width, max_bits, min_bytes), "u long, v long")
    out, _ = stored(links.distinct(), "links")
    remove(spark, path)
    return out


def classes(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp``, ``component_id``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest
    ``doc_id`` reachable. Null and empty texts have fingerprint zero and link like any other.
    Repeated rows stay repeated; ids that are null are ignored in the minimum, and a component of
    null ids only has a null component. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fps, _ = stored(fingerprints(docs, k), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    keyed = nodes.select(F.col("fp").alias("node"))
    keys = F.array(*(
        F.xxhash64(F.lit(i), *(_byte(F.col("node"), p) for p in tuple_)) for i, tuple_ in enumerate(_postings_64(max_bits))
    ))
    postings = keyed.select(F.explode(keys).alias("key"), "node")
    links = linked_pairs(postings, keyed.select("node", F.array("node").alias("words")), 1, max_bits, 8 - max_bits)
    roots = components(links)
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


#: Words of a wide fingerprint.
WIDE_WORDS = 16
#: Characters of a group of candidates that one task compares; larger groups are compared block by block.
GROUP_CHARS = 16 << 20
#: Texts looked at for frequent shingles, how many of them share one, and frequent shingles at most. They only order the postings.
FREQUENT_SAMPLE, FREQUENT_LEAST, FREQUENT_MOST = 2000, 4, 100_000


def max_share(similarity: float) -> float:
    """Expected share of differing bits of two equal-sized sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def loose_share(similarity: float, words: int) -> float:
    """Share of differing bits that no pair of this similarity exceeds: a quarter over the expected one, as small sets
    have (ties count as 0; five hashes against four of them differ in 0.19 of all bits), and six standard deviations.
    """
    share = 1.25 * max_share(similarity)
    return share + 6 * math.sqrt(share * (1 - share) / (64 * words))


def prefix(h: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """Shingles that a set is posted under: two sets of at least this Jaccard similarity have one in common.

    They share ``similarity`` of each set's shingles at least, so in any common order, here by hash with
    frequent shingles last, the first ones that may be missing and one more meet.
    """
    if not len(h):
        return h
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
        h = np.concatenate([h[~often], h[often]])
    return h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]


def _frequent(texts: DataFrame, k: int) -> np.ndarray:
    """Shingles that several texts of a bounded sample share, in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in each_text(batches):
            for t in some:
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, k).view(np.int64))], names=["h"])

    n = max(texts.count(), 1)
    drawn = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < FREQUENT_SAMPLE / n)
    often = drawn.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= FREQUENT_LEAST).orderBy(F.desc("count"), "h").limit(FREQUENT_MOST)
    return np.sort(np.array([r["h"] for r in often.collect()], dtype=np.int64).view(np.uint64))


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _set_forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Spanning forest (child, parent) of the sets whose Jaccard similarity is at least ``similarity``."""
    if len(sets) == 2:
        return [(1, 0)] if _alike(*sets, similarity) else []
    sizes = np.array([len(x) for x in sets])
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    own = lambda i: flat[starts[i] : starts[i + 1]]
    left = np.arange(len(sets))
    edges: list[tuple[int, int]] = []
    marked = np.zeros(len(vocabulary), bool)
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        pieces, at = flat[starts[root + 1] :] if len(left) == len(sets) - 1 else np.concatenate([own(i) for i in left]), np.r_[0, np.cumsum(sizes[left])]
        while queue and len(left):
            one = queue.pop()
            marked[own(one)] = True
            both = np.add.reduceat(marked[pieces].astype(np.int64), at[:-1])
            marked[own(one)] = False
            hit = both >= similarity * (sizes[one] + sizes[left] - both) - 1e-9
            if hit.any():
                found = left[hit]
                edges += [(int(i), int(root)) for i in found]
                queue += found.tolist()
                left = left[~hit]
                pieces, at = pieces[np.repeat(~hit, np.diff(at))], np.r_[0, np.cumsum(sizes[left])]
    return edges


def _set_links(k: int, similarity: float):
    """Map function: groups of texts sorted by ``key`` to the links (u, v) that their shingle sets confirm."""

    def links(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        edges = _set_forest(sets, similarity) if len(sets) > 1 else []
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in edges], pa.int64()), pa.array([nodes[j] for _, j in edges], pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets = None, [], []
        for batch in batches:
            for key, node, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key != now:
                    yield from links(nodes, sets)
                    now, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(shingle_set(text, k))
        yield from links(nodes, sets)

    return run


_ROW_KEYS = ["_keep_id", "_keep_null", "_keep_hash"]


def _row_keys(docs: DataFrame, names: list[str] = _ROW_KEYS) -> DataFrame:
    """``docs`` with columns of these names that tell its rows apart: the id or -1, whether it is null, the text's hash."""
    hashed = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumns(dict(zip(names, (F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), hashed), strict=True)))


def near_copies(docs: DataFrame, k: int = 5, similarity: float = 0.8, words: int = WIDE_WORDS) -> DataFrame:
    """Classes of near copies: ``doc_id``, ``text_hash``, ``node``, ``component`` for each row of ``docs``.

    ``node`` stands for texts of one shingle set; ``component`` is the least node reachable over
    links of a Jaccard similarity of at least ``similarity``. Sets that meet under a posted shingle
    and whose fingerprints are not surely too far apart join into groups of candidates; within a
    group the sets themselves are compared. A group over ``GROUP_CHARS`` is dealt into blocks, each
    pair of which is compared.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = ids_and_texts(docs)
    frequent = _frequent(texts, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, some in each_text(batches):
            sets = [shingle_set(t, k) for t in some]
            fps = np.array([_wide(h, words) for h in sets], dtype=np.uint64)
            posted = [prefix(h, similarity, frequent) for h in sets]
            nodes = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in sets], dtype=np.uint64).view(np.int64)
            hashes = np.array([xxhash.xxh64_intdigest((t or "").encode("utf-8", "surrogatepass"), SEED) for t in some], dtype=np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, words * len(fps) + 1, words, dtype=np.int32), pa.array(fps.view(np.int64).ravel()))
            keys = pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in posted])].astype(np.int32), pa.array(np.concatenate(posted).view(np.int64)))
            sizes = pa.array([len(t or "") for t in some], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(hashes), pa.array(nodes), lists, keys, sizes], names=["doc_id", "text_hash", "node", "words", "keys", "chars"])

    rows, _ = stored(texts.mapInArrow(run, "doc_id long, text_hash long, node long, words array<long>, keys array<long>, chars long"), "wide")
    nodes = rows.select("node", "words").groupBy("node").agg(F.first("words").alias("words"))
    postings = rows.select("node", F.explode("keys").alias("key")).distinct().select("key", "node")
    bound = loose_share(similarity, words)
    near = components(linked_pairs(postings, nodes, words, int(bound * 64 * words), int(words * 8 * (1 - bound) ** 8 / 4)))
    # one row stands for each node; the characters of a group give its number of blocks
    firsts = rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "chars")).alias("o"))
    members = near.join(firsts, "node").select(
        "node", "root", F.coalesce("o.doc_id", F.lit(-1)).alias("_keep_id"), F.col("o.no_id").alias("_keep_null"), F.col("o.text_hash").alias("_keep_hash"), F.col("o.chars").alias("chars")
    )
    members, path = stored(members, "members")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("chars") / GROUP_CHARS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        members.join(blocks, "root").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", *_ROW_KEYS, F.xxhash64("root", F.least(own, "other"), F.greatest(own, "other")).alias("key"))
    )
    groups = _row_keys(texts).join(dealt, _ROW_KEYS).select("key", "node", "text").dropDuplicates(["key", "node"])
    links, links_path = stored(groups.repartition("key").sortWithinPartitions("key").mapInArrow(_set_links(k, similarity), "u long, v long").distinct(), "alike")
    roots = components(links).withColumnRenamed("root", "component")
    remove(spark, path, links_path)
    return rows.select("doc_id", "text_hash", "node").join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))


def keep_one(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class of near copies: that of the smallest ``doc_id``.

    Ties (equal ids, repeated rows) go to the smaller hash of the text, then any one of the equal
    rows stays. A null id counts as larger than all. All columns are kept, whatever their names.
    """
    found, _ = stored(near_copies(docs, k, similarity), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    names = fresh(docs, *_ROW_KEYS)
    kept = found.groupBy("component").agg(F.min(order).alias("o")).select(
        F.coalesce("o.doc_id", F.lit(-1)).alias(names[0]), F.col("o.no_id").alias(names[1]), F.col("o.text_hash").alias(names[2])
    ).distinct()
    out = _row_keys(docs, names).join(kept, names, "left_semi")
    if not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(names)
    return out.select(*own_columns(docs))

"""Target-distribution importance resampling over an integer word dictionary.

In each block of texts the distinct words are numbered by a dictionary, n-grams are tuples of these
numbers, and the block's distinct tuples are found by sorting them. Each distinct tuple gets its bytes
back and is hashed once into a bucket; buckets and counts are joined back to the documents by the
tuple's number. A document's weight is the mean gain of its features between the source's and the
target's bucket counts; a Gumbel draw by id turns weights into a sample without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from ._common import ids_and_texts, small_batches, stored

BUCKETS = 10_000
#: Least and greatest number of words in an n-gram.
GRAMS = (1, 1)
#: Documents with fewer words are never drawn; of the others this share of a hundred is.
LEAST_WORDS = 20
DRAWN_PERCENT = 10
SALT = "2024:"
#: By byte: A-Z as a-z, digits, letters and all bytes beyond ASCII as they are, anything else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a block, the word at each place, and where each text's places begin."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    # a copy starts at offset 0; each byte is mapped to one byte, so offsets stay
    texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    mapped = pa.py_buffer((data.to_pybytes() if data else b"").translate(_LETTERS))
    lists = pc.split_pattern(pa.StringArray.from_buffers(len(texts), offsets, mapped), " ")
    flat, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    found = flat.filter(full).dictionary_encode()
    counts = np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return found.dictionary.to_pylist(), found.indices.to_numpy(), np.r_[0, np.cumsum(counts)].astype(np.int64)


def _distinct(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the row at each place."""
    if runs.shape[1] == 1:
        found, which = np.unique(runs[:, 0], return_inverse=True)
        return found[:, None], which
    found, which = np.unique(runs, axis=0, return_inverse=True)
    return found, which.ravel()


def bucket_counts(texts: pa.Array, grams: tuple[int, int], buckets: int) -> dict[str, np.ndarray]:
    """A block's documents: ``n_words``, ``n_features``, ``sizes`` (distinct buckets of each), ``bucket`` and ``count`` of these."""
    words, codes, starts = _words(texts)
    encoded = [w.encode() for w in words]
    n_words = np.diff(starts)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    keys = []
    for n in range(grams[0], grams[1] + 1):
        m = max(0, len(codes) - n + 1)
        inside = doc[:m] == doc[len(doc) - m :]  # a run stays within its document
        runs = np.stack([codes[i : i + m] for i in range(n)], axis=1)[inside]
        tuples, which = _distinct(runs)
        hashed = np.array([zlib.crc32(b" ".join([encoded[i] for i in t])) % buckets for t in tuples.tolist()], np.int64)
        keys.append(doc[:m][inside] * buckets + hashed[which])
    packed, count = np.unique(np.concatenate(keys), return_counts=True)
    owner, bucket = np.divmod(packed, buckets)
    n_features = np.bincount(owner, count, len(n_words)).astype(np.int64)
    return {"n_words": n_words, "n_features": n_features, "sizes": np.bincount(owner, minlength=len(n_words)).astype(np.int32), "bucket": bucket.astype(np.int32), "count": count.astype(np.int32)}


def feature_blocks(docs: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """One row per block: arrays over its documents, and the buckets and counts of each document's features one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks.blocks(batches):
            found = {"doc_ids": block.column(0)} | {k: pa.array(v) for k, v in bucket_counts(block.column(1), grams, buckets).items()}
            yield pa.RecordBatch.from_arrays([blocks.list_array(np.array([len(v)]), v) for v in found.values()], names=list(found))

    small_batches(docs.sparkSession)
    blocks.block_batches(docs.sparkSession)
    return ids_and_texts(docs).mapInArrow(run, "doc_ids array<long>, n_words array<long>, n_features array<long>, sizes array<int>, bucket array<int>, count array<int>")


def totals(cut: DataFrame, buckets: int) -> np.ndarray:
    """Features by bucket over all blocks: each task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(added, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy().astype(np.int64))
        held = np.flatnonzero(added)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(added[held])], names=["bucket", "count"])

    out = np.zeros(buckets, np.int64)
    for r in cut.select("bucket", "count").mapInArrow(run, "bucket long, count long").groupBy("bucket").agg(F.sum("count").alias("count")).collect():
        out[r["bucket"]] = r["count"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, floored."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((int(t) + 1) * (s_all + n) / ((int(s) + 1) * (t_all + n)))) for s, t in zip(source, target, strict=True)], np.int64)


def noise(doc_id: Column) -> Column:
    """A Gumbel draw by id, in thousandths; a null id counts as the empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(SALT), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weights(docs: DataFrame, target: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` (floored mean gain; 0 without features) of every document."""
    cut, _ = stored(feature_blocks(docs, grams, buckets), "features")
    gain = gains(totals(cut, buckets), totals(feature_blocks(target, grams, buckets), buckets))
    by_bucket = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = by_bucket.value
        for batch in batches:
            for b in range(batch.num_rows):
                of = {name: batch.column(name)[b].values.to_numpy() for name in batch.schema.names if name != "doc_ids"}
                total = np.zeros(len(of["sizes"]), np.int64)
                np.add.at(total, np.repeat(np.arange(len(total)), of["sizes"]), of["count"] * gain[of["bucket"]])
                weight = np.where(of["n_features"] > 0, total // np.maximum(of["n_features"], 1), 0)
                columns = [batch.column("doc_ids")[b].values, pa.array(of["n_words"]), pa.array(of["n_features"]), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return cut.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (from 1 among the drawn, null for the others) of every document.

    Of the documents with ``least_words`` words, ``percent`` of a hundred are drawn, rounded down: those of
    highest score, ties to the smaller id. A null or empty text has no words: weight 0, never drawn.
    A null id draws as the empty text and comes last among ties. Repeated rows are documents of their
    own, told apart in ties by nothing but their place. An empty table gives no rows; an empty target
    makes gains by smoothing alone. Other columns are ignored. The driver holds the buckets' counts
    alone; a rank counts the documents of each higher score first, of which there are some ten thousand.
    """
    scored = weights(docs, target, grams, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    scored, _ = stored(scored, "scores")
    may = scored.where(F.col("n_words") >= least_words)
    per_score = may.groupBy("score").agg(F.count("*").alias("docs"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    drawn = F.floor(F.sum("docs").over(everything) * percent / 100)
    before = per_score.select("score", F.coalesce(F.sum("docs").over(higher), F.lit(0)).alias("before"), drawn.alias("drawn")).where("before < drawn")
    place = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())
    ranked = may.join(before, "score").withColumn("rank", (F.col("before") + F.row_number().over(place)).cast("long"))
    names = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*names, F.when(F.col("rank") <= F.col("drawn"), F.col("rank")).alias("rank"))
    rest = scored.join(before.select("score", F.lit(True).alias("met")), "score", "left").where((F.col("n_words") < least_words) | F.col("met").isNull())
    return ranked.union(rest.select(*names, F.lit(None).cast("long").alias("rank")))

"""Language identification by nearest centroid over TF-IDF vectors of hashed byte n-grams.

Each language has several centroids, clustered from a bounded sample of labelled texts; a text goes
to the language of the centroid of largest cosine. A text whose best cosine falls below what training
texts and pieces of them with as many distinct n-grams reach in that language is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh, id_crc, new_names, own_columns, small_batches

#: Hashed n-gram features; n-grams of these many bytes.
FEATURES = 2048
GRAMS = (1, 2, 3, 4)
#: Training texts of each language, and of all, at most: a bounded sample by hash of the id. Clusters of each language.
SAMPLE, SAMPLE_OF_ALL = 1000, 8000
CLUSTERS = 3
#: A text is rejected below this quantile of the cosines of its language's pieces of like size, less a share of its gap to the median.
REJECT_QUANTILE, REJECT_MARGIN = 0.01, 0.25
#: Sizes are distinct features, in classes of half a power of two; a class counts with so many pieces.
SIZES, SIZE_LEAST = 2 * 11 + 1, 30
#: Steepness of the score over the cosine margins of the languages.
SHARPNESS = 20.0
#: Bytes hashed at once, so that long texts need bounded memory.
BLOCK = 1 << 20
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_SIGNS = regex.compile(r"[^\p{L}\p{M}]+")


def counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text's lower-case letters, other signs taken as one blank."""
    data = np.frombuffer((" " + _SIGNS.sub(" ", text.lower()) + " ").encode("utf-8", "replace"), np.uint8)
    total = np.zeros(FEATURES, np.float32)
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK + max(GRAMS) - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            code = code[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :] if n > 1 else part
            own = code[: BLOCK if at + BLOCK < len(data) else None]
            if n in GRAMS and len(own):
                mixed = (own + np.uint32(n)) * np.uint32(2654435761)
                total += np.bincount(mixed >> np.uint32(21), minlength=FEATURES)[:FEATURES]
    return total


@dataclass
class Centroids:
    """A fitted classifier: idf weights, unit centroids with their language, and least accepted cosines, languages x sizes."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray
    languages: list[str]

    def vectors(self, matrix: np.ndarray) -> np.ndarray:
        """Unit TF-IDF vectors, term counts damped by a root."""
        v = np.sqrt(matrix) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text; ``und`` with score 0, rejected, where there is no letter."""
        blank = np.array([not t or not _LETTER.search(t) for t in texts])
        names, score, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        rows = np.flatnonzero(~blank)
        if len(rows) and len(self.languages):
            matrix = np.stack([counts(texts[i]) for i in rows])
            cosine = self.vectors(matrix) @ self.centroids.T
            best = np.stack([cosine[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)
            e = np.exp(SHARPNESS * (best - best.max(axis=1, keepdims=True)))
            top = best.argmax(axis=1)
            score[rows] = (e / e.sum(axis=1, keepdims=True))[np.arange(len(rows)), top]
            at = _size(matrix)
            least = np.array([np.interp(x, np.arange(SIZES), self.least[k]) for x, k in zip(at, top, strict=True)])
            rejected[rows] = best[np.arange(len(rows)), top] < least
            for i, k in zip(rows, top, strict=True):
                names[i] = self.languages[k]
        return names, score, rejected


def _size(matrix: np.ndarray) -> np.ndarray:
    """Size of each text: twice the binary logarithm of its distinct features."""
    return 2 * np.log2(np.maximum((matrix > 0).sum(axis=1), 1))


def pieces(text: str) -> list[str]:
    """The text and pieces of 1, 2, 4, ... of its words, each from its own place."""
    words = text.split()
    sizes = [1 << i for i in range(len(words).bit_length()) if 1 << i < len(words)]
    starts = [(i + 1) * 7919 % (len(words) - n + 1) for i, n in enumerate(sizes)]
    return [text, *(" ".join(words[at : at + n]) for at, n in zip(starts, sizes, strict=True))]


def _least(size: np.ndarray, cosine: np.ndarray) -> np.ndarray:
    """Least accepted cosine at each size; sizes with few pieces take theirs from those around."""
    known, least = [0], [0.0]
    for i in range(1, SIZES):
        own = cosine[np.round(size) == i]
        if len(own) >= SIZE_LEAST:
            low, middle = np.quantile(own, [REJECT_QUANTILE, 0.5])
            known.append(i)
            least.append(max(low - REJECT_MARGIN * (middle - low), 0.0))
    return np.interp(np.arange(SIZES), known, least)


def _clusters(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the means of equal parts along the main axis; deterministic for given rows."""
    axis = v - v.mean(axis=0)
    along = axis @ np.linalg.svd(axis, full_matrices=False)[2][0]
    c = np.stack([v[part].mean(axis=0) for part in np.array_split(np.argsort(along, kind="stable"), min(k, len(v)))])
    for _ in range(12):
        near = (v @ c.T).argmax(axis=1)
        sums = np.stack([v[near == i].sum(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, held_out_only: bool = True) -> Centroids:
    """Learn from ``text`` and non-null ``lang`` of rows that are not held out, about ``sample`` of each language.

    Rows are held out if the CRC-32 of the id's text has remainder 2 modulo 4. The sample takes the
    rows whose hashed id falls below a share that the language's count gives, so it is bounded
    whatever the table's size and number of languages. No row of its kind: a classifier without languages.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    if held_out_only:
        known = known.where(id_crc() % 4 != 2)
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Centroids(np.ones(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32), np.zeros(0, int), np.zeros((0, SIZES)), [])
    sample = min(sample, -(-SAMPLE_OF_ALL // len(languages)))
    share = F.element_at(F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, sample / n))), F.col("lang"))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [counts(t).astype("<f4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "lang", "counts"])

    small_batches(docs.sparkSession)
    found = drawn.mapInArrow(run, "doc_id long, lang string, counts binary").toPandas().sort_values(["lang", "doc_id", "counts"])
    matrix = np.stack([np.frombuffer(b, "<f4") for b in found["counts"]]) if len(found) else np.zeros((0, FEATURES), np.float32)
    idf = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    model = Centroids(idf, np.zeros((0, FEATURES), np.float32), np.zeros(0, int), np.zeros((0, SIZES)), [])
    vectors, labels = model.vectors(matrix), found["lang"].to_numpy()
    centroids, owner = [], []
    for lang in languages:
        v = vectors[labels == lang]
        if len(v):
            c = _clusters(v, clusters)
            centroids.append(c)
            owner += [len(model.languages)] * len(c)
            model.languages.append(lang)
    if not centroids:
        return model
    model.centroids, model.owner = np.concatenate(centroids).astype(np.float32), np.array(owner)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                matrix = np.stack([counts(t) for t in pieces(text) if _LETTER.search(t)] or [np.zeros(FEATURES, np.float32)])
                own = model.owner == (model.languages.index(lang) if lang in model.languages else -1)
                if matrix.any() and own.any():
                    cosine = (model.vectors(matrix) @ model.centroids[own].T).max(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(matrix)), pa.array(_size(matrix)), pa.array(cosine.astype(float))], names=["lang", "size", "cosine"])

    got = drawn.mapInArrow(reached, "lang string, size double, cosine double").toPandas()
    model.least = np.stack([_least(*(got.loc[got["lang"] == lang, c].to_numpy() for c in ("size", "cosine"))) for lang in model.languages])
    return model


def predict(docs: DataFrame, model: Centroids, names: tuple[str, str, str] | None = None) -> DataFrame:
    """``docs`` with the language, its score and whether it is rejected as its last three columns.

    They are called ``_lang_pred``, ``_lang_score`` and ``_lang_rejected``, led by more underscores where
    ``docs`` has such columns, or ``names``, which must be new.

    Only the text is looked at. Null texts and texts without a letter are ``und``, rejected, with
    score 0. Ties go to the first language by name. Rows and other columns stay as they are;
    nothing is shuffled, and the model that goes to each task is bounded by languages x clusters.
    """

    @F.pandas_udf("struct<lang:string,score:double,rejected:boolean>")
    def classify(texts):
        import pandas as pd

        langs, score, rejected = model.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang": langs, "score": score, "rejected": rejected})

    small_batches(docs.sparkSession)
    names = new_names(docs, names, "_lang_pred", "_lang_score", "_lang_rejected")
    found = fresh(docs, "_lang")[0]
    out = docs.withColumn(found, classify(F.col("text").cast("string")))
    return out.select(*own_columns(docs), *(F.col(found)[part].alias(name) for part, name in zip(("lang", "score", "rejected"), names, strict=True)))


def accepted(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns."""
    names = fresh(docs, "_lang_pred", "_lang_score", "_lang_rejected")
    return predict(docs, model, names).where(~F.col(names[2])).select(*own_columns(docs))

"""Approximate nearest neighbours by multiprobe p-stable hashing with exact reranking.

A table hashes a vector by Gaussian projections, each cut into two cells at its median. How a
query's neighbours project is modelled from the query's own nearest rows in a bounded sample: normal
around the query's projection, drawn towards the mean. The chance that a bucket holds a neighbour is
the product over the projections of the normal mass of its cells. Each table's buckets are visited in
the order of that chance until the chance to miss a neighbour in all tables is small enough; the
query's own bucket always is. Candidates of all tables are merged and ranked by exact distance. A
query that found fewer than it asked for visits all buckets of one table.

The number of projections grows with the table: of all choices, the fit takes the one at which the
sample's queries compare the fewest rows and visit the fewest buckets. Every valid row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored

SEED = 7
TABLES = 2
#: Projections of a table that the fit chooses from, and rows that cost as much to compare as a bucket to visit.
PROJECTIONS = range(1, 13)
VISIT_COST = 8
#: Rows of the fitting sample and its queries, and the share of true neighbours to be found.
SAMPLE, SAMPLE_QUERIES = 4000, 100
RECALL = 0.95
#: Candidates and queries that one task compares at once.
CHUNK = 4096
NEIGHBOURS = 10


@dataclass
class Tables:
    """Projections of each table, their medians, the sample that tells how a query's neighbours project, and the mass to visit."""

    directions: np.ndarray  # tables x projections x dimensions
    borders: np.ndarray  # tables x projections
    mean: np.ndarray
    ids: np.ndarray
    sample: np.ndarray
    mass: float

    @property
    def buckets(self) -> int:
        return 1 << self.directions.shape[1]

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        """Bucket numbers of vectors in a table."""
        above = (x @ self.directions[table].T > self.borders[table]).astype(np.int64)
        return above @ (1 << np.arange(above.shape[1])[::-1])

    def around(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query how far its nearest other sample rows are drawn to the mean, and their spread around that."""
        pull, spread = np.ones(len(q)), np.full(len(q), np.inf)
        for i in range(len(q)):
            d = self.sample - q[i]
            d = np.einsum("ij,ij->i", d, d)
            d[self.ids == q_ids[i]] = np.inf
            near = np.argpartition(d, k - 1)[:k] if len(d) > k else np.arange(len(d))
            near = near[np.isfinite(d[near])]
            if len(near):
                own, rest = q[i] - self.mean, self.sample[near] - self.mean
                pull[i] = np.clip((rest @ own).mean() / max(own @ own, 1e-300), 0, 1)
                spread[i] = math.sqrt(((rest - pull[i] * own) ** 2).sum(axis=1).mean() / q.shape[1])
        return pull, np.maximum(spread, 1e-9 * (np.abs(q).max(axis=1) + 1e-300))

    def chances(self, q: np.ndarray, table: int, pull: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """For each query the chance of each bucket to hold a neighbour, queries x buckets."""
        out = np.ones((len(q), 1))
        for direction, border in zip(self.directions[table], self.borders[table], strict=True):
            middle = self.mean @ direction
            z = (border - middle - pull * (q @ direction - middle)) / (spread * max(np.linalg.norm(direction), 1e-300))
            below = 0.5 * (1 + _erf(z / math.sqrt(2)))
            out = (out[:, :, None] * np.stack([below, 1 - below], axis=1)[:, None, :]).reshape(len(q), -1)
        return out

    def probes(self, q: np.ndarray, table: int, pull: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Buckets that each query visits, in estimated order of success until the mass is reached; queries x buckets, true or false."""
        chance = self.chances(q, table, pull, spread)
        order = np.argsort(-chance, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
        visit = np.zeros(chance.shape, bool)
        np.put_along_axis(visit, order, np.hstack([np.ones((len(q), 1), bool), sums[:, :-1] < self.mass]), axis=1)
        visit[np.arange(len(q)), self.cells(q, table)] = True
        return visit


_erf = np.vectorize(math.erf, otypes=[float])


def _matrix(column: pa.Array) -> np.ndarray:
    """List column to a matrix in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of rows that take part.

    Left out: null ids, null or empty vectors, zero vectors, and vectors with a null, infinite or
    NaN component, or of another length than the most common one.
    """
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    e = F.col("embedding")
    finite = ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)).where(finite & F.exists(e, lambda x: x != 0))
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("embedding") == lengths[0]["n"]) if lengths else rows


def fit(valid: DataFrame, recall: float = RECALL, tables: int = TABLES, projections: int | None = None, k: int = NEIGHBOURS, n: int | None = None) -> Tables | None:
    """Fit on the ``SAMPLE`` rows of least hashed id; None for an empty table.

    ``projections`` None: as many as make the sample's queries cheapest at the table's ``n`` rows.
    The mass to visit per table follows from the recall wanted, taking the tables as independent.
    """
    rows = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not rows:
        return None
    n = n or valid.count()
    x, ids = np.array([r["embedding"] for r in rows], dtype=np.float64), np.array([r["vec_id"] for r in rows])
    every = np.random.default_rng(SEED).standard_normal((tables, max(PROJECTIONS) if projections is None else projections, x.shape[1]))
    medians = np.median(np.einsum("tpd,nd->tpn", every, x), axis=2)
    mass = 1 - (1 - recall) ** (1 / tables)

    def model(m: int) -> Tables:
        return Tables(every[:, :m], medians[:, :m], x.mean(axis=0), ids, x, mass)

    if projections is not None:
        return model(projections)
    q, q_ids = x[:SAMPLE_QUERIES], ids[:SAMPLE_QUERIES]
    pull, spread = model(1).around(q_ids, q, k)
    best, least = model(PROJECTIONS[0]), math.inf
    for m in PROJECTIONS:
        if 1 << m > max(n, 2):
            break
        tried, cost = model(m), 0.0
        for t in range(tables):
            visit = tried.probes(q, t, pull, spread)
            share = np.bincount(tried.cells(x, t), minlength=tried.buckets) / len(x)
            cost += n * (visit @ share).mean() + VISIT_COST * visit.sum(axis=1).mean()
        if cost < least:
            best, least = tried, cost
    return best


def _best(vec_ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least scores, ties to the smaller id."""
    if len(score) > k:
        limit = np.partition(score, k - 1)[k - 1]
        kept = np.flatnonzero(score <= limit)
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((vec_ids[kept], score[kept]))[:k]]


def _rerank(k: int, low_bits: int):
    """Cogroup function: exact distances of a region's candidates to its queries, in the buckets that each visits; the k best of each."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s, out_n = [], [], [], []
        if left.num_rows and right.num_rows:
            ids, bucket = left.column("vec_id").to_numpy(), left.column("bucket").to_numpy()
            x = _matrix(left.column("embedding").combine_chunks())
            q_ids = right.column("query_id").to_numpy()
            q = _matrix(right.column("embedding").combine_chunks())
            visits = right.column("visit").to_pylist()
            for i in range(len(q_ids)):
                visited = np.unpackbits(np.frombuffer(visits[i], np.uint8), count=1 << low_bits).astype(bool)
                other = np.flatnonzero(visited[bucket] & (ids != q_ids[i]))
                diff = x[other] - q[i]
                score = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                best = _best(ids[other], score, k)
                out_q.append(np.full(len(best), q_ids[i]))
                out_v.append(ids[other[best]])
                out_s.append(score[best])
                out_n.append(np.full(len(best), len(other)))
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
        return pa.table({"query_id": join(out_q, pa.int64()), "vec_id": join(out_v, pa.int64()), "score": join(out_s, pa.float64()), "compared": join(out_n, pa.int64())})

    return run


def _found(valid: DataFrame, queries: DataFrame, model: Tables, n: int, n_queries: int, k: int, whole: bool) -> DataFrame:
    """The best of each query in each region: ``query_id``, ``vec_id``, ``score``, ``compared``; with ``whole`` of all buckets of one table."""
    tables, bits = 1 if whole else len(model.directions), model.directions.shape[1]
    # a region is a run of neighbouring buckets of about CHUNK rows; a query goes once to a region, with the buckets that it visits there
    low = bits - min(bits, max(0, math.ceil(math.log2(max(n, 1) / CHUNK))))
    regions = model.buckets >> low

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                for t in range(tables):
                    cell = model.cells(x, t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((cell >> low) + t * regions), pa.array((cell & ((1 << low) - 1)).astype(np.int32)), batch.column(0), batch.column(1)],
                        names=["region", "bucket", "vec_id", "embedding"],
                    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                q = _matrix(part.column(1))
                pull, spread = (None, None) if whole else model.around(part.column(0).to_numpy(), q, k)
                for t in range(tables):
                    visit = (np.ones((len(q), model.buckets), bool) if whole else model.probes(q, t, pull, spread)).reshape(len(q), regions, 1 << low)
                    row, region = np.nonzero(visit.any(axis=2))
                    packed = np.packbits(visit[row, region], axis=1)
                    taken = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(region + t * regions), part.column(0).take(taken), pa.array([p.tobytes() for p in packed], pa.binary()), part.column(1).take(taken)],
                        names=["region", "query_id", "visit", "embedding"],
                    )

    kind = valid.schema["embedding"].dataType.simpleString()
    indexed = valid.mapInArrow(index, f"region long, bucket int, vec_id long, embedding {kind}")
    # one row per region, of which there are tables x 2 ** projections at most
    sizes = F.broadcast(indexed.groupBy("region").count().select("region", F.ceil(F.col("count") / CHUNK).cast("int").alias("parts")))
    q_parts = max(1, -(-n_queries // CHUNK))
    left = (
        indexed.join(sizes, "region").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1)))).select("region", "part", "q_part", "bucket", "vec_id", "embedding")
    )
    right = (
        queries.mapInArrow(probe, f"region long, query_id long, visit binary, embedding {kind}").join(sizes, "region")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("q_part", F.pmod(F.xxhash64("query_id"), F.lit(q_parts)).cast("int"))
        .select("region", "part", "q_part", "query_id", "visit", "embedding")
    )
    keys = ["region", "part", "q_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rerank(k, low), "query_id long, vec_id long, score double, compared long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # a pair found in several tables has one score, so one rank; ranks are limited before the shuffle too
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.dense_rank().over(by_score)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, every: int = 100, recall: float = RECALL, model: Tables | None = None) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Queries are the valid rows whose id is divisible by ``every``, candidates all valid rows of
    another id. Scores are Euclidean distances in double precision; ties go to the smaller id. A
    query with fewer than ``k`` candidates has them all. Repeated rows of one id count once, by the
    least vector. An empty table gives no rows. Regions of neighbouring buckets are cut into chunks
    of about ``CHUNK`` candidates and queries, so a hot bucket is spread over tasks and nothing is
    left out.
    """
    spark = vectors.sparkSession
    valid, _ = stored(valid_vectors(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    n = valid.count()
    model = model or fit(valid, recall, k=k, n=n)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = valid.where(F.col("vec_id") % every == 0)
    best, _ = stored(_ranked(_found(valid, queries, model, n, n // every, k, whole=False), k), "neighbours")
    enough = best.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1))
    short = queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
    n_short = short.count()
    if not n_short:
        return best
    rest = _ranked(_found(valid, short, model, n, n_short, k, whole=True), k)
    return best.join(enough, "query_id", "left_semi").select(*rest.columns).union(rest)

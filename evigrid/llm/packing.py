"""Packing of documents into token sequences by non-negative least squares over length combinations.

A document's ids are cut into full windows and a rest. The rests' lengths form a histogram with at
most one bin for each length below the window. Pairs and triples of lengths that fill a window
exactly are enumerated, their repeat counts solve a non-negative least squares problem against the
histogram and are rounded to what is there; further exact fills are taken greedily in order of the
solution, and what is left is laid end to end, longest first, and cut at window edges. The last,
partial window is cut at powers of two, which need no padding. The plan has a size that depends on
the window alone; documents are numbered within their length by Spark and find their place by it.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks
from ._common import ids_and_texts, small_batches, stored

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 2048
#: Id that ends each document.
END = 1
#: Steps of the least-squares solver.
STEPS = 150
#: Rows of one numbering chunk, on average.
CHUNK_ROWS = 4096


class FileTokenizer:
    """Ids of whole texts by the tokenizer file.

    A text that holds an added token's string is encoded by the file's own library, any other by the
    rank-merging library over the file's ranks, which gives the same ids several times as fast.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        ranks, added = blocks.byte_level_file(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = "|".join(rf"\Q{a}\E" for a in added) or r"[^\s\S]"
        self.merges = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring_regex(texts, self.added).to_pylist()
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) if s else self.merges.encode_to_numpy(t, disallowed_special=())
            for t, s in zip(texts.to_pylist(), special, strict=True)
        ]


@functools.cache
def tokenizer(name: str) -> FileTokenizer:
    """The tokenizer of a worker, loaded once."""
    return FileTokenizer(public_tokenizers.path(name) if "/" not in name else name)


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of lengths present that sum to the window, as rows in rising order; a pair leads with 0."""
    lengths = np.flatnonzero(present[: window + 1])
    small = lengths[(lengths > 0) & (2 * lengths <= window)]
    pairs = small[present[window - small]]
    rows = [np.stack([np.zeros_like(pairs), pairs, window - pairs], axis=1)]
    for a in lengths[(lengths > 0) & (3 * lengths <= window)]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[present[window - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(rows)


def least_squares(columns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the columns that nearly minimise |A x - histogram|, by accelerated projected gradients.

    A's column for a combination counts each length in it; bin 0 is no length.
    """
    if not len(columns):
        return np.zeros(0)
    flat, n = columns.ravel(), len(histogram)

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, np.repeat(x, columns.shape[1]), n)
        out[0] = 0
        return out

    v = np.ones(len(columns))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        v = forward(v)[columns].sum(1)
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(columns))
    momentum = 1.0
    for _ in range(steps):
        after = np.maximum(0, y - step * (forward(y) - histogram)[columns].sum(1))
        further = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        y = after + (momentum - 1) / further * (after - x)
        x, momentum = after, further
    return x


@dataclass
class Plan:
    """Where the rests go: ranges of whole ones by length and number, and the line of those that may be cut."""

    window: int
    keys: np.ndarray  #: length << 40 | first number, rising
    ends: np.ndarray  #: number after the last
    sequences: np.ndarray  #: sequence of the first number
    offsets: np.ndarray
    whole: np.ndarray  #: by length: numbers from this on lie on the line
    line: np.ndarray  #: by length: where its first one lies on the line
    first_line_sequence: int
    edges: np.ndarray  #: of the last, partial window, from 0
    full_windows: int  #: edges of that window begin here, in windows

    def pieces(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """``start`` in the rest, ``length``, ``sequence``, ``offset`` of the pieces of a rest on the line."""
        at = int(self.line[length]) + (number - int(self.whole[length])) * length
        out, done = [], 0
        while done < length:
            place = at + done
            if place < self.full_windows * self.window:
                w, off = divmod(place, self.window)
                room, sequence = self.window - off, self.first_line_sequence + w
            else:
                place -= self.full_windows * self.window
                e = int(np.searchsorted(self.edges, place, "right")) - 1
                off, room, sequence = place - int(self.edges[e]), int(self.edges[e + 1]) - place, self.first_line_sequence + self.full_windows + e
            take = min(room, length - done)
            out.append((done, take, sequence, off))
            done += take
        return out


def plan(histogram: np.ndarray, first_sequence: int, window: int = WINDOW) -> Plan:
    """The plan for ``histogram[l]`` rests of each length ``l`` below the window; its sequences count from ``first_sequence``."""
    columns = combinations(histogram > 0, window)
    x = least_squares(columns, histogram.astype(float) / max(1, histogram.max(initial=0))) * max(1, histogram.max(initial=0))
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    order = np.argsort(-x, kind="stable")
    rows, rounded = columns.tolist(), np.rint(x).astype(np.int64).tolist()
    found: list[tuple[int, int, int, int, int]] = []
    sequence = first_sequence
    remaining = left.tolist()
    taken = used.tolist()
    for greedy in (False, True):
        for c in order.tolist():
            want = rounded[c]
            if not greedy and not want:
                break
            a, b, d = rows[c]
            most = min(remaining[d] // ((d == b) + (d == a) + 1), remaining[b] // ((b == d) + (b == a) + 1))
            if a:
                most = min(most, remaining[a] // ((a == b) + (a == d) + 1))
            count = most if greedy else min(most, want)
            if not count:
                continue
            offset = 0
            for length in (d, b, a) if a else (d, b):
                found.append((length << 40 | taken[length], taken[length] + count, sequence, offset, length))
                taken[length] += count
                remaining[length] -= count
                offset += length
            sequence += count
    found.sort()
    table = np.array(found, np.int64).reshape(-1, 5)
    whole, left = np.array(taken, np.int64), np.array(remaining, np.int64)
    line, at = np.zeros_like(left), 0
    for length in range(window - 1, 0, -1):
        line[length] = at
        at += length * int(left[length])
    full, tail = divmod(at, window)
    edges = [0]
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    return Plan(window, table[:, 0], table[:, 1], table[:, 2], table[:, 3], whole, line, sequence, np.array(edges, np.int64), full)


def token_rows(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end: int | None = END) -> DataFrame:
    """``doc_id``, ``n`` (ids, the end id included), ``crcs`` of the full windows, ``rest_crc``, ``rest`` (ids after the last full window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        last = np.array([] if end is None else [end], "<u4")
        for block in blocks.blocks(batches):
            n, crcs, rest_crc, rests = [], [], [], []
            for found in bpe.encode(block.column(1)):
                ids = np.concatenate([found, last]).astype("<u4")
                n.append(len(ids))
                cut = len(ids) // window * window
                crcs.append([zlib.crc32(ids[i : i + window].tobytes()) for i in range(0, cut, window)])
                rests.append(ids[cut:].tobytes())
                rest_crc.append(zlib.crc32(rests[-1]))
            columns = [block.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rest_crc, pa.int64()), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "crcs", "rest_crc", "rest"])

    small_batches(docs.sparkSession)
    blocks.block_batches(docs.sparkSession)
    return ids_and_texts(docs).mapInArrow(run, "doc_id long, n long, crcs array<long>, rest_crc long, rest binary")


def _numbered(rows: DataFrame, chunks: int) -> DataFrame:
    """``rows`` with ``number`` within their ``r`` and ``windows_before``, the full windows of the rows of their ``r`` before them.

    Two levels: rows of one split are numbered in one window, the splits' sums in another, so that a
    length that a third of all documents have is dealt to many tasks.
    """
    cut = rows.withColumn("split", F.pmod(F.xxhash64("k"), F.lit(chunks)))
    sums = cut.groupBy("r", "split").agg(F.count("*").alias("rows"), F.sum("full").alias("windows"))
    earlier = Window.partitionBy("r").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("r", "split", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in ("rows", "windows")))
    within = Window.partitionBy("r", "split").orderBy("k")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    counted = cut.withColumn("at", F.row_number().over(within) - 1).withColumn("w", F.coalesce(F.sum("full").over(before), F.lit(0)))
    return counted.join(starts, ["r", "split"]).withColumn("number", F.col("at") + F.col("rows_start")).withColumn("windows_before", F.col("w") + F.col("windows_start"))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end: int | None = END) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers), ``doc_tokens``,
    ``sequence_id``, ``offset``. Each sequence is filled from offset 0 without a gap, to the window or
    to a power of two.

    A null or empty text has the end id alone, so it still is one piece; without an end id it has
    none. Equal rows and equal ids are packed as rows of their own. Documents of any length take as
    many windows as they fill. An empty table gives no pieces. Other columns are ignored. The driver
    holds the histogram of rests and the plan, both bounded by the window. Ids are stored once in the
    shared folder, so a lost executor repeats only what it was doing.
    """
    spark = docs.sparkSession
    rows, _ = stored(token_rows(docs, vocabulary, window, end).withColumn("k", F.monotonically_increasing_id()), "tokens")
    narrow = rows.select("k", "doc_id", "n", "crcs", "rest_crc", (F.col("n") % window).alias("r"), F.floor(F.col("n") / window).cast("long").alias("full")).where("n > 0")
    counted = {int(r["r"]): (r["rows"], r["windows"]) for r in narrow.groupBy("r").agg(F.count("*").alias("rows"), F.sum("full").alias("windows")).collect()}
    histogram = np.array([counted.get(r, (0, 0))[0] if r else 0 for r in range(window)] + [0], np.int64)
    windows = np.array([counted.get(r, (0, 0))[1] for r in range(window)], np.int64)
    first_window = np.r_[0, np.cumsum(windows)]
    made = spark.sparkContext.broadcast((plan(histogram, int(first_window[-1]), window), first_window))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, first = made.value
        names = ["k", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            r, number = np.array(columns[5], np.int64), np.array(columns[7], np.int64)
            at = np.searchsorted(where.keys, r << 40 | number, "right") - 1
            for i, (k, doc, n, crcs, rest_crc, rest, full, num, windows_before) in enumerate(zip(*columns, strict=True)):
                for w, crc in enumerate(crcs):
                    out.append((k, doc, w * window, window, crc, n, int(first[rest]) + windows_before + w, 0))
                if not rest:
                    continue
                if num < where.whole[rest]:
                    p = at[i]
                    out.append((k, doc, full * window, rest, rest_crc, n, int(where.sequences[p]) + num - (int(where.keys[p]) & (1 << 40) - 1), int(where.offsets[p])))
                    continue
                for start, length, sequence, offset in where.pieces(rest, num):
                    out.append((k, doc, full * window + start, length, rest_crc if length == rest else None, n, sequence, offset))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 8)], names=names)

    chunks = max(1, -(-sum(n for n, _ in counted.values()) // CHUNK_ROWS))
    numbered = _numbered(narrow, chunks).select("k", "doc_id", "n", "crcs", "rest_crc", "r", "full", "number", "windows_before")
    schema = "k long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    pieces, _ = stored(numbered.mapInArrow(place, schema), "pieces")
    # only rests that were cut need their ids again
    ids = F.substring(F.col("rest"), ((F.col("start") % window) * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    cut = pieces.where("ids_crc32 is null").join(rows.select("k", "rest"), "k").withColumn("ids_crc32", F.crc32(ids))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.where("ids_crc32 is not null").select(*names).union(cut.select(*names))

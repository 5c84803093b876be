"""Alignment of two tokenizers' tokens over the bytes of the same text.

Every distinct chunk of a block is encoded once by both sides. Running sums of token sizes give the
bytes where tokens end; where both sides end, a group of tokens closes, for all chunks of a block at
once. Pairs of ids that share a group are counted by the documents that hold them, over the whole
corpus, and the counts are joined back to the blocks.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from ._common import ids_and_texts, small_batches, stored

A_VOCABULARY = "byte_bpe_50k.json"
B_VOCABULARY = "piece_bpe_32k.model"
#: Transitions that are remembered.
TRANSITIONS = 300_000
#: Chunks whose digest texts are joined at once.
JOINED = 100_000
#: Blocks in a stored file; a block's arrays are some MB, and a task reads a file's at once.
FILE_BLOCKS = 8


class Transducer:
    """Cuts two token sequences into groups that cover the same bytes, token by token.

    It says for one chunk what ``Aligner.aligned`` finds for all chunks of a block; a test holds both
    against each other. The side behind reads next, and a transition is remembered.
    A state is twice a number, plus 1 if A leads, so that B reads next; state 0: nothing dangles.
    Ids of both sides are below 2 to the 20th.
    """

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.forget()

    def forget(self) -> None:
        #: by half the state: the bytes by which one side leads
        self.dangling: list[bytes] = [b""]
        self.numbers: dict[tuple[int, bytes], int] = {}
        #: by state and next token: the state after it, -1 if their bytes differ
        self.moves: dict[int, int] = {}

    def _state(self, a_leads: int, dangling: bytes) -> int:
        if not dangling:
            return 0
        state = self.numbers.get((a_leads, dangling))
        if state is None:
            state = self.numbers[a_leads, dangling] = len(self.dangling) * 2 + a_leads
            self.dangling.append(dangling)
        return state

    def move(self, state: int, token: int) -> int:
        """State after the side behind reads ``token``; where nothing dangles, A reads."""
        a_leads, dangling = state & 1, self.dangling[state >> 1]
        read = self.b_bytes[token] if a_leads else self.a_bytes[token]
        if dangling.startswith(read):
            after = self._state(a_leads, dangling[len(read) :])
        elif read.startswith(dangling):
            after = self._state(1 - a_leads, read[len(dangling) :])
        else:
            after = -1
        self.moves[state << 20 | token] = after
        return after

    def groups(self, a: list[int], b: list[int]) -> list | None:
        """Groups in order, as A id << 32 | B id where both sides have one token, else as lists of both sides' ids; None if their bytes differ."""
        if len(self.moves) > TRANSITIONS:
            self.forget()
        out: list = []
        known = self.moves.get
        i = j = from_a = from_b = state = 0
        n_a, n_b = len(a), len(b)
        while state or i < n_a or j < n_b:
            if state & 1:
                if j == n_b:
                    return None
                token = b[j]
                j += 1
            else:
                if i == n_a:
                    return None
                token = a[i]
                i += 1
            after = known(state << 20 | token)
            state = self.move(state, token) if after is None else after
            if state <= 0:
                if state:
                    return None
                if i - from_a == 1 and j - from_b == 1:
                    out.append(a[from_a] << 32 | token)
                else:
                    out.append((a[from_a:i], b[from_b:j]))
                from_a, from_b = i, j
        return out


class Aligner:
    """Both tokenizers of a worker; nothing of a text is kept from one block to the next.

    Neither tokenizer merges over a blank within a text without runs of blanks, so each chunk with
    the blank before it has the tokens that it has within its text; other texts are one chunk.
    """

    def __init__(self, a_path: str, b_path: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        ranks, _ = blocks.byte_level_file(a_path)
        # without special tokens the rank-merging library gives the file's ids
        self.a = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        blank_inside = any("▁" in p.lstrip("▁") for p in pieces)
        self.whole = "(?s)." if blank_inside else rf"^ |  | $|\x00|{blocks.SPACES} {blocks.SPACES}"
        #: what the digest's text says of an id of A within a group and at its side's end, then the same of B
        said = [[f"{i}{sign}".encode() for i in range(n) for sign in signs] for n, signs in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))]
        self.said = pa.array(said[0] + said[1], pa.binary())

    def encoded(self, words: list[str], together: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A and of B and their chunks, all in order, without the chunks whose bytes B doesn't give back, and which these are.

        The first ``together`` chunks neither begin nor end with white space: A encodes them as one text.
        """
        led = [f" {w}" for w in words]
        sizes = np.array([len(x.encode()) for x in led], np.int64)
        ends = np.cumsum(sizes)
        a = self.a.encode_ordinary("".join(led[:together]))
        if together and not np.isin(ends[:together], np.cumsum(self.a_sizes[a])).all():
            a, together = [], 0
        for x in led[together:]:
            a += self.a.encode_ordinary(x)
        a = np.array(a, np.int64)
        of_a = np.searchsorted(ends, np.cumsum(self.a_sizes[a]))
        lists = self.b.encode(words, num_threads=1)
        b = np.fromiter(itertools.chain.from_iterable(lists), np.int64)
        of_b = np.repeat(np.arange(len(words)), np.fromiter(map(len, lists), np.int64, len(words)))
        read = np.zeros(len(words), np.int64)
        np.add.at(read, of_b, self.b_sizes[b])
        bad = read != sizes
        same = np.flatnonzero(~bad)
        if b"".join([self.b_bytes[i] for i in b[~bad[of_b]].tolist()]) != "".join([led[i] for i in same.tolist()]).encode():
            for i in same.tolist():
                bad[i] = b"".join([self.b_bytes[t] for t in lists[i]]) != led[i].encode()
        kept_a, kept_b = ~bad[of_a], ~bad[of_b]
        return a[kept_a], of_a[kept_a], b[kept_b], of_b[kept_b], bad

    def aligned(self, words: list[str], together: int) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Of each chunk: its numbers of tokens of A and B, groups and links (groups -1 if the bytes differ), its part of the digest's text, and how many pairs it has; then all chunks' linked pairs and how often each is linked."""
        a, of_a, b, of_b, bad = self.encoded(words, together)
        # both sides cover the same bytes, so one running count of bytes says where tokens end
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        owner = of_a[upto_a - 1]
        counts = np.zeros((len(words), 4), np.int64)
        for column, value in enumerate((n_a, n_b, 1, n_a * n_b)):
            np.add.at(counts[:, column], owner, value)
        counts[bad, 2] = -1
        # the digest's text: each group's tokens of A, then those of B
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        said = np.empty(len(a) + len(b), np.int64)
        said[at_a + (upto_b - n_b)[group_a]] = a * 2 + (at_a == upto_a[group_a] - 1)
        said[at_b + upto_a[group_b]] = (len(self.a_bytes) + b) * 2 + (at_b == upto_b[group_b] - 1)
        text = pc.binary_join(blocks.list_array(counts[:, 0] + counts[:, 1], self.said.take(pa.array(said))), b"")
        # a group's distinct ids of either side, so that a long group costs its pairs of ids and not of places
        (ids_a, times_a), (ids_b, times_b) = (np.unique(g << 20 | ids, return_counts=True) for g, ids in ((group_a, a), (group_b, b)))
        d_a, d_b = (np.bincount(ids >> 20, minlength=len(cuts)) for ids in (ids_a, ids_b))
        of = np.repeat(np.arange(len(cuts)), d_a * d_b)
        place = blocks.ranges(np.zeros(len(cuts), np.int64), d_a * d_b)
        left, right = (np.cumsum(d_a) - d_a)[of] + place // d_b[of], (np.cumsum(d_b) - d_b)[of] + place % d_b[of]
        lengths = np.zeros(len(words), np.int64)
        np.add.at(lengths, owner, d_a * d_b)
        low = (1 << 20) - 1
        return counts, text, lengths, (ids_a[left] & low) << 32 | ids_b[right] & low, times_a[left] * times_b[right]

    def block(self, ids: pa.Array, texts: pa.Array) -> dict[str, pa.Array]:
        """One block's documents, their linked pairs, and the block's distinct pairs."""
        words, codes, starts = blocks.chunked(texts, self.whole)
        plain = np.array([bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words], bool)
        if plain.any():
            # whole texts may hold runs of blanks but not at their ends, which is all that matters here
            order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
            back = np.empty(len(words), np.int64)
            back[order] = np.arange(len(words))
            words, codes = [words[i] for i in order.tolist()], back[codes]
        chunk_counts, said, lengths, keys, links = self.aligned(words, int(plain.sum()))
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        counts = chunk_counts[codes]
        ok = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False).copy()
        ok[owner[counts[:, 2] < 0]] = False
        sums = np.add.reduceat(counts, starts[:-1])
        sums[~ok] = 0
        shas = []
        for i, fine in enumerate(ok.tolist()):
            text = hashlib.sha256()
            for c in range(starts[i], starts[i + 1], JOINED) if fine else ():
                part = b"".join(said.take(pa.array(codes[c : min(c + JOINED, starts[i + 1])])).to_pylist())
                text.update(part if c + JOINED < starts[i + 1] else part[:-1])
            shas.append(text.hexdigest() if fine else "")
        # pairs by document: distinct chunks of each document first, then their pairs
        kept = ok[owner]
        per, times = np.unique(owner[kept] * len(words) + codes[kept], return_counts=True)
        doc, code = np.divmod(per, max(1, len(words)))
        distinct, number = np.unique(keys, return_inverse=True)
        at = blocks.ranges((np.cumsum(lengths) - lengths)[code], lengths[code])
        doc, times = np.repeat(doc, lengths[code]), np.repeat(times, lengths[code])
        both, place = np.unique(doc * max(1, len(distinct)) + number[at], return_inverse=True)
        linked = np.zeros(len(both), np.int64)
        np.add.at(linked, place, times * links[at])
        doc, pair = np.divmod(both, max(1, len(distinct)))
        held, pair = np.unique(pair, return_inverse=True)  # pairs of documents without tokens go
        one = {
            "doc_ids": ids, "n_a": pa.array(sums[:, 0]), "n_b": pa.array(sums[:, 1]), "n_groups": pa.array(sums[:, 2]), "n_links": pa.array(sums[:, 3]), "shas": pa.array(shas, pa.string()),
            "sizes": pa.array(np.bincount(doc, minlength=len(ids)).astype(np.int32)), "which": pa.array(pair.astype(np.int32)), "links": pa.array(linked),
            "pairs": pa.array(distinct[held]), "docs": pa.array(np.bincount(pair, minlength=len(held)).astype(np.int64)),
        }
        return {name: blocks.list_array(np.array([len(v)]), v) for name, v in one.items()}


@functools.cache
def aligner(a: str, b: str) -> Aligner:
    """The tokenizers of a worker, loaded once."""
    return Aligner(*(public_tokenizers.path(n) if "/" not in n else n for n in (a, b)))


def alignment_blocks(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> DataFrame:
    """One row per block: arrays over its documents, their linked pairs by number, and the block's distinct pairs with its documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        for block in blocks.blocks(batches):
            one = both.block(block.column(0), block.column(1))
            yield pa.RecordBatch.from_arrays(list(one.values()), names=list(one))

    small_batches(docs.sparkSession)
    blocks.block_batches(docs.sparkSession)
    documents = "doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, shas array<string>"
    return ids_and_texts(docs).mapInArrow(run, f"{documents}, sizes array<int>, which array<int>, links array<long>, pairs array<long>, docs array<long>")


def pair_counts(cut: DataFrame) -> DataFrame:
    """``pair`` (A id << 32 | B id), ``count`` (documents that hold it linked), ``best``: whether no pair of its A id has more."""
    counted = cut.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    counted, _ = stored(counted.withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> DataFrame:
    """Alignment of every whole text: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A encodes a blank and the text, B the text (it adds the blank). A null or empty text, and one whose
    bytes either side doesn't give back, has no tokens: zeros and ''. Repeated rows and ids are
    documents of their own. An empty table gives no rows. Other columns are ignored. Pairs are counted
    in each block first, so a pair that all documents hold is one row a block. Blocks are stored once
    in the shared folder, a few a file.
    """
    cut, _ = stored(alignment_blocks(docs, a, b).withColumn("block", F.monotonically_increasing_id()), "blocks", FILE_BLOCKS)
    flat = cut.select("block", F.posexplode("pairs").alias("at", "pair"))
    back = flat.join(pair_counts(cut), "pair").groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("found"))
    none = F.array().cast("array<struct<at:int,count:bigint,best:boolean>>")
    joined = cut.drop("pairs", "docs").join(back, "block", "left").withColumn("found", F.coalesce("found", none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                of = {name: batch.column(name)[i].values for name in batch.schema.names if name != "block"}
                sizes, which, links = (of[c].to_numpy() for c in ("sizes", "which", "links"))
                at = of["found"].field("at").to_numpy()
                count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                count[at] = of["found"].field("count").to_numpy()
                best[at] = of["found"].field("best").to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                n_best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                np.add.at(n_best, owner, links * best[which])
                np.add.at(total, owner, links * count[which])
                columns = [of[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(n_best), pa.array(total), of["shas"]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

"""Byte-level BPE as a monoid: encode halves, join neighbours, decode by concatenation up a tree.

A sequence of tokens is the encoding of its bytes exactly if every two neighbours are: encoding the
bytes of the two gives the two again. So when two encodings are joined, a window over the boundary
is encoded anew and grown until the tokens at its edges fit their neighbours outside; then no token
outside can change.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import each_text, ids_and_texts, small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes that are merged directly; longer pieces are halved.
LEAF = 6
#: Pieces whose ids a worker remembers.
REMEMBERED = 300_000
#: Tokens that are decoded at once at the tree's leaves.
DECODE_LEAF = 4096


class TreeBpe:
    """Encoder and decoder for a table of byte ranks, equal to the rank-merging library's results."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # three unassigned code points are letters to the regex module alone
        letter = r"[\p{L}--[\u0558\u058b\u058c]]"
        self.split = regex.compile(pattern.replace(r"\p{L}", letter), regex.V1)
        # No match of the pattern goes on past white space, but for one blank before it, so texts are
        # first cut there; the white space itself is cut as the pattern does.
        self.chunks = regex.compile(r" ?\S+|\s+(?!\S)|\s+")
        self._leaves: dict[bytes, list[int]] = {}
        self._joints: dict[tuple[int, int], list[int]] = {}
        self._packed: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> TreeBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def merge(self, data: bytes) -> list[int]:
        """Merge the neighbours of least rank, leftmost first, until none can merge."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, r in enumerate(pairs):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def joint(self, a: int, b: int) -> list[int]:
        """Encoding of the bytes of two tokens; the two themselves if they may stand next to each other."""
        known = self._joints.get((a, b))
        if known is None:
            if len(self._joints) > REMEMBERED:
                self._joints.clear()
            known = self._joints[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens may stand next to each other in an encoding."""
        return self.joint(a, b) == [a, b]

    def tree(self, data: bytes) -> list[int]:
        """Encoding of a piece by halves."""
        if len(data) <= LEAF:
            known = self._leaves.get(data)
            if known is None:
                if len(self._leaves) > REMEMBERED:
                    self._leaves.clear()
                known = self._leaves[data] = self.merge(data)
            return known
        middle = len(data) // 2
        return self.join(self.tree(data[:middle]), self.tree(data[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings one after the other."""
        window = self.joint(left[-1], right[0])
        if window == [left[-1], right[0]]:
            return left + right
        reach = 1
        while True:
            at, to = max(0, len(left) - reach), min(len(right), reach)
            if (not at or self.fits(left[at - 1], window[0])) and (to == len(right) or self.fits(window[-1], right[to])):
                return left[:at] + window + right[to:]
            reach *= 2
            window = self.merge(b"".join([self.tokens[t] for t in left[-reach:] + right[:reach]]))

    def piece(self, match: str) -> bytes:
        """Ids of one match of the pattern as little-endian 32-bit integers; a match that is a token is that token."""
        data = match.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        packed = np.array([whole] if whole is not None else self.tree(data), dtype="<u4").tobytes()
        return packed

    def chunk(self, chunk: str) -> bytes:
        """Ids of a run of letters with the blank before it, or of white space; short ones are remembered."""
        known = self._packed.get
        packed = b"".join([known(m) or self.piece(m) for m in self.split.findall(chunk)])
        if len(chunk) <= 64:
            if len(self._packed) > REMEMBERED:
                self._packed.clear()
            self._packed[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text, each match of the pattern separately, as little-endian unsigned 32-bit integers."""
        known = self._packed.get
        return b"".join([known(m) or self.chunk(m) for m in self.chunks.findall(text)])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids, concatenated up a binary tree."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@functools.cache
def tokenizer(name: str = VOCABULARY) -> TreeBpe:
    """The tokenizer of a worker, loaded once."""
    return TreeBpe.load(public_tokenizers.path(name) if "/" not in name else name)


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (array of int), ``ids_sha256``, ``decoded_sha256`` of every whole text.

    Null and empty texts have no tokens. Rows, ties and repeated ids stay as they are; other columns
    are ignored. Nothing is shuffled: a lost executor's partitions are simply encoded again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(vocabulary)
        for doc_ids, texts in each_text(batches):
            packed, ids_sha, text_sha = [], [], []
            for text in texts:
                data = bpe.encode(text or "")
                packed.append(data)
                ids_sha.append(hashlib.sha256(data).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(np.frombuffer(data, "<u4"))).hexdigest())
            counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts), lists, pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return ids_and_texts(docs).mapInArrow(run, schema)

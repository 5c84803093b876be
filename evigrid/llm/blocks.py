"""Blocks of texts inside a task: cut by bytes, split at blanks, and each distinct chunk handled once.

The operators on words and tokens work on blocks. A block's distinct chunks are found by Arrow's
dictionary encoding, the costly work is done on these alone, and results are spread over all places
by index. Chunks that a worker knows already are remembered within a bound.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of texts in a block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: White space of any kind, as the split patterns of byte-level tokenizers see it.
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def block_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts and of whole blocks near the size of one block."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 stands for itself, others for 256 and on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_file(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Bytes and ids of a byte-level tokenizer file's own tokens, and its added tokens.

    Its merges must rank as the ids do, so that merging by least id is what the file says.
    """
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    vocabulary, letters = parts["model"]["vocab"], byte_of_letter()
    added = [t["content"] for t in parts["added_tokens"]]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in parts["model"]["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        raise ValueError(f"{path}: merges do not rank as ids do")
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in added}, added


def blocks(batches: Iterator[pa.RecordBatch], text_column: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose texts hold at most ``BLOCK_BYTES``, but at least one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def chunked(texts: pa.Array, whole: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks between blanks, the chunk at each place, and where each text's places begin.

    A text that matches the pattern ``whole`` is one chunk; a null text counts as empty.
    """
    texts = pc.fill_null(texts, "")
    as_one = pc.match_substring_regex(texts, whole).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    found = lists.flatten().dictionary_encode()
    words, codes = found.dictionary.to_pylist(), found.indices.to_numpy()
    starts = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())].astype(np.int64)
    if as_one.any():
        parts = []
        for i in range(len(texts)):
            if as_one[i]:
                parts.append(np.array([len(words)], codes.dtype))
                words.append(texts[i].as_py())
            else:
                parts.append(codes[starts[i] : starts[i + 1]])
        codes, starts = np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
    return words, codes, starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), values)

"""Exact token counts at every prefix by dynamic programming, for BPE with an end-of-word suffix.

For a word, the last token of each prefix's encoding is the only vocabulary entry that ends there
and fits the last token of the prefix before it, so one pass gives the count of every prefix. For a
text, the counts of its words are summed up. Truncation and budget questions are then answered from
the stored counts, without encoding again.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import each_text, ids_and_texts, small_batches

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words whose counts, and pairs of tokens whose fit, a worker remembers.
REMEMBERED = 400_000

#: White space as the vocabulary's splitter sees it; str.split() also cuts at four separators that it takes for signs.
WHITE = regex.compile(r"\s+")
LETTER = r"[\p{L}--[\u0558\u058b\u058c]]"
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class PrefixCounter:
    """Token counts of the prefixes of words and texts under a vocabulary file of merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab = model["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        kinds = [p["type"] for p in spec["normalizer"]["normalizers"]], [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError(f"unknown normaliser or splitter: {kinds}")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # three unassigned code points are letters to the regex module alone
        self.words = regex.compile(pattern.replace(r"\p{L}", LETTER), regex.V1)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
        self.letters = _byte_letters()
        self.names = {i: t for t, i in self.vocab.items()}
        # the merge that makes each token: its rank and its two parts; letters have rank -1
        self.made = {}
        for i, (a, b) in enumerate(self.rank):
            self.made.setdefault(self.vocab[a + b], (i, self.vocab[a], self.vocab[b]))
        self.pair_rank = {(self.vocab[a], self.vocab[b]): i for i, (a, b) in enumerate(self.rank)}
        self._fits: dict[tuple[int, int], bool] = {}
        self._total: dict[str, int] = {}
        self.inner, self.ending = ahocorasick.Automaton(), ahocorasick.Automaton()
        for i, token in self.names.items():
            body = token.removesuffix(self.end) if self.end else token
            if body and self._whole(token):
                if token != body or not self.end:
                    self.ending.add_word(body, (len(body), i))
                if token == body:
                    self.inner.add_word(body, (len(body), i))
        self.inner.make_automaton()
        self.ending.make_automaton()

    def merge(self, parts: list[str]) -> list[str]:
        """Merge the neighbours of least rank, leftmost first, until none can merge."""
        parts = list(parts)
        rank = self.rank
        while len(parts) > 1:
            best, at = min((rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _letters_of(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens may be neighbours in an encoding.

        Merges are undone from the last on. The parts ``x`` and ``y`` that touch at the boundary
        live together until one of them is merged inside its own token; a merge of both that comes
        before that would join the tokens. Of equal ranks the left one comes first.
        """
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            known = self._fits[a, b] = self._never_joined(a, b)
        return known

    def _never_joined(self, x: int, y: int) -> bool:
        never = 1 << 60
        x_until = y_until = never
        made, pair_rank = self.made, self.pair_rank
        while True:
            rank = pair_rank.get((x, y), never)
            if rank < x_until and rank <= y_until and rank != never:
                return False
            x_made, y_made = made.get(x), made.get(y)
            if x_made is None and y_made is None:
                return True
            if y_made is None or (x_made is not None and x_made[0] > y_made[0]):
                x_until, _, x = x_made
            else:
                y_until, y, _ = y_made

    def _whole(self, token: str) -> bool:
        """Whether merging the token's letters gives the token; no other entry occurs in an encoding."""
        return self.merge(self._letters_of(token)) == [token]

    def word_prefixes(self, word: str) -> tuple[int, ...]:
        """Token counts of the prefixes of 1, 2, ... letters (bytes) of a word, each as a word of its own."""
        text = "".join([self.letters[b] for b in word.encode("utf-8", "replace")])
        last, counts, ended = [-1], [0], []
        fits, done = self._fits, 0
        for at, (length, token) in self.inner.iter(text):  # entries that end at each letter, by place
            if at == done:
                j = at + 1 - length
                if j:
                    known = fits.get((last[j], token))
                    if known is None:
                        known = self.fits(last[j], token)
                    if not known:
                        continue
                last.append(token)
                counts.append(counts[j] + 1)
                done += 1
        done = 0
        for at, (length, token) in self.ending.iter(text):
            if at == done:
                j = at + 1 - length
                if j:
                    known = fits.get((last[j], token))
                    if known is None:
                        known = self.fits(last[j], token)
                    if not known:
                        continue
                ended.append(counts[j] + 1)
                done += 1
        if len(last) != len(text) + 1 or len(ended) != len(text):
            raise ValueError(f"no token ends at some letter of {word!r}")
        return tuple(ended)

    def _chunk(self, chunk: str) -> int:
        """Tokens of a run of letters without white space; short runs are remembered."""
        known = self._total.get
        letters = chunk.lower() if chunk.isascii() else self.normal(chunk)
        n = sum([known(w) or self.word_prefixes(w)[-1] for w in self.words.findall(letters)])
        if len(chunk) <= 64:
            if len(self._total) > REMEMBERED:
                self._total.clear()
            self._total[chunk] = n
        return n

    def normal(self, text: str) -> str:
        """Composed, white space runs as one blank, lower case letter by letter."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return WHITE.sub(" ", text).replace("Σ", "σ").lower()

    def cut(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special strings, and those strings themselves."""
        at = 0
        for m in self.special.finditer(text) if "<|" in text else ():
            if m.start() > at:
                yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def cumulative(self, text: str) -> list[int]:
        """Token counts of a text up to the end of each run of letters without white space."""
        known = self._total.get
        counts: list[int] = []
        for part, special in self.cut(text):
            if special:
                counts.append(1)
                continue
            # no word spans white space, so runs are counted one by one; a run may hold no word
            runs = WHITE.split(part) if _SEPARATORS.search(part) else part.split()
            counts += [known(r) or self._chunk(r) for r in runs]
        return list(accumulate(counts))

    def count(self, text: str) -> int:
        return (self.cumulative(text) or [0])[-1]


class PrefixIndex:
    """The stored counts of one text: the token count at every prefix of its normalised form."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.text, self.ends, self.totals, self._words = "", [], [], []
        done = 0
        for part, special in counter.cut(text):
            part = part if special else counter.normal(part)
            for start, word in [(0, part)] if special else [(m.start(), m.group()) for m in counter.words.finditer(part)]:
                ends = tuple(0 if i + 1 < len(word) else 1 for i in range(len(word))) if special else self._by_letter(counter, word)
                self._words.append((len(self.text) + start, ends))
                done += ends[-1]
                self.ends.append(len(self.text) + start + len(word))
                self.totals.append(done)
            self.text += part

    @staticmethod
    def _by_letter(counter: PrefixCounter, word: str) -> tuple[int, ...]:
        by_byte = counter.word_prefixes(word)
        at = accumulate(len(c.encode("utf-8", "replace")) for c in word)
        return tuple(by_byte[i - 1] for i in at)

    @property
    def total(self) -> int:
        return self.totals[-1] if self.totals else 0

    def at(self, position: int) -> int:
        """Tokens of the first ``position`` letters of ``text``."""
        i = bisect_right(self.ends, position)
        done = self.totals[i - 1] if i else 0
        if i < len(self._words) and (start := self._words[i][0]) < position:
            done += self._words[i][1][position - start - 1]
        return done

    def longest_prefix(self, budget: int) -> int:
        """The end of the last whole word of the longest run of words within a token budget."""
        i = bisect_right(self.totals, budget)
        return self.ends[i - 1] if i else 0


@functools.cache
def counter(name: str = VOCABULARY) -> PrefixCounter:
    """The counter of a worker, loaded once."""
    return PrefixCounter(public_tokenizers.path(name) if "/" not in name else name)


def count_documents(docs: DataFrame, limit: int = LIMIT, vocabulary: str = VOCABULARY, store_prefixes: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``, ``words_in_limit`` of every whole text.

    ``words_in_limit`` is how many leading words fit the limit, read off the stored prefix counts.
    With ``store_prefixes`` the column ``prefix_tokens`` holds the count at the end of every word.
    Null texts count as empty, with no bytes and no tokens. Rows, ties and repeated ids stay as they
    are, other columns are ignored, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for doc_ids, texts in each_text(batches):
            sums = [c.cumulative(t or "") for t in texts]
            totals = np.array([s[-1] if s else 0 for s in sums], dtype=np.int64)
            columns = [
                doc_ids,
                pa.array([len((t or "").encode("utf-8", "replace")) for t in texts], pa.int64()),
                pa.array(totals),
                pa.array(totals > limit),
                pa.array([bisect_right(s, limit) for s in sums], pa.int64()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "words_in_limit"]
            if store_prefixes:
                columns.append(pa.array(sums, pa.list_(pa.int64())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    small_batches(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, words_in_limit long"
    return ids_and_texts(docs).mapInArrow(run, schema + ", prefix_tokens array<long>" * store_prefixes)

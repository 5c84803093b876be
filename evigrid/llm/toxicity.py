"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, strips accents, and maps homoglyphs of other scripts and digit or sign
substitutions to the Latin letters they stand for. The lexicon holds whole words and word beginnings
with log-odds weights, learned from labelled documents. Matches inside an exception phrase do not
count. The weight of a text's matches, and the same normalised by its length, give its score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh, id_crc, new_names, own_columns, small_batches

#: Labelled rows used for training at most: a bounded sample by hash of the id.
SAMPLE = 20_000
#: Letters of a word beginning, the least toxic documents of an entry, and its least precision.
PREFIXES = range(4, 9)
LEAST_SUPPORT = 5
LEAST_PRECISION = 0.85
#: Nats beyond the number of candidates by which an entry must be unlikely by chance, and the share of a beginning's documents by which a longer entry explains it.
CERTAINTY = 2.0
EXPLAINED = 0.8
#: Log-odds of a text without any match at most: it is never called toxic, however few labels there are.
MOST_BIAS = -1.0
#: Phrases that are exceptions from the start; more are learned.
EXCEPTIONS: tuple[str, ...] = ()
#: Words around a match that can make an exception, and the least clean documents of one.
EXCEPTION_SUPPORT = 5

_HOMOGLYPHS = {
    # Cyrillic and Greek letters that look like Latin ones
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ո": "n", "ս": "u", "α": "a", "β": "b",
    "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
}
#: Digits and signs written for letters; ``l``, ``1``, ``!`` and ``|`` all fold to ``i``, in lexicon and text alike.
_SUBSTITUTES = {"0": "o", "1": "i", "!": "i", "|": "i", "l": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b"}


def _table() -> dict[int, str]:
    table = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if plain and plain != chr(code):
            table[code] = plain
    table |= {ord(k): v for k, v in _HOMOGLYPHS.items()} | {ord(k.upper()): v for k, v in _HOMOGLYPHS.items() if len(k.upper()) == 1}
    table |= {code: None for code in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]}
    folded = {code: v and "".join(_SUBSTITUTES.get(c, c) for c in v) for code, v in table.items()}
    return folded | {ord(k): v for k, v in _SUBSTITUTES.items()}


_FOLD = _table()
_ASCII_FOLD = str.maketrans(_SUBSTITUTES)
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text in the letters it stands for."""
    return text.lower().translate(_ASCII_FOLD if text.isascii() else _FOLD)


@dataclass
class Lexicon:
    """Weighted entries (words end with a blank, word beginnings do not), exceptions, and the score's coefficients."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = -4.0
    by_sum: float = 1.5
    by_density: float = 0.5
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def _machine(self):
        if self._automaton is None:
            machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                body = entry.rstrip(" ")
                machine.add_word(body, (len(body), *((weight, None) if body == entry else (None, weight))))
            for entry, weight in self.weights.items():
                body = entry.rstrip(" ")
                _, start, whole = machine.get(body)
                machine.add_word(body, (len(body), weight, whole) if body == entry else (len(body), start, weight))
            guards = ahocorasick.Automaton()
            for phrase in self.exceptions:
                guards.add_word(phrase, len(phrase))
            for m in (machine, guards):
                if len(m):
                    m.make_automaton()
            self._automaton = machine, guards
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the matches at word beginnings, the heaviest of each word, without those inside exceptions."""
        machine, guards = self._machine()
        if not len(machine):
            return []
        best: dict[int, tuple[int, int, float]] = {}
        for at, (length, start_weight, whole_weight) in machine.iter(folded):
            a, b = at + 1 - length, at + 1
            if a and folded[a - 1].isalnum():
                continue
            ends = b == len(folded) or not folded[b].isalnum()
            weight = max((w for w in (start_weight, whole_weight if ends else None) if w is not None), default=None)
            if weight is not None and (a not in best or weight > best[a][2]):
                best[a] = (a, b, weight)
        if best and len(guards):
            spans = [(at + 1 - n, at + 1) for at, n in guards.iter(folded)]
            best = {a: m for a, m in best.items() if not any(s <= m[0] and m[1] <= e for s, e in spans)}
        return list(best.values())

    def features(self, text: str | None) -> tuple[float, float]:
        """Logarithms of the weight of all matches, and of the weight per thousand letters."""
        folded = fold(text or "")
        total = sum(m[2] for m in self.matches(folded))
        return math.log1p(total), math.log1p(1000 * total / (len(folded) + 200))

    def score(self, text: str | None) -> float:
        """From 0 to 1; a text without a match has the least score."""
        by_sum, by_density = self.features(text)
        return 1 / (1 + math.exp(-(self.bias + self.by_sum * by_sum + self.by_density * by_density)))


def _candidates(folded: str) -> set[str]:
    words = {w for w in _WORD.findall(folded) if not w.isdigit()}
    return {w + " " for w in words if len(w) >= 3} | {w[:n] for w in words for n in PREFIXES if len(w) > n}


def _contexts(folded: str, spans: list[tuple[int, int, float]]) -> set[str]:
    """Each match with the word before it, and with the word after it."""
    found = set()
    for a, b, _ in spans:
        before = re.search(r"[^\W_]+[\W_]{1,2}$", folded[max(0, a - 40) : a])
        after = re.match(r"[^\W_]*[\W_]{1,2}[^\W_]+", folded[b : b + 40])
        if before:
            found.add(before.group() + folded[a:b])
        if after:
            found.add(folded[a:b] + after.group())
    return found


def _fit_score(rows: list[tuple[float, float]], labels: list[int]) -> tuple[float, float, float]:
    """Logistic regression with non-negative coefficients by gradient steps; deterministic."""
    x, y = np.array(rows, float).reshape(-1, 2), np.array(labels, float)
    w, b = np.array([1.0, 1.0]), -2.0
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = weight * (p - y)
        w, b = np.maximum(w - 2.0 * (g @ x + 1e-4 * w), 0.05), b - 2.0 * g.sum()
    return float(b), float(w[0]), float(w[1])


def _choose(counted: list, n_toxic: int, n_clean: int, least: float, base: float) -> dict[str, float]:
    """Entries with their log-odds: beginnings that stand for many words, else the words themselves.

    An entry must be unlikely, by ``least`` nats over the base rate, to be toxic by chance. A
    beginning that one longer entry explains for the most part gives way to it.
    """
    support = {r["entry"]: r["toxic"] for r in counted}
    explained = set()
    for entry, n in support.items():
        body = entry.rstrip(" ")
        explained |= {body[:k] for k in PREFIXES if k < len(entry) and n >= EXPLAINED * support.get(body[:k], math.inf)}
    chosen: dict[str, float] = {}
    for r in sorted(counted, key=lambda r: (len(r["entry"]), -r["toxic"], r["entry"])):
        entry, toxic, clean = r["entry"], r["toxic"], r["clean"]
        covered = entry in explained or any(entry[:k] in chosen for k in PREFIXES if k < len(entry))
        if not covered and toxic * math.log(toxic / (toxic + clean) / max(base, 1e-9)) >= least:
            odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
            if odds > 0:
                chosen[entry] = odds
    return chosen


def _training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    marks = marks.where(id_crc() % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marks.count()
    marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the marks are bounded by the sample, so their rows may go to every task
    return texts.join(F.broadcast(marks), "doc_id").select("text", "toxic").where("text is not null")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn a lexicon from ``labels.toxic`` of rows whose id's CRC-32 is not divisible by 5.

    About ``sample`` labelled rows at most are used, which bounds all that is learned from them.
    Candidate entries are counted once a document, per task and then over all; only supported and
    precise ones reach the driver. A beginning that is precise enough stands for all longer ones. No
    labelled rows: an empty lexicon.
    """
    rows = _training_rows(docs, labels, sample).persist()
    try:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            toxic, clean = Counter(), Counter()
            for batch in batches:
                for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    (toxic if mark else clean).update(_candidates(fold(text)))
            for start in range(0, len(names := list(toxic.keys() | clean.keys())), 50_000):
                part = names[start : start + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([toxic[e] for e in part], pa.int64()), pa.array([clean[e] for e in part], pa.int64())],
                    names=["entry", "toxic", "clean"],
                )

        small_batches(docs.sparkSession)
        totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
        base = n_toxic / max(n_toxic + n_clean, 1)
        total = rows.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        total = total.where(F.col("toxic") >= LEAST_SUPPORT).persist()
        tried = total.count()
        counted = total.where(F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean"))).collect()
        total.unpersist()
        lexicon = Lexicon(_choose(counted, n_toxic, n_clean, math.log(max(tried, 1)) + CERTAINTY, base), [fold(e) for e in exceptions])
        chosen = lexicon.weights

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks, context = batch.column(1), []
                for text in batch.column(0).to_pylist():
                    folded = fold(text)
                    context.append(sorted(_contexts(folded, lexicon.matches(folded))))
                features = [lexicon.features(t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [marks, pa.array([f[0] for f in features], pa.float64()), pa.array([f[1] for f in features], pa.float64()), pa.array(context, pa.list_(pa.string()))],
                    names=["toxic", "by_sum", "by_density", "context"],
                )

        schema = "toxic int, by_sum double, by_density double, context array<string>"
        described = rows.mapInArrow(describe, schema).persist()
        phrases = (
            described.select("toxic", F.explode("context").alias("phrase")).groupBy("phrase")
            .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).where(f"toxic = 0 and clean >= {EXCEPTION_SUPPORT}").collect()
        )
        if phrases:  # exceptions change the features
            lexicon = Lexicon(chosen, lexicon.exceptions + sorted(r["phrase"] for r in phrases))
        features = (rows.mapInArrow(describe, schema) if phrases else described).select("toxic", "by_sum", "by_density").collect()
        described.unpersist()
        sample_rows = sorted(tuple(r) for r in features)
        if n_toxic and n_clean and chosen:
            bias, lexicon.by_sum, lexicon.by_density = _fit_score([(r[1], r[2]) for r in sample_rows], [r[0] for r in sample_rows])
            lexicon.bias = min(bias, MOST_BIAS)
        return lexicon
    finally:
        rows.unpersist()


def score(docs: DataFrame, lexicon: Lexicon, names: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with a score and a prediction (1 from a score of 0.5) as its last two columns.

    They are called ``_tox_score`` and ``_tox_predicted``, led by more underscores where ``docs`` has
    such columns, or ``names``, which must be new.

    Only the text is looked at; a null text counts as empty and has no match. Rows and other columns
    stay as they are; nothing is shuffled, the lexicon that goes to each task is bounded.
    """

    @F.pandas_udf("double")
    def weigh(texts):
        import pandas as pd

        return pd.Series([lexicon.score(t if isinstance(t, str) else None) for t in texts], dtype=float)

    small_batches(docs.sparkSession)
    names = new_names(docs, names, "_tox_score", "_tox_predicted")
    return docs.withColumn(names[0], weigh(F.col("text").cast("string"))).withColumn(names[1], (F.col(names[0]) >= 0.5).cast("int"))


def accepted(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    names = fresh(docs, "_tox_score", "_tox_predicted")
    return score(docs, lexicon, names).where(F.col(names[1]) == 0).select(*own_columns(docs))

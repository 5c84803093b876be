"""Packing, importance resampling and alignment held against libraries and plain versions."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from evigrid.llm import alignment, importance, packing

SCHEMA = "doc_id long, text string, length long, side string, block long, k long, words string, ids string"


def odd_texts():
    rng = random.Random(4)
    letters = ["a", "B", "é", "ß", "日", "本", "ا", "ö", "́", "🙂", "'s", "'", "1", "23", ".", "▁", "<|endoftext|>", "<s>", "<0x0A>"]
    blanks = [" ", " ", " ", " ", "  ", "   ", "\n", " \n ", "\t", " ", "　", "\r\n"]
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "x \ny", "x\n y", "x\n \ny", "a▁b", "a\x00b", "word " * 3000, "q" * 9000, "日本語" * 700, "ab " * 1365, "the <|endoftext|> end"]
    texts += ["".join(rng.choice(letters if rng.random() < 0.7 else blanks) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return texts


@pytest.fixture(scope="module")
def rows(spark):
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    texts = [None, *odd_texts(), *real, *real[:20]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, texts[3]), (3, "same id, other text"), (7, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, 9, "s", 9, 9, "w", "i") for d, t in rows], SCHEMA).repartition(5)


# packing


def plain_ids(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [(d, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for d, x in rows]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_file_tokenizer_equals_the_library(rows):
    got = packing.tokenizer(packing.VOCABULARY).encode(pa.array([t for _, t in rows], pa.string()))
    assert [g.tolist() for g in got] == [ids[:-1] for _, ids in plain_ids(rows)]


def test_both_libraries_cut_every_code_point_alike():
    tokens = packing.tokenizer(packing.VOCABULARY)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(codes), 200_000):
        texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}" for c in codes[i : i + 200_000]]
        got = tokens.encode(pa.array(texts, pa.string()))
        assert all(g.tolist() == w.ids for g, w in zip(got, tokens.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True))


def check_packed(got, want, window):
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id, r.doc_tokens].append(r)
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want) and all(r.length > 0 for r in got)
    # pieces of each document, told by id and length: every wanted document's ids are covered by equal pieces
    wanted = defaultdict(list)
    for d, ids in want:
        wanted[d, len(ids)].append(ids)
    assert set(by_doc) == set(wanted)
    for key, all_ids in wanted.items():
        assert sum(r.length for r in by_doc[key]) == len(all_ids) * key[1]
        if len(all_ids) == 1 or all(ids == all_ids[0] for ids in all_ids):
            assert all(r.ids_crc32 == crc(all_ids[0][r.start : r.start + r.length]) for r in by_doc[key])
        if len(all_ids) == 1:
            at = 0
            for r in sorted(by_doc[key], key=lambda r: r.start):
                assert r.start == at
                at += r.length
    fills = Counter()
    for r in got:
        fills[r.sequence_id] += r.length
    ends = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert all(f == window or (f < window and f & (f - 1) == 0) for f in fills.values())
    assert sum(f < window for f in fills.values()) <= window.bit_length()
    assert sorted(fills) == list(range(len(fills)))


@pytest.mark.parametrize("window", [2048, 64])
def test_packed_pieces_hold_every_id_once(docs, rows, window):
    check_packed(packing.pack(docs, window=window).collect(), plain_ids(rows), window)


def test_packing_without_end_id_and_of_nothing(spark, docs):
    assert packing.pack(docs.limit(0)).count() == 0
    only = spark.createDataFrame([(1, None), (2, ""), (3, "two words")], "doc_id long, text string")
    assert [(r.doc_id, r.length) for r in packing.pack(only, end=None).collect()] == [(3, 2)]
    assert {(r.doc_id, r.length) for r in packing.pack(only).collect() if r.doc_id < 3} == {(1, 1), (2, 1)}


def test_combinations_are_all_that_fill_the_window():
    present = np.zeros(33, bool)
    present[[1, 2, 3, 8, 10, 14, 15, 16, 17, 28, 29]] = True
    lengths = np.flatnonzero(present).tolist()
    want = {(0, b, c) for b in lengths for c in lengths if b <= c and b + c == 32}
    want |= {(a, b, c) for a in lengths for b in lengths for c in lengths if a <= b <= c and a + b + c == 32}
    assert set(map(tuple, packing.combinations(present, 32).tolist())) == want


def test_least_squares_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 50, 65).astype(float)
    h[0] = h[64] = 0
    columns = packing.combinations(h > 0, 64)
    x = packing.least_squares(columns, h, 5000)
    a = np.zeros((65, len(columns)))
    for j, c in enumerate(columns):
        np.add.at(a[:, j], c, 1)
    a[0] = 0
    gradient = a.T @ (a @ x - h)
    assert (x >= 0).all() and gradient.min() > -0.05 and abs(gradient[x > 0.05]).max() < 0.05


@pytest.mark.parametrize("sizes", [[], [1], [2047], [1024] * 7, [1000] * 500 + [48] * 100, list(range(1, 2048)), [5] * 2000])
def test_plan_places_every_rest(sizes):
    h = np.bincount(np.array(sizes, int), minlength=2049)
    made = packing.plan(h, 10)
    slots, ends = Counter(), defaultdict(list)
    for i in range(len(made.keys)):
        length, first = int(made.keys[i]) >> 40, int(made.keys[i]) & (1 << 40) - 1
        for number in range(first, int(made.ends[i])):
            slots[length, number] += 1
            ends[int(made.sequences[i]) + number - first].append((int(made.offsets[i]), length))
    for length in range(1, 2048):
        for number in range(int(made.whole[length]), int(h[length])):
            slots[length, number] += 1
            for _, size, sequence, offset in made.pieces(length, number):
                ends[sequence].append((offset, size))
    assert slots == Counter({(length, n): 1 for length in range(1, 2048) for n in range(int(h[length]))})
    for pieces in ends.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == 2048 or at & (at - 1) == 0
    assert sorted(ends) == list(range(10, 10 + len(ends)))


# importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_resample(rows, target, grams, buckets, least, percent):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(grams[0], grams[1] + 1) for i in range(len(w) - n + 1)]

    source, goal = Counter(), Counter()
    found = [(d, *features(t)) for d, t in rows]
    for _, _, f in found:
        source.update(f)
    for t in target:
        goal.update(features(t)[1])
    s_all, t_all = source.total(), goal.total()
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in source}
    out = []
    for d, w, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = may[: percent * len(may) // 100]
    ranks = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted(((r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize(("grams", "buckets", "percent"), [((1, 1), 10_000, 10), ((1, 2), 97, 50), ((2, 3), 1000, 100)])
def test_resampling_equals_a_plain_version(spark, docs, rows, grams, buckets, percent):
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [None, "", "a a A"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "doc_id long, text string")
    got = importance.resample(docs, frame, grams, buckets, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_resample(rows, target, grams, buckets, 20, percent)


def test_resampling_of_nothing_and_towards_nothing(docs, rows):
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    assert sorted((tuple(r) for r in importance.resample(docs, none).collect()), key=repr) == plain_resample(rows, [], (1, 1), 10_000, 20, 10)


# alignment


def plain_alignment(rows):
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letter = {}
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            letter[chr(b)] = b
        else:
            letter[chr(256 + n)] = b
            n += 1
    a_bytes = {i: bytes(letter[c] for c in w) for w, i in a_tok.get_vocab().items() if w != "<|endoftext|>"}
    b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(b_tok.id_to_piece, range(b_tok.get_piece_size())))]
    found, counts = [], Counter()
    for d, x in rows:
        whole = (" " + (x or "")).encode()
        a, b = a_tok.encode(" " + (x or ""), add_special_tokens=False).ids, b_tok.encode(x or "")
        if not x or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            found.append((d, None))
            continue
        ends = [np.cumsum([len(t[i]) for i in ids]) for t, ids in ((a_bytes, a), (b_bytes, b))]
        shared = np.intersect1d(*ends)
        groups = [([], []) for _ in shared]
        for side, ids in enumerate((a, b)):
            for g, i in zip(np.searchsorted(shared, ends[side]), ids, strict=True):
                groups[g][side].append(i)
        links = Counter((i, j) for left, right in groups for i in left for j in right)
        counts.update(links.keys())
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        found.append((d, (len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest())))
    most = Counter()
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for d, f in found:
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_best = sum(n for p, n in f[3].items() if counts[p] == most[p[0]])
            out.append((d, *f[:3], f[3].total(), n_best, sum(n * counts[p] for p, n in f[3].items()), f[4]))
    return sorted(out, key=repr)


def test_alignment_equals_a_plain_version(docs, rows):
    assert sorted((tuple(r) for r in alignment.align(docs).collect()), key=repr) == plain_alignment(rows)
    assert alignment.align(docs.limit(0)).count() == 0


def test_alignment_stores_few_blocks_a_file(spark, monkeypatch):
    paths = {}

    def kept(df, tag, *more, stored=alignment.stored):
        table, paths[tag] = stored(df, tag, *more)
        return table, paths[tag]

    monkeypatch.setattr(alignment, "stored", kept)
    docs = spark.range(0, 20_000, 1, 1).selectExpr("id AS doc_id", "'a b' AS text")
    assert alignment.align(docs).count() == 20_000
    held = [r["count"] for r in spark.read.parquet(paths["blocks"]).selectExpr("input_file_name() AS file").groupBy("file").count().collect()]
    assert sum(held) >= 20 and max(held) <= 8  # a task reads all rows of a file at once


def test_transducer_closes_groups_where_both_sides_end():
    machine = alignment.Transducer([b"ab", b"c", b"def", b"a"], [b"a", b"bcd", b"ef", b"ab"])
    assert machine.groups([0, 1, 2], [0, 1, 2]) == [([0, 1, 2], [0, 1, 2])]
    assert machine.groups([0, 0, 3], [3, 3, 0]) == [0 << 32 | 3, 0 << 32 | 3, 3 << 32 | 0]
    assert machine.groups([0, 0], [3, 0]) is None and machine.groups([0], [2]) is None and machine.groups([3], []) is None and machine.groups([], []) == []
    # a transition is made once for each dangling suffix and token
    before = len(machine.moves)
    machine.groups([0, 1, 2] * 50, [0, 1, 2] * 50)
    assert len(machine.moves) == before


def test_chunks_of_a_block_align_as_one_by_one():
    both = alignment.aligner(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    plain = ["the", "naïve", "don't", "日本語", "x" * 40, "1,234.5", "a\nb", "▁x", "ﬁn", "\U0001f600!", "a　b", "é́"]
    words = [*plain, "", "two  blanks here", "end\n", "\ttab", " led"]
    counts, text, lengths, keys, links = both.aligned(words, len(plain))
    machine, at = alignment.Transducer(both.a_bytes, both.b_bytes), 0
    for w, n, said, k in zip(words, counts.tolist(), text.to_pylist(), lengths.tolist(), strict=True):
        a, b = both.a.encode_ordinary(f" {w}"), both.b.encode(w)
        groups = machine.groups(a, b)
        if groups is not None:
            groups = [([g >> 32], [g & 0xFFFFFFFF]) if isinstance(g, int) else g for g in groups]
            pairs = Counter(x << 32 | y for left, right in groups for x in left for y in right)
            assert n == [len(a), len(b), len(groups), pairs.total()]
            assert said.decode() == "".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) + ";" for left, right in groups)
            got = Counter()
            for key, times in zip(keys[at : at + k].tolist(), links[at : at + k].tolist(), strict=True):
                got[key] += times
            assert got == pairs
        else:
            assert n == [0, 0, -1, 0] and said == b"" and k == 0
        at += k


def test_aligner_keeps_nothing_of_texts():
    both = alignment.aligner(alignment.A_VOCABULARY, alignment.B_VOCABULARY)
    held = lambda: sum(len(v) for v in vars(both).values() if isinstance(v, dict | list | str))
    before = held()
    for i in range(3):
        both.block(pa.array([1, 2]), pa.array([f"text {i}  with two blanks", " ".join(f"w{i}x{k}" for k in range(500))]))
    assert held() == before

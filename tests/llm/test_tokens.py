import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from evigrid.llm import bpe_tree, token_prefix

ODD = [
    None, "", " ", "\n\n \t", "a" * 3000, "ab" * 1500 + "é" * 333, " " * 300 + "x", "<|endoftext|>x<|startoftext|> hi", "ΑΣ ΟΔΟΣ İstanbul ǅ ﬁ", "日本語" * 100,
    "0123456789" * 100, "²½Ⅷ a_b__c", "école", "\U0001f600\U0001f600 don't I'LL we've", "\x1c\x1d a\x1fb", "֋՘a",
]


def strings():
    rng = random.Random(5)
    alphabets = ["abtheinr  é1.-'", "ab", "abtheinrs", "".join(map(chr, [*range(1, 0x250), *range(0x370, 0x600), *range(0x3040, 0x3100)]))]
    return [t or "" for t in ODD] + ["".join(rng.choice(a) for _ in range(rng.randint(1, 500))) for a in alphabets for _ in range(40)]


def test_tree_equals_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe_tree.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe_tree.tokenizer()
    for t in strings():
        ids = np.frombuffer(own.encode(t), "<u4")
        assert ids.tolist() == library.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_tree_joins_any_halves():
    own, rng = bpe_tree.tokenizer(), random.Random(1)
    for _ in range(200):
        data = bytes(rng.choice(b"abcaaaz \xc3\xa9") for _ in range(rng.randint(2, 60)))
        cut = rng.randint(1, len(data) - 1)
        assert own.join(own.merge(data[:cut]), own.merge(data[cut:])) == own.merge(data)


def test_decoding_tree_is_whole():
    own = bpe_tree.tokenizer()
    text = "the quick fox " * 4000
    assert own.decode(np.frombuffer(own.encode(text), "<u4")) == text.encode()


def test_counts_equal_library():
    library, own = Tokenizer.from_file(P.path(token_prefix.VOCABULARY)), token_prefix.counter()
    texts = strings()
    assert [own.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_is_exact():
    library, own = Tokenizer.from_file(P.path(token_prefix.VOCABULARY)), token_prefix.counter()
    for t in ["Hello, wonderful worlds of tokenization!", "déjà vu 2024 <x>", "aaa bbb"]:
        index = token_prefix.PrefixIndex(own, t)
        for i in range(len(index.text) + 1):
            assert index.at(i) == len(library.encode(index.text[:i], add_special_tokens=False).ids), (t, i)
        for budget in range(index.total + 2):
            end = index.longest_prefix(budget)
            assert index.at(end) <= budget
    assert token_prefix.PrefixIndex(own, "").total == 0


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(1, "", "x", 1), (None, "b c", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids long")


def test_columns(docs):
    own, counter = bpe_tree.tokenizer(), token_prefix.counter()
    texts = {i: t or "" for i, t in enumerate(ODD)}
    for r in bpe_tree.encode_documents(docs).collect():
        data = own.encode(texts.get(r.doc_id, "b c"))
        assert (r.n_tokens, r.ids_sha256) == (len(data) // 4, hashlib.sha256(data).hexdigest()) and len(r.ids) == r.n_tokens
        assert r.decoded_sha256 == hashlib.sha256(texts.get(r.doc_id, "b c").encode()).hexdigest()
    got = token_prefix.count_documents(docs, limit=100, store_prefixes=True).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = texts.get(r.doc_id, "b c")
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), counter.count(text), counter.count(text) > 100)
        assert r.prefix_tokens == counter.cumulative(text)


def test_empty_table(docs):
    assert bpe_tree.encode_documents(docs.limit(0)).count() == 0
    assert token_prefix.count_documents(docs.limit(0)).count() == 0

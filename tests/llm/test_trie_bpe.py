import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cargolens.llm import trie_bpe

PIECES = ["a", "the", "ing", "'s", " ", " ", "\n", "É", "é", "1", "²", "..", "\x1c", "\xa0", "日本", "<|endoftext|>", "<|", "ΑΣ", "İ", "ß"]
PIECES += ["​", " ", "\U0001f600", "ﬁ", "\x00", "<|startoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def bpe():
    return trie_bpe.loaded(public_tokenizers.path("word_bpe_49k.json"))


def same(library, bpe, texts):
    for text, ids in zip(texts, bpe.encode(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text[:80]
        assert bpe.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_random_pieces_equal_the_library(library, bpe):
    pick = random.Random(1)
    same(library, bpe, ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 14))) for _ in range(4000)])


def test_random_words_equal_the_library(library, bpe):
    pick = random.Random(2)
    same(library, bpe, ["".join(pick.choice("etaoinshr") for _ in range(pick.randint(1, 40))) for _ in range(4000)])
    same(library, bpe, ["a" * n for n in range(1, 60)] + ["ab" * n for n in range(1, 40)])


def test_given_texts_equal_the_library(spark, library, bpe):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(library, bpe, [r.text or "" for r in docs.collect()])


def test_memory_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 3)
    own = trie_bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    for text in ["several words of different kinds", "several other words", "and the same words again"] * 3:
        same(library, own, [text])


def test_shared_prefixes_are_encoded_once(bpe):
    own = trie_bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    words = ["interplanetarys", "interplanetarity", "interplanetarily"]
    nodes = []

    class Counted(dict):
        def __getitem__(self, token):
            nodes.append(token)
            return super().__getitem__(token)

    own.id_bytes = Counted(own.id_bytes)
    own.encode_words(words)
    # one step for each distinct prefix and for each word's end
    assert len(nodes) == len({w[:i] for w in words for i in range(1, len(w))}) + len(words)


def test_query_against_the_library(spark, edge_dir, rows, library):
    expected = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        )
    assert sorted(map(tuple, trie_bpe.op3_trie_bpe(spark, edge_dir).collect()), key=str) == sorted(expected, key=str)


def test_empty_table_and_clashing_columns(spark, empty_dir, clashing):
    assert trie_bpe.op3_trie_bpe(spark, empty_dir).count() == 0
    assert trie_bpe.encode_documents(clashing).count() == 20


def test_memory_of_a_very_long_word_is_linear():
    import tracemalloc

    bpe = trie_bpe.loaded(public_tokenizers.path("word_bpe_49k.json"))
    word = "thequickbrown" * 15_000
    tracemalloc.start()
    bpe.encode_words([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = bpe.words.pop(word)
    assert bpe.decode(ids).replace(" ", "").replace("</w>", "") == word
    assert peak < 60 << 20

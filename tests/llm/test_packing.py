import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cargolens.llm import packing

PIECES = ["a", "word", "'s", " ", " ", "  ", "\n", "\t", "é", "1", ".", "\x1c", " ", "日", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_ids_equal_the_library(library, encoder, rows):
    pick = random.Random(3)
    texts = ["".join(pick.choice(PIECES) for _ in range(pick.randint(0, 12))) for _ in range(4000)]
    for text in [*texts, *(t for _, t, *_ in rows if t)]:
        assert library.encode(text, add_special_tokens=False).ids == encoder.ids(text).tolist(), text[:80]


def test_retrieval_is_bm25():
    pieces = [np.array(x) for x in ([1, 1, 2, 3], [1, 4], [2, 2, 2, 5, 6], [7], [1, 2, 3, 8, 9, 9])]
    index = packing.Retrieval(pieces)
    mean = np.mean([len(p) for p in pieces])
    for seed, query in enumerate(pieces):
        for i, doc in enumerate(pieces):
            score = 0.0
            for term in set(query.tolist()):
                n = (doc == term).sum()
                df = sum((p == term).any() for p in pieces)
                idf = np.log1p((len(pieces) - df + 0.5) / (df + 0.5))
                score += idf * n * (packing.K1 + 1) / (n + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean)) if n else 0
            assert index.scores(seed)[i] == pytest.approx(score)


def test_neighbours_share_a_window():
    random_ids = np.random.default_rng(0)
    topics = [random_ids.integers(30 * k, 30 * k + 30, (8, 16)) for k in range(4)]
    packer = packing.Packer(64, 0)
    for i in range(8):
        for k in range(4):
            packer.add((k, i), topics[k][i])
    packer.finish()
    windows = defaultdict(set)
    for doc, *_, sequence, _ in packer.rows:
        windows[sequence].add(doc[0])
    assert all(len(topics) == 1 for topics in windows.values())


def checked(pieces, expected, window):
    """All ids of all documents once, in gapless sequences; returns padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    for group in by_sequence.values():
        group.sort(key=lambda r: r.offset)
        assert [r.offset for r in group] == [0, *np.cumsum([r.length for r in group])[:-1].tolist()]
        assert sum(r.length for r in group) <= window
    found = sorted(
        (str(doc), r.start, r.length, r.ids_crc32) for (doc, _), group in by_doc.items() for r in group
    )
    left = defaultdict(list)
    for doc, ids in expected:
        left[str(doc)].append(ids)
    spans = []
    for (doc, total), group in by_doc.items():
        copies = [ids for ids in left[str(doc)] if len(ids) == total]
        assert sum(r.length for r in group) == total * len(copies)
        for r in group:
            assert r.ids_crc32 in {zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids in copies}
        spans += group
    assert len(spans) == len(found) and sum(len(i) for _, i in expected) == sum(r.length for r in spans)
    sizes = [sum(r.length for r in g) for g in by_sequence.values()]
    return sum(0 if n & (n - 1) == 0 else window - n for n in sizes)


def test_query_packs_every_id_once(spark, edge_dir, rows, library):
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in rows]
    assert checked(packing.op5_packing(spark, edge_dir).collect(), expected, packing.WINDOW) == 0


def test_small_windows_and_shards(spark, rows, library):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(2)
    pieces = packing.pack(docs, window=64, shard_docs=5).withColumn("ids_crc32", F.crc32("ids"))
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in rows]
    assert checked(pieces.collect(), expected, 64) == 0


def test_empty_table_and_clashing_columns(spark, empty_dir, clashing):
    assert packing.op5_packing(spark, empty_dir).count() == 0
    assert {r.doc_id for r in packing.pack(clashing).collect()} == set(range(20))


def test_odd_white_space_has_the_library_s_ids(encoder):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(7)
    parts = [" ", "   ", "\t", "\n\n", "\x0b", "\r\n", "\x85", "\xa0", "\u2003", "\u3000", "\x1c", "\x1f", "a", "Word", "'s", "'S", "23", "é", "日本"]
    parts += ["<|endoftext|>", "\x00", "\ufeff", "½", "क्", "_"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(14)))
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids

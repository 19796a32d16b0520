import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cargolens.llm import neural_lm


def test_query_base_scores_against_brute_force(spark, edge_dir, rows):
    counts = Counter()
    for i, text, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(neural_lm.tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for i, text, *_ in rows:
        words = neural_lm.tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        held_out = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        expected.append((i, held_out, len(words), sum(counts[w] > 0 for w in words), total, base))
    found = sorted((tuple(r) for r in neural_lm.op4_neural_lm(spark, edge_dir).collect()), key=lambda r: str((r[0], r[2], r[5])))
    expected.sort(key=lambda r: str((r[0], r[2], r[5])))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in expected])
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in found)


def test_few_frequent_tokens_and_classes_change_no_count(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    few = neural_lm.score(docs, docs, classes=4, frequent=6)
    many = neural_lm.score(docs, docs, classes=64, frequent=4096)
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.base_score, 6))
    for a, b in zip(sorted(few.collect(), key=key), sorted(many.collect(), key=key)):
        assert (a.doc_id, a.n_tokens, a.n_known, a.train_tokens) == (b.doc_id, b.n_tokens, b.n_known, b.train_tokens)
        assert a.base_score == pytest.approx(b.base_score)


def test_every_context_is_normalised():
    share = np.array([0.4, 0.3, 0.2, 0.1])
    model = neural_lm.LogBilinear(share, dims=5)
    random = np.random.default_rng(0)
    model.train((random.integers(0, 4, 64), random.integers(0, 4, 64), random.integers(0, 4, 64)) for _ in range(20))
    first, second, norm = model.tables()
    scores = first[:, None, :] + second[None, :, :] - norm[:, :, None]
    assert np.allclose(np.exp(scores).sum(axis=2), 1, atol=1e-4)


def test_noise_contrastive_training_finds_conditional_probabilities():
    random = np.random.default_rng(1)
    follow = np.array([[0.8, 0.1, 0.1], [0.1, 0.1, 0.8], [0.3, 0.6, 0.1]])
    words = [0]
    for _ in range(60_000):
        words.append(int(random.choice(3, p=follow[words[-1]])))
    words = np.array(words)
    share = np.append(np.bincount(words, minlength=3) + 1.0, 1.0)
    model = neural_lm.LogBilinear(share / share.sum(), dims=8)
    one, two = neural_lm.preceding(words, 4)
    for _ in range(6):
        model.train((one[i : i + 512], two[i : i + 512], words[i : i + 512]) for i in range(0, len(words), 512))
    first, second, norm = model.tables()
    for before in range(3):
        found = np.exp(first[before] + second[0] - norm[before, 0])[:3]
        assert np.abs(found - follow[before]).max() < 0.08


def test_model_beats_counts_on_held_out_text(spark):
    found = neural_lm.op4_neural_lm(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in found) > 0.995 * sum(r.base_score for r in found)  # both are negative


def test_frequent_tokens_with_ties(spark):
    pairs = [(b"", 9), (b"a", 5), (b"c", 3), (b"b", 3), (b"d", 3), (b"e", 1), (b"z", 7)]
    table = spark.createDataFrame(pairs, "token binary, n long").repartition(3)
    whole = sorted(pairs[1:], key=lambda p: (-p[1], p[0]))
    for size in range(1, 10):
        found = neural_lm.corpus_counts(table, size)
        assert (found.total, found.distinct) == (31, 7) and found.frequent == [(b"", 9), *whole[: size - 1]]
    assert neural_lm.corpus_counts(table.limit(0)).frequent == [(b"", 0)]


def test_nothing_to_learn_from_and_empty_table(spark, empty_dir):
    assert neural_lm.op4_neural_lm(spark, empty_dir).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in neural_lm.score(docs, docs.where("doc_id > 5")).collect()}
    assert (found[1].n_known, found[1].train_tokens, found[1].base_score) == (0, 0, 0.0)
    assert math.isfinite(found[2].score)


def test_clashing_columns(clashing):
    assert neural_lm.score(clashing, clashing).count() == 20

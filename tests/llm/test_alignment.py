import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargolens.llm import alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_of():
    """Byte-level letters: visible Latin-1 characters are themselves, the others follow from U+0100."""
    visible = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + n): b for n, b in enumerate(hidden)}


def token_bytes(tokenizers, text):
    a, b = tokenizers
    letters = byte_of()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    return ids_a, bytes_a, ids_b, bytes_b


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows, tokenizers):
    """Every overlap by a walk over both token lists, counts over all documents."""
    each, counts = [], Counter()
    for doc_id, text, *_ in rows:
        ids_a, bytes_a, ids_b, bytes_b = token_bytes(tokenizers, text) if text else ([], [], [], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            each.append((doc_id, None))
            continue
        range_a, range_b = ranges(bytes_a), ranges(bytes_b)
        links, j = [], 0
        for i, (start, end) in enumerate(range_a):
            while j and range_b[j][0] > start:
                j -= 1
            while j < len(range_b) and range_b[j][0] < end:
                if range_b[j][1] > start:
                    links.append((ids_a[i], ids_b[j]))
                j += 1
            j = max(0, j - 1)
        cuts = {e for _, e in range_a} & {e for _, e in range_b}
        sides = []
        for ids, own in ((ids_a, range_a), (ids_b, range_b)):
            groups, current = [], []
            for token, (_, end) in zip(ids, own):
                current.append(str(token))
                if end in cuts:
                    groups.append(",".join(current))
                    current = []
            sides.append(groups)
        counts.update(links)
        each.append((doc_id, (len(ids_a), len(ids_b), links, ["|".join(g) for g in zip(*sides, strict=True)])))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, found in each:
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = found
        best = sum(counts[p] == most[p[1]] for p in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), sha))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def odd_texts():
    pick = random.Random(1)
    parts = [" ", "  ", "\t", "\n", "\x0b", "\r", "\x85", "\xa0", "　", "a", "b", "th", "er", "'s", "23", "é", "é", "日本", "\U0001f600"]
    parts += ["<|endoftext|>", "<s>", "</s>", "<0x41>", "▁", "\x00", "​", "क्", "İ", "Straße"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(1, 40))) for _ in range(300)]


def test_query_against_brute_force(spark, edge_dir, rows, tokenizers):
    found = sorted(map(tuple, alignment.op12_alignment(spark, edge_dir).select(COLUMNS).collect()), key=str)
    assert found == brute(rows, tokenizers)


def test_odd_texts_and_small_blocks(spark, tokenizers):
    rows = list(enumerate(odd_texts()))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows, tokenizers)
    assert any(r[1] == 0 for r in expected) and any(r[1] > r[3] for r in expected)
    for parts in (1, 12):
        assert sorted(map(tuple, alignment.align(frame.repartition(parts)).collect()), key=str) == expected


def test_blocks_of_a_task(spark, monkeypatch):
    pair = alignment.loaded(alignment._paths(None, None, None))
    texts = odd_texts()
    whole = alignment.block_row(0, list(range(300)), texts, pair).to_pylist()[0]
    one = [alignment.block_row(0, [i], [t], pair).to_pylist()[0] for i, t in enumerate(texts)]
    assert [d for r in one for d in r["docs"]] == whole["docs"]
    counted = Counter()
    for r in one:
        counted.update(dict(zip(r["pairs"], r["times"])))
    assert counted == dict(zip(whole["pairs"], whole["times"]))


def test_cuts_of_random_ends():
    pick = np.random.default_rng(4)
    for size in (1, 2, 3, 10, 200, 3000):
        for share in (0.02, 0.3, 0.9):
            a, b = (np.flatnonzero(pick.random(size) < s) + 1 for s in (share, pick.choice([0.05, 0.5, 1.0])))
            documents = np.unique(np.append(pick.integers(1, size + 1, 3), size))
            a, b = (np.unique(np.concatenate([x, documents])) for x in (a, b))
            cut_a, cut_b = alignment.shared_cuts(a, b, np.searchsorted(a, documents), np.searchsorted(b, documents))
            assert a[cut_a].tolist() == b[cut_b].tolist() == np.intersect1d(a, b).tolist()


def test_groups_rebuild_the_text(spark, rows, tokenizers):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").where("doc_id < 15")
    groups = alignment.aligned_groups(frame).orderBy("doc_id", "number").collect()
    for doc_id in range(9, 15):
        text = (" " + rows[doc_id][1]).encode()
        ids_a, bytes_a, ids_b, _ = token_bytes(tokenizers, rows[doc_id][1])
        own = [g for g in groups if g["doc_id"] == doc_id]
        assert b"".join(text[g["start"] : g["end"]] for g in own) == text
        assert [i for g in own for i in g["a_ids"]] == ids_a and [i for g in own for i in g["b_ids"]] == ids_b


def test_pair_counts_are_those_of_the_corpus(spark, tokenizers):
    rows = [(1, "the thing"), (2, "the thing"), (3, "thing")]
    blocks = alignment.aligned_blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = {r["pair"]: r["links"] for r in alignment.pair_counts(blocks).collect()}
    thing = tokenizers[0].encode(" thing").ids[0] << 32 | tokenizers[1].encode("thing")[0]
    assert found[thing] == 3


def test_long_texts(tokenizers):
    pair = alignment.loaded(alignment._paths(None, None, None))
    for text in ("x" * 200_000, " " * 100_000, "ab " * 50_000, "é" * 100_000):
        x = alignment.align_texts([text], pair)
        assert x.end_a[-1] == x.end_b[-1] == len(text.encode()) + 1
        assert x.end_a[x.cut_a].tolist() == np.intersect1d(x.end_a, x.end_b).tolist()


def test_empty_and_clashing(spark, empty_dir, clashing):
    assert alignment.op12_alignment(spark, empty_dir).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align(nothing).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    found = alignment.align(clashing.withColumn("pairs", F.lit(1)).withColumn("block", F.lit("x")))
    assert found.columns == COLUMNS and found.count() == 20


def test_ids_are_those_of_the_vocabulary_file(tokenizers):
    pair = alignment.loaded(alignment._paths(None, None, None))
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        assert len(pair.bytes_a) == len(json.load(file)["model"]["vocab"])
    for text in odd_texts():
        assert pair.a.encode_ordinary(" " + text) == tokenizers[0].encode(" " + text, add_special_tokens=False).ids

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cargolens.llm import simhash
from cargolens.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    spans = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def brute_groups(prints, distance):
    """Component number of each print."""
    prints = np.array(prints, np.uint64)
    label = np.full(len(prints), -1)
    for i in range(len(prints)):
        todo = [i] if label[i] < 0 else []
        while todo:
            at = todo.pop()
            if label[at] < 0:
                label[at] = i
                todo += [int(j) for j in np.flatnonzero((np.bitwise_count(prints ^ prints[at]) <= distance) & (label < 0))]
    return label


def near_prints(seed, groups=120, copies=25):
    random = np.random.default_rng(seed)
    values = []
    for center in random.integers(0, 2**63, groups, dtype=np.uint64) * np.uint64(2) + random.integers(0, 2, groups, dtype=np.uint64):
        values.append(center)
        for _ in range(random.integers(0, copies)):
            value = int(center)
            for bit in random.integers(0, 64, random.integers(0, 6)):
                value ^= 1 << int(bit)
            values.append(value)
    return np.unique(np.array(values, np.uint64))


@pytest.mark.parametrize("budget", [0, 1, 3, 5])
def test_trie_finds_all_pairs(budget):
    values = near_prints(1)
    left, right = simhash.trie_links(values, np.array([[0, len(values), 0, len(values)]]), 0, budget)
    i, j = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None]) <= budget, 1))
    assert sorted(zip(left.tolist(), right.tolist())) == sorted(zip(i.tolist(), j.tolist()))


def test_two_tries_find_all_pairs():
    values = near_prints(2)
    first, second = values[::2], values[1::2]
    both, cut = np.concatenate([first, second]), len(first)
    left, right = simhash.trie_links(both, np.array([[0, cut, cut, len(both)]]), 0, 3)
    i, j = np.nonzero(np.bitwise_count(first[:, None] ^ second[None]) <= 3)
    assert sorted(zip(left.tolist(), (right - cut).tolist())) == sorted(zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("leaf_rows", [1, 7, 50_000])
def test_spread_join_keeps_every_link(spark, leaf_rows):
    # one hot subtree: half of the prints share their first 16 bits
    values = near_prints(3)
    hot = np.unique((near_prints(4, 40) >> np.uint64(16)) | (np.uint64(0xBEEF) << np.uint64(48)))
    values = np.unique(np.concatenate([values, hot]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in components(simhash.linked_stars(frame, 3, leaf_rows)).collect()}
    label = brute_groups(values, 3)
    ours = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    assert len(set(zip(label.tolist(), ours))) == len(set(label.tolist())) == len(set(ours))


def test_query_against_brute_force(spark, edge_dir, rows):
    prints = [brute_print(t) for _, t, *_ in rows]
    label = brute_groups(prints, 3)
    least = {}
    for group, (i, *_) in zip(label.tolist(), rows):
        if i is not None:
            least[group] = min(i, least.get(group, i))
    expected = [(i, f"{p:016x}", least.get(g)) for (i, *_), p, g in zip(rows, prints, label.tolist())]
    assert sorted(map(tuple, simhash.op10_simhash(spark, edge_dir).collect()), key=str) == sorted(expected, key=str)


def test_one_of_each_group_stays(spark, edge_dir, rows):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    label = brute_groups([brute_print(t) for _, t, *_ in rows], 3)
    assert kept.count() == len(set(label.tolist()))
    assert {r.doc_id for r in kept.collect()} >= {4, 75, 90}


def test_nameless_groups_keep_one_row(spark):
    frame = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z")], "doc_id long, text string")
    assert simhash.one_of_each_group(frame).count() == 2


def test_empty_table_and_clashing_columns(spark, empty_dir, clashing):
    assert simhash.op10_simhash(spark, empty_dir).count() == 0
    assert simhash.simhash_groups(clashing).count() == 20
    assert simhash.one_of_each_group(clashing).columns == clashing.columns


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 500), (7, 200), (200, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in [*range(41), 200, 300])
    assert all(found[100 + i] == 100 for i in range(60))
    assert components(spark.createDataFrame([], "a long, b long").select(F.col("a"), F.col("b"))).count() == 0

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cargolens.llm import ranked_search
from test_line_dedup import lowered
from verification.compare import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lowered(text or ""))


def brute(docs, items, k=10):
    """Scores of every document for every item, from plain Python integers."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    documents, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(term for _, c in counts for term in c)
    weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = Counter(terms(text)), []
        for (i, c), n in zip(counts, sizes):
            m = 25 + 75 * n * documents // max(length, 1)
            score = sum(times * weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, times in asked.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(rows):
    texts = [rows[i][1] for i in (0, 4, 11, 75, 96)]
    passages = [" ".join(t.split()[:40]) for t in texts]
    own = list(enumerate(passages)) + [(5, None), (6, ""), (7, "nowhere"), (8, "MIT Licence mit license, mit"), (2, "thing"), (3, passages[3])]
    return own + [(3, passages[3]), (None, "under the License")]


def searched(spark, docs, items, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.search(ranked_search.build_index(frame), asked, **more)
    return sorted(map(tuple, found.collect()), key=str)


def test_search_against_brute_force(spark, rows, items):
    docs = [r[:2] for r in rows]
    assert searched(spark, docs, items) == brute(docs, items)


def test_small_shards_and_blocks_give_the_same(spark, rows, items, monkeypatch):
    docs = [r[:2] for r in rows]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    texts = [(i, (t or "").encode()) for i, t in docs]
    expected = brute(docs, items, 3)
    for block, per_shard in ((2, 7), (128, 1000), (1, 40)):
        monkeypatch.setattr(ranked_search, "BLOCK", block)
        documents, length = frame.count() - sum(not terms(t) for _, t in docs), sum(len(terms(t)) for _, t in docs)
        df = Counter(t for _, text in docs for t in set(terms(text)))
        found = {}
        for start in range(0, len(texts), per_shard):
            shard = ranked_search.Shard(documents, length)
            for i, text in texts[start : start + per_shard]:
                shard.add(i, text)
            table = shard.rows(start).to_pydict()
            n = len(shard.ids)
            factors = ranked_search.length_factors(np.array(shard.lengths), documents, length)
            lists = {
                t: ranked_search.Postings(*row, factors)
                for t, *row in zip(*[table[c] for c in ("term", "df", "top", "heads", "body")])
                if t
            }
            for item, text in dict.fromkeys(items):
                weighted = [
                    (c * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))), lists[t])
                    for t, c in Counter(terms(text)).items()
                    if t in lists
                ]
                own, score = ranked_search.best_of_shard(weighted, n, 3)
                found.setdefault((item, text), []).extend((-s, texts[start + d][0] is None, texts[start + d][0] or 0) for d, s in zip(own, score.tolist()))
        got = [
            (item, r, None if none else i, -s)
            for (item, _), own in found.items()
            for r, (s, none, i) in enumerate(sorted(own)[:3], 1)
        ]
        assert sorted(got, key=str) == expected


def test_lists_that_are_not_essential_stay_packed():
    pick = random.Random(3)
    shard = ranked_search.Shard(4000, 4000 * 30)
    for i in range(4000):
        words = [pick.choice(["the", "of", "and", f"w{pick.randrange(300)}"]) for _ in range(30)]
        shard.add(i, " ".join(words + ["needle pin"] * (i in range(500, 520))).encode())
    table = shard.rows(0).to_pydict()
    factors = ranked_search.length_factors(np.array(shard.lengths), 4000, 4000 * 30)
    lists = {t: ranked_search.Postings(*row, factors) for t, *row in zip(*[table[c] for c in ("term", "df", "top", "heads", "body")])}
    asked = [(8000, lists["needle"]), (8000, lists["pin"]), (3, lists["the"]), (2, lists["of"])]
    found, score = ranked_search.best_of_shard(asked, 4000, 10)
    assert lists["the"].whole is None and 0 < len(lists["the"].blocks) <= 2 and len(lists["the"].last) > 20
    exact = np.zeros(4000, np.int64)
    for weight, postings in asked:
        doc, impact = postings.all()
        exact[doc] += weight * impact
    best = np.argsort(-exact, kind="stable")[:10]
    assert set(best) <= set(found) and all(exact[found] == score)


def test_wide_gaps_and_frequencies_are_packed_exactly():
    gap, tf = np.array([70000, 1, 300, 5, 2]), np.array([1, 70000, 2, 3, 300])
    head, size = np.array([0, 2, 4]), np.array([2, 2, 1])
    body, offset = ranked_search.pack_blocks(gap, tf, head, size)
    factors = np.full(80000, 50)
    heads = np.column_stack([np.cumsum(gap)[[1, 3, 4]], [0, 0, 0], offset[:-1]]).astype("<i4").tobytes()
    old, ranked_search.BLOCK = ranked_search.BLOCK, 2
    try:
        doc, impact = ranked_search.Postings(5, 0, heads, body.tobytes(), factors).all()
    finally:
        ranked_search.BLOCK = old
    assert doc.tolist() == np.cumsum(gap).tolist()
    assert impact.tolist() == ranked_search.impacts(tf, factors[:5]).tolist()


def test_query_against_sql(spark, unique_dir, items, duck, tmp_path):
    import shutil

    folder = str(tmp_path / "data")
    shutil.copytree(unique_dir, folder)
    own = [(i, t) for i, (_, t) in enumerate(items)]
    spark.createDataFrame(own, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert compare(ranked_search.op11_ranked_search(spark, folder), con.sql(ranked_search.OP11_SQL)) is None


def test_shuffled_terms_give_the_same(spark, rows, items, monkeypatch):
    monkeypatch.setattr(ranked_search, "BROADCAST_TERMS", 0)
    docs = [r[:2] for r in rows]
    assert searched(spark, docs, items, k=4) == brute(docs, items, 4)


def test_empty_tables(spark, rows, items):
    assert searched(spark, [], items) == []
    assert searched(spark, [(1, None), (2, "..")], items) == []
    assert searched(spark, [r[:2] for r in rows], []) == []


def test_clashing_columns(spark, clashing, items):
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS number", "2 AS term", "3 AS rank")
    found = ranked_search.search(ranked_search.build_index(clashing), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count()

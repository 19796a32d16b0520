import numpy as np
import pytest

from cargolens.llm import embedding_dedup
from verification.compare import compare

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=150, dims=16):
    random = np.random.default_rng(seed)
    rows = []
    centers = random.standard_normal((12, dims))
    for i in range(n):
        near = centers[random.integers(12)] + random.standard_normal(dims) * random.choice([0.02, 0.1, 0.25])
        rows.append((i, near.astype(np.float32).tolist(), int(random.integers(3))))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]  # a hot vector
    rows += [
        (2000, None, 1),
        (2001, [], 1),
        (2002, [0.0] * dims, 1),
        (2003, [None] + [1.0] * (dims - 1), 1),
        (2004, [float("nan")] + [1.0] * (dims - 1), 1),
        (2005, [float("inf")] + [1.0] * (dims - 1), 1),
        (2006, rows[3][1], None),
        (2007, rows[3][1][:5], rows[3][2]),
        (2008, [x * 7 for x in rows[3][1]], rows[3][2]),
        (2009, [-x for x in rows[3][1]], rows[3][2]),
    ]
    return rows


def brute(rows, threshold=0.93):
    def good(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(rows))}
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la == lb and good(a, la) and good(b, lb) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        kept = rows[i][0] == least if rows[i][0] is not None else not (links[i] or good(*rows[i][1:]))
        out.append((rows[i][0], len(links[i]), least, kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile_rows", [7, 2048])
def test_links_against_brute_force(spark, tile_rows):
    rows = vectors()
    found = embedding_dedup.embedding_groups(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_query_against_sql(spark, tmp_path, duck):
    spark.createDataFrame(vectors(1), SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = embedding_dedup.op9_embedding_dedup(spark, str(tmp_path))
    assert compare(found, duck(embedding_dedup.OP9_SQL, str(tmp_path), "embeddings")) is None


def test_error_bound_is_never_exceeded():
    random = np.random.default_rng(4)
    left = random.standard_normal((200, 24)) * 10.0 ** random.integers(-3, 4, (200, 24))
    right = random.standard_normal((180, 24))
    a, s, a_norm, a_error = embedding_dedup.quantised(left)
    b, t, b_norm, b_error = embedding_dedup.quantised(right)
    product = (a.astype(float) @ b.astype(float).T) * s[:, None] * t
    exact = (left @ right.T) / (np.linalg.norm(left, axis=1)[:, None] * np.linalg.norm(right, axis=1))
    bound = np.outer(a_norm, b_error) + np.outer(a_error, b_norm + b_error)
    assert (np.abs(product - exact) <= bound + 1e-12).all()
    i, j = embedding_dedup.tile_links(left, right, 0.5)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(exact >= 0.5))))


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.01], 0), (None, [0.0, 1.0], 0)]
    found = embedding_dedup.embedding_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 2, 1, True)] * 2 + [(None, 2, 1, False), (None, 0, None, False)], key=str)


def test_empty_table_and_extra_columns(spark, empty_dir):
    assert embedding_dedup.op9_embedding_dedup(spark, empty_dir).count() == 0
    frame = spark.createDataFrame([(1, [1.0], 0, 5, 6, 7)], SCHEMA + ", node long, sign long, links long")
    assert embedding_dedup.embedding_groups(frame).first() == (1, 0, 1, True)


def test_parallel_vectors_of_any_size_link(spark):
    rows = [(1, [1e-200, 2e-200], 0), (2, [2e-200, 4e-200], 0), (3, [1e200, 2e200], 0), (4, [5e-324, 1e-323], 0), (5, [-1.0, 2.0], 0)]
    found = {r["vec_id"]: r for r in embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [found[i]["n_links"] for i in range(1, 6)] == [3, 3, 3, 3, 0] and found[4]["component_id"] == 1


def test_a_null_id_is_never_kept(spark):
    rows = [(None, None, 0), (None, [1.0], 0), (7, [0.0], 0)]
    found = embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((str(r["vec_id"]), r["kept"]) for r in found) == [("7", True), ("None", False), ("None", False)]

import hashlib
from collections import Counter

from cargolens.llm import line_dedup
from cargolens.llm.columns import ASCII_SPACE
from verification.compare import compare


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs):
    found = Counter()
    for _, text in {(i, t or "") for i, t, *_ in rows}:
        found.update({lowered(x.strip(ASCII_SPACE)) for x in text.split("\n")})
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not lowered(x.strip(ASCII_SPACE)) or found[lowered(x.strip(ASCII_SPACE))] < min_docs]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, edge_dir, rows):
    found = sorted(map(tuple, line_dedup.op6_line_dedup(spark, edge_dir).collect()), key=str)
    assert found == brute(rows, 10)
    assert any(r[2] for r in found)


def test_query_against_sql(spark, unique_dir, duck):
    assert compare(line_dedup.op6_line_dedup(spark, unique_dir), duck(line_dedup.OP6_SQL, unique_dir)) is None


def test_empty_table(spark, empty_dir):
    assert line_dedup.op6_line_dedup(spark, empty_dir).count() == 0


def test_clashing_columns_stay(spark, clashing):
    done = line_dedup.dedup_lines(clashing)
    assert set(clashing.columns) - {"n_lines"} <= set(done.columns)
    assert {r["row"] for r in done.collect()} == {2 * i for i in range(20)}


def test_runs_are_compacted_and_settled(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), min_docs=3, fanout=2)
    for batch in ([("a", 2), ("b", 1)], [("a", 1), ("c", 1)], [("a", 5), ("b", 1)], [("b", 1), ("c", 1)]):
        runs.add(spark.createDataFrame(batch, "key string, docs long"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert sorted(r.key for r in runs.settled().collect()) == ["a", "b"]
    # a settled key is not stored again
    assert {r.key for r in runs._read(runs.levels[2]).collect()} == {"c"}


def test_every_batch_and_fanout_gives_the_same(spark, rows):
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    results = [
        sorted(map(str, line_dedup.dedup_lines(frame, min_docs=5, batches=b, fanout=f).collect())) for b, f in ((1, 2), (5, 3))
    ]
    assert results[0] == results[1]

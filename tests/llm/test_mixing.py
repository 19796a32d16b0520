import hashlib
import re
from collections import Counter, defaultdict

import pytest

from cargolens.llm import mixing
from verification.compare import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_level(sizes, weights, repeats, budget):
    """Targets by the rule's own words: share, cap, share the excess again."""
    targets, full, rest = {}, set(), float(budget)
    while True:
        open_sources = [s for s in sizes if s not in full]
        if not open_sources:
            return targets
        left = sum(weights[s] for s in open_sources)
        shares = {s: rest * weights[s] / left for s in open_sources}
        above = [s for s in open_sources if shares[s] > repeats * sizes[s]]
        if not above:
            return targets | shares
        for s in above:
            targets[s] = float(repeats * sizes[s])
            full.add(s)
        rest = float(budget - sum(int(targets[s]) for s in full))


def brute(rows, repeats=3):
    """All queues in one list; rows with unique ids."""
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for i in size:
        sizes[source[i]] += size[i]
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: mixing.WEIGHTS[n % 3] for n, s in enumerate(names)}
    targets = water_level(sizes, weights, repeats, sum(size.values()))
    queue, sent = [], defaultdict(int)
    for number, name in enumerate(names):
        words = 0
        own = [i for i in size if source[i] == name and size[i]]
        for turn in range(1, repeats + 1):
            for i in sorted(own, key=lambda i: (hashlib.md5(f"0:{turn}:{i}".encode()).hexdigest(), i)):
                words += size[i]
                queue.append((words / targets[name], number, turn, hashlib.md5(f"0:{turn}:{i}".encode()).hexdigest(), i))
    total = 0
    for *_, i in sorted(queue):
        total += size[i]
        if total > sum(size.values()):
            break
        sent[i] += size[i]
    return sorted((i, size[i], sizes[source[i]], targets[source[i]], sent[i]) for i in size)


@pytest.fixture(scope="module")
def unique(rows):
    named = [(i, t, lang, [None, "a", "é", "Z"][i % 4] if i and i > 20 else s, n) for i, t, lang, s, n in rows if i is not None]
    return [r for n, r in enumerate(named) if r[0] not in {x[0] for x in named[:n]}]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def test_mix_against_brute_force(spark, unique, many_blocks):
    done = mixing.mix(frame(spark, unique)).select("doc_id", "size", "source_size", "target", "taken")
    found = sorted(map(tuple, done.collect()))
    assert found == brute(unique)
    assert any(r[4] > r[1] > 0 for r in found) and any(r[4] == 0 < r[1] for r in found)


def test_query_against_sql(spark, unique_dir, duck):
    assert compare(mixing.op13_mixing(spark, unique_dir), duck(mixing.OP13_SQL, unique_dir)) is None


def test_targets_of_many_sources(spark):
    sizes = {f"s{i:03d}": (i * 7919) % 1000 + (i % 5 == 0) * 90_000 for i in range(200)} | {None: 12}
    given = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    targets, budget = mixing.source_targets(given)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = water_level(sizes, {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}, 3, sum(sizes.values()))
    found = {r["source"]: r["target"] for r in targets.collect()}
    assert found == pytest.approx(expected) and budget == sum(sizes.values())
    assert sum(found.values()) == pytest.approx(budget)
    above, _ = mixing.source_targets(given, budget=10**9)
    assert {r["source"]: r["target"] for r in above.collect()} == {k: 3.0 * v for k, v in sizes.items()}


def test_sources_come_near_their_targets(spark, many_blocks):
    rows = [(i, "w " * (i % 50 + 1), "en", "hot" if i % 3 else f"s{i % 7}", 0) for i in range(3000)]
    done = mixing.mix(frame(spark, rows)).collect()
    taken, target = Counter(), {}
    for r in done:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)
    assert 0 <= sum(r["size"] for r in done) - sum(taken.values()) < 50


def test_reruns_agree_whatever_the_split(spark, unique):
    runs = [mixing.mix(frame(spark, unique).repartition(n)).select("doc_id", "taken").collect() for n in (1, 7)]
    assert sorted(runs[0]) == sorted(runs[1])


def test_mixture_has_the_rows_that_mix_counts(spark, unique):
    docs = frame(spark, unique)
    counted = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}
    sent = mixing.mixture(docs).orderBy("sent").collect()
    found, total = Counter(), 0
    for r in sent:
        size = len(WORD.findall(r["text"]))
        found[r["doc_id"]] += size
        total += size
        assert r["sent"] == total
    assert found == counted
    assert [r["finish"] for r in sent] == sorted(r["finish"] for r in sent)


def test_repeated_and_null_rows(spark, rows):
    done = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert done.count() == len(rows)
    assert all(r["taken"] <= 3 * r["size"] for r in done.collect())


def test_clashing_columns_stay(spark, clashing):
    extra = clashing.withColumn("source", clashing["doc_id"].cast("string")).withColumn("taken", clashing["text"]).withColumn("task", clashing["text"])
    done = mixing.mix(extra)
    assert set(done.columns) == set(extra.columns) | {"size", "source_size", "target"}
    assert {r["row"] for r in done.collect()} == {2 * i for i in range(20)} and dict(done.dtypes)["taken"] == "bigint"


def test_empty_table(spark, empty_dir):
    assert mixing.op13_mixing(spark, empty_dir).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {tuple(r)[3:] for r in mixing.mix(nothing).collect()} == {(0, 0, 0.0, 0)}


def test_sorted_rows_are_written_narrow(spark, unique, many_blocks, monkeypatch):
    """Columns that only sort the queues are not written, sorted or shuffled again."""
    columns, store = {}, mixing.stored

    def noted(df, name, *args, **options):
        columns[name] = set(df.columns)
        return store(df, name, *args, **options)

    monkeypatch.setattr(mixing, "stored", noted)
    assert mixing.mix(frame(spark, unique)).count() == len(unique)
    assert columns["mix-queues"] == {"row_id", "pass", "size", "target", "number", "place", "task"}
    assert columns["mix-sent"] == {"row_id", "pass", "size", "finish", "place", "task"}

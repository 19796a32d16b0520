"""Replacing months under a journal: whatever step a job dies at, the next call ends up where an undisturbed one does."""

import os
import shutil
import subprocess
import sys

import pytest

from cargolens.plans.refresh import refresh
from cargolens.storage import files_under, path_exists, read_text, write_text
from cargolens.streaming import journal, rollups, upsert

KEYS = ("year", "month_number", "country_code")
TYPES = "year int, month_number int, country_code string, valuecif double"


class Died(Exception):
    pass


def rows_of(spark, store):
    return sorted((tuple(r) for r in spark.read.parquet(store).select(*KEYS, "valuecif").collect()), key=str)


@pytest.fixture
def base(spark):
    rows = [(2024, 1, "a", 1.0), (2024, 1, "b", 2.0), (2024, 2, "a", 3.0), (2024, None, "a", 9.0), (2023, 5, "z", 7.0)]
    return spark.createDataFrame(rows, TYPES)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(2024, 1, "a", 10.0), (2024, 2, "c", 4.0), (2024, None, "a", 90.0), (2025, 1, "a", 5.0)], TYPES)


MERGED = sorted(
    [
        (2024, 1, "a", 10.0), (2024, 1, "b", 2.0), (2024, 2, "a", 3.0), (2024, 2, "c", 4.0), (2024, None, "a", 90.0),
        (2023, 5, "z", 7.0), (2025, 1, "a", 5.0),
    ],
    key=str,
)


def dying(patch, step):
    """Make the journal's ``step``-th change of a folder its last; returns the counter."""
    count = [0]

    def counted(change, before):
        def run(*args):
            count[0] += 1
            if count[0] == step and before:
                raise Died
            change(*args)
            if count[0] == step:
                raise Died

        return run

    for name in ("move_file", "remove_path"):
        patch.setattr(journal, name, counted(getattr(journal, name), before=step % 2 == 0))
    return count


@pytest.mark.parametrize("with_rollups", [False, True])
def test_any_step_may_be_the_last(spark, base, batch, tmp_path, monkeypatch, with_rollups):
    first = str(tmp_path / "store")
    upsert.upsert(spark, first, base, KEYS, rollups=with_rollups)
    upsert.prepare(spark, first, batch, KEYS)
    suffixes = ("", ".staging", ".rollups") if with_rollups else ("", ".staging")
    done = str(tmp_path / "done")
    for s in suffixes:
        shutil.copytree(first + s, done + s)
    journal.finish(spark, done)
    assert rows_of(spark, done) == MERGED and not path_exists(spark, journal.staging_of(done))
    want = {s: files_under(spark, done + s) for s in suffixes}
    step, between = 0, 7 if with_rollups else 1  # the aggregates' tables are replaced like the store
    while True:
        step += between
        store = str(tmp_path / f"store{step}")
        for s in suffixes:
            shutil.copytree(first + s, store + s)
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                journal.finish(spark, store)
            except Died:
                pass
            else:
                break
        journal.recover(spark, store)
        assert {s: files_under(spark, store + s) for s in suffixes} == want, f"step {step}"
    assert step > (25 if with_rollups else 8)


def test_a_refresh_finishes_what_a_died_one_decided(spark, tmp_path, monkeypatch):
    def raw(*rows):
        return spark.createDataFrame(rows, "month string, country_code string, valuecif string, weight string")

    store = str(tmp_path / "store")
    refresh(spark, raw(("May 2024", "a", "1", "2"), ("June 2024", "a", "2", "2"), ("June 2024", "b", "2", "2")), store)
    second = raw(("June 2024", "a", "9", "2"), ("July 2024", "a", "3", "2"))
    with monkeypatch.context() as patch:
        dying(patch, 3)  # after two looks for earlier leftovers: the old file of June is gone, nothing has come in
        with pytest.raises(Died):
            refresh(spark, second, store)
    assert not files_under(spark, f"{store}/year=2024/month_number=6")
    third = raw(("August 2024", "a", "4", "2"))
    assert refresh(spark, third, store) == "merged"
    found = {(r["month_number"], r["country_code"], float(r["valuecif"])) for r in spark.read.parquet(store).collect()}
    assert found == {(5, "a", 1.0), (6, "a", 9.0), (6, "b", 2.0), (7, "a", 3.0), (8, "a", 4.0)}


def test_an_undecided_replacement_is_forgotten(spark, base, batch, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    upsert.upsert(spark, store, base, KEYS)
    before = files_under(spark, store)
    with monkeypatch.context() as patch:
        patch.setattr(upsert, "decide", lambda *a: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            upsert.upsert(spark, store, batch, KEYS)
    assert path_exists(spark, journal.staging_of(store)) and files_under(spark, store) == before
    assert journal.recover(spark, store) is False
    assert files_under(spark, store) == before and not path_exists(spark, journal.staging_of(store))


def test_a_rebuild_that_died_is_finished(spark, base, batch, tmp_path, monkeypatch):
    first = str(tmp_path / "store")
    upsert.upsert(spark, first, base, KEYS)
    upsert.prepare(spark, first, batch, KEYS, rebuild=True)
    for step in range(1, 7):
        store = str(tmp_path / f"store{step}")
        for s in ("", ".staging"):
            shutil.copytree(first + s, store + s)
        with monkeypatch.context() as patch:
            dying(patch, step)
            with pytest.raises(Died):
                journal.finish(spark, store)
        assert journal.recover(spark, store)
        assert rows_of(spark, store) == sorted(map(tuple, batch.collect()), key=str)


def test_a_killed_process_loses_nothing(spark, tmp_path):
    """Not an exception: the job's process ends by itself right after the first deletion."""
    store, root = str(tmp_path / "store"), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = spark.createDataFrame([(2024, 1, "a", 1.0), (2024, 2, "a", 2.0)], TYPES)
    upsert.upsert(spark, store, base, KEYS)
    job = f"""
import os
from pyspark.sql import SparkSession
from cargolens.streaming import journal, upsert
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / 'shared')!r}).getOrCreate()
remove = journal.remove_path
def last(*args):
    if not args[1].endswith(".staging"):
        remove(*args)
        os._exit(9)
    remove(*args)
journal.remove_path = last
batch = spark.createDataFrame([(2024, 1, "b", 5.0), (2024, 2, "a", 6.0)], {TYPES!r})
upsert.upsert(spark, {store!r}, batch, {KEYS!r})
"""
    run = subprocess.run([sys.executable, "-c", job], cwd=root, capture_output=True, timeout=300)
    assert run.returncode == 9, run.stderr[-800:]
    assert not files_under(spark, f"{store}/year=2024/month_number=1")
    upsert.upsert(spark, store, spark.createDataFrame([], TYPES), KEYS)
    assert rows_of(spark, store) == [(2024, 1, "a", 1.0), (2024, 1, "b", 5.0), (2024, 2, "a", 6.0)]


def test_a_first_load_stages_no_batch(spark, base, tmp_path):
    store = str(tmp_path / "store")
    upsert.prepare(spark, store, base, KEYS)
    assert not path_exists(spark, f"{journal.staging_of(store)}/batch")
    journal.finish(spark, store)
    assert rows_of(spark, store) == sorted(map(tuple, base.collect()), key=str)


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "folder/note.json")
    assert read_text(spark, path) is None
    write_text(spark, path, "é")
    write_text(spark, path, "second ☃")
    assert read_text(spark, path) == "second ☃" and files_under(spark, str(tmp_path / "nowhere")) == {}


def test_lost_staged_files_are_an_error(spark, base, batch, tmp_path):
    store = str(tmp_path / "store")
    upsert.upsert(spark, store, base, KEYS)
    upsert.prepare(spark, store, batch, KEYS)
    shutil.rmtree(f"{journal.staging_of(store)}/months")
    with pytest.raises(RuntimeError, match="neither"):
        journal.recover(spark, store)


def test_rollups_follow_the_store(spark, base, batch, tmp_path):
    store = str(tmp_path / "store")
    upsert.upsert(spark, store, base, KEYS)
    upsert.upsert(spark, store, batch, KEYS, rollups=True)  # made late: months that stay are in them, too
    upsert.upsert(spark, store, batch, KEYS)
    months = rollups.covering(spark, rollups.rollups_of(store), "year")
    found = {(r["year"], r["month_number"]): (r["records_added_up"], r["valuecif"]) for r in months.collect()}
    want: dict = {}
    for year, month, _, value in MERGED:
        n, v = want.get((year, month), (0, 0))
        want[year, month] = (n + 1, v + value)
    assert {k: (n, float(v)) for k, (n, v) in found.items()} == want

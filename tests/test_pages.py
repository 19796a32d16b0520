"""Pages from a stored order, and answers from folder names and footers."""

import re

from pyspark.sql import functions as F

from cargolens.sources import pages
from cargolens.streaming import upsert


def rows_of(df, keys):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r[: len(keys)]))


def folders_read(df):
    files = df.inputFiles()
    return {re.search(r"_block=(\d+)", f)[1] for f in files}


def test_pages_cover_the_table_once_and_read_few_blocks(spark, many_blocks, tmp_path):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    index = pages.build_page_index(df, str(tmp_path / "index"), ["k"])
    blocks = index.blocks(spark).collect()
    assert len(blocks) == 8 and max(b["row_count"] for b in blocks) < 1500  # the hot key is spread
    assert index.row_count(spark) == 5000 and blocks[0]["first_keys"]["k"] is None
    found, numbers = [], []
    for number in range(1, 12):
        page = index.page(spark, 500, number)
        got = page.orderBy("row_number").collect()
        found += [r["n"] for r in got]
        numbers += [r["row_number"] for r in got]
        if got:
            assert len(folders_read(page)) <= 3
        else:
            assert number == 11
    assert sorted(found) == list(range(5000)) and numbers == list(range(1, 5001))
    keys = {r["n"]: r["k"] for r in df.collect()}
    ordered = [keys[n] for n in found]
    assert ordered == sorted(ordered, key=lambda k: (k is not None, k or ""))


def test_a_page_has_no_limit_and_no_sort(spark, tmp_path):
    index = pages.build_page_index(spark.range(1000).toDF("n"), str(tmp_path / "index"), ["n"], descending=True)
    page = index.page(spark, 10, 3)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "Sort" not in plan and "Exchange" not in plan
    assert sorted((r["row_number"], r["n"]) for r in page.collect()) == [(i, 1000 - i) for i in range(21, 31)]


def test_an_empty_table_has_no_pages(spark, tmp_path):
    index = pages.build_page_index(spark.range(0).toDF("n"), str(tmp_path / "index"), ["n"])
    assert index.row_count(spark) == 0 and index.page(spark, 10).count() == 0


def test_months_come_from_folder_names(spark, tmp_path):
    rows = [(2024, 5, 1.0), (2024, None, 2.0), (None, None, 3.0), (2023, 12, 4.0)]
    store = str(tmp_path / "store")
    upsert.upsert(spark, store, spark.createDataFrame(rows, "year int, month_number int, valuecif double"), ("year", "month_number"))
    for file in (tmp_path / "store").rglob("*.parquet"):
        file.write_bytes(b"not read")
    months = {tuple(r) for r in upsert.stored_months(spark, store).collect()}
    assert months == {(2024, 5), (2024, None), (None, None), (2023, 12)}
    found = upsert.store_freshness(spark, store, store).first()
    assert str(found["newest_held"]) == "2024-05-01" and found["has_new_data"] is False


def test_a_count_reads_no_column(spark, tmp_path):
    spark.range(100).selectExpr("id", "2024 AS year", "1 AS month_number").write.partitionBy("year", "month_number").parquet(str(tmp_path / "s"))
    found = upsert.completeness(spark.read.parquet(str(tmp_path / "s")), 100)
    assert "ReadSchema: struct<>" in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(found.first()) == (100, True)


def test_blocks_are_sorted_once(spark, many_blocks, tmp_path, monkeypatch):
    """The write to block folders keeps the order it is given; a block's first row names its keys."""
    written = []
    inside = pages.unsorted_writes

    def noted(session, folders):
        written.append(folders)
        return inside(session, folders)

    monkeypatch.setattr(pages, "unsorted_writes", noted)
    df = spark.range(300).select((F.col("id") % 100).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("n"))
    index = pages.build_page_index(df, str(tmp_path / "index"), ["k", "n"])
    assert written == [1]
    rows = spark.read.parquet(f"{index.path}/rows")
    for block in index.blocks(spark).collect():
        own = sorted(rows.where(F.col("_block") == block["block"]).collect(), key=lambda r: r["_place"])
        assert [r["_place"] for r in own] == list(range(block["row_count"]))
        assert (own[0]["k"], own[0]["n"]) == tuple(block["first_keys"])

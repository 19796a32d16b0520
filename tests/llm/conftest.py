import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_documents():
    """Ordinary prose with copies, near copies and shared lines, and every awkward row the contracts name."""
    pick = random.Random(5)
    stems = {"en": "the of and thing ation er in reed", "de": "der und schung heit über ein ge ver", "fr": "le éaux ment que tion ré ou"}
    rows = []

    def words(lang, n):
        parts = stems[lang].split()
        return [pick.choice(parts) + pick.choice(["", pick.choice(parts)]) for _ in range(n)]

    def prose(lang, lines):
        return "\n".join(" ".join(words(lang, pick.randint(4, 30))).capitalize() + "." for _ in range(lines))

    for i in range(60):
        lang = pick.choice(list(stems))
        text = prose(lang, pick.randint(1, 8))
        if i % 3 == 0:
            text += "\nShared FOOTER line \t"
        if i % 7 == 0:
            text += "\nReleased under the MIT License."
        if i % 11 == 0:
            text = "Licensed under the Apache License, Version 2.0.\n" + text + "\nAll rights reserved."
        rows.append((i, text, lang))
    for i in range(60, 75):  # exact copies
        rows.append((i, rows[4][1], rows[4][2]))
    base = words("en", 400)
    for i in range(75, 90):  # near copies
        changed = list(base)
        changed[pick.randrange(400)] = "changed"
        rows.append((i, " ".join(changed), "en"))
    long_words = words("en", 30_000)
    rows += [
        (90, None, "en"),
        (91, "", "en"),
        (92, " \t\x0b\n ", "de"),
        (93, " ".join(long_words), None),
        (94, "MIT license " * 3000, "en"),
        (95, "12345 67 !!", "en"),
        (96, "ÀÉ ΑΣ İK ﬁ́ 日本語 \U0001f600 tschüß", "de"),
        (97, "line\r\n\nline\n\n", None),
        (98, "<|endoftext|> and <|startoftext|> a\n \nb   c  ", "en"),
        (99, "x" * 20_000, "en"),
        (100, "gnu general public license general public license", "en"),
        (7, rows[7][1], rows[7][2]),  # a repeated row
        (8, "another text of the same id", "en"),
        (None, "a text without an id", "en"),
        (None, None, None),
        (101, "word", "en"),
        (102, "two words", "en"),
    ]
    return [(i, t, lang, "src0" if (i or 0) % 3 else "hot", len(t) if t is not None else None) for i, t, lang in rows]


@pytest.fixture(scope="session")
def rows():
    return edge_documents()


@pytest.fixture(scope="session")
def edge_dir(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="session")
def unique_dir(spark, rows, tmp_path_factory):
    """The same without repeated and null ids, for SQL that counts by id."""
    folder = str(tmp_path_factory.mktemp("unique"))
    own = [r for i, r in enumerate(rows) if r[0] is not None and r[0] not in {x[0] for x in rows[:i]}]
    spark.createDataFrame(own, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture
def clashing(spark, rows):
    """Extra columns whose names the operators use themselves."""
    names = ["row", "ID", "sign", "gone", "lines", "words", "hits", "labels", "score", "found", "fp", "key", "bucket", "n_lines", "a.b"]
    frame = spark.createDataFrame(rows[:20], SCHEMA)
    for name in names:
        frame = frame.withColumn(name, frame["doc_id"] * 2) if "." not in name else frame.withColumnRenamed("source", name)
    return frame


@pytest.fixture
def duck(edge_dir, unique_dir):
    import duckdb

    def run(sql, folder, table="documents"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        return con.sql(sql)

    return run

import re

from cargolens.llm import license_scan
from verification.compare import compare


def spoken(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    """Base places and all labels by looking at every place of the text."""
    words = spoken(text)
    base, labels = [], set()
    for template in license_scan.TEMPLATES:
        for start in range(-len(template.words), len(words)):
            at = lambda i: words[start + i] if 0 <= start + i < len(words) else None
            if all(at(i) == template.words[i] for i in template.key_places):
                labels.add(template.label)
                if template.base:
                    base.append((start, template.label))
    return len(words), base, labels


def test_query_against_brute_force(spark, edge_dir, rows):
    expected = []
    for i, text, *_ in rows:
        n, base, labels = brute(text)
        starts = [s for s, _ in base]
        row = (i, n, len(base), min(starts, default=None), max(starts, default=None))
        expected.append((*row, ",".join(sorted({x for _, x in base})), ",".join(sorted(labels))))
    found = license_scan.op1_license_scan(spark, edge_dir).collect()
    assert sorted((tuple(r)[:-1] for r in found), key=str) == sorted(expected, key=str)
    assert all((r.score > 0) == bool(r.labels) and r.score <= 1 for r in found)


def test_query_against_sql(spark, unique_dir, duck):
    assert compare(license_scan.op1_license_scan(spark, unique_dir), duck(license_scan.OP1_SQL, unique_dir)) is None


def test_notices_and_near_misses(spark):
    texts = [
        "Licensed under CC BY-NC 4.0.",
        "licensed under the apache license, version 2.0",
        "apache, license",
        "Apache\nLicense version 3",
        "gnu general public license, version 2",
        "general public general public license",
        "ſt mit lıcense",
        "Permission is hereby granted, free of charge, to any person",
        "all rights are reserved",
        "é mit license",
        "mit-license.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan.scan(docs).collect()}
    assert list(found[i] for i in range(len(texts))) == [
        "cc-by-nc-4.0", "apache,apache-2.0", "apache", "apache", "gpl,gpl-2.0", "gpl", "", "mit", "", "mit", "mit",
    ]


def test_whole_notice_scores_one(spark):
    docs = spark.createDataFrame([(1, license_scan.TEMPLATES[5].text), (2, "gnu general public license x version 3")], "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert found[1].score == 1.0
    assert found[2].labels == "gpl"


def test_empty_table_and_clashing_columns(spark, empty_dir, clashing):
    assert license_scan.op1_license_scan(spark, empty_dir).count() == 0
    done = license_scan.scan(clashing)
    assert set(clashing.columns) <= set(done.columns)
    assert sorted(r["words"] for r in done.collect()) == [2 * i for i in range(20)]

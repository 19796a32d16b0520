import re

import pytest
from pyspark.sql import functions as F

from cargolens.llm import warc
from verification.compare import compare

PAGES = [
    (1, "http://a.example/", "<html lang='EN'><title> A\n title </title><p>One<br>two &amp; three</p><script>no</script>"),
    (2, None, None),
    (3, "http://b.example/", ""),
    (4, "http://c.example/", "<p>" + "long text " * 20_000 + "</p><!-- gone\n -->"),
    (5, "http://d.example/", "a < b and c > d &lt;kept&gt; &amp;lt; é WARC/1.1 text"),
    (6, "http://e.example/", "<script>never closed"),
    (1, "http://a.example/", "<html lang='EN'><title> A\n title </title><p>One<br>two &amp; three</p><script>no</script>"),
    (None, "http://f.example/", "<STYLE>x</STYLE><DIV>Upper</DIV> <a href=x>one</a><A HREF=y>two</A>"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_query_against_sql(spark, tmp_path, duck):
    pages(spark).write.parquet(f"{tmp_path}/pages.parquet")
    found = warc.op2_warc_derivatives(spark, str(tmp_path))
    assert found.count() == 2 * len(PAGES)
    assert compare(found, duck(warc.OP2_SQL, str(tmp_path), "pages")) is None


def test_plain_text(spark):
    rows = {r.page_id: r.content for r in warc.derivatives(warc.responses(pages(spark))).where("warc_type = 'conversion'").collect()}
    assert rows[1] == "A title\nOne\ntwo & three"
    assert rows[2] == rows[3] == ""
    assert rows[4] == ("long text " * 20_000).strip()
    assert rows[5] == "a < b and c > d <kept> &lt; é WARC/1.1 text"
    assert rows[None] == "Upper\none" + "two"


def test_derivatives_are_linked(spark):
    source = {r.record_id: r for r in warc.responses(pages(spark)).collect()}
    made = warc.derivatives(warc.responses(pages(spark))).collect()
    for r in made:
        origin = source[r.refers_to]
        assert (r.refers_to_digest, r.source_headers, r.target_uri) == (origin.block_digest, origin.http_headers, origin.target_uri)
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id)
    fields = next(r.content for r in made if r.page_id == 1 and r.warc_type == "metadata")
    assert "status: 200\r\n" in fields and "html-lang: en\r\n" in fields and "title: A title\r\n" in fields


def test_other_types_and_dates(spark):
    records = warc.responses(pages(spark, PAGES[:1]).withColumn("warc_date", F.lit("2024-01-02T03:04:05Z")))
    text = records.withColumn("http_headers", F.lit("HTTP/1.1 404 Not Found\r\ncontent-type: Text/Plain\r\n\r\n"))
    image = records.withColumn("http_headers", F.lit("HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n"))
    bare = records.withColumn("http_headers", F.lit(None).cast("string"))
    made = {r.warc_type: r for r in warc.derivatives(text).collect()}
    assert made["conversion"].content == PAGES[0][2] and "status: 404" in made["metadata"].content
    assert made["conversion"].warc_date == "2024-01-02T03:04:05Z"
    assert [r.warc_type for r in warc.derivatives(image).collect()] == ["metadata"]
    assert [r.warc_type for r in warc.derivatives(bare).collect()] == ["metadata"]


def test_files_round_trip(spark, tmp_path):
    made = warc.derivatives(warc.responses(pages(spark).where("page_id != 5")))
    warc.write_warc(made, f"{tmp_path}/plain")
    warc.write_warc(made, f"{tmp_path}/zipped", compression="gzip")
    columns = ["record_id", "warc_type", "refers_to", "refers_to_digest", "target_uri", "warc_date", "content_type", "content", "content_length", "content_digest"]
    expected = sorted(map(tuple, made.select(*columns).collect()))
    for folder in ("plain", "zipped"):
        assert sorted(map(tuple, warc.read_warc(spark, f"{tmp_path}/{folder}").select(*columns).collect())) == expected


def test_every_text_and_the_source_headers_round_trip(spark, tmp_path):
    hard = [
        (20, "http://h.example/", "ends in WARC/1.1"),
        (21, "http://h.example/2", "<pre>WARC/1.1\r\nContent-Length: 5\r\n\r\nxx</pre>"),
        (22, "http://h.example/3", "\r\n\r\n"),
        (23, "http://h.example/4", None),
        (None, None, "é \U0001f600 WARC/1.1\r\n"),
        (24, "http://h.example/5", "x" * 300_000),
    ]
    frame = pages(spark).select("page_id", "url", "html").union(spark.createDataFrame(hard, "page_id long, url string, html string"))
    # plain text keeps the line ends that HTML loses
    records = warc.responses(frame)
    plain = records.withColumn("http_headers", F.lit("HTTP/1.1 200 OK\r\ncontent-type: text/plain\r\nX-A: \"q\"\r\n\r\n"))
    made = warc.derivatives(records.union(plain))
    columns = [*warc.FIELDS, "source_headers", "content", "content_length"]
    expected = sorted(map(tuple, made.select(*columns).collect()), key=str)
    assert sum("WARC/1.1\r\n" in r[-2] for r in expected) >= 2
    for compression in ("none", "gzip"):
        warc.write_warc(made.repartition(3), f"{tmp_path}/{compression}", compression)
        assert sorted(map(tuple, warc.read_warc(spark, f"{tmp_path}/{compression}").select(*columns).collect()), key=str) == expected


def test_a_file_that_is_cut_short_is_an_error(spark, tmp_path):
    made = warc.derivatives(warc.responses(pages(spark))).coalesce(1)
    warc.write_warc(made, str(tmp_path / "whole"))
    [file] = (tmp_path / "whole").glob("part-*")
    data = file.read_bytes()
    assert len(list(warc.records_of(data, "x"))) == made.count() and list(warc.records_of(b"", "x")) == []
    with pytest.raises(ValueError):
        list(warc.records_of(data[:-10], "x"))
    with pytest.raises(ValueError):
        list(warc.records_of(b"something else\r\n\r\n", "x"))


def test_empty_table_and_extra_columns(spark, empty_dir):
    assert warc.op2_warc_derivatives(spark, empty_dir).count() == 0
    extra = pages(spark).withColumns({n: F.lit("x") for n in ("record_id", "payload", "text", "kind", "content")})
    assert warc.derivatives(warc.responses(extra)).count() == 2 * len(PAGES)

"""WARC derivatives: metadata and plain-text conversion records made from response records.

``responses`` frames pages as HTTP response records. ``derivatives`` gives each response one ``metadata`` record (what
the response's headers and page say: status, type, charset, language, title, link count, digests) and, where it holds
HTML or text, one ``conversion`` record with the page's plain text. Both carry ``WARC-Refers-To`` with the response's
id, its target, date and digests; record ids are derived from the response's id, so a repeated run makes the same ones.
``write_warc`` and ``read_warc`` are the file sink and source.

Everything is row by row, in DataFrame functions but for the reading of files: no shuffle, whatever the hosts or sizes.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import BATCH_BYTES, bounded_batches

VERSION, CRLF = "WARC/1.1", "\r\n"
#: Header field that holds the source's HTTP headers, and the columns of the fields a file's records are read into.
SOURCE_HEADERS = "X-Source-Headers"
FIELDS = {
    "record_id": "WARC-Record-ID",
    "warc_type": "WARC-Type",
    "refers_to": "WARC-Refers-To",
    "refers_to_digest": "WARC-Refers-To-Digest",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "content_type": "Content-Type",
    "content_digest": "WARC-Block-Digest",
}
#: Date of records whose source has none.
NO_DATE = "1970-01-01T00:00:00Z"

# HTML elements without text, elements that end a line, and the entities that are decoded.
SILENT = r"(?is)<!--.*?-->|<(?:script|style|noscript|template)\b[^>]*>.*?</(?:script|style|noscript|template)\s*>"
LINES = r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
TAGS = r"(?s)<[/!?A-Za-z][^>]*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def record_id(*parts: Column) -> Column:
    """``<urn:uuid:...>`` from the md5 of the parts."""
    sign = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(sign, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def plain_text(html: Column) -> Column:
    """Text of a page: no scripts, styles or comments; block elements end lines; white space collapsed, blank lines gone."""
    text = F.regexp_replace(html, SILENT, " ")
    text = F.regexp_replace(text, r"[\x00-\x20]+", " ")
    text = F.regexp_replace(text, LINES, "\n")
    text = F.regexp_replace(text, TAGS, "")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    text = F.regexp_replace(text, r"[ \t]*\n[ \t\n]*", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    return F.btrim(text, F.lit(" \n"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of ``pages(page_id, url, html)`` and, where there is one, ``warc_date``.

    Columns ``record_id, page_id, target_uri, warc_date, http_headers, payload, payload_digest, block_digest``. Null
    pages have an empty payload, null URLs an empty target. Other columns are not read.
    """
    payload = F.coalesce("html", F.lit(""))
    date = F.coalesce(F.col("warc_date").cast("string"), F.lit(NO_DATE)) if "warc_date" in pages.columns else F.lit(NO_DATE)
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("target_uri"), date.alias("warc_date"), payload.alias("payload"))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(CRLF + CRLF),
    )
    rows = rows.withColumns(
        {"http_headers": headers, "payload_digest": digest(F.col("payload")), "record_id": record_id(F.lit("response"), F.col("page_id"), F.col("target_uri"))}
    )
    block = digest(F.concat("http_headers", "payload"))
    return rows.select("record_id", "page_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest", block.alias("block_digest"))


def http_field(headers: Column, name: str) -> Column:
    """A field of an HTTP header block, null if absent; names in any case."""
    value = F.regexp_extract(headers, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", F.btrim(value))


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records.

    Columns ``record_id, warc_type, refers_to, refers_to_digest, target_uri, warc_date, source_headers, content_type,
    content, content_length, content_digest, page_id``. A response whose type is neither HTML nor text has no
    conversion. A page without text has an empty conversion. Repeated responses give repeated records; records of a
    null id are derived from target and digest alone. An empty table gives an empty table.
    """
    kind = F.lower(F.coalesce(F.regexp_extract(http_field(F.col("http_headers"), "Content-Type"), r"^([^;\s]*)", 1), F.lit("")))
    rows = records.withColumns({"kind": kind, "text": F.when(kind == "text/html", plain_text(F.col("payload"))).when(kind.startswith("text/"), F.col("payload"))})
    title = F.regexp_replace(F.regexp_extract("payload", r"(?is)<title\b[^>]*>(.*?)</title", 1), r"[\x00-\x20]+", " ")
    facts = {
        "status": F.regexp_extract("http_headers", r"^HTTP/[0-9.]+ ([0-9]+)", 1),
        "media-type": F.col("kind"),
        "charset": F.regexp_extract(F.coalesce(http_field(F.col("http_headers"), "Content-Type"), F.lit("")), r"(?i)charset=([^;\s]*)", 1),
        "html-lang": F.lower(F.regexp_extract("payload", r"(?is)<html\b[^>]*\blang=.?([A-Za-z-]+)", 1)),
        "title": F.btrim(title),
        "outlinks": F.regexp_count("payload", F.lit(r"(?i)<a\s[^>]*href=")).cast("string"),
        "payload-digest": F.col("payload_digest"),
        "payload-length": F.octet_length("payload").cast("string"),
        "text-digest": digest(F.coalesce("text", F.lit(""))),
        "text-length": F.octet_length(F.coalesce("text", F.lit(""))).cast("string"),
    }
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("")), F.lit(CRLF)) for name, value in facts.items()]
    metadata = F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), F.concat(*lines).alias("content"))
    conversion = F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("content"))
    made = F.filter(F.array(metadata, conversion), lambda r: r["content"].isNotNull())
    rows = rows.select(
        F.col("record_id").alias("refers_to"),
        F.col("block_digest").alias("refers_to_digest"),
        "target_uri",
        "warc_date",
        F.col("http_headers").alias("source_headers"),
        "page_id",
        F.inline(made),
    )
    return rows.select(
        record_id(F.col("warc_type"), F.col("refers_to"), F.col("refers_to_digest")).alias("record_id"),
        "warc_type",
        "refers_to",
        "refers_to_digest",
        "target_uri",
        "warc_date",
        "source_headers",
        "content_type",
        "content",
        F.octet_length("content").cast("long").alias("content_length"),
        digest(F.col("content")).alias("content_digest"),
        "page_id",
    )


#: Records of a file at most, so that a file stays small enough to be read whole.
FILE_RECORDS = 20_000


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Derivative records as WARC files, one or more for each task.

    The source's HTTP headers go into a field of their own, as a JSON string in brackets: they have line ends. Line ends
    in any other field, such as a broken URL, become blanks.
    """
    fields = [
        ("WARC-Type", F.col("warc_type")),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Refers-To-Digest", F.col("refers_to_digest")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("warc_date")),
        ("WARC-Block-Digest", F.col("content_digest")),
        (SOURCE_HEADERS, F.to_json(F.array("source_headers"))),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    ]
    one_line = {name: F.regexp_replace(F.coalesce(value, F.lit("")), "[\\r\\n]", " ") for name, value in fields}
    head = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in one_line.items()]
    record = F.concat(F.lit(VERSION + CRLF), *head, F.lit(CRLF), F.coalesce("content", F.lit("")))
    writer = records.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", compression).text(path)


def records_of(data: bytes, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC file, plain or gzip.

    A record ends where its length says, whatever its block holds; a file that is cut short is an error.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    end, gap, at = len(data), (CRLF + CRLF).encode(), 0
    while True:
        while data[at : at + 2] == CRLF.encode():
            at += 2
        if at == end:
            return
        body = data.find(gap, at)
        lines = data[at:body].decode().split(CRLF)
        fields = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        if body < 0 or not lines[0].startswith("WARC/") or not length.isdigit() or body + 4 + int(length) > end:
            raise ValueError(f"no whole WARC record at byte {at} of {path}")
        at = body + 4 + int(length)
        yield fields, data[body + 4 : at]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files of text, as ``write_warc`` writes them, with the source's headers. A file is read whole by one task."""
    bounded_batches(spark)
    kinds = {"content_length": pa.int64()}
    columns = [*FIELDS, "source_headers", "content", "content_length"]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for fields, block in records_of(data.as_py(), name):
                    headers = json.loads(fields.get(SOURCE_HEADERS.lower()) or "[null]")[0]
                    rows.append([*[fields.get(f.lower(), "") for f in FIELDS.values()], headers, block.decode(), len(block)])
                    size += len(block)
                    if size >= BATCH_BYTES:
                        yield arrow(rows)
                        rows, size = [], 0
                yield arrow(rows)

    def arrow(rows: list[list]) -> pa.RecordBatch:
        each = zip(*rows) if rows else [[] for _ in columns]
        return pa.RecordBatch.from_arrays([pa.array(list(v), kinds.get(c, pa.string())) for c, v in zip(columns, each)], columns)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parsed, ", ".join(f"{c} {'long' if c in kinds else 'string'}" for c in columns))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def _uuid_sql(*parts: str) -> str:
    sign = f"md5(concat_ws(chr(10), {', '.join(parts)}))"
    cut = ", ".join(f"substr({sign}, {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {cut}) || '>'"


def _text_sql(html: str) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"regexp_replace({html}, {quoted(SILENT)}, ' ', 'g')"
    text = f"regexp_replace({text}, '[\\x00-\\x20]+', ' ', 'g')"
    text = f"regexp_replace({text}, {quoted(LINES)}, chr(10), 'g')"
    text = f"regexp_replace({text}, {quoted(TAGS)}, '', 'g')"
    for entity, character in ENTITIES:
        text = f"replace({text}, {quoted(entity)}, {quoted(character)})"
    text = f"regexp_replace({text}, '[ \\t]*\\n[ \\t\\n]*', chr(10), 'g')"
    return f"trim(regexp_replace({text}, '[ \\t]+', ' ', 'g'), ' ' || chr(10))"


OP2_SQL = rf"""
WITH page AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10) AS source_headers
  FROM pages),
response AS (
  SELECT *, {_uuid_sql("'response'", "coalesce(page_id::VARCHAR, '')", "target_uri")} AS refers_to,
         'sha256:' || sha256(source_headers || payload) AS refers_to_digest, {_text_sql("payload")} AS body
  FROM page),
made AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
         concat_ws(chr(13) || chr(10), 'status: 200', 'media-type: text/html', 'charset: utf-8',
           'html-lang: ' || lower(regexp_extract(payload, '(?is)<html\b[^>]*\blang=.?([A-Za-z-]+)', 1)),
           'title: ' || trim(regexp_replace(regexp_extract(payload, '(?is)<title\b[^>]*>(.*?)</title', 1), '[\x00-\x20]+', ' ', 'g')),
           'outlinks: ' || len(regexp_extract_all(payload, '(?i)<a\s[^>]*href=')),
           'payload-digest: sha256:' || sha256(payload), 'payload-length: ' || octet_length(encode(payload)),
           'text-digest: sha256:' || sha256(body), 'text-length: ' || octet_length(encode(body)), '') AS content
  FROM response
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', body FROM response)
SELECT {_uuid_sql("warc_type", "refers_to", "refers_to_digest")} AS record_id, warc_type, refers_to, refers_to_digest,
       target_uri, '{NO_DATE}' AS warc_date, source_headers, content_type, content,
       octet_length(encode(content))::BIGINT AS content_length, 'sha256:' || sha256(content) AS content_digest, page_id
FROM made
"""

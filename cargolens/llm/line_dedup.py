"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

A line's key is the line without ASCII white space at its ends and with A-Z lowered. Keys that occur in at least
``min_docs`` documents lose all their lines, in every document.

The index is a small log-structured store in the shared folder. Documents come in batches. A batch counts the
documents of each key, drops by anti-join the keys that the index has settled already (they have reached
``min_docs``), and appends the rest as a run sorted by key. When a level holds ``fanout`` runs they are merged into
one run of the next level; keys that reach ``min_docs`` by that leave the runs and are settled. A key's counts in
several batches add up because a document lies in one batch.

Only DataFrame functions are used. A key that a third of all documents hold is counted map-side; the join that
finds its lines has unique keys on the other side, so Spark splits the hot partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import ASCII_SPACE, ascii_lower, packed, unpacked
from cargolens.storage import remove_path, scratch_path


class LineRuns:
    """Levels of runs ``(key, docs)``, each sorted by key, and the settled keys."""

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = 10, fanout: int = 2):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.settled_parts: list[str] = []
        self.written = 0

    def _write(self, rows: DataFrame, kind: str) -> str:
        self.written += 1
        path = f"{self.folder}/{kind}-{self.written:06d}"
        rows.write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("key string, docs long").parquet(*paths)

    def add(self, counts: DataFrame) -> None:
        """Merge-anti-join a batch's ``(key, docs)`` with the settled keys and add the rest as a run."""
        if self.settled_parts:
            counts = counts.join(self._read(self.settled_parts), "key", "left_anti")
        self.levels[0].append(self._write(counts.select("key", "docs").sortWithinPartitions("key"), "run"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        merged = self._write(self._merged(self.levels[level]).sortWithinPartitions("key"), "merge")
        old, self.levels[level] = self.levels[level], []
        if level + 1 == len(self.levels):
            self.levels.append([])
        rows = self._read([merged])
        self.settled_parts.append(self._write(rows.where(F.col("docs") >= self.min_docs), "settled"))
        self.levels[level + 1].append(self._write(rows.where(F.col("docs") < self.min_docs), "run"))
        for path in [*old, merged]:
            remove_path(self.spark, path)

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy("key").agg(F.sum("docs").alias("docs"))

    def settled(self) -> DataFrame:
        """All keys of at least ``min_docs`` documents, each once: settled ones and those that all runs add up to."""
        runs = [path for level in self.levels for path in level]
        found = self._merged(runs).where(F.col("docs") >= self.min_docs).select("key")
        if self.settled_parts:
            found = found.union(self._read(self.settled_parts).select("key"))
        return found.distinct()


def line_keys(line: Column) -> Column:
    """md5 of a lowered line's key; null where the key is empty."""
    key = F.btrim(line, F.lit(ASCII_SPACE))
    return F.when(key != "", F.md5(key))


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    batches: int = 3,
    fanout: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The input rows with their text without repeated lines, and ``n_lines`` (before), ``n_dropped``.

    A document is an id with a text: identical repeated rows count once, other texts of the same id count on their
    own. Null or empty texts have one empty line; an empty key (white space only) is never dropped. A text whose
    lines all go becomes empty. Null ids are an id of their own. Other columns stay as they are, whatever their
    names; input columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.
    The line hashes and the index are written to the shared folder when the function is called.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "line-runs")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = packed(docs, id=F.col(f"`{id_col}`"), text=text, sign=F.xxhash64(text))

    keys = F.transform(F.split(ascii_lower(F.col("text")), "\n"), line_keys)
    batch = F.pmod(F.xxhash64("id", "sign"), F.lit(batches)).cast("int")
    lines = rows.select("id", "sign", keys.alias("keys"), batch.alias("batch"))
    lines.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{folder}/lines")

    runs = LineRuns(spark, folder, min_docs, fanout)
    for number in range(batches):
        own = lines.where(F.col("batch") == number).dropDuplicates(["id", "sign"])
        each = own.select(F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
        runs.add(each.groupBy("key").agg(F.count("*").alias("docs")))

    places = lines.select("id", "sign", F.posexplode("keys").alias("place", "key")).where("key is not null")
    gone = places.join(runs.settled(), "key").groupBy("id", "sign").agg(F.collect_set("place").alias("gone"))

    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.sign") == F.col("b.sign"))
    both = rows.alias("a").join(gone.alias("b"), same, "left").select("row", "text", "gone")
    line_list = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(line_list) - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    both = both.withColumn("lines", line_list)
    return unpacked(
        both,
        docs.columns,
        **{
            text_col: F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept),
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        },
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of every document without the lines found in ten or more documents."""
    done = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, place, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
        FROM documents)),
frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (WHERE key IN (SELECT key FROM frequent)))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE key NOT IN (SELECT key FROM frequent)), '')) AS kept_sha256
FROM lines GROUP BY doc_id
"""

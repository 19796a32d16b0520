"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

The index lies in the shared folder as one table with a row for each shard and term. A shard is a stretch of a task's
input, bounded in documents and tokens. A term's postings are cut into blocks of ``BLOCK`` documents; a block holds
document gaps and frequencies in as few bytes as its largest ones need, and its last document and greatest impact stand
outside, so they are known without unpacking it.

A search sends each block of queries to the shards that hold its terms. There a query's lists are read in the order of
their bounds (weight times the list's greatest impact). As soon as the bounds of the rest can't reach the k-th best
partial score, the lists read are the essential ones: no document outside them can enter. For what they found, the
block maxima of the other lists are added up; documents that stay below the k-th best are rejected, and only blocks of
documents still in question are unpacked. The shards' heaps are merged at the end.

Scores are 64-bit integers: a term's weight is floor(1000 ln((2N+2)/(2df+1))), its impact in a document
(10^9 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cargolens.llm.columns import ascii_lower, bounded_batches
from cargolens.operators.running import numbered
from cargolens.storage import scratch_path, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Postings in a block; documents and tokens in a shard (a longer document is a shard of its own); queries in a block.
BLOCK, SHARD_DOCS, SHARD_TOKENS, QUERIES = 128, 16_384, 4_000_000, 512

#: Rows of query terms up to which they are broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_TERMS = 100_000

#: The term of the row that holds a shard's document ids and lengths.
LENGTHS = ""

INDEX_SCHEMA = "shard long, term string, df int, top int, heads binary, body binary"

#: Bytes of terms: letters A-Z lowered, digits, and all bytes of other characters; whatever else parts them.
_KEPT = [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)]
LOWERED = bytes(_KEPT)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term that occurs ``tf`` times adds to a document with length factor ``m``, before its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def length_factors(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    return 25 + 75 * n * documents // max(length, 1)


class Numbers(dict):
    """Numbers terms in the order of their first occurrence."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


class Shard:
    """Documents gathered by a task until the shard is full, then turned into index rows."""

    def __init__(self, documents: int, length: int):
        self.documents, self.length = documents, length
        self.clear()

    def clear(self) -> None:
        self.numbers, self.terms, self.lengths, self.ids, self.tokens = Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        terms = text.translate(LOWERED).split()
        self.terms.append(np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms)))
        self.lengths.append(len(terms))
        self.ids.append(doc_id)
        self.tokens += len(terms)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.tokens >= SHARD_TOKENS

    def rows(self, shard: int) -> pa.RecordBatch:
        lengths = np.array(self.lengths, np.int64)
        places = np.concatenate(self.terms) << 32 | np.repeat(np.arange(len(lengths)), lengths)
        places, tf = np.unique(places, return_counts=True)
        term, doc = places >> 32, places & 0xFFFFFFFF
        # list and block of each posting
        first = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(first, append=len(term))
        inside = np.arange(len(term)) - np.repeat(first, df)
        head = np.flatnonzero(inside % BLOCK == 0)
        size = np.diff(head, append=len(term))
        gap = np.diff(doc, prepend=0)
        gap[first] = doc[first]
        impact = impacts(tf, length_factors(lengths, self.documents, self.length)[doc])
        body, offset = pack_blocks(gap, tf, head, size)
        blocks = -(-df // BLOCK)
        block_of = np.cumsum(blocks) - blocks  # first block of each list
        maxima = np.maximum.reduceat(impact, head) if len(head) else impact[:0]
        base = np.repeat(offset[block_of], blocks) if len(head) else offset[:0]
        heads = np.column_stack([doc[head + size - 1], maxima, offset[:-1] - base]).astype("<i4")
        top = np.maximum.reduceat(maxima, block_of) if len(head) else maxima
        ends = np.append(offset[block_of], offset[-1])
        names = [*self.numbers, LENGTHS.encode()]
        own = self.lengths_row(lengths)
        count = len(names)

        def binary(ends: np.ndarray, data: bytes, kind: pa.DataType) -> pa.Array:
            return pa.Array.from_buffers(kind, count, [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(data)])

        columns = [
            pa.array(np.full(count, shard)),
            pa.array(names, pa.binary()).cast(pa.string()),
            pa.array(np.append(df, len(lengths)), pa.int32()),
            pa.array(np.append(top, 0), pa.int32()),
            binary(np.concatenate([block_of * 12, [len(head) * 12] * 2]), heads.tobytes(), pa.binary()),
            binary(np.append(ends, offset[-1] + len(own)), body.tobytes() + own, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "term", "df", "top", "heads", "body"])

    def lengths_row(self, lengths: np.ndarray) -> bytes:
        missing = np.array([i is None for i in self.ids], "u1")
        ids = np.array([i or 0 for i in self.ids], "<i8")
        return lengths.astype("<i8").tobytes() + ids.tobytes() + missing.tobytes()


def pack_blocks(gap: np.ndarray, tf: np.ndarray, head: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all blocks and where each begins (and the last ends).

    A block is one byte that tells the widths, then its gaps (1 or 4 bytes each), then its frequencies (1 or 4 bytes).
    """
    if not len(head):
        return np.zeros(0, "u1"), np.zeros(1, np.int64)
    wide_gap = np.maximum.reduceat(gap, head) > 255
    wide_tf = np.maximum.reduceat(tf, head) > 255
    gap_bytes, tf_bytes = np.where(wide_gap, 4, 1), np.where(wide_tf, 4, 1)
    offset = np.concatenate([[0], np.cumsum(1 + size * (gap_bytes + tf_bytes))])
    body = np.zeros(offset[-1], "u1")
    body[offset[:-1]] = wide_gap + 2 * wide_tf
    inside = np.arange(len(gap)) - np.repeat(head, size)

    def put(values: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        at, each = np.repeat(start, size) + inside * np.repeat(width, size), np.repeat(width, size)
        for byte in range(4):
            some = slice(None) if byte == 0 else each == 4
            body[at[some] + byte] = values[some] >> 8 * byte & 255

    put(gap, offset[:-1] + 1, gap_bytes)
    put(tf, offset[:-1] + 1 + size * gap_bytes, tf_bytes)
    return body, offset


class Postings:
    """One term's list in one shard; blocks are unpacked when they are asked for and kept for the group's other queries."""

    def __init__(self, df: int, top: int, heads: bytes, body: bytes, factors: np.ndarray):
        self.df, self.top, self.body, self.factors = df, top, body, factors
        self.last, self.most, self.at = np.frombuffer(heads, "<i4").reshape(-1, 3).astype(np.int64).T
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if b not in self.blocks:
            n, at = min(BLOCK, self.df - b * BLOCK), int(self.at[b])
            widths = self.body[at]
            gap_type, tf_type = "<u4" if widths & 1 else "u1", "<u4" if widths & 2 else "u1"
            gap = np.frombuffer(self.body, gap_type, n, at + 1).astype(np.int64)
            tf = np.frombuffer(self.body, tf_type, n, at + 1 + n * (4 if widths & 1 else 1)).astype(np.int64)
            doc = np.cumsum(gap) + (self.last[b - 1] if b else 0)
            self.blocks[b] = doc, impacts(tf, self.factors[doc])
        return self.blocks[b]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            doc, impact = zip(*[self.block(b) for b in range(len(self.last))])
            self.whole = np.concatenate(doc), np.concatenate(impact)
            self.blocks = {}  # the whole list replaces its blocks
        return self.whole

    def of(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Impacts in the given documents (ascending), which may lie in the given blocks only; 0 where the term is not."""
        out = np.zeros(len(docs), np.int64)
        if self.whole is not None:
            parts = [(slice(None), *self.whole)]
        else:
            inside = block < len(self.last)
            parts = [(np.flatnonzero(inside & (block == b)), *self.block(int(b))) for b in np.unique(block[inside])]
        for rows, own, impact in parts:
            asked = docs[rows]
            place = np.minimum(np.searchsorted(own, asked), len(own) - 1)
            out[rows] = np.where(own[place] == asked, impact[place], 0)
        return out


def kth_best(scores: np.ndarray, k: int) -> int:
    """The k-th largest score; 0 if there are fewer above 0."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of_shard(lists: list[tuple[int, Postings]], documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that may be among the k best, with their scores, for ``(weight, postings)`` of a query."""
    lists = sorted(lists, key=lambda x: -x[0] * x[1].top)
    bounds = np.array([w * p.top for w, p in lists], np.int64)
    below = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # of this list and all after it
    score, threshold, read = np.zeros(documents, np.int64), 0, 0
    while read < len(lists) and below[read] >= max(threshold, 1):
        weight, postings = lists[read]
        docs, impact = postings.all()
        score[docs] += weight * impact
        read += 1
        threshold = kth_best(score, k)
    rest = lists[read:]
    found = np.flatnonzero(score > 0)
    found = found[score[found] + below[read] >= threshold]
    own = score[found]
    # block maxima of the lists that are not essential, of the documents still in question
    block = [np.searchsorted(p.last, found) for _, p in rest]
    most = [w * np.append(p.most, 0)[b] for (w, p), b in zip(rest, block)]
    still = np.sum(most, axis=0) if rest else np.zeros(len(found), np.int64)
    for i, (weight, postings) in enumerate(rest):
        keep = own + still >= threshold
        if not keep.all():
            found, own, still = found[keep], own[keep], still[keep]
            block, most = [b[keep] for b in block], [m[keep] for m in most]
        still = still - most[i]
        own = own + weight * postings.of(found, block[i])
        threshold = max(threshold, kth_best(own, k))
    keep = (own >= threshold) & (own > 0)
    return found[keep], own[keep]


def search_group(table: pa.Table, k: int, documents: int, length: int) -> pa.Table:
    """The k best documents of one shard for each query of one block."""
    terms = table.column("term").to_pylist()
    bodies = table.column("body")
    lengths = bodies[terms.index(LENGTHS)].as_py()
    n = len(lengths) // 17
    sizes = np.frombuffer(lengths, "<i8", n)
    ids, missing = np.frombuffer(lengths, "<i8", n, 8 * n), np.frombuffer(lengths, "u1", n, 16 * n).astype(bool)
    factors = length_factors(sizes, documents, length)
    queries: dict[int, list[tuple[int, Postings]]] = {}
    columns = [table.column(c).to_pylist() for c in ("df", "top", "weight", "queries")]
    for i, (term, df, top, weight, asking) in enumerate(zip(terms, *columns)):
        if term == LENGTHS or not weight:
            continue
        postings = Postings(df, top, table.column("heads")[i].as_py(), bodies[i].as_py(), factors)
        for query in asking:
            queries.setdefault(query["number"], []).append((weight * query["times"], postings))
    numbers, docs, scores = [], [], []
    for number, lists in queries.items():
        found, own = best_of_shard(lists, n, k)
        order = np.lexsort((ids[found], missing[found], -own))[:k]
        numbers += [number] * len(order)
        docs += [None if missing[d] else int(ids[d]) for d in found[order]]
        scores += own[order].tolist()
    arrays = [pa.array(x, pa.int64()) for x in (numbers, docs, scores)]
    return pa.Table.from_arrays(arrays, ["number", "doc_id", "score"])


@dataclass
class Index:
    """An index in the shared folder, with the corpus counts that scores need."""

    path: str
    documents: int
    length: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(INDEX_SCHEMA).parquet(self.path)


def terms_of(text: Column) -> Column:
    """All terms of a text, in order, with repeats; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index all rows of ``docs`` in the shared folder. Two scans: one counts, one builds the shards."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.cast("binary").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.array([len((t.as_py() or b"").translate(LOWERED).split()) for t in batch.column(0)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["documents", "length"])

    counts = rows.select("text").mapInArrow(counted, "documents long, length long")
    documents, length = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in counts.columns]).first()

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(documents, length), TaskContext.get().partitionId() << 32

        def done() -> Iterator[pa.RecordBatch]:
            rows = shard.rows(number)
            shard.clear()
            for start in range(0, rows.num_rows, 10_000):
                yield rows.slice(start, 10_000)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard.add(doc_id, text.as_py() or b"")
                if shard.full():
                    yield from done()
                    number += 1
        if shard.ids:
            yield from done()

    path = scratch_path(spark, "index")
    rows.mapInArrow(sharded, INDEX_SCHEMA).write.option("compression", "zstd").parquet(path)
    return Index(path, documents, length)


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k highest-scoring documents with a score above 0 of each item.

    Equal scores are ranked by ascending id, null ids last; documents with equal ids are ranked each. Items that repeat
    in id and text count once; an id with several texts is an item for each. An item whose text is null, empty or has no
    known term has no rows, nor has any item if the index is empty. Other columns are not read.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    chosen = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).distinct()
    order = [F.col("item_id").asc_nulls_last(), F.col("text").asc_nulls_last()]
    chosen = stored(numbered(chosen, order, "number"), "search-items")
    asked = chosen.select("number", F.explode(terms_of(F.col("text"))).alias("term"))
    asked = asked.groupBy("number", "term").agg(F.count("*").alias("times"))
    block = F.floor((F.col("number") - 1) / QUERIES).alias("block")
    asked = asked.groupBy(block, "term").agg(F.collect_list(F.struct("number", "times")).alias("queries"))
    asked = stored(asked, "search-terms")
    few = asked.count() <= BROADCAST_TERMS

    def beside(rows: DataFrame, terms: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(terms) if few else terms, "term")

    rows = index.rows(spark)
    df = beside(rows.select("term", "df"), asked.select("term").distinct()).groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(float(2 * index.documents + 2)) / (2 * F.col("df") + 1).cast("double")
    weights = df.select("term", F.floor(1000 * F.log(ratio)).alias("weight"))
    weighted = asked.join(weights, "term").select("block", "term", "weight", "queries")
    none = F.array().cast("array<struct<number:bigint,times:bigint>>")
    lengths = asked.select("block").distinct().select("block", F.lit(LENGTHS).alias("term"), F.lit(0).cast("long"), none)
    wanted = stored(weighted.union(lengths), "search-weights")
    met = beside(rows, wanted).select("block", "shard", "term", "df", "top", "heads", "body", "weight", "queries")
    documents, length = index.documents, index.length

    def searched(group: pa.Table) -> pa.Table:
        return search_group(group, k, documents, length)

    found = met.groupBy("block", "shard").applyInArrow(searched, "number long, doc_id long, score long")
    best = W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(chosen.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each item of ``benchmark``."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM lengths),
factors AS (SELECT doc_id, 25 + ((75 * n * docs)::BIGINT // words) AS m FROM lengths, corpus),
postings AS (SELECT term, doc_id, count(*)::BIGINT AS tf FROM doc_terms GROUP BY term, doc_id),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, corpus GROUP BY term, docs),
item_terms AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM item_terms GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf)::BIGINT // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN factors USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

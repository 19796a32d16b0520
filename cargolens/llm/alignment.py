"""Alignment of two tokenizers' tokens of the same texts, by divide and conquer at shared cuts.

Tokenizer A is byte-level BPE of space and text, B a sentencepiece model that puts the space there itself. Each token
covers a range of bytes. A byte offset where a token of A and one of B both end is a cut. Alignment divides: in an
interval between two cuts it takes the token end in the middle of A's tokens and bisects B's ends for it; if it is none
of them, the search goes on from there to the next end of B, which is bisected in A's, and so on, to the right and then
to the left. The common end found first divides the interval into two that are treated alike; an interval without one is a
leaf, a group of tokens that stand for the same bytes. All intervals of a block of documents take a step together.

Two tokens are linked if their bytes overlap. How often an id pair is linked in the whole corpus is counted in Spark:
tasks add up the pairs of a block of documents, so a pair that is everywhere has one row for each block. The counts come
back to each block by a join, and there they are summed for its documents.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from cargolens.llm.columns import bounded_batches
from cargolens.llm.trie_bpe import byte_letters
from cargolens.storage import stored

#: Characters of text aligned together; a longer text is a block of its own.
BLOCK_CHARS = 3_000_000

BLOCK_SCHEMA = (
    "block long, pairs array<long>, times array<int>, entries binary, docs array<struct<doc_id:bigint,n_a:bigint,"
    "n_b:bigint,n_groups:bigint,n_links:bigint,n_pairs:int,groups_sha256:string>>"
)


class Pair:
    """Both tokenizers, the bytes of their tokens, and the decimal ids with what separates them in a group's text.

    A is encoded by tiktoken from the same vocabulary as ranks, whose ids are those of the tokenizers file.
    """

    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(vocabulary, encoding="utf-8") as file:
            names = json.load(file)["model"]["vocab"]
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.bytes_a[number] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        texts = [f"{i}{s}" for n, last in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for s in ("," + last)]
        self.written = np.array(texts, "S")

    def ids(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of A and B; none if the text is null or empty or the tokens' bytes are not those of space and text."""
        if text:
            a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
            whole = (" " + text).encode()
            if all(b"".join(map(of.__getitem__, ids)) == whole for of, ids in ((self.bytes_a, a), (self.bytes_b, b))):
                return a, b
        return [], []


def _common_right(end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest common end at or after A's token ``a``; there always is one, the interval's own."""
    a, b = a.copy(), np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    while len(open_):
        own = end_a[a[open_]]
        b[open_] = at = np.searchsorted(end_b, own)
        open_, theirs = open_[end_b[at] != own], end_b[at[end_b[at] != own]]
        a[open_] = at = np.searchsorted(end_a, theirs)
        open_ = open_[end_a[at] != theirs]
    return a, b


def _common_left(
    end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray, lo_a: np.ndarray, lo_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest common end before A's token ``a`` inside the interval; -1 where there is none."""
    a, b = a.copy(), np.full(len(a), -1)
    open_ = np.arange(len(a))
    while len(open_):
        own = end_a[a[open_]]
        at = np.searchsorted(end_b, own, "right") - 1
        outside = at < lo_b[open_]
        b[open_] = np.where(outside, -1, at)
        left = ~outside & (end_b[at] != own)
        open_, theirs = open_[left], end_b[at[left]]
        at = np.searchsorted(end_a, theirs, "right") - 1
        outside = at < lo_a[open_]
        b[open_[outside]] = -1
        a[open_] = at
        open_ = open_[~outside & (end_a[at] != theirs)]
    return a, b


def shared_cuts(end_a: np.ndarray, end_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B at whose end both end, ascending, for documents side by side.

    ``end_a``, ``end_b`` are ascending byte offsets; ``last_a``, ``last_b`` the last tokens of each document, which are
    cuts and the first intervals' bounds.
    """
    is_cut_a, is_cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    is_cut_a[last_a] = is_cut_b[last_b] = True
    lo_a, lo_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
    hi_a, hi_b = last_a, last_b  # the interval's last tokens
    while True:
        more = np.flatnonzero((hi_a > lo_a) & (hi_b > lo_b))
        if not len(more):
            break
        lo_a, lo_b, hi_a, hi_b = lo_a[more], lo_b[more], hi_a[more], hi_b[more]
        middle = (lo_a + hi_a - 1) // 2
        a, b = _common_right(end_a, end_b, middle)
        none = np.flatnonzero(a == hi_a)
        if len(none):
            a[none], b[none] = _common_left(end_a, end_b, middle[none], lo_a[none], lo_b[none])
            hi_a[none] = a[none]  # nothing to divide on the right
            if (b[none] < 0).any():
                cut = np.flatnonzero(b >= 0)
                a, b, lo_a, lo_b, hi_a, hi_b = a[cut], b[cut], lo_a[cut], lo_b[cut], hi_a[cut], hi_b[cut]
        is_cut_a[a] = is_cut_b[b] = True
        # halves side by side keep the intervals in order, so that bisecting walks through the ends
        lo_a, lo_b = np.column_stack([lo_a, a + 1]).ravel(), np.column_stack([lo_b, b + 1]).ravel()
        hi_a, hi_b = np.column_stack([a, hi_a]).ravel(), np.column_stack([b, hi_b]).ravel()
    return np.flatnonzero(is_cut_a), np.flatnonzero(is_cut_b)


@dataclass
class Aligned:
    """A block of documents: its tokens side by side, and how many each document has."""

    a: np.ndarray
    b: np.ndarray
    count_a: np.ndarray
    count_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def align_texts(texts: list[str | None], pair: Pair) -> Aligned:
    ids = [pair.ids(t) for t in texts]
    count_a, count_b = (np.array([len(x[i]) for x in ids], np.int64) for i in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(x[i] for x in ids), np.int64, n.sum()) for i, n in ((0, count_a), (1, count_b)))
    end_a, end_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    full = count_a > 0
    cut_a, cut_b = shared_cuts(end_a, end_b, np.cumsum(count_a)[full] - 1, np.cumsum(count_b)[full] - 1)
    return Aligned(a, b, count_a, count_b, end_a, end_b, cut_a, cut_b)


def linked(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """Links of all documents in order, as positions of A's and B's tokens: one for each range between two ends."""
    is_end = np.zeros((2, x.end_a[-1] + 1 if len(x.end_a) else 0), bool)
    is_end[0, x.end_a] = is_end[1, x.end_b] = True
    ends = np.flatnonzero(is_end.any(axis=0))
    at_a, at_b = (np.cumsum(own)[ends] - own[ends] for own in is_end)  # tokens that end before
    return at_a, at_b


def written_groups(x: Aligned, pair: Pair) -> list[bytes]:
    """Each document's groups as text: ids of A, a bar, ids of B; groups parted by semicolons."""
    last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
    last_a[x.cut_a] = last_b[x.cut_b] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.zeros(len(x.a) + len(x.b), np.int64)
    order[np.arange(len(x.a)) + np.append(0, x.cut_b + 1)[group_a]] = 2 * x.a + last_a
    order[np.arange(len(x.b)) + (x.cut_a + 1)[group_b]] = 2 * (x.b + len(pair.bytes_a)) + last_b
    ends = np.cumsum(x.count_a + x.count_b)
    starts = ends - x.count_a - x.count_b
    return [pair.written[order[s:e]].tobytes().translate(None, b"\0")[:-1] for s, e in zip(starts, ends)]


_LOADED: dict[tuple, Pair] = {}


def loaded(paths: tuple) -> Pair:
    if paths not in _LOADED:
        _LOADED[paths] = Pair(*paths)
    return _LOADED[paths]


def _paths(vocabulary: str | None, ranks: str | None, pieces: str | None) -> tuple:
    path = public_tokenizers.path
    return vocabulary or path("byte_bpe_50k.json"), ranks or path("byte_bpe_50k.tiktoken"), pieces or path("piece_bpe_32k.model")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of a task's documents in blocks of bounded size."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= BLOCK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers with all their lowest bytes first: small numbers compress well."""
    return values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "u1").reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def block_row(block: int, doc_ids: list, texts: list, pair: Pair) -> pa.RecordBatch:
    """One row for a block: its id pairs with their numbers of links, and which of them each document has, how often."""
    x = align_texts(texts, pair)
    at_a, at_b = linked(x)
    full = x.count_a > 0
    of_doc = np.repeat(np.arange(len(texts)), x.count_a)[at_a]
    place, codes = pd.factorize(x.a[at_a] << 32 | x.b[at_b])
    times = np.bincount(place, minlength=len(codes))
    entries, repeats = np.unique(of_doc << 32 | place, return_counts=True)
    doc = entries >> 32
    gaps = np.diff(entries & 0xFFFFFFFF, prepend=0)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    gaps[first] = (entries & 0xFFFFFFFF)[first]
    n_links = np.bincount(of_doc, minlength=len(texts))
    n_pairs = np.bincount(doc, minlength=len(texts))
    n_groups = np.bincount(np.repeat(np.arange(len(texts)), x.count_a)[x.cut_a], minlength=len(texts))
    shas = [hashlib.sha256(g).hexdigest() if f else "" for g, f in zip(written_groups(x, pair), full)]
    kinds = ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())
    kinds = (*kinds, ("n_pairs", pa.int32()), ("groups_sha256", pa.string()))
    values = [doc_ids, x.count_a, x.count_b, n_groups, n_links, n_pairs, shas]
    docs = pa.StructArray.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(values, kinds)], [n for n, _ in kinds])

    def one(items: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)

    columns = [
        pa.array([block], pa.int64()),
        one(pa.array(codes, pa.int64())),
        one(pa.array(times, pa.int32())),
        pa.array([planes(gaps) + planes(repeats)], pa.binary()),
        one(docs),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "pairs", "times", "entries", "docs"])


def aligned_blocks(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    pieces: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All documents aligned, a row for each block of them, written to the shared folder."""
    bounded_batches(docs.sparkSession)
    paths = _paths(vocabulary, ranks, pieces)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task = loaded(paths), TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_blocks(batches)):
            yield block_row(task + number, ids, texts, pair)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return stored(rows.mapInArrow(aligned, BLOCK_SCHEMA), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, links, best)``: links of each id pair in the whole corpus, and whether no pair of its B id has more.

    ``pair`` holds A's id in the upper and B's in the lower 32 bits.
    """
    each = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links"))
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def _summed(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the corpus counts of their links."""
    docs = blocks.column("docs").combine_chunks().flatten()
    entries = blocks.column("entries")[0].as_py()
    gaps, repeats = from_planes(entries[: len(entries) // 2]), from_planes(entries[len(entries) // 2 :])
    links, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
    place = counts.column("place").to_numpy()
    links[place], best[place] = counts.column("links").to_numpy(), counts.column("best").to_numpy()
    n_pairs = docs.field("n_pairs").to_numpy()
    doc = np.repeat(np.arange(len(docs)), n_pairs)
    inside = np.cumsum(gaps)
    start = np.cumsum(n_pairs) - n_pairs
    before = np.append(0, inside)[start]  # gaps of earlier documents
    place = inside - before[doc]
    sums = [np.zeros(len(docs), np.int64) for _ in range(2)]
    for total, values in zip(sums, (best[place] * repeats, links[place] * repeats)):
        np.add.at(total, doc, values)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    columns = [docs.field(n) for n in names] + [pa.array(s) for s in sums] + [docs.field("groups_sha256")]
    return pa.Table.from_arrays(columns, [*names, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    ``n_best`` counts the links whose pair no other pair of its B id exceeds in the corpus (ties included);
    ``count_sum`` adds up the corpus counts of the links. A text that is null or empty, or whose tokens' bytes are not
    those of space and text, has no tokens: zeros and an empty digest. Repeated rows, ids and null ids are documents
    each. Other columns are not read. An empty table gives an empty table. A very long text is aligned whole, in one
    task. Blocks and counts are written to the shared folder when the function is called. Options are those of
    ``aligned_blocks``; the vocabulary files must be readable under one path on all executors.
    """
    blocks = aligned_blocks(docs, **options)
    places = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    met = places.join(pair_counts(blocks), "pair").select("of", "place", "links", "best")
    both = blocks.select("block", "entries", "docs").groupBy("block").cogroup(met.groupBy("of"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return both.applyInArrow(_summed, schema)


def aligned_groups(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    pieces: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, number, start, end, a_ids, b_ids)``: every group of every document with its byte range in space and text.

    Documents without tokens have no rows; else as ``align``.
    """
    bounded_batches(docs.sparkSession)
    paths = _paths(vocabulary, ranks, pieces)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(paths)
        for ids, texts in _blocks(batches):
            x = align_texts(texts, pair)
            doc = np.repeat(np.arange(len(texts)), x.count_a)[x.cut_a]
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            size = np.diff(first, append=len(doc))
            end = x.end_a[x.cut_a]
            start = np.append(0, end[:-1])[: len(end)]
            base = np.repeat(start[first], size)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.append(0, cut + 1), pa.int32()), pa.array(own, pa.int32()))
                for cut, own in ((x.cut_a, x.a), (x.cut_b, x.b))
            ]
            number = np.arange(len(doc)) - np.repeat(first, size)
            columns = [pa.array([ids[d] for d in doc], pa.int64()), pa.array(number), pa.array(start - base), pa.array(end - base), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "number", "start", "end", "a_ids", "b_ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(grouped, "doc_id long, number long, start long, end long, a_ids array<int>, b_ids array<int>")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens by two tokenizers."""
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))

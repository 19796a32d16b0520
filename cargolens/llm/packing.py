"""Packing documents into training sequences by lexical retrieval.

Tasks read their documents in shards of at most ``shard_docs`` documents and about ``shard_tokens`` tokens. A shard
has a BM25 inverted index over token ids. Whole windows of long documents become sequences of their own; what is left
of each document (less than a window) is a piece of the pool. The next unused piece is a seed: BM25 ranks the shard's
unused pieces for it, those that fit are added in that order, and the best one that does not fit is cut to fill the
window; its rest stays in the pool. A last window that is not full goes on into the next shard. At the end of a task
the rest is cut into sequences of powers of two, so nothing is padded.

Documents are not shuffled: a shard is a stretch of the task's input, so its size does not depend on any key.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers

from cargolens.llm.columns import bounded_batches

WINDOW = 2048
END = 1
K1, B = 1.2, 0.75


class ByteEncoder:
    """Byte-level BPE of whole texts: ``tiktoken`` with the same vocabulary as ranks, and the tokenizers library itself
    for texts that hold a special token."""

    def __init__(self, vocabulary: str, ranks: str):
        self.library = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.library.no_truncation()
        self.library.no_padding()
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(t in text for t in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.bpe.encode_ordinary(text), "<u4")


_ENCODERS: dict[tuple[str, str], ByteEncoder] = {}


def encoder(vocabulary: str, ranks: str) -> ByteEncoder:
    """This worker's encoder, kept between tasks."""
    if (vocabulary, ranks) not in _ENCODERS:
        _ENCODERS[vocabulary, ranks] = ByteEncoder(vocabulary, ranks)
    return _ENCODERS[vocabulary, ranks]


class Retrieval:
    """BM25 inverted index of a shard's pieces, over token ids."""

    def __init__(self, pieces: list[np.ndarray]):
        counted = [np.unique(p, return_counts=True) for p in pieces]
        sizes = np.array([len(t) for t, _ in counted])
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        terms = np.concatenate([t for t, _ in counted]).astype(np.int64)
        often = np.concatenate([n for _, n in counted])
        owner = np.repeat(np.arange(len(pieces)), sizes)
        order = np.argsort(terms, kind="stable")
        self.docs = owner[order]
        vocabulary, self.first, df = np.unique(terms[order], return_index=True, return_counts=True)
        self.df = df
        self.term = np.empty(len(terms), np.int64)  # of each piece's distinct tokens, the place in the vocabulary
        self.term[order] = np.repeat(np.arange(len(vocabulary)), df)
        length = np.array([len(p) for p in pieces], np.float64)
        norm = K1 * (1 - B + B * length / length.mean())
        idf = np.log1p((len(pieces) - df + 0.5) / (df + 0.5))
        n = often[order]
        self.weight = np.repeat(idf, df) * n * (K1 + 1) / (n + norm[self.docs])
        self.size = len(pieces)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every piece for the distinct tokens of the seed."""
        terms = self.term[self.bounds[seed] : self.bounds[seed + 1]]
        each = self.df[terms]
        at = np.repeat(self.first[terms] - np.cumsum(each) + each, each) + np.arange(each.sum())
        return np.bincount(self.docs[at], weights=self.weight[at], minlength=self.size)


class Packer:
    """Packs one task's documents; ``rows`` gathers ``(doc, start, ids, doc_tokens, sequence, offset)``."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.rows: list[tuple] = []
        self.pool: list[tuple] = []  # (doc, start, ids, doc_tokens), each shorter than a window

    def add(self, doc, ids: np.ndarray) -> None:
        """Full windows of a document at once, the rest into the pool."""
        total = len(ids)
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            self._close([(doc, start, ids[start : start + self.window], total)])
        if whole < total:
            self.pool.append((doc, whole, ids[whole:], total))

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, ids, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def pack(self) -> None:
        """Fill windows from the pool; the last one, if not full, is the new pool."""
        pool, self.pool = self.pool, []
        if not pool:
            return
        index = Retrieval([p[2] for p in pool])
        length = np.array([len(p[2]) for p in pool])
        unused = np.ones(len(pool), bool)
        for seed in range(len(pool)):
            if not unused[seed]:
                continue
            chosen, room = [pool[seed]], self.window - int(length[seed])
            unused[seed] = False
            if room and unused.any():
                near = np.flatnonzero(unused)
                near = near[np.argsort(-index.scores(seed)[near], kind="stable")]
                for i, size in zip(near.tolist(), length[near].tolist()):
                    if size <= room:
                        chosen.append(pool[i])
                        unused[i] = False
                        room -= size
                        if not room:
                            break
                left = near[unused[near]]
                if room and len(left):
                    i = int(left[0])
                    doc, start, ids, total = pool[i]
                    chosen.append((doc, start, ids[:room], total))
                    pool[i] = (doc, start + room, ids[room:], total)
                    length[i] -= room
                    room = 0
            if room:
                self.pool = chosen
            else:
                self._close(chosen)

    def finish(self) -> None:
        """Cut what is left into sequences whose lengths are powers of two."""
        self.pack()
        rest, left = list(self.pool), sum(len(p[2]) for p in self.pool)
        self.pool = []
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            chosen = []
            while room:
                doc, start, ids, total = rest.pop(0)
                chosen.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                room -= len(chosen[-1][2])
            self._close(chosen)

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        doc, start, ids, total, sequence, offset = zip(*rows) if rows else ([],) * 6
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()),
                pa.array(start, pa.int64()),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([i.tobytes() for i in ids], pa.binary()),
                pa.array(total, pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    window: int = WINDOW,
    shard_docs: int = 512,
    shard_tokens: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` of all documents.

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit integers; a document ends with id 1. A null or
    empty text has that id alone. Repeated rows and ids are packed each on their own, null ids too. Other columns are
    not read. Sequence numbers are unique but have gaps, and they depend on how the input is split into tasks. An
    empty table gives an empty table. ``window`` must be a power of two. The vocabulary files must be readable under
    the same path on all executors.
    """
    bounded_batches(docs.sparkSession)
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        held = tokens = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode.ids(text.as_py() or ""), np.uint32(END)).astype("<u4")
                packer.add(doc, ids)
                held, tokens = held + 1, tokens + len(ids)
                if held >= shard_docs or tokens >= shard_tokens:
                    packer.pack()
                    yield packer.taken()
                    held = tokens = 0
        packer.finish()
        yield packer.taken()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(packed, schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies, with the checksum of its ids."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns)

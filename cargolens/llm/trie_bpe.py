"""BPE encoding of whole texts by a prefix-sharing trie, and decoding.

A batch's distinct words are visited in sorted order, which is the depth-first order of their trie; a stack holds the
path to the current node. A node's state is the last token of its prefix's encoding: the one token that ends the
prefix and follows the state of the prefix before it without a merge between them. So a prefix's encoding is that of
a shorter prefix plus one token, and prefixes that words share are encoded once.

Two tokens can stand side by side if BPE of their joined symbols gives exactly these two; that is computed by plain
merging and remembered.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from cargolens.llm.columns import bounded_batches

#: Words and chunks, and pairs of tokens, a Python worker remembers between batches; characters encoded at a time.
REMEMBERED, PAIRS, BLOCK_CHARS = 200_000, 600_000, 2_000_000

# The vocabulary's white space and word patterns.
SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it has a visible Latin-1 form, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder for a ``tokenizers`` JSON file of BPE with a suffix at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.suffix: str = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.id_bytes = {t: np.uint32(i).astype("<u4").tobytes() for t, i in [*self.vocab.items(), *self.special.items()]}
        names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.longest = max(len(t.removesuffix(self.suffix)) for t in self.vocab)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.letters = {b: c for b, c in enumerate(letters) if c != chr(b)}
        self.alone: dict[str, bool] = {}
        self.beside: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = token.removesuffix(self.suffix)
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """Plain BPE: the pair of lowest rank first, the leftmost of equals."""
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:])]
            low = min(ranks)
            if low == len(self.rank):
                break
            at = ranks.index(low)
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
        return parts

    def whole(self, token: str) -> bool:
        """Whether a token's own symbols merge into it."""
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merged(self.symbols(token)) == [token]
        return known

    def fits(self, left: str, right: str) -> bool:
        """Whether two tokens stay apart when they stand side by side."""
        pair = self.vocab[left] << 32 | self.vocab[right]
        known = self.beside.get(pair)
        if known is None:
            if len(self.beside) >= PAIRS:
                self.beside.clear()
            joined = self.symbols(left) + self.symbols(right)
            known = self.beside[pair] = self.merged(joined) == [left, right]
        return known

    def encode_words(self, words: list[str]) -> None:
        """Depth-first over the trie of words (as byte letters): fills ``self.words`` with their ids.

        Exactly one token can end a prefix, so candidates may be tried in any order: first the last token grown by the
        new letter, then every token that ends the prefix, longest first.
        """
        vocab, id_bytes = self.vocab, self.id_bytes
        last, ids, path = [""], [b""], ""
        for word in sorted(words):
            size, common = len(word), 0
            for a, b in zip(word[:-1], path):
                if a != b:
                    break
                common += 1
            del last[common + 1 :], ids[common + 1 :]
            path = word[:-1]
            for depth in range(common + 1, size + 1):
                ending = self.suffix if depth == size else ""
                before = last[depth - 1]
                start = depth - 1 - len(before)
                token = before + word[depth - 1] + ending
                if token not in vocab or not (self.fits(last[start], token) if start else self.whole(token)):
                    start, token = self.last_token(word, depth, ending, last)
                if depth < size:
                    last.append(token)
                    ids.append(id_bytes[token])
            # a state is its last token only; where that begins stands the state before it
            parts = [id_bytes[token]]
            while start:
                parts.append(ids[start])
                start -= len(last[start])
            self.words[word] = b"".join(reversed(parts))

    def last_token(self, word: str, depth: int, ending: str, last: list[str]) -> tuple[int, str]:
        """Where the token that ends a prefix begins, and the token, from the last tokens of all shorter prefixes."""
        for start in range(max(0, depth - self.longest), depth):
            token = word[start:depth] + ending
            if token in self.vocab and (self.fits(last[start], token) if start else self.whole(token)):
                return start, token
        raise ValueError(f"no token ends {word[:depth]!r}")

    def normalized(self, text: str) -> list[str]:
        """Chunks between white space of a text in NFC and lower case (each character on its own, as sigma shows)."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()
        return SPACES.split(text) if SEPARATORS.search(text) else text.split()

    def letters_of(self, word: str) -> str:
        if word.isascii() and word.isprintable():  # every byte stands for itself
            return word
        return word.encode().decode("latin-1").translate(self.letters)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers."""
        if len(self.chunks) >= REMEMBERED:
            self.chunks.clear()
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        cut = [self.cut.split(t) if self.cut and "<" in t else [t] for t in texts]
        parts = [[[p] if p in self.special else self.normalized(p) for p in pieces] for pieces in cut]
        new = {c for pieces in parts for chunks in pieces for c in chunks if c not in self.chunks}
        split = {c: [self.letters_of(w) for w in WORDS.findall(c)] for c in new if c not in self.special}
        self.encode_words(list({w for words in split.values() for w in words if w not in self.words}))
        for chunk, words in split.items():
            self.chunks[chunk] = b"".join([self.words[w] for w in words])
        get, special = self.chunks.__getitem__, self.special
        out = []
        for pieces, whole in zip(parts, cut):
            if len(pieces) == 1 and whole[0] not in special:
                out.append(b"".join(map(get, pieces[0])))
            else:
                each = [self.id_bytes[p] if p in special else b"".join(map(get, chunks)) for p, chunks in zip(whole, pieces)]
                out.append(b"".join(each))
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens of ids joined by a space, as a tokenizer without decoder does."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """This worker's encoder of a vocabulary file, kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def decode(ids: Column, vocabulary: str | None = None) -> Column:
    """Text of stored token ids (special tokens kept); null for null."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    @F.pandas_udf("string")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = loaded(path)
        for batch in batches:
            yield pd.Series([None if i is None else bpe.decode(i) for i in batch], dtype=object)

    return of_batches(ids)


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row.

    ``ids`` are little-endian unsigned 32-bit integers, none for a null or empty text; ``decoded`` is made from them.
    Repeated rows, ids and null ids stay, other columns are not read. An empty table gives an empty table. The
    vocabulary file must be readable under one path on all executors.
    """
    bounded_batches(docs.sparkSession)
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)

        def block(documents: list, texts: list[str]) -> pa.RecordBatch:
            ids = bpe.encode(texts)
            columns = [
                pa.array(documents, pa.int64()),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array(map(bpe.decode, ids), pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

        for batch in batches:
            documents, texts, size = [], [], 0
            for document, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                documents.append(document)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BLOCK_CHARS:
                    yield block(documents, texts)
                    documents, texts, size = [], [], 0
            yield block(documents, texts)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(done, "doc_id long, n_tokens long, ids binary, decoded string")


def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    done = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    decoded = F.sha2(F.col("decoded").cast("binary"), 256)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"))

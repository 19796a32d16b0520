"""Language ID by prediction by partial matching (PPM).

Every language has a variable-order byte context tree. A byte's probability comes from the longest context seen in
training; a byte new there pays the escape probability (distinct followers over all followers plus distinct ones) and
is coded by the next shorter context, excluding the bytes the longer one has seen; below order 0 all symbols are
equal. The code length of a text, in bits, is exact, and the statistics are frozen after training, so a text's length
under a language is a sum over its positions. The shortest code wins.

All 256 byte values count, A-Z lowered and digits as one: a language whose letters are rare in the whole corpus keeps
them. Contexts are the preceding ``order`` bytes; a mark that is no byte stands before the text. Only what occurs in
training is kept, in hash tables that up to ``TOGETHER`` languages share (``Forest``), so the model's size follows the
distinct contexts, not the corpus or the alphabet. Training counts come from all learning rows: tasks count their own rows with numpy, Spark adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import bounded_batches, bucket, packed, unpacked

#: Preceding bytes of a context; the byte values and the mark before the text.
ORDER, SYMBOLS = 3, 257
#: Distinct n-grams a task holds, and bytes of a language that wait to be counted, before it hands them on.
HELD = 1 << 20
#: Languages whose code lengths stand side by side under one key.
TOGETHER = 8
#: Bytes that are counted or scored at a time.
BLOCK = 1 << 18
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def folded(text: str) -> np.ndarray:
    """A text's UTF-8 bytes with A-Z lowered and digits as 0."""
    return np.frombuffer(text.encode().lower().translate(_DIGITS), np.uint8)


_DIGITS = bytes.maketrans(b"123456789", b"0" * 9)


def symbol_table(counts: dict[int, int], symbols: int) -> np.ndarray:
    """Byte to symbol: the ``symbols - 1`` most frequent bytes in order (ties: smaller byte), 0 for all others."""
    table = np.zeros(256, np.int32)
    for rank, byte in enumerate(sorted(counts, key=lambda b: (-counts[b], b))[: symbols - 1]):
        table[byte] = rank + 1
    return table


def contexts(codes: np.ndarray, order: int, symbols: int) -> np.ndarray:
    """At each position the number of its ``order`` preceding symbols and its own; symbol 0 stands before the text."""
    padded = np.concatenate([np.zeros(order, codes.dtype), codes])
    out = np.zeros(len(codes), np.int64 if symbols ** (order + 1) >= 1 << 31 else np.int32)
    for k in range(order + 1):
        out = out * symbols + padded[k : k + len(codes)]
    return out


def code_lengths(counts: np.ndarray, order: int, symbols: int) -> np.ndarray:
    """Bits of each symbol after each context of ``order`` symbols, from n-gram counts of that order."""
    bits = np.full((1, symbols), 1.0 / symbols)
    for k in range(order + 1):
        own = counts.reshape(-1, symbols**k, symbols).sum(axis=0).astype(np.float64)
        shorter = np.tile(bits, (symbols if k else 1, 1)) if k else bits
        total, seen = own.sum(axis=1, keepdims=True), own > 0
        kinds = seen.sum(axis=1, keepdims=True)
        rest = np.where(seen, 0.0, shorter)
        left = rest.sum(axis=1, keepdims=True)
        # all symbols seen: nothing is left to escape to
        escape = np.where(kinds == symbols, 0.0, kinds / np.maximum(total + kinds, 1))
        found = own / np.maximum(total, 1) * (1 - escape)
        bits = np.where(total > 0, found + escape * rest / np.where(left > 0, left, 1), shorter)
    return -np.log2(bits).astype(np.float32)


class Lookup:
    """Open-addressing hash table from non-negative int64 keys, each given once, to numbers."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (3 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, values.dtype)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) % len(self.keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its value (0 without)."""
        slot = self._slot(keys)
        there = self.keys[slot]
        found = there == keys
        values = np.where(found, self.values[slot], 0)
        left = np.flatnonzero(~found & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) % len(self.keys)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            found[left[hit]] = True
            values[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return found, values


class Tree:
    """A language's code lengths: of each n-gram seen in training, and what an unseen one adds to the next shorter one.

    Made from the distinct n-grams of ``order + 1`` symbols in ascending order, and their counts. Symbol 0 is the mark
    before the text, which is never coded itself.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, symbols: int):
        self.order, self.symbols = order, symbols
        keys, bits, places, more = [], [], [], []
        shorter = None  # of the next shorter n-grams: keys, probabilities, contexts, kinds of followers, escapes
        for k in range(order + 1):
            own, place = np.unique(grams % symbols ** (k + 1), return_inverse=True)
            n = np.bincount(place, counts, len(own))
            context, first = np.unique(own // symbols, return_index=True)
            total, kinds = np.add.reduceat(n, first), np.diff(first, append=len(own))
            # all bytes seen: nothing is left to escape to
            escape = np.where(kinds == symbols - 1, 0.0, kinds / (total + kinds))
            if shorter is None:
                left = 1 - kinds / (symbols - 1)
            else:
                known, share, contexts_below, kinds_below, escape_below = shorter
                seen = np.add.reduceat(share[np.searchsorted(known, own % symbols**k)], first)
                below = np.searchsorted(contexts_below, context % symbols ** max(k - 1, 0))
                # the same followers: exactly the shorter context's escape is left, without a difference of near numbers
                left = np.where(kinds == kinds_below[below], escape_below[below], 1 - seen)
            found = n / np.repeat(total, kinds) * (1 - np.repeat(escape, kinds))
            keys.append(self._key(own, k))
            bits.append(-np.log2(found))
            places.append(self._key(context, k - 1))
            more.append(np.where(escape > 0, -np.log2(np.where(escape > 0, escape, 1) / np.where(left > 0, left, 1)), 0.0))
            shorter = own, found, context, kinds, escape
        self.keys, self.places = np.concatenate(keys), np.concatenate(places)
        self.seen, self.escapes = Lookup(self.keys, np.concatenate(bits)), Lookup(self.places, np.concatenate(more))

    def _key(self, grams: np.ndarray, order: int) -> np.ndarray:
        """N-grams of all orders as different numbers, shorter ones first; the empty one is 0."""
        return grams + sum(self.symbols**j for j in range(order + 1))


class Forest:
    """Code lengths under several trees: a row for each n-gram that any of them has seen."""

    def __init__(self, trees: list[Tree]):
        one = trees[0]
        self.order, self.symbols, self._key = one.order, one.symbols, one._key
        keys, places = (np.unique(np.concatenate(x)) for x in ([t.keys for t in trees], [t.places for t in trees]))
        self.none = np.full(len(trees), np.log2(self.symbols - 1))
        self.more = np.stack([t.escapes.get(places)[1] for t in trees], axis=1).astype(np.float32)
        self.rows, self.places = Lookup(keys, np.arange(len(keys))), Lookup(places, np.arange(len(places)))
        self.bits = np.empty((len(keys), len(trees)), np.float32)
        for k in range(self.order + 1):  # a tree without the n-gram escapes to the next shorter one, whose row is done
            low, high = np.searchsorted(keys, [self._key(0, k), self._key(0, k + 1)])
            own = keys[low:high] - self._key(0, k)
            shorter = self.bits[self.rows.get(self._key(own % self.symbols**k, k - 1))[1]] if k else self.none
            escaped = self.more[self.places.get(self._key(own // self.symbols, k - 1))[1]] + shorter
            for i, tree in enumerate(trees):
                found, bits = tree.seen.get(keys[low:high])
                self.bits[low:high, i] = np.where(found, bits, escaped[:, i])

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last symbol of all n-grams together, under each tree."""
        total = np.zeros(len(self.none))
        for k in range(self.order, -1, -1):
            found, row = self.rows.get(self._key(grams, k))
            total += self.bits[row[found]].sum(axis=0, dtype=np.float64)
            grams = grams[~found]
            if not len(grams):
                return total
            there, row = self.places.get(self._key(grams // self.symbols, k - 1))
            total += self.more[row[there]].sum(axis=0, dtype=np.float64)
            grams = grams % self.symbols**k
        return total + len(grams) * self.none


def train(docs: DataFrame, order: int = ORDER) -> tuple[list[str], np.ndarray, list[Forest]]:
    """Languages in alphabetical order, the symbol of each byte, and the code lengths under their trees.

    ``docs`` has ``text`` and ``lang``; rows with a null are not learned from. What reaches the driver is one count for
    each distinct n-gram of ``order + 1`` bytes of each language.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("text", "lang").where("text is not null and lang is not null")
    table = np.arange(1, SYMBOLS, dtype=np.int64)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        waits = 0

        def count() -> None:
            for lang, parts in waiting.items():
                seen, n = np.unique(np.concatenate(parts), return_counts=True)
                before = held.get(lang, (seen[:0], n[:0]))
                every, place = np.unique(np.concatenate([before[0], seen]), return_inverse=True)
                held[lang] = every, np.bincount(place, np.concatenate([before[1], n]), len(every)).astype(np.int64)
            waiting.clear()

        def hand_on() -> Iterator[pa.RecordBatch]:
            for lang, (seen, n) in held.items():
                columns = [pa.array([lang]).take(pa.array(np.zeros(len(seen), int))), pa.array(seen), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                codes = table[folded(text.as_py())]
                for at in range(0, len(codes), BLOCK):
                    first = max(0, at - order)
                    part = contexts(codes[first : at + BLOCK], order, SYMBOLS)[at - first :]
                    waiting.setdefault(lang, []).append(part)
                    waits += len(part)
                    if waits >= 4 * BLOCK:
                        count()
                        waits = 0
                        if sum(len(seen) for seen, _ in held.values()) >= HELD:
                            yield from hand_on()
        count()
        yield from hand_on()

    counted = rows.mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = counted.toArrow()
    lang = counted.column("lang").combine_chunks().dictionary_encode()
    names, place = lang.dictionary.to_pylist(), lang.indices.to_numpy()
    gram, n = (counted.column(c).to_numpy() for c in ("gram", "n"))
    trees = {}
    for i, name in enumerate(names):
        own = np.flatnonzero(place == i)
        own = own[np.argsort(gram[own])]
        trees[name] = Tree(gram[own], n[own], order, SYMBOLS)
    names.sort()
    return names, table, [Forest([trees[x] for x in names[i : i + TOGETHER]]) for i in range(0, len(names), TOGETHER)]


def lengths(text: str, table: np.ndarray, bits: np.ndarray | list[Forest], order: int, symbols: int) -> np.ndarray:
    """Code length of a text under each language, in bits, from trees or a table ``[context and symbol, language]``."""
    codes = table[folded(text)]
    forests = isinstance(bits, list)
    total = np.zeros(sum(len(f.none) for f in bits) if forests else bits.shape[1])
    for at in range(0, len(codes), BLOCK):
        first = max(0, at - order)
        grams = contexts(codes[first : at + BLOCK], order, symbols)[at - first :]
        total += np.concatenate([f.lengths(grams) for f in bits]) if forests else bits[grams].sum(axis=0, dtype=np.float64)
    return total


def predicted(text: Column, spark: SparkSession, model, order: int = ORDER) -> Column:
    """``struct(lang, score)`` of a text column; ``und`` and 0 for null, letterless and unlearnable texts.

    The score is the winner's share when each language weighs 2 to the minus code length. Equal code lengths go to
    the language that comes first in the alphabet.
    """
    bounded_batches(spark)
    names, table, forests = model
    shared = spark.sparkContext.broadcast((table, forests))

    @F.pandas_udf("lang string, score double")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, forests = shared.value
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                lang, score = UNKNOWN, 0.0
                if names and text is not None and LETTER.search(text):
                    total = lengths(text, table, forests, order, SYMBOLS)
                    best = int(total.argmin())
                    lang, score = names[best], float(1 / np.exp2(np.clip(total[best] - total, -1000, 0)).sum())
                langs.append(lang)
                scores.append(score)
            yield pd.DataFrame({"lang": langs, "score": scores})

    return of_batches(text)


def identify(docs: DataFrame, learn_from: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from PPM trees of ``learn_from(text, lang)``.

    Training runs when the function is called. Input columns named ``lang_pred`` or ``score`` are replaced, all others
    stay as they are. Without any learnable row every prediction is ``und``. Repeated rows and ids are kept.
    """
    model = train(learn_from)
    rows = packed(docs, text=F.col(f"`{text_col}`"))
    rows = rows.withColumn("found", predicted(F.col("text"), docs.sparkSession, model))
    return unpacked(rows, docs.columns, lang_pred=F.col("found.lang"), score=F.col("found.score"))


def learnable(docs: DataFrame) -> DataFrame:
    """Rows to learn from: remainder 0 or 2 of the id's crc32 modulo 3 (a null id is in neither part)."""
    return docs.where(bucket(F.col("doc_id"), 3) != 1).select("text", "lang")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; ``held_out`` ones were not learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learnable(docs))
    held_out = F.coalesce(bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

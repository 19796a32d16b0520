"""LM scoring with a log-bilinear neural model trained by noise-contrastive estimation.

Counts of all training tokens are a Spark aggregate. The ``CLASSES`` most frequent tokens (the end token always among
them) have embeddings; all other tokens share one class, inside which a token has its add-one share of the class's
counts. So every token has a normalised probability, and the model's size does not grow with the corpus.

The two preceding classes predict the next: each context class has a vector, each position a matrix, each target a
vector and a bias. Tasks train their own copy on all their training tokens, in numpy, against noise drawn from the
class frequencies; the copies are averaged by their number of tokens. The context enters the scores linearly, so
normalisers of all contexts are a few batched matrix products, and a text's score is a sum of table entries.

Counts of frequent tokens reach the scoring tasks in a broadcast of at most ``FREQUENT`` rows. Rarer ones are joined:
none of those tokens is frequent, so that join has no hot key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cargolens.llm.columns import bounded_batches, bucket
from cargolens.operators.running import numbered
from cargolens.storage import stored

CLASSES, DIMS, FREQUENT = 512, 32, 65_536
#: Tokens of a training step, noise tokens it shares, and the step size.
STEP_TOKENS, NOISE, RATE = 4096, 32, 0.05
#: Distinct tokens a task counts before it hands them on; groups in which trained copies are added up.
HELD, GROUPS = 400_000, 32
#: The end token; words are never empty.
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Lowered (A-Z) words between ASCII white space, as UTF-8, and the end token."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def count_tokens(texts: DataFrame) -> DataFrame:
    """``(token, n)`` over all rows of ``texts(text)``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) >= HELD:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["token", "n"])

    return texts.mapInArrow(counted, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Places(dict):
    """Frequent token to its place; ``missing`` for all others."""

    missing = 0

    def __missing__(self, token):
        return self.missing


@dataclass
class Counts:
    """What the driver knows of the corpus: totals, and the frequent tokens with the end token first."""

    total: int
    distinct: int
    frequent: list[tuple[bytes, int]]

    def places(self) -> Places:
        found = Places((token, i) for i, (token, _) in enumerate(self.frequent))
        found.missing = len(self.frequent)
        return found


def corpus_counts(counts: DataFrame, frequent: int = FREQUENT) -> Counts:
    """Totals and the ``frequent`` most frequent tokens, ties by token; only rows that are kept come to the driver.

    The tokens of each count are counted first, which tells the count at which the list is full. Tokens above it are
    fewer than the list; those with just that count are numbered by a range sort.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end = [r.n for r in counts.where(F.octet_length("token") == 0).collect()]
    words = counts.where(F.octet_length("token") > 0)
    # different counts are at most the root of twice the tokens
    sizes = words.groupBy("n").agg(F.count("*").alias("words"))
    upto = F.sum("words").over(W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0))
    full = sizes.withColumn("upto", upto).where(F.col("upto") >= frequent - 1).agg(F.max("n")).first()[0] or 0
    top = [(bytes(r.token), r.n) for r in words.where(F.col("n") > full).collect()]
    ties = numbered(words.where(F.col("n") == full), [F.asc("token")], "place").where(F.col("place") < frequent - len(top))
    top += [(bytes(r.token), r.n) for r in ties.collect()]
    return Counts(total, distinct, [(END, end[0] if end else 0), *sorted(top, key=lambda x: (-x[1], x[0]))])


class LogBilinear:
    """Parameters ``context`` (classes and a start mark), ``turns`` (a matrix for each position), ``target``, ``bias``.

    Class ``classes`` is that of all rarer tokens; context number ``classes + 1`` stands before the text.
    """

    def __init__(self, share: np.ndarray, dims: int = DIMS, seed: int = 7):
        random = np.random.default_rng(seed)
        outputs = len(share)
        self.share = share
        self.context = (random.standard_normal((outputs + 1, dims)) * 0.1).astype(np.float32)
        self.turns = np.stack([np.eye(dims), 0.5 * np.eye(dims)]).astype(np.float32)
        self.target = (random.standard_normal((outputs, dims)) * 0.1).astype(np.float32)
        self.bias = np.log(share).astype(np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.turns, self.target, self.bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for part in self.parts():
            part[...] = values[at : at + part.size].reshape(part.shape)
            at += part.size

    def train(self, steps: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], noise: int = NOISE, seed: int = 11) -> int:
        """Noise-contrastive estimation with Adagrad over steps of ``(previous, before that, class)``; tokens seen."""
        random = np.random.default_rng(seed)
        squares = [np.full(p.shape, 1e-6, np.float32) for p in self.parts()]
        edges = np.cumsum(self.share)
        log_noise = (np.log(self.share) + np.log(noise)).astype(np.float32)
        seen = 0
        for one, two, word in steps:
            n = len(word)
            first, second = self.context @ self.turns[0], self.context @ self.turns[1]
            hidden = first[one] + second[two]
            drawn = np.minimum(np.searchsorted(edges, random.random(noise)), len(self.share) - 1)
            own = (hidden * self.target[word]).sum(axis=1) + self.bias[word] - log_noise[word]
            other = hidden @ self.target[drawn].T + (self.bias[drawn] - log_noise[drawn])
            miss = 1 / (1 + np.exp(np.clip(own, -30, 30)))  # 1 - sigmoid: how far data looks like noise
            false = 1 / (1 + np.exp(np.clip(-other, -30, 30)))
            pull = miss[:, None] * self.target[word] - false @ self.target[drawn]
            by_first, by_second = summed(one, pull, len(first)), summed(two, pull, len(second))
            target = summed(word, miss[:, None] * hidden, len(self.target))
            np.subtract.at(target, drawn, false.T @ hidden)
            bias = np.bincount(word, miss, len(self.bias))
            np.subtract.at(bias, drawn, false.sum(axis=0))
            context = by_first @ self.turns[0].T + by_second @ self.turns[1].T
            turns = np.stack([self.context.T @ by_first, self.context.T @ by_second])
            for part, square, gradient in zip(self.parts(), squares, (context, turns, target, bias)):
                gradient = (gradient / n).astype(np.float32)
                square += gradient * gradient
                part += RATE * gradient / np.sqrt(square)
            seen += n
        return seen

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score parts of each class by previous class and by the one before, and log normalisers of both contexts."""
        first = self.context @ self.turns[0] @ self.target.T + self.bias
        second = self.context @ self.turns[1] @ self.target.T
        norm = np.empty((len(first), len(second)), np.float32)
        for i, row in enumerate(first):
            scores = row + second
            high = scores.max(axis=1, keepdims=True)
            norm[i] = high[:, 0] + np.log(np.exp(scores - high).sum(axis=1))
        return first, second, norm


def summed(place: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by place."""
    dims = rows.shape[1]
    flat = (place[:, None] * dims + np.arange(dims)).ravel()
    return np.bincount(flat, rows.ravel(), n * dims).reshape(n, dims).astype(np.float32)


def preceding(classes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Previous class and the one before it at each place."""
    padded = np.concatenate([[start, start], classes])
    return padded[1:-1], padded[:-2]


def class_shares(counts: Counts, classes: int) -> np.ndarray:
    """Share of each class among the training tokens, add-one smoothed; the last is that of all rarer tokens."""
    own = [n for _, n in counts.frequent[:classes]]
    every = np.array([*own, counts.total - sum(own)], np.float64) + 1
    return every / every.sum()


def train(texts: DataFrame, counts: Counts, classes: int = CLASSES, dims: int = DIMS) -> LogBilinear:
    """The average of the copies that tasks train on their own rows of ``texts(text)``."""
    spark = texts.sparkSession
    model = LogBilinear(class_shares(counts, classes), dims)
    rare = len(model.share) - 1
    shared = spark.sparkContext.broadcast(Counts(0, 0, counts.frequent[:classes]).places())

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value

        def steps():
            held, size = [], 0
            for batch in batches:
                for text in batch.column(0):
                    words = tokens(text.as_py())
                    word = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                    held.append((*preceding(word, rare + 1), word))
                    size += len(words)
                    if size >= STEP_TOKENS:
                        joined = [np.concatenate(x) for x in zip(*held)]
                        whole = size - size % STEP_TOKENS
                        for at in range(0, whole, STEP_TOKENS):
                            yield tuple(x[at : at + STEP_TOKENS] for x in joined)
                        held, size = [tuple(x[whole:] for x in joined)], size - whole
            if size:
                yield tuple(np.concatenate(x) for x in zip(*held))

        own = LogBilinear(model.share, dims)
        seen = own.train(steps())
        part = TaskContext.get().partitionId() % GROUPS
        weighted = (own.packed().astype(np.float64) * seen).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seen]), pa.array([weighted], pa.binary())], ["part", "n", "sums"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums = 0, np.zeros(len(model.packed()))
        for rows in batches:
            for one, values in zip(rows["n"], rows["sums"]):
                n += one
                sums += np.frombuffer(values)
        yield pd.DataFrame({"n": [n], "sums": [sums.tobytes()]})

    copies = texts.mapInArrow(trained, "part long, n long, sums binary").where("n > 0")
    found = copies.repartition(GROUPS, "part").select("n", "sums").mapInPandas(added, "n long, sums binary").collect()
    seen = sum(r.n for r in found)
    if seen:
        model.load((sum(np.frombuffer(r.sums) for r in found) / seen).astype(np.float32))
    return model


def score(
    docs: DataFrame,
    learn_from: DataFrame,
    classes: int = CLASSES,
    dims: int = DIMS,
    frequent: int = FREQUENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row, learned from ``learn_from(text)``.

    Both scores are log10 probabilities of the whole text with its end. Null and empty texts have the end token only.
    Repeated rows, ids and null ids each give a row; other columns are not read. An empty table gives an empty table;
    with nothing to learn from all tokens are unknown and equal. Counting and training run when the function is
    called. The average depends on how the rows to learn from are split into tasks; all else does not.
    """
    if frequent < classes:
        raise ValueError("frequent tokens must include all classes")
    spark = docs.sparkSession
    bounded_batches(spark)
    table = stored(count_tokens(learn_from.select("text")), "token-counts")
    counts = corpus_counts(table, frequent)
    model = train(learn_from.select("text"), counts, classes, dims)
    own = [n for _, n in counts.frequent[:classes]]
    rare = len(model.share) - 1
    rare_total = counts.total - sum(own) + max(counts.distinct - len(own), 0) + 1
    base_total = counts.total + counts.distinct + 1
    known = np.array([n for _, n in counts.frequent] + [0])
    shared = spark.sparkContext.broadcast((counts.places(), np.log10(known + 1.0), known > 0, model.tables()))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, logs, is_known, (first, second, norm) = shared.value
        beyond, number = places.missing, TaskContext.get().partitionId() << 40
        element = pa.struct([("token", pa.binary()), ("n", pa.int64())])
        names = ["row", "doc_id", "n_tokens", "n_known", "n_rare", "frequent_logs", "rare_logs", "classes_score", "beyond"]
        for batch in batches:
            out = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens(text.as_py())
                place = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                word = np.minimum(place, rare)
                one, two = preceding(word, rare + 1)
                value = (first[one, word] + second[two, word] - norm[one, two]).sum(dtype=np.float64) / np.log(10)
                log = logs[place]
                is_rare = place >= rare
                far = Counter(words[i] for i in np.flatnonzero(place == beyond).tolist())
                number += 1
                row = (
                    number,
                    doc,
                    len(words),
                    int(is_known[place].sum()),
                    int(is_rare.sum()),
                    float(log[~is_rare].sum()),
                    float(log[is_rare].sum()),
                    float(value),
                    [{"token": token, "n": n} for token, n in far.items()],
                )
                for column, x in zip(out, row):
                    column.append(x)
            kinds = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.list_(element)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = (
        "row long, doc_id long, n_tokens long, n_known long, n_rare long, frequent_logs double, rare_logs double, "
        "classes_score double, beyond array<struct<token: binary, n: long>>"
    )
    rows = stored(rows.mapInArrow(scored, schema), "lm-rows")
    far = rows.select("row", F.inline("beyond")).withColumnRenamed("n", "times")
    far = far.join(table, "token").groupBy("row").agg(
        F.sum("times").alias("far_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("far_logs")
    )
    rows = rows.drop("beyond").join(far, "row", "left")
    logs = F.col("rare_logs") + F.coalesce("far_logs", F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("frequent_logs") + logs - F.col("n_tokens") * float(np.log10(base_total))).alias("base_score"),
        (F.col("classes_score") + logs - F.col("n_rare") * float(np.log10(rare_total))).alias("score"),
    )


def op4_neural_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those whose id's crc32 leaves not 2 modulo 7 (a null id is in neither part)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    part = bucket(F.col("doc_id"), 7)
    found = score(docs, docs.where(part != 2))
    held_out = F.coalesce(part == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""Document fingerprints: Merkle trees over sections, paragraphs and short spans.

A text is cut into spans (a sentence, at most ``SPAN`` characters), spans into paragraphs (at line ends) and paragraphs
into sections (at blank lines, and where a paragraph's hash says so, so that an edit moves no distant boundary). A
node's hash is the hash of its children's, so a fingerprint that lists the spans' hashes by paragraph and section holds the
whole tree. Equal roots mean equal texts. Unequal trees are walked down together: at each level children of equal hash
are matched in order and not entered, and what lies between two matches is compared one level below, which ends at the
ranges of characters that were changed.

For each document's successor, documents are dealt by ranges of their id, and the largest row of each range is also
dealt to the range above it, so every task sees the successors of all its rows in one sorted pass and holds two rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import bounded_batches

SPAN = 160
SPANS = re.compile(r"[^\n.!?]{1,%d}[.!?\n]?|[.!?\n]" % SPAN)
#: A section ends after one paragraph of this many, on average, if no blank line ends it before.
PARAGRAPHS = 4
#: Rows of an id range, and the largest number of ranges (their bounds are the only rows the driver sees).
RANGE_ROWS, MOST_RANGES = 1024, 10_000
CHANGE = ("old_from", "old_to", "new_from", "new_to")


def _hash(children: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b"".join(children))


class Tree:
    """``sections`` of ``paragraphs`` of span hashes, with the hashes above them; ``lengths`` of the spans in order."""

    __slots__ = ("lengths", "root", "sections", "size")

    def __init__(self, text: str):
        digest = xxhash.xxh64_digest
        self.sections: list[tuple[bytes, list[tuple[bytes, list[bytes]]]]] = []
        spans: list[bytes] = []
        paragraphs: list[tuple[bytes, list[bytes]]] = []
        self.size = 0
        self.lengths: list[int] = []

        def end_section():
            if paragraphs:
                self.sections.append((_hash([p for p, _ in paragraphs]), paragraphs.copy()))
                paragraphs.clear()

        def end_paragraph():
            paragraph = _hash(spans)
            paragraphs.append((paragraph, spans.copy()))
            spans.clear()
            return paragraph

        for span in SPANS.findall(text):
            spans.append(digest(span))
            self.lengths.append(len(span))
            self.size += 1
            if span[-1] == "\n":
                blank = span == "\n" and len(spans) == 1
                if end_paragraph()[0] % PARAGRAPHS == 0 or blank:
                    end_section()
        if spans:
            end_paragraph()
        end_section()
        self.root = _hash([s for s, _ in self.sections])

    def fingerprint(self) -> str:
        """Root in hex, then sixteen hex digits of each span: sections after ``;``, paragraphs after ``,``."""
        parts = (",".join(b"".join(spans).hex() for _, spans in section) for _, section in self.sections)
        return ";".join([self.root.hex(), *parts])

    @classmethod
    def of_fingerprint(cls, fingerprint: str) -> Tree:
        """The tree that a fingerprint stands for, without the lengths of its spans."""
        tree = cls("")
        for part in fingerprint.split(";")[1:]:
            paragraphs = []
            for digits in part.split(","):
                spans = [bytes.fromhex(digits[i : i + 16]) for i in range(0, len(digits), 16)]
                paragraphs.append((_hash(spans), spans))
                tree.size += len(spans)
            tree.sections.append((_hash([p for p, _ in paragraphs]), paragraphs))
        tree.root = _hash([s for s, _ in tree.sections])
        return tree


def _apart(left: list, right: list, key) -> tuple[int, list, list]:
    """How many elements have a partner of the same hash on the other side, and the elements without."""
    ours, theirs = Counter(map(key, left)), Counter(map(key, right))
    both = ours & theirs
    if not both:
        return 0, left, right
    rest = []
    for side in (left, right):
        seen, own = Counter(both), []
        for x in side:
            if seen[key(x)]:
                seen[key(x)] -= 1
            else:
                own.append(x)
        rest.append(own)
    return sum(both.values()), rest[0], rest[1]


def shared_spans(a: Tree, b: Tree) -> int:
    """Spans in branches that both trees have; equal branches are not entered."""
    _, left, right = _apart(a.sections, b.sections, lambda s: s[0])
    gone = sum(len(spans) for _, section in left for _, spans in section)
    shared = a.size - gone
    left = [p for _, section in left for p in section]
    right = [p for _, section in right for p in section]
    _, rest, right = _apart(left, right, lambda p: p[0])
    shared += gone - sum(len(spans) for _, spans in rest)
    same, _, _ = _apart([x for _, s in rest for x in s], [x for _, s in right for x in s], lambda x: x)
    return shared + same


def likeness(a: Tree, b: Tree) -> float:
    """1 for equal roots, else the shared spans over those of the larger tree."""
    if a.root == b.root:
        return 1.0
    return min(shared_spans(a, b) / max(a.size, b.size), 1.0)


def _in_order(left: list[bytes], right: list[bytes]) -> list[tuple[int, int]]:
    """Places of equal hashes on both sides, ascending on both: the n-th of a hash goes with the n-th, and of these
    pairs a longest run that ascends is kept."""
    places: dict[bytes, list[int]] = {}
    for i, key in enumerate(left):
        places.setdefault(key, []).append(i)
    seen: Counter = Counter()
    tails, ends, links = [], [], []  # of runs by length: last left place and pair; each pair's forerunner
    pairs = []
    for j, key in enumerate(right):
        own, n = places.get(key, ()), seen[key]
        if n >= len(own):
            continue
        seen[key] += 1
        at = bisect_left(tails, own[n])
        links.append(ends[at - 1] if at else -1)
        pairs.append((own[n], j))
        tails[at : at + 1], ends[at : at + 1] = [own[n]], [len(pairs) - 1]
    found, pair = [], ends[-1] if ends else -1
    while pair >= 0:
        found.append(pairs[pair])
        pair = links[pair]
    return found[::-1]


def _between(left: list[bytes], right: list[bytes]) -> Iterator[tuple[slice, slice]]:
    """Parts of both sides that lie between children of equal hash."""
    size = min(len(left), len(right))
    start = next((i for i in range(size) if left[i] != right[i]), size)
    end = next((i for i in range(size - start) if left[-1 - i] != right[-1 - i]), size - start)
    a, b = start, start
    inner = _in_order(left[start : len(left) - end], right[start : len(right) - end])
    for i, j in [*((start + i, start + j) for i, j in inner), (len(left) - end, len(right) - end)]:
        if i > a or j > b:
            yield slice(a, i), slice(b, j)
        a, b = i + 1, j + 1


def changes(old: Tree, new: Tree) -> list[tuple[int, int, int, int]]:
    """``(old_from, old_to, new_from, new_to)``: character ranges in which two texts differ, in order.

    A range is one or more whole spans on at least one side; an empty side tells where something was put in or taken out.
    A span that was moved differs at both places.
    """
    if old.root == new.root:
        return []

    def level(nodes: list[tuple], first: int) -> tuple[list[bytes], list[int]]:
        """Hashes of nodes side by side, and the number of each one's first span (and of the one after the last)."""
        starts = [first]
        for _, children in nodes:
            starts.append(starts[-1] + (len(children) if children and isinstance(children[0], bytes) else sum(len(s) for _, s in children)))
        return [key for key, _ in nodes], starts

    ends = [[0, *accumulate(tree.lengths)] for tree in (old, new)]
    found: list[list[int]] = []

    def spans(left: list[bytes], right: list[bytes], a: int, b: int) -> None:
        for x, y in _between(left, right):
            part = [ends[0][a + x.start], ends[0][a + x.stop], ends[1][b + y.start], ends[1][b + y.stop]]
            if found and (found[-1][1], found[-1][3]) == (part[0], part[2]):
                found[-1][1], found[-1][3] = part[1], part[3]
            else:
                found.append(part)

    keys_a, starts_a = level(old.sections, 0)
    keys_b, starts_b = level(new.sections, 0)
    for x, y in _between(keys_a, keys_b):
        left, right = ([p for _, section in tree.sections[part] for p in section] for tree, part in ((old, x), (new, y)))
        inner_a, first_a = level(left, starts_a[x.start])
        inner_b, first_b = level(right, starts_b[y.start])
        for v, w in _between(inner_a, inner_b):
            own, other = ([h for _, hashes in side[part] for h in hashes] for side, part in ((left, v), (right, w)))
            spans(own, other, first_a[v.start], first_b[w.start])
    return [tuple(part) for part in found]


def edits(old: str, new: str) -> list[tuple[int, int]]:
    """``(from, to)`` character ranges of ``new`` that ``old`` has not at that place, in order."""
    return [(start, end) for _, _, start, end in changes(Tree(old), Tree(new)) if end > start]


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(bucket, again, doc_id, text)`` in partitions sorted by bucket, then descending id.

    After a bucket's own rows comes a row (or equal rows) with ``again`` set: the successor of its last row. Ranges
    are cut at quantiles of the ids; what reaches the driver is at most ``MOST_RANGES`` cuts.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    total = ids.count()
    ranges = min(MOST_RANGES, total // RANGE_ROWS + 1)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", shares, 0.25 / ranges)}) if shares else []

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        found = np.searchsorted(np.array(cuts, np.int64), values.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(values.isna(), -1, found))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    largest = ids.select("doc_id", range_of("doc_id").alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    heads = sorted((r.bucket, r.doc_id) for r in largest.collect())
    above = [(doc, heads[(i + 1) % len(heads)][0]) for i, (_, doc) in enumerate(heads)]
    targets = spark.createDataFrame(above, "head long, target int")
    rows = rows.withColumn("bucket", range_of("doc_id")).join(
        F.broadcast(targets), F.col("doc_id").eqNullSafe(F.col("head")), "left"
    )
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("again")),
            F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("bucket"), F.lit(True).alias("again"))),
        )
    )
    rows = rows.select(F.explode(places).alias("place"), "doc_id", "text")
    rows = rows.select("place.bucket", "place.again", "doc_id", "text", F.xxhash64("text").alias("sign"))
    order = ["bucket", "again", F.col("doc_id").desc_nulls_last(), F.col("sign").desc()]
    return rows.repartition("bucket").sortWithinPartitions(*order).drop("sign")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changes)`` a document.

    ``changes`` are the character ranges in which the edited text differs, as ``changes`` finds them; both likenesses
    follow from the fingerprints alone.

    The next document is the one with the next smaller id, and for the smallest the largest. Rows with one id follow
    each other by a hash of their text; null ids come last. A null text counts as empty. A single row follows itself.
    Other columns are not read. An empty table gives an empty table.
    """

    bounded_batches(docs.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_chars", pa.int64()),
                ("edited_sha256", pa.string()),
                ("fingerprint", pa.string()),
                ("edited_fingerprint", pa.string()),
                ("near_edited", pa.float64()),
                ("near_next", pa.float64()),
                ("changes", pa.list_(pa.struct([(c, pa.int64()) for c in CHANGE]))),
            ]
        )
        last = None  # (bucket, doc_id, text, tree) of the row that waits for its successor
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "again", "doc_id"))
            for bucket, again, doc, text in zip(*columns, batch.column("text")):
                if again and last is None:
                    continue
                text = text.as_py()
                tree = Tree(text)
                if last is not None:
                    _, own_id, own, own_tree = last
                    new = edited(own, text)
                    new_tree = Tree(new)
                    out.append(
                        (
                            own_id,
                            len(own),
                            hashlib.sha256(new.encode()).hexdigest(),
                            own_tree.fingerprint(),
                            new_tree.fingerprint(),
                            likeness(own_tree, new_tree),
                            likeness(own_tree, tree),
                            [dict(zip(CHANGE, c)) for c in changes(own_tree, new_tree)],
                        )
                    )
                last = None if again else (bucket, doc, text, tree)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, "
        f"changes array<struct<{', '.join(f'{c}:bigint' for c in CHANGE)}>>"
    )
    return with_successors(docs, id_col, text_col).mapInArrow(compare, schema)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document, its edited text, and their likeness."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))

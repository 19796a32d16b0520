"""SimHash near-dedup: fingerprints linked by a binary trie self-join.

A fingerprint bit is 1 if it is set in over half of the XXH64 values of the document's word shingles. Equal
fingerprints are one node. Fingerprints at most ``max_distance`` bits apart are linked.

The self-join walks pairs of trie nodes downwards together and adds up the bits by which their paths differ; a pair
whose budget is exceeded is pruned with all below it. A trie over sorted fingerprints needs no pointers: a node is a
range of the array, and running bit counts give the place where it splits. To spread it, two fingerprints within
``d`` bits agree on one of ``d + 1`` blocks of bits, so there is one trie for each block rotated to the front, cut at
that depth into subtrees that tasks join on their own. A subtree of more than ``leaf_rows`` fingerprints is dealt
into parts, and each two parts are joined as two tries: exact, and no task holds more than two parts.

A task returns its links as stars (each fingerprint with the smallest of its local component), never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import bounded_batches, packed
from cargolens.llm.components import components, local_components
from cargolens.storage import stored

#: Node pairs that are compared value by value instead of being walked further, and the walk's block of pairs.
FEW_PAIRS, BLOCK = 32, 1 << 16
#: Shingles whose bits are unpacked at a time.
SHINGLES = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text, 0 without words. ``bytes`` methods know only ASCII cases and ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[: len(words) - size + 1].tolist()
    stop = end[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(start), SHINGLES):
        spans = zip(start[at : at + SHINGLES], stop[at : at + SHINGLES])
        values = np.array([digest(joined[i:j], 42) for i, j in spans], "<u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(start), bitorder="little").tobytes(), "little")


def fingerprints(text, shingle: int = 3):
    """Column of fingerprints as signed longs."""

    @F.pandas_udf("long")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pd.Series(values.view(np.int64))

    return of_batches(text)


def trie_links(values: np.ndarray, roots: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values at most ``budget`` bits apart.

    ``roots`` has rows ``(a_from, a_to, b_from, b_to)`` of ranges to join; a range is sorted and shares its first
    ``depth`` bits with its partner. Equal ranges stand for a self-join.
    """
    ones: dict[int, np.ndarray] = {}

    def zeros_end(low, high, bit):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int64)])
        return high - (ones[bit][high] - ones[bit][low])

    found = []
    stack = [(depth, roots[i : i + BLOCK], np.zeros(len(roots[i : i + BLOCK]), np.int8)) for i in range(0, len(roots), BLOCK)]
    while stack:
        bit, nodes, differ = stack.pop()
        a, b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        done = (a * b <= FEW_PAIRS) | (bit == 64)
        if done.any():
            found += compared(values, nodes[done], budget)
        nodes, differ = nodes[~done], differ[~done]
        if not len(nodes):
            continue
        a0, a2, b0, b2 = nodes.T
        a1, b1 = zeros_end(a0, a2, bit), zeros_end(b0, b2, bit)
        same = (a0 == b0) & (a2 == b2)
        spent = differ < budget
        below = [
            (a0, a1, b0, b1, np.ones(len(nodes), bool), differ),
            (a1, a2, b1, b2, np.ones(len(nodes), bool), differ),
            (a0, a1, b1, b2, spent, differ + 1),
            (a1, a2, b0, b1, spent & ~same, differ + 1),
        ]
        ranges = np.concatenate([np.stack(x[:4], 1)[x[4]] for x in below])
        differ = np.concatenate([x[5][x[4]] for x in below])
        full = (ranges[:, 1] > ranges[:, 0]) & (ranges[:, 3] > ranges[:, 2])
        ranges, differ = ranges[full], differ[full]
        stack += [(bit + 1, ranges[i : i + BLOCK], differ[i : i + BLOCK]) for i in range(0, len(ranges), BLOCK)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.concatenate(found, axis=1)
    return pairs[0], pairs[1]


def compared(values: np.ndarray, nodes: np.ndarray, budget: int) -> list[np.ndarray]:
    """Pairs within budget of few-element (or all-equal) ranges, compared bit by bit."""
    a, b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
    out = []
    sizes = np.cumsum(a * b)
    cuts = [0, *(np.searchsorted(sizes, np.arange(BLOCK * 16, sizes[-1], BLOCK * 16)) + 1).tolist(), len(nodes)]
    for i, j in zip(cuts, cuts[1:]):
        if i >= j:
            continue
        each = (a * b)[i:j]
        owner = np.repeat(np.arange(i, j), each)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
        left = nodes[owner, 0] + place // b[owner]
        right = nodes[owner, 2] + place % b[owner]
        near = np.bitwise_count(values[left] ^ values[right]) <= budget
        near &= ~((nodes[owner, 0] == nodes[owner, 2]) & (left >= right))
        out.append(np.stack([left[near], right[near]]))
    return out


def rotated(value, bits: int):
    """A long rotated left, on columns."""
    if bits == 0:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def linked_stars(prints: DataFrame, max_distance: int = 3, leaf_rows: int = 50_000) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints ``prints(fp long)`` whose components are those of all links."""
    blocks = max_distance + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    width = min(j - i for i, j in zip(edges, edges[1:]))
    turns = edges[:-1]
    value = F.element_at(F.array(*[rotated(F.col("fp"), t) for t in turns]), F.col("turn") + 1)
    rows = prints.select("fp", F.explode(F.array(*[F.lit(i) for i in range(blocks)])).alias("turn"))
    rows = rows.select("turn", value.alias("value"), F.shiftrightunsigned(value, 64 - width).alias("prefix"))

    counts = rows.groupBy("turn", "prefix").agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("parts"))
    split = counts.where("parts > 1")
    rows = rows.join(split, ["turn", "prefix"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("value"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    rows = rows.select("turn", "prefix", low, high, (F.col("part") == F.col("high")).alias("second"), "value")
    key = ["turn", "prefix", "low", "high"]
    # sorting signed longs puts the sign bit last, within a prefix all have the same one: the order is that of the bits
    rows = rows.repartition(*key).sortWithinPartitions(*key, "second", "value")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(part: pa.Table) -> pa.RecordBatch:
            cols = [part.column(c).to_numpy() for c in (*key, "second")]
            values = part.column("value").to_numpy().view(np.uint64)
            side = np.concatenate([[0], _changes(cols) + 1, [len(values)]])
            group = np.concatenate([[0], _changes(cols[:4]) + 1, [len(values)]])
            own = side[:-1]
            first = group[np.searchsorted(group, own, "right") - 1]
            two = own != first
            alone = cols[2][own] == cols[3][own]
            roots = np.stack([own, side[1:], own, side[1:]], 1)[alone]
            cross = np.stack([first, own, own, side[1:]], 1)[two]
            left, right = trie_links(values, np.concatenate([roots, cross]), width, max_distance)
            label = local_components(len(values), left, right)
            at = np.flatnonzero(label != np.arange(len(values)))
            turn = np.array(turns, np.uint64)[cols[0]]
            plain = (values >> turn) | np.where(turn > 0, values << ((np.uint64(64) - turn) & np.uint64(63)), 0).astype(np.uint64)
            back = plain.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(back[at]), pa.array(back[label[at]])], ["a", "b"])

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * leaf_rows:
                table = pa.Table.from_batches(held)
                ends = _changes([table.column(c).to_numpy() for c in key])
                if len(ends):
                    cut = int(ends[-1]) + 1
                    yield links(table.slice(0, cut))
                    table = table.slice(cut)
                held, size = table.combine_chunks().to_batches(), table.num_rows
        if size:
            yield links(pa.Table.from_batches(held))

    return rows.mapInArrow(join, "a long, b long")


def _changes(cols: list[np.ndarray]) -> np.ndarray:
    """Indexes whose successor differs in a column."""
    differ = np.zeros(max(0, len(cols[0]) - 1), bool)
    for c in cols:
        differ |= c[1:] != c[:-1]
    return np.flatnonzero(differ)


def simhash_groups(
    docs: DataFrame,
    shingle: int = 3,
    max_distance: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_rows: int = 50_000,
) -> DataFrame:
    """One row ``(doc_id, sign, fingerprint, component_id, group)`` for each input row.

    ``component_id`` is the smallest id that links reach. Null and wordless texts have fingerprint zero and link like
    any other. Repeated rows and ids each give a row. Rows with a null id take part; their component has the smallest
    non-null id, or null where there is none. ``group`` numbers the component in any case. ``sign`` is a 64-bit hash of
    the text, for joining rows back. Other columns are not read. An empty table gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("sign"), fingerprints(F.col("text"), shingle).alias("fp"))
    rows = stored(rows, "simhash")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = components(linked_stars(prints.select("fp"), max_distance, leaf_rows), "simhash-components")
    tree = prints.join(roots, prints["fp"] == roots["node"], "left")
    tree = tree.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = tree.groupBy("root").agg(F.min("least").alias("component_id"))
    tree = tree.join(smallest, "root").select("fp", "component_id", F.col("root").alias("group"))
    return rows.join(tree, "fp").select("doc_id", "sign", F.col("fp").alias("fingerprint"), "component_id", "group")


def one_of_each_group(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each SimHash group the row of the smallest id (then of the smallest text
    hash), once even if the same row is repeated. Columns are those of ``docs``."""
    found = simhash_groups(docs, shingle, max_distance)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sign")
    best = found.groupBy("group").agg(F.min(order).alias("order"))
    best = best.select(F.col("order.doc_id").alias("id"), F.col("order.sign").alias("sign")).distinct()
    rows = packed(docs, id=F.col("doc_id"), sign=F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.sign") == F.col("b.sign"))
    kept = rows.alias("a").join(best.alias("b"), same, "left_semi")
    once = kept.groupBy("id", "sign").agg(F.first("row").alias("row"))
    return once.select("row.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 3 differing bits."""
    found = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

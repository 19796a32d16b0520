"""Embedding near-dedup: int8 tile products with error bounds, full precision where they cannot decide.

Equal vectors of a label are one class with a number of copies. A label's classes are dealt into tiles of about
``tile_rows``; each two tiles of a label (and each with itself) are one task's group, so a hot label is spread like
any other. A tile's unit vectors are quantised to int8 with a scale and the exact norm of the error left. For unit
vectors u = s q + e the product differs from the int8 product by at most |s q| |f| + |t r| |e| + |e| |f|
(Cauchy-Schwarz), with v = t r + f. Pairs whose int8 product plus this bound reaches the threshold are computed again
in double precision, all others cannot link.

A group returns for each class its number of links and one link to the smallest class of its local component: linear
in the tile, never all pairs. The products themselves grow with the square of a label's classes, as the contract asks
for all links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.components import components, local_components
from cargolens.storage import stored

THRESHOLD, TILE_ROWS = 0.93, 2048
#: Pairs that are computed again at a time.
BLOCK = 1 << 15


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors with their largest component between 0.5 and 1, so that no square leaves the range of doubles.

    The factors are powers of two: cosines stay as they are to the last bit.
    """
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, scales, norms of what the codes stand for, and norms of the error."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    stands = codes * scale[:, None]
    return codes, scale, np.linalg.norm(stands, axis=1), np.linalg.norm(unit - stands, axis=1)


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of double-precision vectors whose cosine is at least the threshold."""
    a, s, a_norm, a_error = quantised(left)
    b, t, b_norm, b_error = quantised(right)
    # sums of int8 products are whole numbers that float32 holds exactly up to 2**24
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (a.astype(exact) @ b.astype(exact).T).astype(np.float64) * s[:, None] * t[None, :]
    bound = np.outer(a_norm, b_error) + np.outer(a_error, b_norm + b_error)
    i, j = np.nonzero(product + bound >= threshold - 1e-9)
    near = np.zeros(len(i), bool)
    left_norm, right_norm = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    for at in range(0, len(i), BLOCK):
        p, q = i[at : at + BLOCK], j[at : at + BLOCK]
        cosine = np.einsum("ij,ij->i", left[p], right[q]) / (left_norm[p] * right_norm[q])
        near[at : at + BLOCK] = cosine >= threshold
    return i[near], j[near]


def tile_result(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Of two tiles (or one, joined with itself): each linked class, its links' copies, its local root."""
    group = group.sort_values("node", kind="stable")
    nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy(np.float64)
    vectors = scaled(np.array(group["embedding"].tolist(), np.float64).reshape(len(group), -1))
    if group["low"].iloc[0] == group["high"].iloc[0]:
        left, right = tile_links(vectors, vectors, threshold)
        left, right = left[left < right], right[left < right]
    else:
        second = group["second"].to_numpy()
        first_rows, second_rows = np.flatnonzero(~second), np.flatnonzero(second)
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(first_rows) and len(second_rows):
            left, right = tile_links(vectors[first_rows], vectors[second_rows], threshold)
            left, right = first_rows[left], second_rows[right]
    n = len(group)
    links = np.bincount(left, copies[right], n) + np.bincount(right, copies[left], n)
    root = local_components(n, left, right)
    found = links > 0
    return pd.DataFrame({"node": nodes[found], "links": links[found].astype(np.int64), "root": nodes[root[found]]})


def embedding_groups(
    vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label)``.

    Only vectors of one label and one length are compared. Null, empty and zero vectors, vectors with null or
    non-finite components and rows without a label link with nothing and are their own component. Equal vectors of a
    label link with each other. A null id takes part; its component has the smallest non-null id, or null, and it is
    not kept. Repeated rows each count. Other columns are not read. An empty table gives an empty table.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(whole, F.lit(False)))
    alone = rows.where("not valid").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    key = ["label", "dims", "sign", "second_sign"]
    rows = rows.where("valid").select(
        "vec_id",
        "embedding",
        "label",
        F.size("embedding").alias("dims"),
        F.xxhash64("embedding").alias("sign"),
        F.xxhash64(F.lit(1), "embedding").alias("second_sign"),
    )
    classes = rows.groupBy(*key).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")

    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    dealt = classes.join(sizes, ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    dealt = dealt.select("label", "dims", "low", "high", (F.col("tile") == F.col("high")).alias("second"), "node", "copies", "embedding")

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        return tile_result(group, threshold)

    found = dealt.groupBy("label", "dims", "low", "high").applyInPandas(joined, "node long, links long, root long")
    found = stored(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    tree = classes.select(*key, "node", "least", "copies").join(links, "node", "left").join(roots, "node", "left")
    tree = tree.withColumn("root", F.coalesce("root", "node"))
    smallest = tree.groupBy("root").agg(F.min("least").alias("component_id"))
    tree = tree.join(smallest, "root").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    linked = rows.select("vec_id", *key).join(tree, key)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.select("vec_id", "n_links", "component_id", kept.alias("kept")).union(alone)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93 within their label."""
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP9_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node),
component AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, node = component_id AS kept
FROM component LEFT JOIN degree ON degree.a = component.node
"""

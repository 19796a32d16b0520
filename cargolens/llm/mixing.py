"""Mixing sources to target weights by weighted fair queueing.

Each source has a weight. Its target is its share of the budget; a target stops at ``repeats`` times the source's size,
and what is above is shared again by weight among the others, until none is above.

Every source is a queue: its documents shuffled, then shuffled anew for each further pass. A document's virtual finish
time is the source's words up to and including it, divided by the source's target, so at time 1 each source has sent its
target. All queues are merged by one range sort on the finish time and cut where the budget is reached.

Only DataFrame functions are used. Running sums never gather a source in a task: rows are range-sorted, written once,
summed inside each sort task, and the sums of earlier tasks are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cargolens.llm.columns import packed, unpacked
from cargolens.operators.running import numbered
from cargolens.storage import stored

#: Weights of the sources in the order of their names, repeating; passes over a source at most.
WEIGHTS, REPEATS = (5, 2, 1), 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(
    df: DataFrame, order: list[Column], value: str, out: str, name: str, keep: tuple[str, ...], group: tuple[str, ...] = ()
) -> DataFrame:
    """The columns to ``keep`` and the sum of ``value`` over all rows of the group up to and including this one, in the
    order of ``group, order``.

    The rows are sorted over all tasks and written with the number of their task, without columns that only sort them. A
    task's rows are summed by a window of their own; sums of the earlier tasks have one row for each task and group.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = df.orderBy(*group, *order).select(*keep, *group).withColumn("place", place).withColumn("task", F.shiftright("place", 33))
    sorted_rows = stored(sorted_rows, name)
    sums = sorted_rows.groupBy("task", *group).agg(F.sum(value).alias("all_of_task"))
    earlier = W.partitionBy(*group).orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("task", *group, F.coalesce(F.sum("all_of_task").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("task", *group).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    summed = sorted_rows.withColumn(out, F.sum(value).over(inside))
    return summed.join(offsets, ["task", *group]).withColumn(out, F.col(out) + F.col("offset")).drop("place", "task", "offset")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, budget: int | None = None
) -> tuple[DataFrame, int]:
    """``(number, source, source_size, target)`` from ``(source, source_size)``, and the budget (all sizes by default).

    Sources are numbered by code point, null last, and take ``weights`` in turn. Each round of the loop is one aggregate
    of the sources: what the targets that reached their limit leave over, and the weights of the others. A budget above
    all limits gives every source its limit.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = numbered(sizes, order, "number")
    nth = F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1
    weighted = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), nth.cast("int")))
    weighted = stored(weighted, "mix-sources")
    whole, weight = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    budget = whole if budget is None else budget
    limit = (F.col("source_size") * repeats).cast("double")
    rest, left = float(budget), weight
    while left:
        share = F.lit(rest) * F.col("weight") / F.lit(float(left))
        full = limit < share
        taken, remaining = weighted.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * repeats)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if remaining == left:
            break
        rest, left = float(budget - taken), remaining
    target = F.least(limit, F.lit(rest) * F.col("weight") / F.lit(float(left))) if left else limit
    return weighted.select("number", "source", "source_size", target.alias("target")), budget


def schedule(rows: DataFrame, targets: DataFrame, budget: int, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """The mix: ``(row_id, pass, size, finish, sent)`` of every document sent, where ``sent`` counts the mix's words so far.

    ``rows`` has ``(row_id, doc_id, sign, source, size)``. A pass is shuffled by md5 of seed, pass and id; equal ids
    follow by ``sign`` and ``row_id``. Rows of no words are not sent.
    """
    own = targets.select("number", F.col("source").alias("name"), "target")
    queued = rows.where("size > 0").join(own, F.col("source").eqNullSafe(F.col("name")))
    passes = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("pass")
    queued = queued.select("row_id", "doc_id", "sign", "size", "number", "target", passes)
    text = F.concat_ws(":", F.lit(str(seed)), F.col("pass").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    queued = queued.withColumn("shuffle", F.unhex(F.md5(text)))
    order = [F.col(c) for c in ("pass", "shuffle", "doc_id", "sign", "row_id")]
    queues = running(queued, order, "size", "queued", "mix-queues", ("row_id", "pass", "size", "target"), ("number",))
    finished = queues.withColumn("finish", F.col("queued").cast("double") / F.col("target")).drop("target")
    # words queued so far grow along a queue, so they alone tell rows of one finish time and queue apart
    merged = [F.col(c) for c in ("finish", "number", "queued")]
    sent = running(finished, merged, "size", "sent", "mix-sent", ("row_id", "pass", "size", "finish"))
    return sent.where(F.col("sent") <= budget).select("row_id", "pass", "size", "finish", "sent")


def _rows(docs: DataFrame, size: Column, id_col: str, source_col: str, content: list[str]) -> DataFrame:
    """The input rows, each with a number of its own that stays as written, its words and its source."""
    sign = F.xxhash64(*[F.col(f"`{c}`") for c in (id_col, source_col, *content)])
    own = packed(
        docs,
        doc_id=F.col(f"`{id_col}`"),
        source=F.col(f"`{source_col}`"),
        size=F.coalesce(size.cast("long"), F.lit(0)),
        sign=sign,
        row_id=F.monotonically_increasing_id(),
    )
    return stored(own, "mix-rows")


def _planned(rows: DataFrame, weights, repeats, budget, seed) -> tuple[DataFrame, DataFrame]:
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, budget = source_targets(sizes, weights, repeats, budget)
    narrow = rows.select("row_id", "doc_id", "sign", "source", "size")
    return targets, schedule(narrow, targets, budget, repeats, seed)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    budget: int | None = None,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    size_col: str | None = None,
) -> DataFrame:
    """The input rows with ``size``, ``source_size``, ``target`` (of the source) and ``taken`` words, passes added up.

    ``size`` counts words between ASCII white space, 0 for a null or empty text; ``size_col`` names a column of sizes to
    use instead (null: 0). A null source is a source of its own, the last. Repeated rows and ids are documents each;
    which of several equal rows is taken more often is open, all else is the same in every run. Null ids shuffle as one
    id. Input columns named like the four are replaced, others stay. An empty table gives an empty table. A very long
    document that does not fit the rest of the budget ends the mix. Tables are written to the shared folder when the
    function is called.
    """
    size, content = (word_count(F.col(f"`{text_col}`")), [text_col]) if size_col is None else (F.col(f"`{size_col}`"), [size_col])
    rows = _rows(docs, size, id_col, source_col, content)
    targets, sent = _planned(rows, weights, repeats, budget, seed)
    taken = sent.groupBy("row_id").agg(F.sum("size").alias("taken"))
    own = targets.select(F.col("source").alias("name"), "source_size", "target")
    both = rows.join(own, F.col("source").eqNullSafe(F.col("name"))).join(taken, "row_id", "left")
    return unpacked(
        both,
        docs.columns,
        size=F.col("size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        taken=F.coalesce("taken", F.lit(0)).cast("long"),
    )


def mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    budget: int | None = None,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The mix itself: a row for each time a document is sent, the input columns with ``pass``, ``finish`` and ``sent``.

    Sort by ``sent`` to read it in order. Nulls, ties, repeated rows and empty tables as in ``mix``.
    """
    rows = _rows(docs, word_count(F.col(f"`{text_col}`")), id_col, source_col, [text_col])
    _, sent = _planned(rows, weights, repeats, budget, seed)
    both = sent.join(rows.select("row", "row_id"), "row_id")
    return unpacked(both, docs.columns, **{c: F.col(c) for c in ("pass", "finish", "sent")})


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mix(sized, size_col="words").select("doc_id", "size", "source_size", "target", "taken")


OP13_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (
  SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM sizes)),
rounds(rest, left_over) AS (
  SELECT sum(source_size)::DOUBLE, sum(weight)::DOUBLE FROM weighted
  UNION
  SELECT (SELECT sum(source_size) FROM weighted)::DOUBLE
           - coalesce(sum(source_size * 3) FILTER (WHERE (source_size * 3)::DOUBLE < rest * weight / left_over), 0)::DOUBLE,
         coalesce(sum(weight) FILTER (WHERE NOT (source_size * 3)::DOUBLE < rest * weight / left_over), 0)::DOUBLE
  FROM rounds, weighted WHERE left_over > 0 GROUP BY rest, left_over),
final AS (SELECT * FROM rounds ORDER BY left_over LIMIT 1),
targets AS (
  SELECT number, source, source_size, least((source_size * 3)::DOUBLE, rest * weight / left_over) AS target FROM weighted, final),
queues AS (
  SELECT d.doc_id, d.size, t.number, t.target, p.pass, md5('0:' || p.pass || ':' || d.doc_id) AS shuffle
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([1, 2, 3]) AS pass) p
  WHERE d.size > 0),
finished AS (
  SELECT *, (sum(size) OVER (PARTITION BY number ORDER BY pass, shuffle, doc_id ROWS UNBOUNDED PRECEDING))::DOUBLE / target AS finish
  FROM queues),
sent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, number, pass, shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS words FROM finished),
taken AS (SELECT doc_id, sum(size) AS taken FROM sent WHERE words <= (SELECT sum(size) FROM docs) GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN taken k USING (doc_id)
"""

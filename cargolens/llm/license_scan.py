"""License scans with a positional rare-token index.

Licence templates are word sequences with mandatory key phrases. The corpus gives every licence word its document
frequency. A template's posting hangs on the rarest word of its key phrases, with the word's position in the template.
A file's words that carry postings (its licence words of highest IDF) are looked up; word position minus template
position is the only place where the template can lie, and there the key phrases must stand word by word. The score is
the share of the template's IDF that the file has at that place.

Only DataFrame functions are used. A file is one row throughout, so nothing but the frequencies is shuffled, and those
are one row for each licence word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm.columns import ascii_lower, packed, unpacked

#: A word is a run of characters other than these; A-Z are lowered before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words, and the phrases in it that must be there word by word."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_places(self) -> list[int]:
        """Positions in the template that belong to a key phrase."""
        places: set[int] = set()
        for key in self.keys:
            phrase = key.split()
            starts = [i for i in range(len(self.words)) if self.words[i : i + len(phrase)] == phrase]
            if not starts:
                raise ValueError(f"{key!r} is not in the template {self.text!r}")
            places.update(range(starts[0], starts[0] + len(phrase)))
        return sorted(places)


# Base phrases with their labels, then notices of further licences.
TEMPLATES = (
    Template("mit", "mit license", ("mit license",), base=True),
    Template("apache", "apache license", ("apache license",), base=True),
    Template("gpl", "general public license", ("general public license",), base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("lgpl-3.0", "gnu lesser general public license version 3", ("lesser general public license", "version 3")),
    Template("agpl-3.0", "gnu affero general public license version 3", ("affero general public license", "version 3")),
    Template("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license", "2 0")),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc0-1.0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("permission is hereby granted free of charge",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify and or distribute",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification", ("redistribution and use in source and binary forms",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)


def words_of(text: Column) -> Column:
    """``split`` of the lowered text; an empty string stands first or last where the text begins or ends otherwise."""
    return F.split(ascii_lower(text), SEPARATORS)


def word_idf(docs: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> dict[str, float]:
    """IDF of every template word over all documents: ``ln((1 + documents) / (1 + documents with it)) + 1``.

    One row for each template word comes to the driver, whatever the number of documents.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    every = F.array(F.lit(""), *[F.lit(w) for w in vocabulary])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    seen = docs.select(words_of(text).alias("words"))
    # the empty string counts the documents
    seen = seen.select(F.explode(F.array_intersect(every, F.array_append("words", F.lit("")))).alias("word"))
    found = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = found.get("", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1 for w in vocabulary}


def postings(templates: tuple[Template, ...], idf: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Rarest key word to its templates and its position in each (ties: the word that comes first)."""
    found: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        place = min(template.key_places, key=lambda i: (-idf[template.words[i]], template.words[i], i))
        found.setdefault(template.words[place], []).append((number, place))
    return found


def _posting(number: int, place: int, template: Template, idf: dict[str, float]) -> Column:
    """A posting as a literal: place of the rare word, key words and all words with their weights, by position."""
    keys = [F.struct(F.lit(i).alias("at"), F.lit(template.words[i]).alias("word")) for i in template.key_places]
    total = sum(idf[w] for w in template.words)
    body = [
        F.struct(F.lit(i).alias("at"), F.lit(w).alias("word"), F.lit(idf[w] / total).alias("weight"))
        for i, w in enumerate(template.words)
    ]
    return F.struct(
        F.lit(number).alias("template"),
        F.lit(template.label).alias("label"),
        F.lit(template.base).alias("base"),
        F.lit(place).alias("place"),
        F.array(*keys).alias("keys"),
        F.array(*body).alias("body"),
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> DataFrame:
    """The input rows with ``n_words``, ``hits``, ``labels`` and ``score``.

    ``hits`` has every place of every template: ``(label, base, start, score)``, start in words from 0. ``labels`` is
    distinct, sorted and comma-joined, empty without hits; ``score`` is the best hit's, 0 without hits. Null and empty
    texts have no words. Rows are independent: repeated rows, ids and null ids stay. Input columns of these four names
    are replaced, all others stay. An empty table gives an empty table. The frequencies are counted when the function
    is called.
    """
    idf = word_idf(docs, templates, text_col)
    index = postings(templates, idf)
    lookup = F.create_map(
        *[
            part
            for word, places in sorted(index.items())
            for part in (F.lit(word), F.array(*[_posting(n, i, templates[n], idf) for n, i in places]))
        ]
    )
    words = F.col("words")

    def stands(entry: Column, start: Column) -> Column:
        return F.coalesce(F.get(words, start + entry["at"]) == entry["word"], F.lit(False))

    def at_place(place: Column) -> Column:
        def hit(posting: Column) -> Column:
            start = place - posting["place"]
            verified = F.forall(posting["keys"], lambda k: stands(k, start))
            share = F.aggregate(posting["body"], F.lit(0.0), lambda s, b: s + F.when(stands(b, start), b["weight"]).otherwise(0.0))
            found = F.struct(
                posting["label"].alias("label"),
                posting["base"].alias("base"),
                (start - F.col("lead")).cast("long").alias("start"),
                F.round(share, 6).alias("score"),
            )
            return F.when(verified, found)

        return F.filter(F.transform(F.element_at(lookup, F.get(words, place)), hit), lambda h: h.isNotNull())

    rows = packed(docs, words=words_of(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    lead = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    rare = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(sorted(index)))
    rows = rows.select("row", "words", lead.alias("lead"), tail.alias("tail"), rare.alias("rare"))
    rows = rows.select(
        "row",
        (F.size(words) - F.col("lead") - F.col("tail")).cast("long").alias("n_words"),
        F.flatten(F.transform("rare", at_place)).alias("hits"),
    )
    return unpacked(
        rows,
        docs.columns,
        n_words=F.col("n_words"),
        hits=F.col("hits"),
        labels=F.array_join(F.array_sort(F.array_distinct("hits.label")), ","),
        score=F.coalesce(F.array_max("hits.score"), F.lit(0.0)),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of every document, with the places of the base phrases."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = found.withColumn("base", F.filter("hits", lambda h: h["base"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        "labels",
        "score",
    )


def _sql(templates: tuple[Template, ...]) -> str:
    """All places of all templates by matching every template word with every text word."""
    rows = ", ".join(
        f"({n}, '{t.label}', {str(t.base).lower()}, {i}, '{w}', {int(i in t.key_places)})"
        for n, t in enumerate(templates)
        for i, w in enumerate(t.words)
    )
    return rf"""
WITH template(t, label, base, pos, word, is_key) AS (VALUES {rows}),
spoken AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM spoken),
licence AS (SELECT * FROM tokens WHERE word IN (SELECT word FROM template)),
often AS (SELECT word, count(DISTINCT doc_id) AS n FROM licence GROUP BY word),
weight AS (
  SELECT t, label, base, pos, template.word, is_key,
         ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(n, 0))) + 1 AS idf
  FROM template LEFT JOIN often USING (word)),
whole AS (SELECT t, sum(idf) AS total, sum(is_key) AS n_keys FROM weight GROUP BY t),
aligned AS (
  SELECT doc_id, t, label, base, place - pos AS start, sum(idf) AS found, sum(is_key) AS n_found
  FROM licence JOIN weight USING (word) GROUP BY ALL),
hits AS (
  SELECT doc_id, label, base, start, round(found / total, 6) AS score
  FROM aligned JOIN whole USING (t) WHERE n_found = n_keys),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
         max(start) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM spoken LEFT JOIN per_doc USING (doc_id)
"""


OP1_SQL = _sql(TEMPLATES)

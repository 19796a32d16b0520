from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cargolens.llm import language_id
from cargolens.llm.columns import ASCII_SPACE
from test_line_dedup import lowered
from test_simhash import brute_groups, brute_print


def brute_after_language(rows, predicted):
    """Documents and texts that line dedup and SimHash leave, from plain Python."""
    kept = [(i, t) for (i, t, *_), (lang, _) in zip(rows, predicted) if lang != "und"]
    seen = Counter()
    for _, text in set(kept):
        seen.update({lowered(x.strip(ASCII_SPACE)) for x in text.split("\n")} - {""})
    cleaned = [(i, "\n".join(x for x in t.split("\n") if seen[lowered(x.strip(ASCII_SPACE))] < 10)) for i, t in kept]
    label = brute_groups([brute_print(t) for _, t in cleaned], 3).tolist()
    best = defaultdict(list)
    for group, (i, text) in zip(label, cleaned):
        best[group].append((i is None, i or 0, text))
    return cleaned, {group: {(None if n else i, t) for n, i, t in own if (n, i) == min(own)[:2]} for group, own in best.items()}


def test_pipeline_against_brute_force(spark, edge_dir, rows):
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    model = language_id.train(language_id.learnable(docs))
    predicted = []
    for _, text, *_ in rows:
        if text is None or not language_id.LETTER.search(text):
            predicted.append(("und", 0.0))
            continue
        total = language_id.lengths(text, model[1], model[2], language_id.ORDER, language_id.SYMBOLS)
        predicted.append((model[0][int(total.argmin())], float(1 / np.exp2(total.min() - total).sum())))
    _, groups = brute_after_language(rows, predicted)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, edge_dir).collect():
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    found = {(doc, b"".join(ids for _, ids in sorted(parts))) for (doc, _), parts in pieces.items()}
    assert len(found) == len(groups)
    for options in groups.values():
        ids = [(i, library.encode(t, add_special_tokens=False).ids + [1]) for i, t in options]
        assert any((i, np.array(x, "<u4").tobytes()) in found for i, x in ids)


def test_stages_keep_the_columns(spark, edge_dir, clashing):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edge_dir).columns == docs.columns
        assert stage(spark, clashing, edge_dir).columns == clashing.columns


def test_language_stage_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.keep_known_languages(spark, docs, folder)
    clean = docs.where(F.length("text") >= 200).count()
    assert kept.where(F.length("text") >= 200).count() >= 0.99 * clean


def test_language_stage_keeps_short_texts_of_every_language(spark):
    """Names that all languages share tell nothing of the language, but are clean."""
    langs = ["de", "en", "es", "fr"]
    shared = ["anna", "otto", "nina", "a"]
    rows = [(4 * i + k, word, lang) for i, word in enumerate(shared * 6) for k, lang in enumerate(langs)]
    rows += [(200, "12 !", "en"), (201, None, "de"), (202, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_known_languages(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == list(range(4 * len(shared) * 6))


def test_empty_table(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)

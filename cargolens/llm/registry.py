"""All queries of the text operators, their SQL where SQL can express them, and the pipeline's."""

from __future__ import annotations

from cargolens.llm import (
    alignment,
    embedding_dedup,
    language_id,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    neural_lm,
    packing,
    ranked_search,
    simhash,
    trie_bpe,
    warc,
)

QUERIES = {
    "op2_warc_derivatives": warc.op2_warc_derivatives,
    "op4_neural_lm": neural_lm.op4_neural_lm,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op3_trie_bpe": trie_bpe.op3_trie_bpe,
    "op8_merkle": merkle.op8_fingerprints,
    "op1_license_scan": license_scan.op1_license_scan,
    "op10_simhash": simhash.op10_simhash,
    "op7_language_id": language_id.op7_language_id,
    "op5_packing": packing.op5_packing,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op13_mixing": mixing.op13_mixing,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_alignment": alignment.op12_alignment,
}
ORACLES = {
    "op2_warc_derivatives": warc.OP2_SQL,
    "op9_embedding_dedup": embedding_dedup.OP9_SQL,
    "op1_license_scan": license_scan.OP1_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op13_mixing": mixing.OP13_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
}

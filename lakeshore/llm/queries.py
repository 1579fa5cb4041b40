"""The queries of this subpackage, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from lakeshore.llm import (bpe, chat, collocations, dac, langid, licenses, mixing, negatives, quality,
                           search, simhash, substrings, vectors)

QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_token_files": dac.op4_token_files,
    "op5_bpe_roundtrip": bpe.op5_bpe_roundtrip,
    "op6_chat_format": chat.op6_chat_format,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_embedding_dedup": vectors.op8_embedding_dedup,
    "op9_source_mix": mixing.op9_source_mix,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_nearest_neighbours": search.op11_nearest_neighbours,
    "op12_collocations": collocations.op12_collocations,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

#: Where SQL can express the result; the others are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": substrings.OP2_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op8_embedding_dedup": vectors.OP8_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}

"""The queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from marquee.llm import (
    decontaminate, licences, packing, quality, resampling, sentence_pieces, sharding, simhash, suffixes, token_counts,
    token_store, vector_codes, warc,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_token_ids": token_store.op3_token_ids,
    "op4_warc": warc.op4_warc,
    "op5_suffix_array": suffixes.op5_suffix_array,
    "op6_sentencepiece": sentence_pieces.op6_sentencepiece,
    "op7_sharding": sharding.op7_sharding,
    "op8_licences": licences.op8_licences,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_packing": packing.op12_packing,
    "op13_resampling": resampling.op13_resampling,
}
ORACLE = {
    "op2_decontaminate": decontaminate.LEAK_SQL,
    "op4_warc": warc.WARC_SQL,
    "op8_licences": licences.LICENCE_SQL,
    "op10_quality_rules": quality.QUALITY_SQL,
    "op11_vector_codes": vector_codes.CODES_SQL,
    "op13_resampling": resampling.RESAMPLING_SQL,
}

"""The registered queries of this package: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from . import (conversations, decontaminate, language, licenses, lines, merkle, near, packing, quality, shards,
               substrings, token_files, topk)

QUERIES = {
    "op1_license_scan": (licenses.op1_license_scan, licenses.OP1_SQL),
    "op2_decontaminate": (decontaminate.op2_decontaminate, decontaminate.OP2_SQL),
    "op10_token_files": (token_files.op10_token_files, None),
    "op4_interleave_shards": (shards.op4_interleave_shards, None),
    "op5_language_id": (language.op5_language_id, None),
    "op7_pack_sequences": (packing.op7_pack_sequences, None),
    "op3_substring_dedup": (substrings.op3_substring_dedup, substrings.OP3_SQL),
    "op6_exact_top_k": (topk.op6_exact_top_k, topk.OP6_SQL),
    "op8_line_dedup": (lines.op8_line_dedup, lines.OP8_SQL),
    "op9_near_duplicates": (near.op9_near_duplicates, None),
    "op11_quality": (quality.op11_quality, None),
    "op12_merkle_manifest": (merkle.op12_merkle_manifest, merkle.OP12_SQL),
    "op13_conversation_repair": (conversations.op13_conversation_repair, conversations.OP13_SQL),
}

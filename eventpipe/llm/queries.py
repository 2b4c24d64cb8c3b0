"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from eventpipe.llm import byte_bpe, chat_format, collocations, decontaminate, language_id, license_scan, line_dedup, minhash, token_counts, topk, toxicity, turn_repair, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_warc": warc.op4_warc,
    "op5_topk": topk.op5_topk,
    "op6_minhash_dedup": minhash.op6_minhash_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_language_id": language_id.op10_language_id,
    "op11_structure_repair": turn_repair.op11_structure_repair,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_collocations": collocations.op13_collocations,
    "language_id_pages": language_id.language_id_pages,
}

ORACLES = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_chat_format": chat_format.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_topk": topk.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op11_structure_repair": turn_repair.ORACLE,
    "op12_license_scan": license_scan.ORACLE,
    "op13_collocations": collocations.ORACLE,
}

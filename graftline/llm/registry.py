"""The queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from . import byte_pairs, exact_dedup, html_text, importance, language_id, license_scan, mixing, near_dedup, sentence_pieces, spelling, spot_signatures, substring_dedup, warc

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_language_id": language_id.op5_language_id,
    "op6_warc": warc.op6_warc,
    "op7_sentencepiece": sentence_pieces.op7_sentencepiece,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_spot_signatures": spot_signatures.op9_spot_signatures,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_spelling": spelling.op11_spelling,
    "op12_byte_bpe": byte_pairs.op12_byte_bpe,
    "op13_importance": importance.op13_importance,
}
ORACLE_SQL = {
    "op4_mixing": mixing.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_spelling": spelling.OP11_SQL,
    "op13_importance": importance.OP13_SQL,
}

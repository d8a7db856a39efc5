"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, langid, linededup, media, neardup, packing, passages, quality, sharding, tokenfile

QUERIES = {
    "op1_language": langid.op1_language,
    "op2_quality": quality.op2_quality,
    "op3_gif": media.op3_gif,
    "op4_bpe": bpe.op4_bpe,
    "op5_tokens": tokenfile.op5_tokens,
    "op6_packing": packing.op6_packing,
    "op7_passages": passages.op7_passages,
    "op8_sharding": sharding.op8_sharding,
    "op9_neardup": neardup.op9_neardup,
    "op10_lines": linededup.op10_lines,
}

ORACLE_SQL = {
    "op2_quality": quality.OP2_SQL,
    "op10_lines": linededup.OP10_SQL,
}

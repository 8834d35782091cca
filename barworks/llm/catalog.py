"""Queries of the text operators, and their SQL where SQL can express them."""

import corpus_pipeline
from barworks.llm import (alignment, bpe, chat, decontaminate, hyperminhash, language, lines, quality, ranked, repeats, simhash,
                          token_counts, topk)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_topk": topk.op2_topk,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_language": language.op5_language,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_chat_format": chat.op7_chat_format,
    "op8_quality": quality.op8_quality,
    "op9_repeats": repeats.op9_repeats,
    "op10_bpe": bpe.op10_bpe,
    "op11_alignment": alignment.op11_alignment,
    "op12_hyperminhash": hyperminhash.op12_hyperminhash,
    "op13_ranked": ranked.op13_ranked,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_topk": topk.OP2_SQL,
    "op7_chat_format": chat.OP7_SQL,
    "op12_hyperminhash": hyperminhash.OP12_SQL,
    "op13_ranked": ranked.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

import corpus_pipeline
from chargepulse.llm import (ann, bpe, chat_format, conversation_repair, embedding_dedup, license_scan, merkle, minhash,
                             mixing, pii, token_files, toxicity, url_filter)

LLM_QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_embedding_near_dedup": embedding_dedup.op2_embedding_near_dedup,
    "op3_ann": ann.op3_ann,
    "op4_chat_formatting": chat_format.op4_chat_formatting,
    "op5_bpe": bpe.op5_bpe,
    "op6_license_scans": license_scan.op6_license_scans,
    "op7_pii": pii.op7_pii,
    "op8_minhash_near_dedup": minhash.op8_minhash_near_dedup,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_merkle": merkle.op11_merkle,
    "op12_token_files": token_files.op12_token_files,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
    "pipeline": corpus_pipeline.run_whole,
}
LLM_ORACLE = {
    "op1_url_filters": url_filter.ORACLE,
    "op2_embedding_near_dedup": embedding_dedup.ORACLE,
    "op4_chat_formatting": chat_format.ORACLE,
    "op6_license_scans": license_scan.ORACLE,
    "op8_minhash_near_dedup": minhash.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from ledgerloom.llm.chunk_bpe import op11_bpe_chunk_reuse
from ledgerloom.llm.chat import OP6_SQL, op6_chat_formatting
from ledgerloom.llm.decontaminate import OP2_SQL, op2_decontamination
from ledgerloom.llm.divergence import OP13_SQL, op13_source_divergence
from ledgerloom.llm.heap_kmeans import OP12_SQL, op12_heap_kmeans
from ledgerloom.llm.html_text import op8_html_extraction
from ledgerloom.llm.language import op5_language_id
from ledgerloom.llm.line_runs import OP10_SQL, op10_line_dedup
from ledgerloom.llm.packing import op9_best_fit_packing
from ledgerloom.llm.simhash import op7_simhash_near_dedup
from ledgerloom.llm.token_files import op4_token_files
from ledgerloom.llm.versions import op3_document_fingerprints
from ledgerloom.llm.wordpiece import op1_token_counts

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_token_files": op4_token_files,
    "op5_language_id": op5_language_id,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_bpe_chunk_reuse": op11_bpe_chunk_reuse,
    "op12_heap_kmeans": op12_heap_kmeans,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op6_chat_formatting": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_heap_kmeans": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}

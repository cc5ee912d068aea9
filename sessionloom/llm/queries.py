"""The training-data queries and their DuckDB SQL."""

from __future__ import annotations

from sessionloom.llm.divergence import OP13_SQL, op13_divergence
from sessionloom.llm.embedding_join import op2_embedding_near_dup
from sessionloom.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from sessionloom.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from sessionloom.llm.html_text import OP8_SQL, op8_html_text
from sessionloom.llm.jaccard_join import op3_jaccard_join
from sessionloom.llm.language_id import op4_language_id
from sessionloom.llm.packing import op10_packing
from sessionloom.llm.quality import op11_quality
from sessionloom.llm.sentencepiece_codec import op1_sentencepiece
from sessionloom.llm.token_counts import op6_token_counts
from sessionloom.llm.url_filter import OP5_SQL, op5_url_filter
from sessionloom.llm.warc_revisits import OP7_SQL, op7_warc_revisits

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_embedding_near_dup": op2_embedding_near_dup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_url_filter": op5_url_filter,
    "op6_token_counts": op6_token_counts,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_html_text": op8_html_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_quality": op11_quality,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_divergence": op13_divergence,
}

ORACLE: dict[str, str] = {
    "op5_url_filter": OP5_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op8_html_text": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_divergence": OP13_SQL,
}

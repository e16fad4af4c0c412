"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from . import ann, bpe, forest, html_text, mixing, near_text, substrings, token_files, toxicity, urls

QUERIES = {"op1_token_files": token_files.op1_token_files, "op2_substring_dedup": substrings.op2_substring_dedup, "op3_html_text": html_text.op3_html_text, "op4_url_filter": urls.op4_url_filter, "op5_near_duplicates": near_text.op5_near_duplicates, "op6_embedding_dedup": forest.op6_embedding_dedup, "op7_toxicity": toxicity.op7_toxicity, "op8_mixing": mixing.op8_mixing, "op9_bpe": bpe.op9_bpe, "op10_nearest_neighbours": ann.op10_nearest_neighbours}
ORACLE_SQL = {"op4_url_filter": urls.OP4_SQL, "op8_mixing": mixing.OP8_SQL}

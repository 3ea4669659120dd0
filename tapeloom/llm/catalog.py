"""The registered queries of this subpackage and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import (
    bitsliced, bpe, decontaminate, htmltext, langid, near, paragraphs, prefixtree, quality, substrings,
    tensored, tokenfile, topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": langid.op1_langid,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_quality": quality.op3_quality,
    "op4_bpe": bpe.op4_bpe,
    "op5_maxscore": topk.op5_maxscore,
    "op6_html": htmltext.op6_html,
    "op7_ngram_join": near.op7_ngram_join,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_paragraph_dedup": paragraphs.op9_paragraph_dedup,
    "op10_tokenfile": tokenfile.op10_tokenfile,
    "op11_lexical_search": bitsliced.op11_lexical_search,
    "op12_prefix_trie": prefixtree.op12_prefix_trie,
    "op13_tensored_dedup": tensored.op13_tensored_dedup,
}

ORACLE: dict[str, str] = {
    "op5_maxscore": topk.ORACLE,
    "op7_ngram_join": near.ORACLE,
    "op9_paragraph_dedup": paragraphs.ORACLE,
    "op11_lexical_search": bitsliced.ORACLE,
    "op12_prefix_trie": prefixtree.ORACLE,
    "op13_tensored_dedup": tensored.ORACLE,
}

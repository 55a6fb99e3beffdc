"""Queries over the corpus tables, and SQL for those that SQL can express."""

from __future__ import annotations

from candlewick.llm import sql
from candlewick.llm.collocations import OP11_SQL, op11_phrase_collocations
from candlewick.llm.divergence import OP12_SQL, op12_source_divergence
from candlewick.llm.jaccard import op5_ngram_jaccard_join
from candlewick.llm.licenses import op6_license_scan
from candlewick.llm.packing import op9_packing
from candlewick.llm.quality import op4_quality_classifier
from candlewick.llm.rules import op7_quality_rules
from candlewick.llm.sentencepiece import op3_sentencepiece
from candlewick.llm.sharding import op13_sharding
from candlewick.llm.suffix_array import op10_suffix_array_dedup
from candlewick.llm.suffix_tree import op2_substring_dedup
from candlewick.llm.topk import OP8_SQL, op8_exact_top_k
from candlewick.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_license_scan": op6_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_packing": op9_packing,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_source_divergence": op12_source_divergence,
    "op13_sharding": op13_sharding,
}

ORACLE_SQL = {
    "op1_warc": OP1_SQL,
    "op2_substring_dedup": sql.SUBSTRING_DEDUP,
    "op5_ngram_jaccard_join": sql.JACCARD_JOIN,
    "op8_exact_top_k": OP8_SQL,
    "op10_suffix_array_dedup": sql.SUFFIX_ARRAY_DEDUP,
    "op11_phrase_collocations": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
}

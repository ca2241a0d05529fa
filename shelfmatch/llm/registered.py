"""The subpackage's registered queries: name -> fn(spark, sf_dir), and their SQL.

Those without SQL (classifiers, packing, tokenisers, rule order, chat templates, sharding)
are checked against brute force in tests/llm.
"""

from __future__ import annotations

from shelfmatch.llm import (chat, classifiers, lexical, mixing, neardup, packing, quality_rules, repair, sentencepieces, sharding, substrings,
                            topk)

QUERIES = {f.__name__: f for f in (
    substrings.op1_substring_dedup, neardup.op2_minhash, packing.op3_best_fit_packing,
    sentencepieces.op4_sentencepiece, classifiers.op5_toxicity, quality_rules.op6_quality_rules,
    chat.op7_chat_formatting, classifiers.op8_quality_classifier, topk.op9_topk_search, sharding.op10_sharding,
    mixing.op11_source_mixing, lexical.op12_lexical_search, repair.op13_structure_repair)}
ORACLES: dict[str, str] = {"op1_substring_dedup": substrings.SQL, "op2_minhash": neardup.SQL, "op9_topk_search": topk.SQL,
                           "op11_source_mixing": mixing.SQL, "op12_lexical_search": lexical.SQL, "op13_structure_repair": repair.SQL}

"""Registered queries of the training-data operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logbrook.llm.chat import OP9_SQL, op9_chat_formatting
from logbrook.llm.collocations import OP13_SQL, op13_phrase_collocations
from logbrook.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from logbrook.llm.lm import op10_lm_scoring
from logbrook.llm.mixing import OP5_SQL, op5_mixing
from logbrook.llm.ordinal import op7_quality_classifier
from logbrook.llm.packing import op6_packing
from logbrook.llm.personal_data import op12_personal_data
from logbrook.llm.quality_rules import OP8_SQL, op8_quality_rules
from logbrook.llm.sharding import op3_sharding
from logbrook.llm.simhash import op4_simhash_near_dedup
from logbrook.llm.suffix_array import op1_suffix_array_dedup
from logbrook.llm.topk import OP2_SQL, op2_topk_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_suffix_array_dedup,
        op2_topk_search,
        op3_sharding,
        op4_simhash_near_dedup,
        op5_mixing,
        op6_packing,
        op7_quality_classifier,
        op8_quality_rules,
        op9_chat_formatting,
        op10_lm_scoring,
        op11_conversation_repair,
        op12_personal_data,
        op13_phrase_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op2_topk_search": OP2_SQL,
    "op5_mixing": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_phrase_collocations": OP13_SQL,
}

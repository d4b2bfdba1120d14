"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.bpe import op1_byte_bpe
from marquee.llm.exact import OP9_SQL, op9_exact_dedup
from marquee.llm.lm_scoring import OP2_SQL, op2_lm_scoring
from marquee.llm.mixing import OP10_SQL, op10_mixing
from marquee.llm.near_dedup import OP5_SQL, op5_near_dedup
from marquee.llm.packing import op13_packing
from marquee.llm.periodic import op11_periodic_runs
from marquee.llm.prefix_trie import op12_prefix_trie
from marquee.llm.quality import op7_quality
from marquee.llm.secret_scan import OP4_SQL, op4_secret_scan
from marquee.llm.substring import OP6_SQL, op6_substring_dedup
from marquee.llm.toxicity import op3_toxicity
from marquee.llm.vectors import op8_vector_dedup

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_near_dedup": op5_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality": op7_quality,
    "op8_vector_dedup": op8_vector_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_packing": op13_packing,
}

LLM_SQL: dict[str, str] = {
    "op2_lm_scoring": OP2_SQL,
    "op4_secret_scan": OP4_SQL,
    "op5_near_dedup": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_mixing": OP10_SQL,
}

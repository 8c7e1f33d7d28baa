"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from llm.conversation_repair import OP13_SQL, op13_conversation_repair
from llm.decontaminate import OP7_SQL, op7_decontaminate
from llm.hard_negatives import OP12_SQL, op12_hard_negatives
from llm.minhash import OP9_SQL, op9_near_dedup
from llm.mixing import OP8_SQL, op8_mix
from llm.quality_classifier import op3_quality_classifier
from llm.repeated_bytes import OP4_SQL, op4_repeated_bytes
from llm.quality_rules import OP10_SQL, op10_quality_rules
from llm.simhash import op11_simhash_pivots
from llm.substring_dedup import op2_substring_dedup
from llm.toxicity import op5_toxicity
from llm.url_filter import OP1_SQL, op1_url_filter
from llm.warc import OP6_SQL, op6_warc


def queries() -> dict:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_repeated_bytes": op4_repeated_bytes,
        "op5_toxicity": op5_toxicity,
        "op6_warc": op6_warc,
        "op7_decontaminate": op7_decontaminate,
        "op8_mix": op8_mix,
        "op9_near_dedup": op9_near_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_simhash_pivots": op11_simhash_pivots,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op4_repeated_bytes": OP4_SQL, "op6_warc": OP6_SQL, "op7_decontaminate": OP7_SQL, "op8_mix": OP8_SQL, "op9_near_dedup": OP9_SQL, "op10_quality_rules": OP10_SQL, "op12_hard_negatives": OP12_SQL, "op13_conversation_repair": OP13_SQL}

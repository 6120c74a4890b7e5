"""The registered queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from llm import conversations, lines, mixing, preferences, spelling, substrings, vectors
from llm.conversations import op11_conversation_repair
from llm.extract import op9_main_text
from llm.lines import op5_line_dedup
from llm.minhash import op10_near_duplicates
from llm.mixing import op7_mixing
from llm.packing import op4_packing
from llm.preferences import op1_preference_format
from llm.quality import op3_quality_rules
from llm.spelling import op13_spelling_variants
from llm.substrings import op12_substring_dedup
from llm.toxicity import op8_toxicity
from llm.vectors import op6_embedding_links
from llm.warc import op2_warc_derivatives

QUERIES = {
    "op1_preference_format": op1_preference_format,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_quality_rules": op3_quality_rules,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_links": op6_embedding_links,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_main_text": op9_main_text,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES: dict[str, str] = {
    "op1_preference_format": preferences.ORACLE,
    "op5_line_dedup": lines.ORACLE,
    "op6_embedding_links": vectors.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op11_conversation_repair": conversations.ORACLE,
    "op12_substring_dedup": substrings.ORACLE,
    "op13_spelling_variants": spelling.ORACLE,
}

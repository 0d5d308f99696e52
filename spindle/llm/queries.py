"""Registry of the training-data queries and their DuckDB twins."""

from __future__ import annotations

from spindle.llm.chunks import op10_chunks
from spindle.llm.conversations import OP13_SQL, op13_conversations
from spindle.llm.decontaminate import OP2_SQL, op2_decontaminate
from spindle.llm.html import op5_html
from spindle.llm.mix import OP9_SQL, op9_mix
from spindle.llm.neardup import OP3_SQL, op3_neardup
from spindle.llm.packing import op11_packing
from spindle.llm.quality import OP6_SQL, op6_quality
from spindle.llm.search import OP12_SQL, op12_search
from spindle.llm.secrets import OP8_SQL, op8_secrets
from spindle.llm.suffixes import op1_suffixes
from spindle.llm.toxicity import op4_toxicity
from spindle.llm.urls import OP7_SQL, op7_urls

QUERIES = {
    "op1_suffixes": op1_suffixes,
    "op2_decontaminate": op2_decontaminate,
    "op3_neardup": op3_neardup,
    "op4_toxicity": op4_toxicity,
    "op5_html": op5_html,
    "op6_quality": op6_quality,
    "op7_urls": op7_urls,
    "op8_secrets": op8_secrets,
    "op9_mix": op9_mix,
    "op10_chunks": op10_chunks,
    "op11_packing": op11_packing,
    "op12_search": op12_search,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL = {
    "op2_decontaminate": OP2_SQL,
    "op3_neardup": OP3_SQL,
    "op6_quality": OP6_SQL,
    "op7_urls": OP7_SQL,
    "op8_secrets": OP8_SQL,
    "op9_mix": OP9_SQL,
    "op12_search": OP12_SQL,
    "op13_conversations": OP13_SQL,
}

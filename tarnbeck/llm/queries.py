"""The queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tarnbeck.llm.alignment import op11_alignment
from tarnbeck.llm.bitsliced import OP13_SQL, op13_topk
from tarnbeck.llm.decontaminate import op5_decontaminate
from tarnbeck.llm.language import op1_language
from tarnbeck.llm.mixing import op3_mixing
from tarnbeck.llm.neighbours import op2_neighbours
from tarnbeck.llm.quality import op7_quality
from tarnbeck.llm.runs import OP12_SQL, op12_runs
from tarnbeck.llm.simhash import op8_simhash
from tarnbeck.llm.suffixes import OP10_SQL, op10_suffixes
from tarnbeck.llm.toxicity import op9_toxicity
from tarnbeck.llm.urls import op4_urls
from tarnbeck.llm.windows import OP6_SQL, op6_windows

QUERIES = {
    "op1_language": op1_language,
    "op2_neighbours": op2_neighbours,
    "op3_mixing": op3_mixing,
    "op4_urls": op4_urls,
    "op5_decontaminate": op5_decontaminate,
    "op6_windows": op6_windows,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_suffixes": op10_suffixes,
    "op11_alignment": op11_alignment,
    "op12_runs": op12_runs,
    "op13_topk": op13_topk,
}

ORACLE_SQL: dict[str, str] = {
    "op6_windows": OP6_SQL,
    "op10_suffixes": OP10_SQL,
    "op12_runs": OP12_SQL,
    "op13_topk": OP13_SQL,
}

"""Registered queries of this subpackage; their SQL is in ``sql``."""

from headroom.llm.ann import op9_neighbours
from headroom.llm.brown import op2_brown_lm
from headroom.llm.decontam import op10_decontamination
from headroom.llm.html import op5_main_text
from headroom.llm.langid import op1_language_id
from headroom.llm.mixing import op7_mixing
from headroom.llm.phrases import op12_collocations
from headroom.llm.quality import op8_quality
from headroom.llm.secrets import op11_secrets
from headroom.llm.setjoin import op6_jaccard_join
from headroom.llm.sql import ORACLE_SQL
from headroom.llm.toxicity import op3_toxicity
from headroom.llm.trie import op13_prefix_trie
from headroom.llm.warc import op4_warc

QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_brown_lm, op3_toxicity, op4_warc, op5_main_text, op6_jaccard_join, op7_mixing, op8_quality,
    op9_neighbours, op10_decontamination, op11_secrets, op12_collocations, op13_prefix_trie)}

__all__ = ["ORACLE_SQL", "QUERIES"]

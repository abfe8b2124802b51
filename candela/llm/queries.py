"""Registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

from candela.llm import oracle
from candela.llm.automaton import op8_suffix_automata
from candela.llm.bpe import op2_byte_bpe
from candela.llm.decontaminate import op6_decontamination
from candela.llm.hard_negatives import op11_hard_negatives
from candela.llm.lexical_search import op13_lexical_search
from candela.llm.mixture import op12_mixture
from candela.llm.near_dup import op3_near_dup
from candela.llm.pii import op9_pii
from candela.llm.pitman_yor import op1_pitman_yor
from candela.llm.quality import op7_quality_rules
from candela.llm.sequences import op4_token_files
from candela.llm.suffix_sort import op10_suffix_sort
from candela.llm.warc import op5_warc

QUERIES = {
    "op1_pitman_yor": op1_pitman_yor,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_near_dup": op3_near_dup,
    "op4_token_files": op4_token_files,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_automata": op8_suffix_automata,
    "op9_pii": op9_pii,
    "op10_suffix_sort": op10_suffix_sort,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_mixture": op12_mixture,
    "op13_lexical_search": op13_lexical_search,
}
#: The others' results are no SQL: token ids, sampled scores, tilings, spans in code points, bytes, draws.
ORACLE = {
    "op3_near_dup": oracle.OP3,
    "op5_warc": oracle.OP5,
    "op7_quality_rules": oracle.OP7,
    "op8_suffix_automata": oracle.OP8,
    "op11_hard_negatives": oracle.OP11,
    "op13_lexical_search": oracle.OP13,
}

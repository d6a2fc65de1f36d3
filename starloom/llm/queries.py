"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from starloom.llm.jaccard_join import op10_ngram_jaccard_join
from starloom.llm.language_model import op8_lm_scoring
from starloom.llm.lexical_search import OP12_SQL, op12_lexical_search
from starloom.llm.mixing import OP5_SQL, op5_mixing
from starloom.llm.packing import op2_packing
from starloom.llm.passage_dedup import op9_substring_dedup
from starloom.llm.periodic_runs import op11_periodic_runs
from starloom.llm.pseudonyms import op3_pii
from starloom.llm.quality import OP1_SQL, op1_quality_rules
from starloom.llm.quality_classifier import op13_quality_classifier
from starloom.llm.repeated_text import op7_suffix_array_dedup
from starloom.llm.token_counts import op6_token_counts
from starloom.llm.vector_dedup import OP4_SQL, op4_embedding_near_dedup

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_quality_classifier": op13_quality_classifier,
}
QUERIES["pipeline"] = corpus_pipeline.run

SQL: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op4_embedding_near_dedup": OP4_SQL,
    "op5_mixing": OP5_SQL,
    "op12_lexical_search": OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

"""Registry of the corpus operators' queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from strata.llm import sql
from strata.llm.alignment import op12_align
from strata.llm.jaccard import op7_jaccard
from strata.llm.language import op5_language
from strata.llm.lines import op6_lines
from strata.llm.mixing import op10_mix
from strata.llm.packing import op2_pack
from strata.llm.quality import op8_quality
from strata.llm.ranking import SQL as RANK_SQL, op11_rank
from strata.llm.secrets import op1_secrets
from strata.llm.sharding import op4_shards
from strata.llm.substrings import op3_substrings
from strata.llm.toxicity import op13_toxicity
from strata.llm.vectors import op9_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_pack": op2_pack,
    "op3_substrings": op3_substrings,
    "op4_shards": op4_shards,
    "op5_language": op5_language,
    "op6_lines": op6_lines,
    "op7_jaccard": op7_jaccard,
    "op8_quality": op8_quality,
    "op9_vectors": op9_vectors,
    "op10_mix": op10_mix,
    "op11_rank": op11_rank,
    "op12_align": op12_align,
    "op13_toxicity": op13_toxicity,
    "pipeline": corpus_pipeline.run,
}

#: Queries whose rows SQL can state.
ORACLE_SQL: dict[str, str] = {
    "op3_substrings": sql.SUBSTRINGS,
    "op6_lines": sql.LINES,
    "op7_jaccard": sql.JACCARD,
    "op9_vectors": sql.VECTORS,
    "op11_rank": RANK_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

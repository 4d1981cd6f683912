"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from tessera.llm.op1_mixing import OP1_SQL, op1_mixing
from tessera.llm.op2_jaccard import OP2_SQL, op2_jaccard
from tessera.llm.op3_sharding import op3_sharding
from tessera.llm.op4_urls import OP4_SQL, op4_urls
from tessera.llm.op5_licenses import OP5_SQL, op5_licenses
from tessera.llm.op6_substrings import OP6_SQL, op6_substrings
from tessera.llm.op7_toxicity import op7_toxicity
from tessera.llm.op8_quality import op8_quality
from tessera.llm.op9_decontaminate import OP9_SQL, op9_decontaminate
from tessera.llm.op10_topk import OP10_SQL, op10_topk

QUERIES = {f.__name__: f for f in (op1_mixing, op2_jaccard, op3_sharding, op4_urls, op5_licenses, op6_substrings, op7_toxicity, op8_quality, op9_decontaminate, op10_topk)}

ORACLE_SQL = {"op1_mixing": OP1_SQL, "op2_jaccard": OP2_SQL, "op4_urls": OP4_SQL, "op5_licenses": OP5_SQL, "op6_substrings": OP6_SQL, "op9_decontaminate": OP9_SQL, "op10_topk": OP10_SQL}

"""Driver queries of the corpus operators, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import op1_bpe
from tessera.llm.contamination import OP7_SQL, op7_contamination
from tessera.llm.exact import OP10_SQL, op10_exact
from tessera.llm.html import op3_html
from tessera.llm.jaccard import OP2_SQL, op2_jaccard
from tessera.llm.langid import op8_langid
from tessera.llm.lmscore import op4_lmscore
from tessera.llm.negatives import OP11_SQL, op11_negatives
from tessera.llm.pii import op6_pii
from tessera.llm.secrets import op5_secrets
from tessera.llm.tokenbin import op13_tokenbin
from tessera.llm.toxicity import op9_toxicity
from tessera.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_html": op3_html,
    "op4_lmscore": op4_lmscore,
    "op5_secrets": op5_secrets,
    "op6_pii": op6_pii,
    "op7_contamination": op7_contamination,
    "op8_langid": op8_langid,
    "op9_toxicity": op9_toxicity,
    "op10_exact": op10_exact,
    "op11_negatives": op11_negatives,
    "op12_whitening": op12_whitening,
    "op13_tokenbin": op13_tokenbin,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard": OP2_SQL,
    "op7_contamination": OP7_SQL,
    "op10_exact": OP10_SQL,
    "op11_negatives": OP11_SQL,
}

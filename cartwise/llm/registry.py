"""Queries of the operators in this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cartwise.llm.ann import op1_ann
from cartwise.llm.bm25 import op3_bm25
from cartwise.llm.chat import OP11_SQL, op11_chat
from cartwise.llm.common import ship
from cartwise.llm.jaccard import OP8_SQL, op8_jaccard
from cartwise.llm.mixing import OP7_SQL, op7_mixing
from cartwise.llm.negatives import OP13_SQL, op13_negatives
from cartwise.llm.pieces import op9_pieces
from cartwise.llm.repair import op12_repair
from cartwise.llm.secrets import op10_secrets
from cartwise.llm.substrings import OP6_SQL, op6_substrings
from cartwise.llm.suffixes import op5_suffixes
from cartwise.llm.toxicity import op4_toxicity
from cartwise.llm.warc import OP2_SQL, op2_warc

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    """The query, with this package on the executors."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_ann": op1_ann,
    "op2_warc": op2_warc,
    "op3_bm25": op3_bm25,
    "op4_toxicity": op4_toxicity,
    "op5_suffixes": op5_suffixes,
    "op6_substrings": op6_substrings,
    "op7_mixing": op7_mixing,
    "op8_jaccard": op8_jaccard,
    "op9_pieces": op9_pieces,
    "op10_secrets": op10_secrets,
    "op11_chat": op11_chat,
    "op12_repair": op12_repair,
    "op13_negatives": op13_negatives,
    "pipeline": corpus_pipeline.run,
}
QUERIES = {name: _shipped(query) for name, query in _QUERIES.items()}

ORACLES: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op6_substrings": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op8_jaccard": OP8_SQL,
    "op11_chat": OP11_SQL,
    "op13_negatives": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

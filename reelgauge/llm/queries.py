"""Registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from reelgauge.llm import oracle
from reelgauge.llm.embeddings import op9_embedding_near_dedup
from reelgauge.llm.fuzzy_lines import op4_fuzzy_lines
from reelgauge.llm.language_id import op2_language_id
from reelgauge.llm.licences import op10_licence_scan
from reelgauge.llm.mixing import op6_source_mixing
from reelgauge.llm.neighbours import op13_nearest_neighbours
from reelgauge.llm.packing import op8_packing
from reelgauge.llm.prefix_trie import op11_prefix_trie
from reelgauge.llm.quality import op5_quality_rules
from reelgauge.llm.shared import reachable
from reelgauge.llm.simhash import op3_simhash
from reelgauge.llm.spelling import op12_spelling_variants
from reelgauge.llm.token_files import op1_token_files
from reelgauge.llm.warc import op7_warc

Query = Callable[[SparkSession, str], DataFrame]


def _query(function: Query) -> Query:
    return lambda spark, sf_dir: function(reachable(spark), sf_dir)


QUERIES: dict[str, Query] = {
    function.__name__: _query(function)
    for function in (
        op1_token_files,
        op2_language_id,
        op3_simhash,
        op4_fuzzy_lines,
        op5_quality_rules,
        op6_source_mixing,
        op7_warc,
        op8_packing,
        op9_embedding_near_dedup,
        op10_licence_scan,
        op11_prefix_trie,
        op12_spelling_variants,
        op13_nearest_neighbours,
    )
} | {"pipeline": _query(corpus_pipeline.run)}

ORACLE: dict[str, str] = {
    **oracle.ORACLE,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}

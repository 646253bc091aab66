"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfcast.llm import mixing, quality, resampling, warc
from shelfcast.llm.alignment import op13_tokenizer_alignment
from shelfcast.llm.ann import op10_inverted_multi_index
from shelfcast.llm.common import prepared
from shelfcast.llm.content import op12_html_extraction
from shelfcast.llm.jaccard_join import op6_jaccard_join
from shelfcast.llm.language import op3_language_id
from shelfcast.llm.lattice import op2_lattice_near_dup
from shelfcast.llm.licences import op7_licence_scan
from shelfcast.llm.mixing import op5_mixing
from shelfcast.llm.packing import op8_best_fit_packing
from shelfcast.llm.pii import op9_personal_data
from shelfcast.llm.quality import op4_quality_classifier
from shelfcast.llm.resampling import op11_importance_resampling
from shelfcast.llm.warc import op1_warc_derivatives

Query = Callable[[SparkSession, str], DataFrame]

_FUNCTIONS: tuple[Query, ...] = (
    op1_warc_derivatives,
    op2_lattice_near_dup,
    op3_language_id,
    op4_quality_classifier,
    op5_mixing,
    op6_jaccard_join,
    op7_licence_scan,
    op8_best_fit_packing,
    op9_personal_data,
    op10_inverted_multi_index,
    op11_importance_resampling,
    op12_html_extraction,
    op13_tokenizer_alignment,
)


def _tuned(fn: Query) -> Query:
    return lambda spark, sf_dir: fn(prepared(spark), sf_dir)


QUERIES: dict[str, Query] = {fn.__name__: _tuned(fn) for fn in _FUNCTIONS} | {"pipeline": corpus_pipeline.run}
# The other operators have no SQL; tests/llm compares them with brute force, held-out labels or exact round trips.
ORACLES: dict[str, str] = {
    "op1_warc_derivatives": warc.SQL,
    "op4_quality_classifier": quality.SQL,
    "op5_mixing": mixing.SQL,
    "op11_importance_resampling": resampling.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattlake.llm import (bpe, convnet, jaccard, lexical, licences, nearest, negatives, oracles, packing, pages, quality,
                          repeats, sharding, wordpiece)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licences": licences.op1_licences,
    "op2_bpe": bpe.op2_bpe,
    "op3_quality": quality.op3_quality,
    "op4_pages": pages.op4_pages,
    "op5_nearest": nearest.op5_nearest,
    "op6_repeats": repeats.op6_repeats,
    "op7_sharding": sharding.op7_sharding,
    "op8_jaccard": jaccard.op8_jaccard,
    "op9_packing": packing.op9_packing,
    "op10_wordpiece": wordpiece.op10_wordpiece,
    "op11_lexical": lexical.op11_lexical,
    "op12_convnet": convnet.op12_convnet,
    "op13_negatives": negatives.op13_negatives,
}
ORACLES: dict[str, str] = {"op6_repeats": oracles.REPEATS, "op8_jaccard": oracles.JACCARD,
                           "op11_lexical": oracles.LEXICAL, "op13_negatives": oracles.NEGATIVES}

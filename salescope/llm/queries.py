"""Registered queries of this package and their oracle SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (conversation_repair, cover_tree, debruijn_dedup, jaccard_join, langid, learned_ann, mixing, packing,
               secret_crf, sharding, spelling_variants, token_output, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.query,
    "op2_packing": packing.query,
    "op3_learned_ann": learned_ann.query,
    "op4_token_output": token_output.query,
    "op5_debruijn_dedup": debruijn_dedup.query,
    "op6_cover_tree": cover_tree.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_mixing": mixing.query,
    "op9_secret_crf": secret_crf.query,
    "op10_langid": langid.query,
    "op11_spelling_variants": spelling_variants.query,
    "op12_url_filter": url_filter.query,
    "op13_conversation_repair": conversation_repair.query,
}
SQL: dict[str, str] = {
    "op5_debruijn_dedup": debruijn_dedup.SQL,
    "op6_cover_tree": cover_tree.SQL,
    "op7_jaccard_join": jaccard_join.SQL,
    "op8_mixing": mixing.SQL,
    "op11_spelling_variants": spelling_variants.SQL,
    "op12_url_filter": url_filter.SQL,
}

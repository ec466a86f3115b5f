"""Registry of the corpus operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from urbanframe.llm.collocations import OP11_SQL, op11_phrases
from urbanframe.llm.decontaminate import OP12_SQL, op12_leaks
from urbanframe.llm.digest import OP9_SQL, op9_digest
from urbanframe.llm.jaccard import OP4_SQL, op4_jaccard
from urbanframe.llm.language import op3_language
from urbanframe.llm.media import op10_media
from urbanframe.llm.merkle import OP13_SQL, op13_manifest
from urbanframe.llm.mixing import OP1_SQL, op1_mix
from urbanframe.llm.pieces import op2_pieces
from urbanframe.llm.quality import op6_quality
from urbanframe.llm.repeats import OP8_SQL, op8_repeats
from urbanframe.llm.sharding import OP7_SQL, op7_shard
from urbanframe.llm.toxicity import op5_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix": op1_mix,
        "op2_pieces": op2_pieces,
        "op3_language": op3_language,
        "op4_jaccard": op4_jaccard,
        "op5_toxicity": op5_toxicity,
        "op6_quality": op6_quality,
        "op7_shard": op7_shard,
        "op8_repeats": op8_repeats,
        "op9_digest": op9_digest,
        "op10_media": op10_media,
        "op11_phrases": op11_phrases,
        "op12_leaks": op12_leaks,
        "op13_manifest": op13_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": OP1_SQL, "op4_jaccard": OP4_SQL, "op7_shard": OP7_SQL, "op8_repeats": OP8_SQL, "op9_digest": OP9_SQL, "op11_phrases": OP11_SQL, "op12_leaks": OP12_SQL, "op13_manifest": OP13_SQL}

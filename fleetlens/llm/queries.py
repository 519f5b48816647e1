"""The queries of this package by name, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import chat, decontaminate, near_duplicates, nearest_codes, substring_dedup, vector_codes
from fleetlens.llm.chat import op3_chat
from fleetlens.llm.decontaminate import op10_decontamination
from fleetlens.llm.near_duplicates import op2_near_duplicates
from fleetlens.llm.nearest_codes import op9_nearest_codes
from fleetlens.llm.packing import op7_packing
from fleetlens.llm.quality import op8_quality
from fleetlens.llm.secrets import op1_secret_scans
from fleetlens.llm.sharding import op11_hilbert_shards
from fleetlens.llm.substring_dedup import op6_substring_dedup
from fleetlens.llm.token_counts import op5_token_counts
from fleetlens.llm.toxicity import op4_toxicity
from fleetlens.llm.vector_codes import op13_vector_codes
from fleetlens.llm.whitening import op12_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_secret_scans, op2_near_duplicates, op3_chat, op4_toxicity, op5_token_counts, op6_substring_dedup, op7_packing,
        op8_quality, op9_nearest_codes, op10_decontamination, op11_hilbert_shards, op12_embedding_whitening,
        op13_vector_codes,
    )
}
ORACLES: dict[str, str] = {
    "op2_near_duplicates": near_duplicates.ORACLE,
    "op3_chat": chat.ORACLE,
    "op6_substring_dedup": substring_dedup.ORACLE,
    "op9_nearest_codes": nearest_codes.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}

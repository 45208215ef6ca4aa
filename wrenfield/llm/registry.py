"""Queries of the training-data operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, collocations, decontaminate, html_text, near_dedup, ogg, packing, quality, runs, suffix_dedup, toxicity, url_reputation, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": url_reputation.op1_url_reputation,
    "op2_warc": warc.op2_warc,
    "op3_html_text": html_text.op3_html_text,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_ogg_media": ogg.op8_ogg_media,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_quality": quality.op12_quality,
    "op13_collocations": collocations.op13_collocations,
}
SQL: dict[str, str] = {"op1_url_reputation": url_reputation.SQL, "op7_chat_format": chat_format.SQL, "op13_collocations": collocations.SQL}

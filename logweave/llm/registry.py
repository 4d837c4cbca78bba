"""Queries and SQL of the subpackage, gathered for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import annulus_clustering, best_fit_packing, decontamination, filter_audit, html_extraction, lm_scoring, mixing, near_dedup, pii, quality_classifier, quality_rules, toxicity, url_filter

MODULES = (quality_rules, decontamination, near_dedup, mixing, pii, lm_scoring, quality_classifier, toxicity, url_filter, html_extraction, best_fit_packing, filter_audit, annulus_clustering)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}

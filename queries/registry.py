"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from queries import views as v

FAMILIES = ["profiling", "text", "vectors", "outliers", "tabular"]


def queries() -> dict:
    return {k: q for family in FAMILIES for k, q in import_module(f"queries.{family}").family.queries.items()}


def oracle_sql() -> dict:
    return {k: q for family in FAMILIES for k, q in import_module(f"queries.{family}").family.oracles.items()}


def flagship(spark, sf_dir):
    from textlab.plans.retrieval import retrieve

    question = "What are the main risk factors for the business?"
    found = retrieve(v.sentences(spark, sf_dir), v.sections(spark), question, 10)
    return found.select("chunk_id", "company", "section_name", "priority", "char_count", "score")

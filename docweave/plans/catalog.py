"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from docweave.plans import q_assemble, q_crawl, q_functions, q_harvest, q_spec, q_stream  # noqa: F401
from docweave.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "flagship"]


def flagship(spark, sf_dir):
    """Flagship: per-domain manifest of the file-per-domain sink."""
    return QUERIES["domain_manifest"](spark, sf_dir)

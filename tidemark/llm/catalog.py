"""All registered queries of the corpus operators."""

from . import (  # noqa: F401
    ann_queries, archive_queries, contamination_queries, dedup_queries, license_queries, quality_queries, run_queries, secret_queries, substring_queries,
    token_queries, url_queries, whitening_queries)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import leakage_queries, mixing_queries, neardup_queries, packing_queries, pair_queries, quality_queries

MODULES = [pair_queries, mixing_queries, neardup_queries, packing_queries, leakage_queries, quality_queries]

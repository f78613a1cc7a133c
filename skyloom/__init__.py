"""Skyloom: sky-catalogue queries, cleaning and loads as Spark DataFrame jobs."""

from skyloom.operators.query import CatalogQuery, run_spec
from skyloom.sources.catalog import Catalog

__all__ = ["Catalog", "CatalogQuery", "run_spec"]

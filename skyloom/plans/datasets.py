"""The named datasets: fixed columns and conditions over the catalogue tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from skyloom import vocab
from skyloom.operators.query import CatalogQuery
from skyloom.sources.catalog import Catalog


def _planets(catalog: Catalog) -> CatalogQuery:
    return catalog.query().select(vocab.PLANET_COLUMNS).from_table(vocab.PLANETS)


def confirmed_planets(
    catalog: Catalog, limit: int | None = None, filters: Mapping[str, Any] | None = None
) -> DataFrame:
    """Default solutions of confirmed planets."""
    query = _planets(catalog).where_confirmed().where_default_flag().where_filters(filters)
    return query.limit(limit).to_df()


def candidate_planets(
    catalog: Catalog, limit: int | None = None, filters: Mapping[str, Any] | None = None
) -> DataFrame:
    """All solutions of candidate planets."""
    return _planets(catalog).where_candidates().where_filters(filters).limit(limit).to_df()


def planets_with_mass(
    catalog: Catalog,
    min_mass: float = 0.0,
    max_mass: float | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Default solutions with a mass, within a range; a largest mass of 0 means no bound."""
    query = _planets(catalog).where_has_mass().where_default_flag()
    if min_mass > 0:
        query = query.where_at_least("pl_masse", min_mass)
    if max_mass:
        query = query.where_at_most("pl_masse", max_mass)
    return query.limit(limit).to_df()


def systems_overview(catalog: Catalog, limit: int | None = None) -> DataFrame:
    """Distinct descriptions of planetary systems."""
    query = catalog.query().distinct(vocab.SYSTEM_COLUMNS).from_table(vocab.PLANETS)
    return query.where_default_flag().limit(limit).to_df()


def tess_candidates(
    catalog: Catalog, disposition: str | None = None, limit: int | None = None
) -> DataFrame:
    query = catalog.query().select(vocab.TESS_COLUMNS).from_table(vocab.TOI)
    if disposition:
        query = query.where_equal("tfopwg_disp", disposition)
    return query.limit(limit).to_df()


def kepler_objects(
    catalog: Catalog, disposition: str | None = None, limit: int | None = None
) -> DataFrame:
    query = catalog.query().select(vocab.KEPLER_COLUMNS).from_table(vocab.KOI)
    if disposition:
        query = query.where_equal("koi_disposition", disposition)
    return query.limit(limit).to_df()


def microlensing_events(catalog: Catalog, limit: int | None = None) -> DataFrame:
    query = catalog.query().select(vocab.MICROLENSING_COLUMNS).from_table(vocab.MICROLENSING)
    return query.limit(limit).to_df()


# Datasets by group; each is a function of a catalog.
GROUPS: dict[str, tuple[Callable[..., DataFrame], ...]] = {
    "exoplanets": (confirmed_planets, candidate_planets, planets_with_mass),
    "planetary_systems": (systems_overview,),
    "tess_data": (tess_candidates,),
    "kepler_data": (kepler_objects,),
    "microlensing_data": (microlensing_events,),
}


def dataset_group(catalog: Catalog, group: str) -> dict[str, DataFrame]:
    """The DataFrames of a group by dataset name."""
    return {build.__name__: build(catalog) for build in GROUPS[group]}

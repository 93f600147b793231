"""All registered queries. Importing the catalog modules registers them."""

from larder.plans import catalog_files, catalog_linear, catalog_models, catalog_series, catalog_tables  # noqa: F401
from larder.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

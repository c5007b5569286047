"""All queries. Importing the modules registers them."""

from tributary.plans import catalog_delivery, catalog_fields, catalog_files, catalog_flow, catalog_order  # noqa: F401
from tributary.plans.registry import REGISTRY, Query, Tables, jobs, sql_texts  # noqa: F401

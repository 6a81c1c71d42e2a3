"""Sources and sinks: star-schema schemas, readers, writers and report views."""

from starlens.sources.schemas import DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SALES
from starlens.sources.publish import publish, published, remove_superseded
from starlens.sources.sinks import (
    drop_report,
    drop_view,
    materialize,
    publish_report,
    read_materialized,
    register,
)
from starlens.sources.star import Star, read_star, star_from_tables, write_star

__all__ = [
    "DIM_CUSTOMERS",
    "DIM_PRODUCTS",
    "FACT_SALES",
    "Star",
    "drop_report",
    "drop_view",
    "materialize",
    "publish",
    "publish_report",
    "published",
    "read_materialized",
    "read_star",
    "register",
    "remove_superseded",
    "star_from_tables",
    "write_star",
]

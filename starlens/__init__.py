"""starlens: sales analytics over a star schema, expressed as Spark DataFrame plans.

One fact table (``fact_sales``) and two dimensions (``dim_products``,
``dim_customers``). Every operator is a plain ``DataFrame -> DataFrame``
function built from built-in Spark expressions, so Catalyst can prune
columns, push filters into the Parquet scan and plan partial aggregation.

Layout:

- ``starlens.sources``    star-schema schemas, readers, writers, views
- ``starlens.functions``  column expressions with the reference's SQL semantics
- ``starlens.operators``  trend, running totals, benchmarks, segmentation,
                          contribution, reports
- ``starlens.plans``      the registered query catalog and plan inspection
"""

from starlens.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
__version__ = "0.1.0"

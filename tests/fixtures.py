"""Hand-written micro-fixtures (FIXTURES.md section 3) as star-schema DataFrames."""

from __future__ import annotations

import datetime as dt

from starlens.sources.schemas import DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SALES
from starlens.sources.star import Star


def d(s: str | None) -> dt.date | None:
    return None if s is None else dt.date.fromisoformat(s)


def _rows(schema, rows):
    names = schema.fieldNames()
    out = []
    for r in rows:
        unknown = set(r) - set(names)
        assert not unknown, unknown
        out.append(tuple(r.get(n) for n in names))
    return out


def fact(spark, rows):
    """Fact rows as dicts; dates as ISO strings; missing columns are NULL."""
    conv = []
    for r in rows:
        r = dict(r)
        for k in ("order_date", "shipping_date"):
            if k in r:
                r[k] = d(r[k])
        conv.append(r)
    return spark.createDataFrame(_rows(FACT_SALES, conv), FACT_SALES)


def products(spark, rows):
    return spark.createDataFrame(_rows(DIM_PRODUCTS, rows), DIM_PRODUCTS)


def customers(spark, rows):
    conv = []
    for r in rows:
        r = dict(r)
        for k in ("birthdate", "create_date"):
            if k in r:
                r[k] = d(r[k])
        conv.append(r)
    return spark.createDataFrame(_rows(DIM_CUSTOMERS, conv), DIM_CUSTOMERS)


def star(spark, fact_rows, product_rows=(), customer_rows=()):
    return Star(fact(spark, fact_rows), products(spark, product_rows), customers(spark, customer_rows))


def collect(df, *cols, order=None):
    """Rows as tuples of ``cols`` (all columns by default), sorted by ``order``."""
    cols = cols or tuple(df.columns)
    rows = [tuple(r[c] for c in cols) for r in df.collect()]
    if order is not None:
        idx = [cols.index(o) for o in order]
        rows.sort(key=lambda t: tuple((t[i] is not None, t[i]) for i in idx))
    return rows

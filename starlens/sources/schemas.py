"""Explicit schemas: the gold star schema and the raw test tables it is derived from.

Reading with a declared schema avoids inference jobs on large folders and
fails fast when a required column is missing.
"""

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- gold star schema ------------------------------------------------------

FACT_SALES = _schema(
    ("order_number", LongType()),
    ("product_key", LongType()),
    ("customer_key", LongType()),
    ("order_date", DateType()),
    ("shipping_date", DateType()),
    ("sales_amount", LongType()),
    ("quantity", IntegerType()),
    ("price", LongType()),
)

DIM_PRODUCTS = _schema(
    ("product_key", LongType()),
    ("product_name", StringType()),
    ("category", StringType()),
    ("subcategory", StringType()),
    ("cost", DoubleType()),
)

DIM_CUSTOMERS = _schema(
    ("customer_key", LongType()),
    ("customer_number", StringType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("birthdate", DateType()),
    ("create_date", DateType()),
)

STAR = {
    "fact_sales": FACT_SALES,
    "dim_products": DIM_PRODUCTS,
    "dim_customers": DIM_CUSTOMERS,
}

#: Identifiers are only compared and counted: whole numbers or text will do.
IDENTIFIERS = {"order_number", "product_key", "customer_key", "customer_number"}


def usable(declared: StructField, found: DataType) -> bool:
    """Whether a user's column can stand for a declared one: same kind, any width."""
    if declared.name in IDENTIFIERS:
        return isinstance(found, IntegralType | StringType)
    if isinstance(declared.dataType, DateType):
        return isinstance(found, DateType | TimestampType | TimestampNTZType)
    if isinstance(declared.dataType, NumericType):
        return isinstance(found, NumericType)
    return isinstance(found, type(declared.dataType))


# --- raw test tables (only the ones the star is derived from) --------------

LINEITEM = _schema(
    ("l_orderkey", LongType()),
    ("l_partkey", LongType()),
    ("l_suppkey", LongType()),
    ("l_linenumber", IntegerType()),
    ("l_quantity", DoubleType()),
    ("l_extendedprice", DoubleType()),
    ("l_discount", DoubleType()),
    ("l_tax", DoubleType()),
    ("l_returnflag", StringType()),
    ("l_linestatus", StringType()),
    ("l_shipdate", TimestampNTZType()),
)

ORDERS = _schema(
    ("o_orderkey", LongType()),
    ("o_custkey", LongType()),
    ("o_orderstatus", StringType()),
    ("o_totalprice", DoubleType()),
    ("o_orderdate", TimestampNTZType()),
    ("o_orderpriority", StringType()),
)

PART = _schema(
    ("p_partkey", LongType()),
    ("p_name", StringType()),
    ("p_brand", StringType()),
    ("p_type", StringType()),
    ("p_size", IntegerType()),
    ("p_retailprice", DoubleType()),
)

CUSTOMER = _schema(
    ("c_custkey", LongType()),
    ("c_name", StringType()),
    ("c_nationkey", IntegerType()),
    ("c_acctbal", DoubleType()),
    ("c_mktsegment", StringType()),
)

RAW = {"lineitem": LINEITEM, "orders": ORDERS, "part": PART, "customer": CUSTOMER}

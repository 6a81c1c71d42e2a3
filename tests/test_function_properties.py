"""Column expressions against pure-Python models of the reference's rules.

Each example is a batch of rows evaluated in one Spark job, so the random
search stays cheap.
"""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from starlens.functions import (
    bucket,
    concat_text,
    int_div,
    month_boundaries,
    pct_label,
    range_band,
    year_boundaries,
)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=60))
def test_datediff_counts_boundaries(spark, pairs):
    schema = StructType([StructField("a", DateType()), StructField("b", DateType())])
    df = spark.createDataFrame(pairs, schema)
    got = df.select(
        "a", "b", month_boundaries("a", "b").alias("m"), year_boundaries("a", "b").alias("y"),
        bucket("a", "month").alias("ms"), bucket("a", "year_start").alias("ys"),
    ).collect()
    for r in got:
        a, b = r["a"], r["b"]
        assert r["m"] == (b.year - a.year) * 12 + (b.month - a.month)
        assert r["y"] == b.year - a.year
        assert r["ms"] == a.replace(day=1) and r["ys"] == a.replace(month=1, day=1)


longs = st.integers(min_value=-(10**12), max_value=10**12)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), longs), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=80))
def test_int_div_truncates_toward_zero(spark, pairs):
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    got = spark.createDataFrame(pairs, schema).select("a", "b", int_div("a", "b").alias("q")).collect()
    for r in got:
        a, b = r["a"], r["b"]
        if a is None or b is None or b == 0:
            assert r["q"] is None
        else:
            q = abs(a) // abs(b)
            assert r["q"] == (q if (a >= 0) == (b > 0) else -q)


def short_text(x: float, places: int, exact: bool = False) -> str:
    """The percent label's number: round half up, no trailing zeros, no exponent.

    Spark rounds the decimal text of the double. That text is the shortest
    one on newer JVMs but may carry extra digits on older ones (JDK 17), in
    which case a value printed as an exact tie rounds like its binary value;
    ``exact=True`` models that reading.
    """
    source = Decimal(x) if exact else Decimal(repr(x))
    d = source.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)
    text = format(d, "f")
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return "0" if text in ("-0", "") else text


@SETTINGS
@given(
    st.lists(st.floats(min_value=0, max_value=100, allow_nan=False), min_size=1, max_size=80),
    st.sampled_from([2, 4]),
)
def test_pct_label_matches_model(spark, shares, places):
    df = spark.createDataFrame([(s,) for s in shares], StructType([StructField("s", DoubleType())]))
    for r in df.select("s", pct_label("s", places).alias("p")).collect():
        allowed = {short_text(r["s"], places) + "%", short_text(r["s"], places, exact=True) + "%"}
        assert r["p"] in allowed, r


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-10, max_value=2000, allow_nan=False)), min_size=1, max_size=80))
def test_range_band_first_match(spark, costs):
    edges = (100, 500, 1000)
    df = spark.createDataFrame([(c,) for c in costs], StructType([StructField("c", DoubleType())]))
    for r in df.select("c", range_band("c", edges).alias("b")).collect():
        c = r["c"]
        if c is not None and c < 100:
            want = "Below 100"
        elif c is not None and 100 <= c <= 500:
            want = "100-500"
        elif c is not None and 500 <= c <= 1000:
            want = "500-1000"
        else:
            want = "Above 1000"
        assert r["b"] == want, r


texts = st.one_of(st.none(), st.text(max_size=8))


@SETTINGS
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=60))
def test_concat_reads_null_as_empty(spark, pairs):
    schema = StructType([StructField("f", StringType()), StructField("l", StringType())])
    df = spark.createDataFrame(pairs, schema)
    for r in df.select("f", "l", concat_text("f", "l").alias("n")).collect():
        assert r["n"] == (r["f"] or "") + (r["l"] or "")

"""Column expressions with the reference's SQL semantics (all JVM-side built-ins)."""

from starlens.functions.classify import band_labels, first_match, range_band, sign_label
from starlens.functions.columns import as_col, as_cols
from starlens.functions.dates import (
    GRAINS,
    as_of_date,
    bucket,
    month_boundaries,
    month_label,
    month_number,
    month_start,
    year_boundaries,
    year_number,
    year_start,
)
from starlens.functions.numeric import (
    avg_of,
    int_div,
    is_integral,
    quotient,
    ratio,
    stable_avg,
    zero_to_null,
)
from starlens.functions.text import concat_text, full_name, pct_label, short_number

__all__ = [
    "GRAINS",
    "as_col",
    "as_cols",
    "as_of_date",
    "avg_of",
    "band_labels",
    "bucket",
    "concat_text",
    "first_match",
    "full_name",
    "int_div",
    "is_integral",
    "month_boundaries",
    "month_label",
    "month_number",
    "month_start",
    "pct_label",
    "range_band",
    "quotient",
    "ratio",
    "short_number",
    "sign_label",
    "year_boundaries",
    "year_number",
    "year_start",
    "stable_avg",
    "zero_to_null",
]

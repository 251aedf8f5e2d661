"""Column expressions; all of them stay inside Catalyst."""

from lakemart.functions.dates import (
    cursor_start,
    date_key,
    elapsed_hours,
    iso_weekday,
    month_date,
    month_key,
    time_slice,
)
from lakemart.functions.keys import name_parts, packed, source_of, surrogate_key, unpacked
from lakemart.functions.measures import (
    amount,
    count_where,
    mean,
    money,
    percent,
    ratio_if_positive,
    safe_divide,
    sum_or_zero,
    sum_where,
)

__all__ = [
    "amount",
    "count_where",
    "cursor_start",
    "date_key",
    "elapsed_hours",
    "iso_weekday",
    "mean",
    "money",
    "month_date",
    "month_key",
    "name_parts",
    "packed",
    "percent",
    "ratio_if_positive",
    "safe_divide",
    "source_of",
    "sum_or_zero",
    "sum_where",
    "surrogate_key",
    "time_slice",
    "unpacked",
]

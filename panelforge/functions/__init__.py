"""Column-level helpers, all built on ``pyspark.sql.functions`` (JVM side)."""

from panelforge.functions.columns import (  # noqa: F401
    case_label,
    compound_label,
    half_up,
    make_month_date,
    parse_date,
    ratio,
    round_to_class,
    split_year_month,
    threshold_flag,
    url_for,
    year_of_date_text,
    year_of_fiscal,
    year_of_iso_text,
)

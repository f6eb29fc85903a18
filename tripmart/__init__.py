"""tripmart: trip star-schema analytics on Spark DataFrames.

Typical use::

    from tripmart import (Period, build_dims, build_fact, conform, load_month, read_fact,
                          read_feed, star_view, to_layout, yoy)
    from tripmart.schemas import fact_schema
    dims, nov = build_dims(spark), Period("2023", "11")
    fact = to_layout(build_fact(read_feed(spark, "green", nov, landing), "green", nov, dims),
                     "green")
    good, rejects = conform(fact, "green")                     # warehouse types
    load_month(good, f"{warehouse}/fact_green", nov)          # idempotent month load
    green = read_fact(spark, f"{warehouse}/fact_green", fact_schema("green"))
    yoy(star_view(green, dims, include=("date", "payment")), "revenue", 2023, "November",
        by="payment_type")
"""

from .operators.audit import column_profile, fk_audit, key_collisions, key_misses, pk_audit
from .operators.dims import Dims, build_dim_date, build_dim_time, build_dims, dims_from_tables
from .operators.facts import build_fact
from .operators.keys import add_date_keys, add_flag_key, add_keys, add_time_keys
from .operators.metrics import (in_period, kpi_all, period_totals, share_of_total, star_rollup,
                                total_by, yoy)
from .operators.publish import (conform, export_month_csv, load_month, read_fact, to_layout,
                                write_table)
from .operators.star import star_view
from .period import Period, default_period
from .sources.feeds import read_feed
from .sources.landing import landing_status, manifest_from_paths

__all__ = [
    "Dims", "Period", "add_date_keys", "add_flag_key", "add_keys", "add_time_keys",
    "build_dim_date", "build_dim_time", "build_dims", "build_fact", "column_profile",
    "conform", "default_period", "export_month_csv", "dims_from_tables", "fk_audit", "in_period", "key_collisions",
    "key_misses", "kpi_all", "landing_status", "load_month", "manifest_from_paths",
    "period_totals", "pk_audit", "read_fact", "read_feed", "share_of_total", "star_rollup",
    "star_view", "to_layout", "total_by", "write_table", "yoy",
]

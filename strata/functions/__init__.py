from strata.functions.buckets import bucket, climate_zone
from strata.functions.columns import exact_avg, first_of, hours_between, order_spec, path_col, pct

__all__ = ["bucket", "climate_zone", "exact_avg", "first_of", "hours_between", "order_spec", "path_col", "pct"]

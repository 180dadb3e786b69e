from strata.operators.aggregate import decomposed_avg, group_profile
from strata.operators.clean import dedup_latest, require, stamp
from strata.operators.dimension import dense_index, dimension
from strata.operators.flatten import flatten
from strata.operators.joins import (ConstraintError, FanOutError, apply_defaults, assert_unique, bounded_broadcast, enrich,
                                    constraint_violations,
                                    insert_absent)
from strata.operators.order import ordered, top_k
from strata.operators.quality import (check_schema, duplicate_stats, missing_required, null_rates,
                                      numeric_columns, profile, range_stats, schema_holds, schema_report)
from strata.operators.rules import (QualityGateError, freshness, gate, null_threshold_check, route,
                                    sparse_groups, split, violation_counts, violations)
from strata.operators.series import explode_series, map_value
from strata.operators.setops import layer_counts
from strata.operators.window import latest, with_previous

__all__ = [
    "FanOutError", "QualityGateError", "apply_defaults", "assert_unique", "bounded_broadcast",
    "ConstraintError", "check_schema", "constraint_violations", "decomposed_avg", "dedup_latest", "dense_index", "dimension",
    "duplicate_stats", "enrich", "explode_series", "flatten", "freshness", "gate", "group_profile",
    "insert_absent", "latest", "layer_counts", "map_value", "missing_required",
    "null_rates", "null_threshold_check", "numeric_columns", "ordered", "profile", "range_stats",
    "require", "route", "schema_holds", "schema_report", "sparse_groups", "split", "stamp", "top_k",
    "violation_counts", "violations", "with_previous",
]

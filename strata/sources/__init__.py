from strata.sources.catalog import (create_namespace, register_product_views, register_table,
                                   repair)
from strata.sources.files import (read_bronze, read_csv, read_increment, read_json_lines, read_partitions,
                                  with_source_file)
from strata.sources.jdbc import execute_query, extract_incremental, extract_table
from strata.sources.payloads import land, read_envelope, split_payloads, triage

__all__ = [
    "create_namespace", "execute_query", "extract_incremental", "extract_table",
    "land", "read_bronze", "read_csv", "read_envelope", "read_increment", "read_json_lines",
    "read_partitions", "register_product_views", "register_table", "repair", "split_payloads", "triage", "with_source_file",
]
